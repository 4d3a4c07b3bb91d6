"""Registered queries and the batch jobs built on the operators."""

"""Reusable DataFrame operators for batch tables and event streams."""

from tablewright.session import build_session, run_folder, settle, shared_folder

__all__ = ["build_session", "run_folder", "settle", "shared_folder"]

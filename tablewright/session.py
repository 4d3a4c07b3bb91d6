"""Session construction and the shared scratch folder."""

from __future__ import annotations

import configparser
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(
    app: str, conf: Mapping[str, str] | None = None, master: str | None = None
) -> SparkSession:
    """A session with adaptive execution on; ``conf`` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**ADAPTIVE, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def read_conf(path: str, section: str = "SPARK_APP_CONFIGS") -> dict[str, str]:
    """Spark settings kept in one section of an ini file."""
    parser = configparser.ConfigParser()
    parser.optionxform = str
    if not parser.read(path):
        raise FileNotFoundError(path)
    return dict(parser.items(section))


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings that hold inside the block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A machine-local folder is made up only for a local session that names none.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="tablewright-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def run_folder(spark: SparkSession, label: str) -> str:
    """A folder name below the shared folder that no earlier run has used."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and cut its lineage.

    Needed where a column must keep one value however often it is read, and
    between the rounds of an iterative job.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)

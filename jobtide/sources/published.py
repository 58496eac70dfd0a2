"""Versions of a set of tables, of which readers see one.

A version is written to a folder of its own and says nothing to readers.  What they see is the
last line of a log; a line is a file of its own, which appears when its write commits.  So a
job that dies, or whose tables are found wanting, leaves readers with the version they had, and
one who reads an older version goes on reading it.  One job at a time may announce versions.
"""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "number bigint, version string"


def new_version() -> str:
    return uuid.uuid4().hex


def version_folder(root: str, version: str) -> str:
    return f"{root}/versions/{version}"


def announced(spark: SparkSession, root: str) -> DataFrame | None:
    """The log, or None if nothing was ever announced."""
    try:
        return spark.read.schema(LOG).json(f"{root}/log")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version readers see."""
    log = announced(spark, root)
    last = log.agg(F.max(F.struct("number", "version")).alias("last")).first() if log is not None else None
    return last["last"]["version"] if last and last["last"] else None


def announce(spark: SparkSession, root: str, version: str) -> None:
    """Let readers see a version, by one line that is there or not."""
    log = announced(spark, root)
    number = 1 if log is None else (log.agg(F.max("number")).first()[0] or 0) + 1
    line = spark.range(1).select(F.lit(number).cast("bigint").alias("number"), F.lit(version).alias("version"))
    line.coalesce(1).write.mode("append").json(f"{root}/log")


class NothingPublishedError(RuntimeError):
    """There is no version to read."""


def current_folder(spark: SparkSession, root: str) -> str:
    version = current_version(spark, root)
    if version is None:
        raise NothingPublishedError(f"nothing is published below {root}")
    return version_folder(root, version)

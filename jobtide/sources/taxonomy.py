"""The skill taxonomy seed."""

import csv
from collections.abc import Iterable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from jobtide.functions.skills import Skill
from jobtide.schemas import TAXONOMY

SEED = Path(__file__).parents[1] / "seeds" / "skill_taxonomy.csv"


def default_skills() -> list[Skill]:
    """The taxonomy shipped with the package, read where the plan is built."""
    with SEED.open(encoding="utf-8", newline="") as file:
        rows = csv.DictReader(line for line in file if not line.startswith("#"))
        return [Skill(**{**row, "case_sensitive": int(row["case_sensitive"])}) for row in rows]


def taxonomy_frame(spark: SparkSession, skills: Iterable[Skill]) -> DataFrame:
    """Skills as a local relation: Spark knows its size and broadcasts by it."""
    rows = pa.Table.from_pylist([row._asdict() for row in skills])
    return spark.createDataFrame(rows, TAXONOMY)


def default_taxonomy(spark: SparkSession) -> DataFrame:
    return taxonomy_frame(spark, default_skills())


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """A taxonomy CSV from storage that every executor can reach."""
    return spark.read.schema(TAXONOMY).csv(path, header=True, comment="#")

"""The model build: raw postings to published marts, checks included."""

import logging
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession

from jobtide.plans import marts, quality, staging
from jobtide.schemas import MARTS
from jobtide.sources.published import announce, current_folder, new_version, version_folder
from jobtide.sources.tables import read_mart, read_raw, write_mart

log = logging.getLogger(__name__)

AUDIT = "check_name string, severity string, n_failed bigint, status string"


def views(raw: DataFrame) -> dict[str, DataFrame]:
    """The lazy relations, which are never written."""
    return {"stg_jobs": staging.stg_jobs(raw), "int_jobs_latest": staging.jobs_latest(raw)}


def build_marts(
    raw: DataFrame, taxonomy: DataFrame, root: str, postings: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Write all marts, each from the written ones before it.

    The raw table is shuffled once, for the fact table, unless its rows are given; what follows
    reads the written fact table, and the trend reads two columns of the raw table.
    """
    stg = staging.stg_jobs(raw)
    if postings is None:
        postings = marts.fct_job_postings(raw)
    postings = write_mart(postings, root, "fct_job_postings")
    mentions = write_mart(
        marts.fct_skill_mentions(postings, taxonomy), root, "fct_skill_mentions"
    )
    write_mart(marts.agg_skill_demand(mentions, postings), root, "agg_skill_demand")
    write_mart(marts.agg_salary_benchmarks(postings), root, "agg_salary_benchmarks")
    write_mart(marts.agg_skill_by_snapshot(stg), root, "agg_skill_by_snapshot")
    return {name: read_mart(raw.sparkSession, root, name) for name in MARTS}


def audit(
    raw: DataFrame,
    taxonomy: DataFrame,
    built: dict[str, DataFrame],
    folder: str,
    checks: Sequence[quality.Check] = quality.CHECKS,
) -> DataFrame:
    """The outcome of the checks on written marts, kept beside them whatever it is."""
    relations = {"raw_job_postings": raw, "skill_taxonomy": taxonomy, **views(raw), **built}
    path = f"{folder}/audit"
    quality.summary(relations, checks).coalesce(1).write.mode("overwrite").parquet(path)
    return raw.sparkSession.read.schema(AUDIT).parquet(path)


def publish(
    raw: DataFrame,
    taxonomy: DataFrame,
    root: str,
    checks: Sequence[quality.Check] = quality.CHECKS,
    postings: DataFrame | None = None,
) -> list:
    """Write the marts as a new version, check that version, and only then let readers see it.

    Warnings are reported in the rows handed back; errors raise, and readers keep the version
    they had.  The rejected version stays in its folder with the outcome of its checks.
    """
    version = new_version()
    folder = version_folder(root, version)
    built = build_marts(raw, taxonomy, folder, postings)
    rows = quality.enforce(audit(raw, taxonomy, built, folder, checks))
    announce(raw.sparkSession, root, version)
    return rows


def require_fresh(raw: DataFrame, now: datetime) -> Row:
    """The age of the newest row as of ``now``; too old a table raises, an old one is reported."""
    found = quality.freshness(raw, now).first()
    if found.status == quality.ERROR:
        raise quality.QualityError(f"the raw table was last loaded at {found.max_loaded_at}")
    if found.status == quality.WARN:
        log.warning("the raw table was last loaded at %s", found.max_loaded_at)
    return found


def build(
    spark: SparkSession,
    table: str,
    taxonomy: DataFrame,
    root: str,
    checks: Sequence[quality.Check] = quality.CHECKS,
    now: datetime | None = None,
) -> list:
    """Publish the marts of the stored raw table; with ``now``, only of one that is fresh."""
    raw = read_raw(spark, table)
    if now is not None:
        require_fresh(raw, now)
    return publish(raw, taxonomy, root, checks)


def published_marts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All marts, of one and the same version."""
    folder = current_folder(spark, root)
    return {name: read_mart(spark, folder, name) for name in MARTS}


def open_views(spark: SparkSession, table: str, taxonomy: DataFrame, root: str) -> None:
    """Name every relation, so that ``spark.sql`` can read it.

    The small aggregates are cached: reports read them again and again.
    """
    raw = read_raw(spark, table)
    raw.createOrReplaceTempView("raw_job_postings")
    taxonomy.createOrReplaceTempView("skill_taxonomy")
    for name, view in views(raw).items():
        view.createOrReplaceTempView(name)
    for name, mart in published_marts(spark, root).items():
        (mart.cache() if name.startswith("agg_") else mart).createOrReplaceTempView(name)

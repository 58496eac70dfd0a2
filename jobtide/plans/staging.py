"""Staging and intermediate relations: lazy, composed by call."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide import fixed_values as V
from jobtide.functions.keys import job_identity, job_key, mention_id
from jobtide.functions.text import split_list
from jobtide.schemas import RAW


def timestamp_or_null(text: Column) -> Column:
    """Wall-clock time in mixed text; a zone suffix is dropped, not applied.

    Spark alone would also read a bare year, month or time of day.
    """
    dated = F.when(text.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}"), text)
    return dated.try_cast("timestamp_ntz")


def _fetched_at() -> Column:
    return F.col("fetched_at").cast("timestamp_ntz").alias("fetched_at")


def _snapshot_date() -> Column:
    return F.col("snapshot_date").cast("date").alias("snapshot_date")


def stg_jobs(raw: DataFrame, *also: str) -> DataFrame:
    """Typed postings, one row per (source, external_id, snapshot_date).

    ``also`` names further columns to carry along.
    """
    located = F.lower("location_text")
    return raw.select(
        job_key(F.col("source"), F.col("external_id")).alias("job_key"),
        "source",
        "external_id",
        F.trim("title").alias("title"),
        F.trim("company").alias("company"),
        F.coalesce(
            F.nullif(F.trim("location_text"), F.lit("")), F.lit(V.UNKNOWN_LOCATION)
        ).alias("location_text"),
        "tags",
        "description_text",
        "skills",
        "seniority",
        "role_family",
        F.col("salary_min_usd").cast("double").alias("salary_min_usd"),
        F.col("salary_max_usd").cast("double").alias("salary_max_usd"),
        "salary_source",
        timestamp_or_null(F.col("posted_at")).alias("posted_at"),
        "url",
        _fetched_at(),
        _snapshot_date(),
        located.rlike(V.GLOBALLY_REMOTE).alias("globally_remote"),
        located.rlike(V.MENTIONS_PAKISTAN).alias("mentions_pakistan"),
        *also,
    )


# What versions of a posting are ordered by: last fetched, then last snapshot.
_VERSION_ORDER = ("fetched_at", "snapshot_date")


def latest_versions(
    raw: DataFrame, columns: Sequence[str], aggregates: Sequence[Column] = ()
) -> DataFrame:
    """Latest raw version of each posting, beside other aggregates over its versions.

    An aggregate over a struct whose leading fields are the order: each map task
    sends at most one row per posting, however many rows a posting holds.  The
    other fields settle ties, so a recomputed task picks the same row again.  A hash leads the
    key: postings of a source begin alike, and a sort compares whole texts where beginnings tie.
    """
    held = [c for c in columns if c not in _VERSION_ORDER]
    picked = F.max(F.struct(_fetched_at(), _snapshot_date(), *held)).alias("_latest")
    identity = job_identity(F.col("source"), F.col("external_id"))
    keys = F.xxhash64(identity).alias("_hash"), identity.alias("_identity")
    return raw.groupBy(*keys).agg(picked, *aggregates)


def jobs_latest(raw: DataFrame) -> DataFrame:
    """Latest version of each posting, typed; one row per job_key.

    Versions are picked before they are typed: hashing, patterns and timestamps
    then cost once per posting instead of once per version.
    """
    columns = [c for c in RAW.names if c in raw.columns]
    return stg_jobs(latest_versions(raw, columns).select("_latest.*"))


def explode_skills(postings: DataFrame, *keep: str) -> DataFrame:
    """One row per piece of ``skills``, trimmed; empty pieces stay."""
    return (
        postings.where("skills is not null and skills <> ''")
        .select(*keep, F.explode(split_list(F.col("skills"))).alias("skill"))
        .withColumn("skill", F.trim("skill"))
    )


def with_skill_category(mentions: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Inner join on skill, which drops skills the taxonomy does not hold.

    The taxonomy is a small seed, so Spark broadcasts it by its size.
    """
    categories = taxonomy.select("skill", F.col("category").alias("skill_category"))
    return mentions.join(categories, "skill")


def skill_mentions(raw: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """One row per (job_key, skill) of the latest version of each posting."""
    latest = latest_versions(raw, ["skills"]).select(
        F.md5("_identity").alias("job_key"), "_latest.skills"
    )
    return with_skill_category(explode_skills(latest, "job_key"), taxonomy).select(
        mention_id(F.col("job_key"), F.col("skill")).alias("mention_id"),
        "job_key",
        "skill",
        "skill_category",
    )

"""Mart relations."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide import fixed_values as V
from jobtide.functions.keys import job_identity, mention_id
from jobtide.functions.numbers import percent, salary_midpoint
from jobtide.operators.quantiles import exact_quantiles, histogram
from jobtide.plans.staging import (
    explode_skills,
    latest_versions,
    stg_jobs,
    with_skill_category,
)
from jobtide.schemas import FCT_JOB_POSTINGS, RAW

# What the fact table takes from the latest version.  The description, by far
# the widest column, is not among them and so never leaves the scan.
LATEST_COLUMNS = tuple(c for c in RAW.names if c != "description_text")


def _lifecycle() -> list[Column]:
    """Aggregates over the snapshots of one posting.

    The set of dates is bounded by the number of snapshots, however many rows a
    key holds.
    """
    day = F.col("snapshot_date").cast("date")
    return [
        F.min(day).alias("first_seen_date"),
        F.max(day).alias("last_seen_date"),
        F.size(F.collect_set(day)).cast("long").alias("snapshots_present"),
    ]


_LIFECYCLE = ("first_seen_date", "last_seen_date", "snapshots_present")


def job_lifecycle(raw: DataFrame) -> DataFrame:
    """First and last snapshot and number of snapshots, per job_key."""
    identity = job_identity(F.col("source"), F.col("external_id")).alias("_identity")
    seen = raw.groupBy(identity).agg(*_lifecycle())
    return seen.select(F.md5("_identity").alias("job_key"), *_LIFECYCLE)


def fct_job_postings(raw: DataFrame) -> DataFrame:
    """Latest version plus lifecycle, one row per job_key.

    Both parts group by the same key, so they are one aggregation with one
    shuffle instead of a window, an aggregation and a join.
    """
    named = raw.where("source is not null and external_id is not null")
    jobs = latest_versions(named, LATEST_COLUMNS, _lifecycle()).select(
        "_latest.*", F.lit(None).cast("string").alias("description_text"), *_LIFECYCLE
    )
    return fact_rows(jobs, raw.agg(F.max(F.col("snapshot_date").cast("date"))).scalar())


def fact_rows(jobs: DataFrame, market_snapshot: Column) -> DataFrame:
    """Latest versions with their lifecycle as rows of the fact table."""
    days = F.datediff("last_seen_date", "first_seen_date")
    return (
        stg_jobs(jobs, *_LIFECYCLE)
        .withColumns(
            {
                "salary_mid_usd": salary_midpoint(F.col("salary_min_usd"), F.col("salary_max_usd")),
                "days_listed_observed": F.greatest(days, F.lit(0)).cast("long"),
                "is_active": F.col("last_seen_date") == market_snapshot,
            }
        )
        .select(*FCT_JOB_POSTINGS.names)
    )


def fct_skill_mentions(postings: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """One row per (job, skill) of the latest version, with posting attributes.

    The fact table carries the skills of the latest version, so exploding it
    gives the join of mentions with postings without a second shuffle on the
    job key.
    """
    attributes = (
        "job_key",
        "role_family",
        "seniority",
        "salary_mid_usd",
        "globally_remote",
        "is_active",
        "first_seen_date",
    )
    return with_skill_category(explode_skills(postings, *attributes), taxonomy).select(
        mention_id(F.col("job_key"), F.col("skill")).alias("mention_id"),
        "job_key",
        "skill",
        "skill_category",
        *attributes[1:],
    )


def agg_skill_demand(mentions: DataFrame, postings: DataFrame) -> DataFrame:
    """Demand and median salary per skill over active postings."""
    demand = exact_quantiles(
        mentions.where("is_active"),
        ["skill", "skill_category"],
        "salary_mid_usd",
        {"median": 0.5},
    )
    total_active = postings.where("is_active").agg(F.count(F.lit(1))).scalar()
    return demand.where(F.col("n") >= V.MIN_GROUP_SIZE).select(
        "skill",
        "skill_category",
        F.col("n").alias("n_jobs"),
        F.round(percent(F.col("n"), total_active), 1).alias("share_of_active_pct"),
        F.round("median", 0).alias("median_salary_mid_usd"),
        F.col("n_valued").alias("n_with_salary"),
    )


def agg_salary_benchmarks(postings: DataFrame) -> DataFrame:
    """Salary quartiles per role family and seniority over all postings.

    Midpoints are whole dollars and the band bounds them, so a group has at most
    as many distinct values as the band has dollars; the quartiles are taken
    over those counts.
    """
    keys = ["role_family", "seniority"]
    banded = postings.where(F.col("salary_mid_usd").between(*V.SALARY_BAND))
    n = F.col("n")

    quartiles = F.percentile("salary_mid_usd", F.array(*map(F.lit, (0.25, 0.5, 0.75))), n)
    names = ("p25_usd", "median_usd", "p75_usd")
    return (
        histogram(banded, keys, "salary_mid_usd")
        .groupBy(*keys)
        .agg(F.sum(n).alias("n_postings"), quartiles.alias("_quartiles"))
        .where(F.col("n_postings") >= V.MIN_GROUP_SIZE)
        .select(
            *keys,
            "n_postings",
            *[F.round(F.col("_quartiles")[i], 0).alias(name) for i, name in enumerate(names)],
        )
    )


def agg_skill_by_snapshot(stg: DataFrame) -> DataFrame:
    """Postings per snapshot and skill, over every version seen.

    Counts skills outside the taxonomy and empty pieces too.
    """
    return (
        explode_skills(stg, "snapshot_date")
        .groupBy("snapshot_date", "skill")
        .agg(F.count(F.lit(1)).alias("n_jobs"))
    )

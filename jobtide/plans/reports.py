"""Report queries over the marts, the last steps included.

Nothing is collected on the way: each report is one DataFrame.  Ties are broken
by name, so that a top-k is the same on every run.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide import fixed_values as V
from jobtide.functions.numbers import percent, round_half_even
from jobtide.functions.text import java_regex
from jobtide.operators.quantiles import exact_quantiles


def active(postings: DataFrame) -> DataFrame:
    return postings.where("is_active")


def kpi_row(postings: DataFrame, demand: DataFrame) -> DataFrame:
    """The headline figures, one row."""
    current = active(postings)
    salary = exact_quantiles(current, [], "salary_mid_usd", {"median": 0.5})
    n_skills = demand.agg(F.count_distinct("skill"))
    n_open = current.agg(F.count_if("globally_remote"))
    return salary.select(
        F.coalesce("n", F.lit(0)).alias("active_postings"),
        n_skills.scalar().alias("distinct_skills"),
        F.coalesce("n_valued", F.lit(0)).alias("postings_with_salary"),
        percent(F.col("n_valued"), F.col("n")).alias("with_salary_pct"),
        F.col("median").alias("median_salary_usd"),
        n_open.scalar().alias("globally_open"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first, without NULL."""
    return (
        df.dropna(subset=[column])
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), column)
    )


def postings_by_family(postings: DataFrame) -> DataFrame:
    return value_counts(active(postings), "role_family")


def seniority_mix(postings: DataFrame) -> DataFrame:
    return value_counts(active(postings), "seniority")


def salary_coverage_by_source(postings: DataFrame) -> DataFrame:
    """Postings, postings with salary and coverage in percent, per source."""
    with_salary = F.col("salary_mid_usd").isNotNull()
    return (
        postings.groupBy("source")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(with_salary).alias("with_salary"))
        .withColumn("coverage", round_half_even(F.col("with_salary") / F.col("n") * 100, 1))
        .orderBy(F.desc("n"), "source")
    )


def top_skills(demand: DataFrame, k: int = V.TOP_SKILLS) -> DataFrame:
    """The ``k`` skills named by most active postings."""
    return demand.orderBy(F.desc("n_jobs"), "skill").limit(k)


def top_skill_trend(
    trend: DataFrame, demand: DataFrame, k: int = V.TREND_TOP_SKILLS
) -> DataFrame:
    """Trend rows of the ``k`` most demanded skills, oldest first."""
    top = top_skills(demand, k).select("skill")
    return trend.join(top, "skill", "left_semi").orderBy("snapshot_date", "skill")


def best_paid_skills(demand: DataFrame, k: int = V.SALARY_TOP_SKILLS) -> DataFrame:
    """The ``k`` skills with the highest median salary."""
    return (
        demand.dropna(subset=["median_salary_mid_usd"])
        .orderBy(F.desc("median_salary_mid_usd"), F.desc("n_jobs"), "skill")
        .limit(k)
    )


def chart_skill_share(
    demand: DataFrame, k: int = V.CHART_SKILLS, ascending: bool = True
) -> DataFrame:
    """Skills by share.  The published chart orders ascending, smallest first."""
    order = F.asc_nulls_last if ascending else F.desc_nulls_last
    return (
        demand.select("skill", "share_of_active_pct")
        .orderBy(order("share_of_active_pct"), "skill")
        .limit(k)
    )


def salary_bands(benchmarks: DataFrame) -> DataFrame:
    """Labelled salary bands in dollars and in thousands, lowest median first."""

    def thousands(column: str) -> Column:
        return (F.col(column) / 1000).alias(column.replace("_usd", "_k"))

    group = F.concat("role_family", F.lit(" · "), "seniority")
    label = F.concat(group, F.lit(" (n="), F.col("n_postings").cast("string"), F.lit(")"))
    bounds = ("p25_usd", "median_usd", "p75_usd")
    return benchmarks.select(
        group.alias("grp"), label.alias("label"), *bounds, *map(thousands, bounds)
    ).orderBy(F.asc_nulls_last("median_usd"), "grp")


def explorer(
    postings: DataFrame,
    search: str = "",
    families: Sequence[str] = (),
    seniorities: Sequence[str] = V.SENIORITIES,
    globally_open: bool = False,
) -> DataFrame:
    """Active postings that pass the filters, newest first, missing dates last.

    ``search`` is a regular expression on title or company, ignoring case.  An
    empty filter lets everything through.
    """
    view = active(postings)
    if search:
        pattern = java_regex("(?i)" + search)
        view = view.where(F.col("title").rlike(pattern) | F.col("company").rlike(pattern))
    if families:
        view = view.where(F.col("role_family").isin(list(families)))
    if seniorities:
        view = view.where(F.col("seniority").isin(list(seniorities)))
    if globally_open:
        view = view.where("globally_remote")
    return view.select(*V.EXPLORER_COLUMNS).orderBy(F.desc_nulls_last("posted_at"), "url")


def family_choices(postings: DataFrame) -> DataFrame:
    return active(postings).select("role_family").distinct().orderBy("role_family")


def taxonomy_list(taxonomy: DataFrame) -> DataFrame:
    return taxonomy.select("skill", "category")


def snapshots(raw: DataFrame) -> DataFrame:
    """The snapshot dates present, oldest first."""
    return raw.select("snapshot_date").distinct().orderBy("snapshot_date")


def raw_stats(raw: DataFrame) -> DataFrame:
    """Rows, distinct jobs, snapshots, first and last snapshot, one row.

    All but the jobs come from counts per snapshot, which read no data column of a
    stored table.  Dates are compared as dates, whose aggregates need no sort.
    """
    kind = raw.schema["snapshot_date"].dataType
    day = F.col("snapshot_date").try_cast("date")
    by_snapshot = raw.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"))
    job = F.concat("source", F.lit(":"), "external_id").alias("job")
    jobs = raw.select(job).where("job is not null").groupBy("job").agg(F.count(F.lit(1)))
    return by_snapshot.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        jobs.agg(F.count(F.lit(1))).scalar().alias("distinct_jobs"),
        F.count("snapshot_date").alias("snapshots"),
        F.min(day).cast(kind).alias("first_snap"),
        F.max(day).cast(kind).alias("latest_snap"),
    )


def batch_counts(batch: DataFrame) -> DataFrame:
    """Rows per source of one batch."""
    return batch.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def preview(batch: DataFrame, k: int = 8) -> DataFrame:
    """A few rows of a batch, as a glance at the enrichment."""
    return batch.select("title", "role_family", "seniority", "skills").limit(k)

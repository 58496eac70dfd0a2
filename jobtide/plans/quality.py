"""Data-quality checks.  A check gives its failing rows; none means it passed."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide import fixed_values as V

ERROR, WARN = "error", "warn"

Relations = Mapping[str, DataFrame]


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values held by more than one row; NULL is not a value."""
    return (
        df.dropna(subset=[column])
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where("n_records > 1")
    )


def unaccepted_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the accepted ones; NULL passes."""
    return (
        df.where(~F.col(column).isin(list(accepted)))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def orphan_rows(df: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Rows whose value the parent does not hold; NULL passes."""
    parents = parent.select(F.col(field).alias("_parent"))
    return df.where(F.col(column).isNotNull()).join(
        parents, F.col(column) == F.col("_parent"), "left_anti"
    )


def _is_anomalous() -> Column:
    low, high = F.col("salary_min_usd"), F.col("salary_max_usd")
    band_low, band_high = V.SALARY_BAND
    return (
        (low < band_low)
        | (high > band_high)
        | (low > high)
        | (high > low * V.MAX_SALARY_RATIO)
    )


def salary_anomalies(postings: DataFrame) -> DataFrame:
    """Salaries outside the band, inverted, or too wide apart."""
    return postings.where(_is_anomalous()).select(
        "job_key", "title", "salary_min_usd", "salary_max_usd"
    )


def _naive_utc(moment: datetime) -> datetime:
    return moment.astimezone(timezone.utc).replace(tzinfo=None) if moment.tzinfo else moment


def freshness(raw: DataFrame, *moments: datetime) -> DataFrame:
    """Age of the newest row against the two limits, as of each moment (UTC if naive).

    The raw table is read once, whatever the number of moments.
    """
    asked = F.array(*[F.lit(str(_naive_utc(m))).cast("timestamp_ntz") for m in moments])
    loaded = F.max(F.col("fetched_at").cast("timestamp_ntz"))
    seconds = F.timestamp_diff("SECOND", F.col("max_loaded_at"), F.col("checked_at"))
    return (
        raw.agg(loaded.alias("max_loaded_at"))
        .select("max_loaded_at", F.explode(asked).alias("checked_at"))
        .withColumn("age_days", seconds / F.lit(86400.0))
        .withColumn(
            "status",
            F.when(
                F.col("age_days").isNull() | (F.col("age_days") > V.FRESHNESS_ERROR_DAYS), ERROR
            )
            .when(F.col("age_days") > V.FRESHNESS_WARN_DAYS, WARN)
            .otherwise("pass"),
        )
    )


@dataclass(frozen=True)
class Check:
    """One check on one column of one relation."""

    kind: str
    relation: str
    column: str
    severity: str = ERROR
    accepted: tuple[str, ...] = ()
    parent: tuple[str, str] | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.relation}_{self.column}"

    def failing(self, relations: Relations) -> DataFrame:
        df = relations[self.relation]
        if self.kind == "not_null":
            return null_rows(df, self.column)
        if self.kind == "unique":
            return repeated_values(df, self.column)
        if self.kind == "accepted_values":
            return unaccepted_values(df, self.column, self.accepted)
        if self.kind == "relationships":
            name, field = self.parent
            return orphan_rows(df, self.column, relations[name], field)
        if self.kind == "salary_sanity":
            return salary_anomalies(df)
        raise ValueError(f"unknown kind of check: {self.kind}")


def _not_null(relation: str, *columns: str) -> list[Check]:
    return [Check("not_null", relation, column) for column in columns]


CHECKS: tuple[Check, ...] = (
    *_not_null("raw_job_postings", "source", "external_id", "title", "snapshot_date"),
    *_not_null("stg_jobs", "job_key", "source", "seniority", "role_family", "snapshot_date"),
    *_not_null("fct_job_postings", "job_key", "title", "seniority", "first_seen_date"),
    *_not_null("fct_skill_mentions", "mention_id", "skill"),
    *_not_null("agg_skill_demand", "skill"),
    *_not_null("agg_skill_by_snapshot", "skill"),
    Check("unique", "fct_job_postings", "job_key"),
    Check("unique", "fct_skill_mentions", "mention_id"),
    Check("unique", "agg_skill_demand", "skill"),
    Check("accepted_values", "stg_jobs", "source", accepted=V.SOURCES),
    Check("accepted_values", "stg_jobs", "seniority", accepted=V.SENIORITIES),
    Check("accepted_values", "fct_job_postings", "seniority", accepted=V.SENIORITIES),
    Check(
        "relationships", "fct_skill_mentions", "skill", parent=("skill_taxonomy", "skill")
    ),
    Check("salary_sanity", "fct_job_postings", "salary_mid_usd", severity=WARN),
)


# Kinds that a condition on single rows decides.
_BY_ROW = {
    "not_null": lambda check: F.col(check.column).isNull(),
    "salary_sanity": lambda check: _is_anomalous(),
}


def _row_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``check_name`` and ``n_failed`` of all checks on single rows, in one pass."""
    counted = df.agg(
        *[F.count_if(_BY_ROW[check.kind](check)).alias(check.name) for check in checks]
    )
    return counted.unpivot([], [check.name for check in checks], "check_name", "n_failed")


def summary(relations: Relations, checks: Sequence[Check] = CHECKS) -> DataFrame:
    """One row per check: name, severity, number of failing rows and status.

    Checks on relations that are not given are left out.  All checks on single
    rows of a relation share one scan.
    """
    checks = [check for check in checks if check.relation in relations]
    by_row = [check for check in checks if check.kind in _BY_ROW]
    parts = []
    for relation in dict.fromkeys(check.relation for check in by_row):
        group = [check for check in by_row if check.relation == relation]
        parts.append(_row_counts(relations[relation], group))
    for check in checks:
        if check not in by_row:
            parts.append(
                check.failing(relations).agg(
                    F.lit(check.name).alias("check_name"), F.count(F.lit(1)).alias("n_failed")
                )
            )
    counts = reduce(DataFrame.unionByName, parts)
    warns = [check.name for check in checks if check.severity == WARN]
    severity = F.when(F.col("check_name").isin(warns), WARN).otherwise(ERROR)
    return counts.withColumn("severity", severity).select(
        "check_name",
        "severity",
        "n_failed",
        F.when(F.col("n_failed") == 0, "pass").otherwise(F.col("severity")).alias("status"),
    )


class QualityError(RuntimeError):
    """A check of severity error found failing rows."""


def enforce(outcome: DataFrame) -> list:
    """Stop on errors, hand back the summary rows (one per check) otherwise."""
    rows = outcome.collect()
    failed = [f"{row.check_name} ({row.n_failed})" for row in rows if row.status == ERROR]
    if failed:
        raise QualityError("failing rows in: " + ", ".join(sorted(failed)))
    return rows

"""Exact interpolated quantiles per group, without holding a group anywhere."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


SLICES = 4096
# How often a crowded cell is cut again; each time by the least and most of what it holds.
CUTS = 2


def histogram(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct values per group, NULL included, with their frequency ``n``."""
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def _any(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
) -> DataFrame:
    """Per group: ``n`` rows, ``n_valued`` rows with a value, and the quantiles.

    Rows collapse into counts per distinct value before anything else.  A coarse
    pass adds up buckets of values about one percent wide (under 150,000 cover
    all doubles) and finds those that hold a wanted rank.  Each of ``CUTS`` further
    passes does the same for ``SLICES`` even slices of what is left, between the
    least and the most value there, and only the last slices that hold a rank are
    ordered value by value.  So a task sees the buckets of a group, the slices of a
    cell or the values of a last slice, never a group, and values that crowd in one
    slice are spread by the next cut.

    The joins are null-safe throughout, so that no filter is inferred for one side
    only and Spark can reuse a shuffle.
    """
    keys = list(keys)
    counts = histogram(
        df.select(*keys, F.col(value).alias("_value")), keys, "_value"
    ).withColumn("_bucket", F.round(F.asinh("_value"), 2))

    def rank(q: float) -> Column:
        return F.lit(float(q)) * (F.col("_valued") - 1)

    def holds_rank(before: str, end: str) -> Column:
        return _any(
            (F.col(before) <= F.ceil(rank(q))) & (F.floor(rank(q)) < F.col(end))
            for q in quantiles.values()
        )

    def joined(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
        right = right.withColumnsRenamed({name: f"_of_{name}" for name in names})
        same = _all(F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in names)
        return left.join(right, same).drop(*[f"_of_{name}" for name in names])

    group = W.partitionBy(*(keys or [F.lit(0)]))
    valued = F.when(F.col("_bucket").isNotNull(), F.col("_held"))
    buckets = (
        counts.groupBy(*keys, "_bucket")
        .agg(
            F.sum("n").alias("_held"),
            F.min("_value").alias("_least"),
            F.max("_value").alias("_most"),
        )
        .select(
            *keys,
            "_bucket",
            "_least",
            "_most",
            F.sum(valued).over(group.orderBy("_bucket")).alias("_end"),
            F.col("_held"),
            F.sum("_held").over(group).alias("_rows"),
            F.coalesce(F.sum(valued).over(group), F.lit(0)).alias("_valued"),
        )
        .withColumn("_before", F.col("_end") - F.col("_held"))
    )
    # The bucket without value stays, for groups that have no other.
    holding = buckets.where(F.col("_bucket").isNull() | holds_rank("_before", "_end")).drop(
        "_end", "_held"
    )

    def cut(rows: DataFrame, cell: list[str], name: str) -> DataFrame:
        """``rows`` of the slices of their cells that hold a wanted rank."""
        width = F.col("_most") - F.col("_least")
        place = F.floor((F.col("_value") - F.col("_least")) / width * SLICES)
        sliced = rows.withColumn(name, F.when(width > 0, place).otherwise(0))
        slices = (
            sliced.groupBy(*cell, name)
            .agg(
                F.sum("n").alias("_held"),
                F.max("_before").alias("_base"),
                F.max("_valued").alias("_valued"),
                F.min("_value").alias("_first"),
                F.max("_value").alias("_last"),
            )
            .withColumn(
                "_end", F.col("_base") + F.sum("_held").over(W.partitionBy(*cell).orderBy(name))
            )
            .withColumn("_start", F.col("_end") - F.col("_held"))
            .where(F.col("_bucket").isNull() | holds_rank("_start", "_end"))
            .select(*cell, name, "_start", "_first", "_last")
        )
        return joined(sliced.drop("_before", "_least", "_most"), slices, [*cell, name]).withColumnsRenamed(
            {"_start": "_before", "_first": "_least", "_last": "_most"}
        )

    cell = [*keys, "_bucket"]
    ranked = joined(counts, holding, cell)
    for name in [*(f"_part_{number}" for number in range(1, CUTS)), "_slice"]:
        ranked = cut(ranked, cell, name)
        cell = [*cell, name]
    ranked = ranked.withColumn(
        "_end", F.col("_before") + F.sum("n").over(W.partitionBy(*cell).orderBy("_value"))
    ).withColumn("_start", F.col("_end") - F.col("n"))

    def value_at(position: Column) -> Column:
        inside = (F.col("_start") <= position) & (position < F.col("_end"))
        return F.max(F.when(inside, F.col("_value")))

    found = ranked.groupBy(*keys).agg(
        F.max("_rows").alias("n"),
        F.max("_valued").alias("_valued"),
        *[value_at(F.floor(rank(q))).alias(f"_low_{name}") for name, q in quantiles.items()],
        *[value_at(F.ceil(rank(q))).alias(f"_high_{name}") for name, q in quantiles.items()],
    )

    def interpolated(name: str, q: float) -> Column:
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        return low + (high - low) * (rank(q) - F.floor(rank(q)))

    return found.select(
        *keys,
        "n",
        F.col("_valued").alias("n_valued"),
        *[interpolated(name, q).alias(name) for name, q in quantiles.items()],
    )

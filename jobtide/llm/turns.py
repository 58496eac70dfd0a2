"""Conversations cut into blocks of turns, so that none of any length is held at once."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.common import settle


def cut(
    turns: DataFrame, order: list[str], size: int, folder: str
) -> tuple[DataFrame, DataFrame | None]:
    """The turns of short conversations, and those of long ones with their ``place``.

    ``turns`` has ``conv_id`` and the columns of ``order``, by which the turns of a conversation
    follow each other (nulls first).  Conversations of up to ``size`` turns come as they are;
    the others with the number of turns before each, from 0.  They are None if there are none.
    A long conversation is sorted in ranges by several tasks and counted by range.  A null
    ``conv_id`` is a conversation like any other.
    """
    long_ = settle(
        turns.groupBy("conv_id").agg(F.count("*").alias("n")).where(F.col("n") > size)
        .select(F.col("conv_id").alias("long_id")),
        folder,
        "long",
    )
    if long_.isEmpty():
        return turns, None
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    keys = ["conv_id", *order]
    ranged = settle(
        turns.join(long_, same, "left_semi")
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("part", F.spark_partition_id())
        .withColumn("row", F.monotonically_increasing_id()),
        folder,
        "ranged",
    )
    parts = ranged.groupBy("conv_id", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = settle(
        parts.select(
            F.col("conv_id").alias("long_id"),
            F.col("part").alias("long_part"),
            (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        ),
        folder,
        "starts",
    )
    placed = ranged.join(starts, same & (F.col("part") == F.col("long_part"))).select(
        *turns.columns, (F.col("row") + F.col("shift")).alias("place")
    )
    return turns.join(long_, same, "left_anti"), placed

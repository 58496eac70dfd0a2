"""Continuous ingest: newly landed files trigger the ingest of their snapshot.

A stream of file paths says which (snapshot, board) pairs have new payloads.
Each such pair is ingested again from all its landed files, so a payload that
arrives late, or in a later micro-batch, replaces its partition by the whole and
never by a part.  Running a micro-batch twice gives the same tables.  A board that fails
stops the query after the others are stored, and is taken up again by the next run.
"""

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from jobtide import fixed_values as V
from jobtide.functions.skills import Skill
from jobtide.plans.ingest import extract_all, store_batches

# <landing>/<snapshot_date>/<board>/..., see plans.ingest
_PLACE = r"/(\d{4}-\d{2}-\d{2})/(" + "|".join(V.SOURCES) + r")/"


def landed_places(files: DataFrame) -> DataFrame:
    """The distinct ``snapshot_date`` and ``source`` of landed files."""
    return (
        files.select(
            F.regexp_extract("path", _PLACE, 1).alias("snapshot_date"),
            F.regexp_extract("path", _PLACE, 2).alias("source"),
        )
        .where(F.col("snapshot_date") != "")
        .distinct()
    )


class FailedBoardsError(RuntimeError):
    """Boards whose payloads could not be read; all others of the batch are stored."""


def _now() -> datetime:
    return datetime.now(timezone.utc)


def ingest_landed(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    skills: Sequence[Skill],
    now: Callable[[], datetime] = _now,
) -> StreamingQuery:
    """Start a query that ingests what has landed since its last run, then ends."""

    def ingest(files: DataFrame, _batch_id: int) -> None:
        # A few boards times the snapshots that have new files.
        places: dict[str, list[str]] = {}
        for place in landed_places(files).collect():
            places.setdefault(place.snapshot_date, []).append(place.source)
        failed = []
        for snapshot_date, sources in sorted(places.items()):
            batches = extract_all(
                files.sparkSession, landing, snapshot_date, now(), skills, sources
            )
            stored = store_batches(batches, table)
            failed += [(snapshot_date, source) for source in sources if source not in stored.seen]
        if failed:
            # The batch is not committed, so the next run takes these places up again.
            raise FailedBoardsError(failed)

    paths = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json")
        .load(landing)
        .select("path")
    )
    return (
        paths.writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

"""The fact table kept up to date from changed partitions alone.

The state has a row per posting: its winning version, and the snapshots that hold it as a bitmap.
An update reads the partitions of the raw table whose files are not those of the last update,
aggregates them by posting and merges the result into the state.  Bits of a replaced partition
are cleared first.  Where a replaced partition held the winning version and its new rows hold
no later one, the winner is looked up again, for those postings only and only in the partitions
that their bitmaps name.  Each update is a version of its own and shows when it is complete.
"""

import hashlib
from collections import defaultdict
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.functions.keys import job_identity
from jobtide.plans import marts
from jobtide.plans.staging import latest_versions
from jobtide.sources.published import announce, current_folder, current_version, new_version, version_folder
from jobtide.sources.tables import read_raw, scratch_folder

Partition = tuple[str | None, str | None]  # snapshot_date, source

_WORD = 64
_PARTITIONS = "snapshot_date string, source string, ordinal int, files string, stored boolean"
_NULL = "__HIVE_DEFAULT_PARTITION__"


def stored_partitions(spark: SparkSession, table: str) -> dict[Partition, str]:
    """The partitions of the raw table, each with a digest of the names of its files."""
    names = defaultdict(list)
    try:
        files = read_raw(spark, table).inputFiles()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = []
    for path in files:
        *_, day, source, name = path.split("/")
        values = [unquote(part.split("=", 1)[1]) for part in (day, source)]
        names[tuple(None if v == _NULL else v for v in values)].append(name)
    return {p: hashlib.sha256("\n".join(sorted(n)).encode()).hexdigest() for p, n in names.items()}


def _in(partitions: list[Partition]) -> Column:
    """Whether a raw row lies in one of the partitions; Spark prunes by it."""
    days = defaultdict(list)
    for day, source in partitions:
        days[source].append(day)

    def held(source: str | None) -> Column:
        known = [d for d in days[source] if d is not None]
        found = F.col("snapshot_date").isin(known) if known else F.lit(False)
        if None in days[source]:
            found = found | F.col("snapshot_date").isNull()
        own = F.col("source").isNull() if source is None else F.col("source") == source
        return own & found

    return reduce(lambda a, b: a | b, map(held, days), F.lit(False))


def _words(ordinals: Column, size: int) -> Column:
    """A bitmap of ``size`` words with the given bits."""

    def word(w: Column) -> Column:
        own = F.filter(ordinals, lambda o: F.floor(o / _WORD) == w)
        bit = lambda o: F.call_function("shiftleft", F.lit(1).cast("bigint"), (o % _WORD).cast("int"))
        return F.aggregate(own, F.lit(0).cast("bigint"), lambda held, o: held.bitwiseOR(bit(o)))

    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), word)


def _bit(ordinal: int) -> int:
    """The bit of an ordinal in its word, as a signed number."""
    bit = 1 << ordinal % _WORD
    return bit - (1 << _WORD) if bit >> (_WORD - 1) else bit


def _word_at(words: Column, place: int) -> Column:
    return F.coalesce(F.get(words, F.lit(place)), F.lit(0).cast("bigint"))


def _set_bits(words: Column) -> Column:
    """The numbers of the bits that are set."""
    places = F.sequence(F.lit(0), F.size(words) * _WORD - 1)

    def is_set(o: Column) -> Column:
        word = F.element_at(words, F.floor(o / _WORD).cast("int") + 1)
        return F.call_function("shiftright", word, (o % _WORD).cast("int")).bitwiseAND(F.lit(1)) == 1

    return F.filter(places, is_set)


def _versions(raw: DataFrame, ordinals: dict[str | None, int], size: int) -> DataFrame:
    """``hash, identity, latest, seen`` of the postings in some partitions of the raw table."""
    bit, place = F.lit(0).cast("bigint"), F.lit(0)
    for day, ordinal in ordinals.items():
        same = F.col("snapshot_date").isNull() if day is None else F.col("snapshot_date") == day
        bit = F.when(same, F.lit(_bit(ordinal)).cast("bigint")).otherwise(bit)
        place = F.when(same, F.lit(ordinal // _WORD)).otherwise(place)
    named = raw.where("source is not null and external_id is not null")
    named = named.withColumns({"_bit": bit, "_place": place})
    words = [
        F.bit_or(F.when(F.col("_place") == w, F.col("_bit")).otherwise(F.lit(0))).alias(f"_word_{w}")
        for w in range(size)
    ]
    return latest_versions(named, marts.LATEST_COLUMNS, words).select(
        F.col("_hash").alias("hash"),
        F.col("_identity").alias("identity"),
        F.col("_latest").alias("latest"),
        F.array(*[F.col(f"_word_{w}") for w in range(size)]).alias("seen"),
    )


def _partition_rows(spark: SparkSession, folder: str) -> list:
    return spark.read.schema(_PARTITIONS).parquet(f"{folder}/partitions").collect()


def update(spark: SparkSession, table: str, root: str) -> str | None:
    """Bring the state below ``root`` up to the raw table; the version that holds it.

    A first update reads the whole table; one that finds no changed partition writes nothing.
    """
    version = current_version(spark, root)
    folder = version_folder(root, version) if version else None
    rows = _partition_rows(spark, folder) if folder else []
    ordinals = {r["snapshot_date"]: r["ordinal"] for r in rows}
    before = {(r["snapshot_date"], r["source"]): r["files"] for r in rows if r["stored"]}
    now = stored_partitions(spark, table)
    changed = [p for p in now if before.get(p) != now[p]]
    replaced = [p for p in before if before[p] != now.get(p)]
    if not changed and not replaced:
        return version
    for day in sorted({p[0] for p in changed} - ordinals.keys(), key=lambda d: (d is not None, d)):
        ordinals[day] = len(ordinals)
    size = len(ordinals) // _WORD + 1
    raw = read_raw(spark, table)
    delta = _versions(raw.where(_in(changed)), {p[0]: ordinals[p[0]] for p in changed}, size)
    if folder:
        state = spark.read.parquet(f"{folder}/state")
        new = _merged(state, delta, replaced, ordinals, size)
        # Without a replaced partition no winner is lost.
        if replaced:
            scratch = scratch_folder(spark)
            new.write.parquet(f"{scratch}/merged")
            merged = spark.read.schema(new.schema).parquet(f"{scratch}/merged")
            new = _renewed(merged, raw, ordinals, size)
    else:
        new = delta
    target = new_version()
    path = version_folder(root, target)
    new.select("identity", "latest", "seen").write.parquet(f"{path}/state")
    kept = [(*p, ordinals[p[0]], files, True) for p, files in now.items()]
    gone = ordinals.keys() - {p[0] for p in now}
    kept += [(day, None, ordinals[day], "", False) for day in gone]
    names = ["snapshot_date", "source", "ordinal", "files", "stored"]
    listed = pa.Table.from_pylist([dict(zip(names, row, strict=True)) for row in kept])
    spark.createDataFrame(listed, _PARTITIONS).coalesce(1).write.parquet(f"{path}/partitions")
    announce(spark, root, target)
    return target


def _merged(
    state: DataFrame, delta: DataFrame, replaced: list[Partition], ordinals: dict, size: int
) -> DataFrame:
    """State and changes joined: ``identity, latest, seen, lost``.

    ``lost`` marks postings whose winner went with a replaced partition while other partitions
    still hold versions that may be later than what is known.
    """
    bits = defaultdict(list)
    for day, source in replaced:
        bits[source].append(ordinals[day])
    cleared_bits = F.array().cast("array<int>")
    for source, own in bits.items():
        cleared_bits = F.when(F.col("s.latest.source") == source, F.array(*map(F.lit, own))).otherwise(cleared_bits)

    def left(w: int) -> Column:
        """What a word of the state keeps."""
        kept = _word_at(F.col("s.seen"), w)
        return kept.bitwiseAND(F.bitwise_not(_word_at(F.col("mask"), w))) if replaced else kept

    stale = F.coalesce(
        reduce(
            lambda a, b: a | b,
            [
                (F.col("s.latest.source") == source)
                & F.col("s.latest.snapshot_date").cast("string").eqNullSafe(F.lit(day))
                for day, source in replaced
            ],
            F.lit(False),
        ),
        F.lit(False),
    )
    # The changes come dealt and sorted by hash and identity.
    state = state.withColumn("hash", F.xxhash64("identity"))
    same = (F.col("s.hash") == F.col("d.hash")) & (F.col("s.identity") == F.col("d.identity"))
    joined = state.alias("s").join(delta.alias("d"), same, "full_outer")
    joined = joined.withColumn("mask", _words(cleared_bits, size)).select(
        F.coalesce("s.identity", "d.identity").alias("identity"),
        F.coalesce("s.latest.source", "d.latest.source").alias("source"),
        F.when(~stale, F.col("s.latest")).alias("kept"),
        F.col("s.latest").alias("old"),
        F.col("d.latest").alias("own"),
        F.col("d.seen").alias("own_seen"),
        stale.alias("stale"),
        F.array(*map(left, range(size))).alias("left"),
    )

    def any_set(words: str) -> Column:
        return reduce(lambda a, b: a | b, [_word_at(F.col(words), w) != 0 for w in range(size)])

    beaten = F.col("own").isNull() | (F.col("own") < F.col("old"))
    seen = [_word_at(F.col("left"), w).bitwiseOR(_word_at(F.col("own_seen"), w)) for w in range(size)]
    return joined.select(
        "identity",
        "source",
        F.greatest("kept", "own").alias("latest"),
        F.array(*seen).alias("seen"),
        "left",
        (F.col("stale") & any_set("left") & beaten).alias("lost"),
    ).where(any_set("seen"))


def _renewed(merged: DataFrame, raw: DataFrame, ordinals: dict, size: int) -> DataFrame:
    """``merged`` with the winners of lost postings looked up in the partitions that hold them."""
    lost = merged.where("lost")
    # As many rows as there are partitions.
    asked = (
        lost.select("source", F.explode(_set_bits(F.col("left"))).alias("ordinal"))
        .distinct()
        .collect()
    )
    if not asked:
        return merged
    days = {ordinal: day for day, ordinal in ordinals.items()}
    partitions = [(days[r["ordinal"]], r["source"]) for r in asked]
    lost_ids = lost.select(F.col("identity").alias("lost_id"))
    named = job_identity(F.col("source"), F.col("external_id"))
    rows = raw.where(_in(partitions)).join(lost_ids, named == F.col("lost_id"), "left_semi")
    found = _versions(rows, {p[0]: ordinals[p[0]] for p in partitions}, size).select(
        F.col("hash").alias("found_hash"), F.col("identity").alias("found_id"), F.col("latest").alias("found")
    )
    same = (F.xxhash64("identity") == F.col("found_hash")) & (F.col("identity") == F.col("found_id"))
    return merged.join(found, same, "left").select(
        "identity", F.greatest("latest", "found").alias("latest"), "seen"
    )


def fct_job_postings(spark: SparkSession, root: str) -> DataFrame:
    """The fact table from the state: a projection, without a shuffle."""
    folder = current_folder(spark, root)
    rows = _partition_rows(spark, folder)
    dates = {r["ordinal"]: r["snapshot_date"] for r in rows}
    day = lambda d: F.lit(d).cast("date").alias("day")
    known = F.sort_array(
        F.array(
            *[
                F.struct(day(d), F.lit(o // _WORD).alias("place"), F.lit(_bit(o)).cast("bigint").alias("bit"))
                for o, d in dates.items()
            ]
        )
    )
    # Sorted by day, so the first and the last are those of the posting.
    held = lambda d: d["day"].isNotNull() & (F.get(F.col("seen"), d["place"]).bitwiseAND(d["bit"]) != 0)
    state = spark.read.parquet(f"{folder}/state").withColumn("days", F.filter(known, held))
    jobs = state.select(
        "latest.*",
        F.lit(None).cast("string").alias("description_text"),
        F.get("days", F.lit(0))["day"].alias("first_seen_date"),
        F.get("days", F.size("days") - 1)["day"].alias("last_seen_date"),
        F.size("days").cast("bigint").alias("snapshots_present"),
    )
    stored = [r["snapshot_date"] for r in rows if r["stored"] and r["snapshot_date"] is not None]
    return marts.fact_rows(jobs, F.lit(max(stored, default=None)).cast("date"))

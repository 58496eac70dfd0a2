"""What several operators of this package need."""

import ctypes
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def workspace(spark: SparkSession) -> str:
    """A new folder below the one that driver and executors share.

    The session's ``spark.checkpoint.dir`` names it.  Only a local master, where driver and
    executors are one process on one machine, gets a folder of its own if that is unset.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        shared = tempfile.mkdtemp(prefix="jobtide-llm-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/llm-{uuid.uuid4()}"


def settle(df: DataFrame, folder: str, name: str) -> DataFrame:
    """``df`` written below the shared folder and read again, which ends its lineage."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """Gives back what a worker's finished task freed, as the worker stays for other tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library, which keeps what it has


def free_executors(spark: SparkSession) -> None:
    """Lets every executor collect its garbage, so that its heap shrinks to what is in use.

    A heap grown full by one step is kept else, and the next step's Python workers need room
    beside it.  One task for each core, so that each executor gets one.
    """
    cores = spark.sparkContext.defaultParallelism
    collect = F.reflect(F.lit("java.lang.System"), F.lit("gc"))
    spark.range(0, cores, 1, cores).select(collect).write.format("noop").mode("overwrite").save()


_KEPT: dict[str, Callable[[], None]] = {}


def claim(owner: str, clear: Callable[[], None]) -> None:
    """Tells a worker for whom it works now: what it kept for others is freed.

    ``clear`` frees what it will keep from task to task for this owner.
    """
    others = [name for name in _KEPT if name != owner]
    for name in others:
        _KEPT.pop(name)()
    _KEPT[owner] = clear
    if others:
        release_memory()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores before it until ``df`` has no such column."""
    taken = {column.lower() for column in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else, unlike ``lower``."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def steps(count: Column) -> Column:
    """1, 2 .. ``count``; empty for 0 and less, where ``sequence`` would count down."""
    return F.when(count >= 1, F.sequence(F.lit(1), count)).otherwise(
        F.array().cast("array<int>")
    )


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is worked out once.

    An expression named in a lambda would be worked out again for every element.
    """
    return F.transform(F.array(value), body)[0]


_DRAWS = 1 << 30


def copies_drawn(rows: DataFrame, keys: list[str], share: Column) -> DataFrame:
    """``keys`` and ``weight``: how many of the equal rows of each key a sample takes.

    Each row is taken with probability ``share`` (a column of ``rows``, the same for all rows of a
    key).  The copies of a key are counted, and of n copies the whole part of n * share is taken and one more
    as a hash of the key decides: neither the layout of the rows nor a key that is everywhere
    changes the size of the sample, and such a key comes once, with its weight.
    """
    chance = F.least(share, F.lit(1.0))
    luck = F.pmod(F.xxhash64(*keys, F.lit("drawn")), F.lit(_DRAWS)) / F.lit(float(_DRAWS))
    counted = rows.groupBy(*keys).agg(F.count("*").alias("copies"), F.max(chance).alias("chance"))
    weight = F.floor(F.col("copies") * F.col("chance") + luck).cast("bigint")
    return counted.select(*keys, weight.alias("weight")).where("weight > 0")


# Rows of an id and a hash that are sent to every task; the bits that stand for more of them.
SENT_ROWS = 1 << 20
_SIEVE_BITS = 1 << 26


def without(documents: DataFrame, gone: DataFrame) -> DataFrame:
    """``documents`` less the rows whose id and text hash are in ``gone``.

    ``gone`` has these as its two columns, is written and has other names than ``documents``.  Up
    to ``SENT_ROWS`` of them go to where the texts are.  Of more only a table of bits goes there, which
    is no larger; it lets the texts stay that are surely kept, and the others are moved.
    """
    id_name, hash_name = gone.columns
    (own,) = unused(documents, "text_hash")
    same = F.col("doc_id").eqNullSafe(F.col(id_name)) & (F.col(own) == F.col(hash_name))
    hashed = documents.withColumn(own, F.xxhash64("text"))
    if gone.count() <= SENT_ROWS:
        return hashed.join(F.broadcast(gone), same, "left_anti").select(*documents.columns)
    word, bits = unused(hashed, "word", "bits")
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(_SIEVE_BITS))
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("bigint"), (place(c) % 64).cast("int"))
    sieve = gone.groupBy(F.floor(place(F.col(hash_name)) / 64).alias(word)).agg(F.bit_or(bit(F.col(hash_name))).alias(bits))
    marked = hashed.join(F.broadcast(sieve), F.floor(place(F.col(own)) / 64) == F.col(word), "left")
    maybe = F.coalesce(F.col(bits).bitwiseAND(bit(F.col(own))) != 0, F.lit(False))
    stay = marked.where(~maybe).select(*documents.columns)
    return stay.unionByName(marked.where(maybe).join(gone, same, "left_anti").select(*documents.columns))

"""Stored tables: raw postings, the daily archive and the marts."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.schemas import MARTS, RAW

RAW_PARTITIONS = ("snapshot_date", "source")

# Reports mostly ask for active postings, a small part of all ever seen.
MART_PARTITIONS = {
    "fct_job_postings": ("is_active",),
    "fct_skill_mentions": ("is_active",),
}


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW).parquet(path).select(*RAW.names)


def upsert_snapshot(batch: DataFrame, path: str) -> None:
    """Replace exactly the (snapshot_date, source) partitions the batch holds.

    Everything else stays, so a re-run changes nothing and history builds up.
    Partitions are swapped when the job commits; a failed job leaves them.
    """
    (
        batch.select(*RAW.names)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*RAW_PARTITIONS)
        .parquet(path)
    )


def archive_snapshot(batch: DataFrame, path: str) -> None:
    """Replace the whole day of the batch in the archive."""
    (
        batch.select(*RAW.names)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .parquet(path)
    )


def ensure_raw_table(spark: SparkSession, name: str, path: str) -> None:
    """Register the raw postings under a table name, if it is not there yet."""
    columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in RAW)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(RAW_PARTITIONS)}) LOCATION '{path}'"
    )
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def write_mart(df: DataFrame, root: str, name: str) -> DataFrame:
    """Write one mart anew and read it back, which also ends its lineage."""
    writer = df.select(*MARTS[name].names).write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "static")
    if name in MART_PARTITIONS:
        writer = writer.partitionBy(*MART_PARTITIONS[name])
    writer.parquet(f"{root}/{name}")
    return read_mart(df.sparkSession, root, name)


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    schema = MARTS[name]
    return spark.read.schema(schema).parquet(f"{root}/{name}").select(
        *[F.col(column) for column in schema.names]
    )


def scratch_folder(spark: SparkSession) -> str:
    """A new folder that every executor reaches, for tables in between.

    It lies below the shared folder that the cluster names; without one there is
    no folder that all are sure to see.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("spark.checkpoint.dir must name a folder all executors share")
    return f"{shared.rstrip('/')}/jobtide-{uuid.uuid4()}"

"""Versions that appear whole, and a fact table kept from changed partitions."""

import random

import pytest
from pyspark.sql import functions as F

from jobtide.plans import build, incremental, marts, quality
from jobtide.schemas import MARTS, RAW
from jobtide.sources.published import NothingPublishedError, announced, current_version, version_folder
from jobtide.sources.tables import read_raw, upsert_snapshot
from jobtide.sources.taxonomy import default_taxonomy
from jobtide.verification.postings import raw_postings


@pytest.fixture(scope="module")
def raw(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "raw")
    postings = raw_postings(spark, sf_dir).where("cast(external_id as int) < 400")
    stored = postings.withColumns(
        {"fetched_at": F.col("fetched_at").cast("timestamp"), "snapshot_date": F.col("snapshot_date").cast("string")}
    )
    upsert_snapshot(stored.select(*RAW.names), path)
    return read_raw(spark, path)


# The postings of the test tables name some skills twice.
CHECKS = [c for c in quality.CHECKS if c.column != "mention_id"]


def rows(df):
    return sorted(map(str, df.collect()))


def test_rejected_and_interrupted_builds_leave_the_old_version(spark, raw, tmp_path, monkeypatch):
    root, taxonomy = str(tmp_path / "marts"), default_taxonomy(spark)
    with pytest.raises(NothingPublishedError):
        build.published_marts(spark, root)
    assert {r.status for r in build.publish(raw, taxonomy, root, CHECKS)} <= {"pass", "warn"}
    first = current_version(spark, root)
    held = build.published_marts(spark, root)
    before = {name: rows(held[name]) for name in MARTS}

    with pytest.raises(quality.QualityError, match="not_null_fct_job_postings_title"):
        build.publish(raw.withColumn("title", F.lit(None).cast("string")), taxonomy, root, CHECKS)
    assert current_version(spark, root) == first
    rejected = [p for p in (tmp_path / "marts" / "versions").iterdir() if p.name != first]
    outcome = spark.read.schema(build.AUDIT).parquet(f"{rejected[0]}/audit")
    assert outcome.where("status = 'error'").count() > 0

    write, written = build.write_mart, []

    def dies(df, folder, name):
        if len(written) == 2:
            raise RuntimeError("killed")
        written.append(name)
        return write(df, folder, name)

    monkeypatch.setattr(build, "write_mart", dies)
    with pytest.raises(RuntimeError, match="killed"):
        build.publish(raw.where("source = 'jobicy'"), taxonomy, root, CHECKS)
    monkeypatch.undo()
    assert current_version(spark, root) == first
    for name in MARTS:
        assert rows(build.published_marts(spark, root)[name]) == before[name]

    build.publish(raw.where("source = 'jobicy'"), taxonomy, root, CHECKS)
    assert current_version(spark, root) != first and announced(spark, root).count() == 2
    now = build.published_marts(spark, root)["fct_job_postings"]
    assert {r.source for r in now.select("source").distinct().collect()} == {"jobicy"}
    # One who read the first version reads on.
    assert rows(held["fct_job_postings"]) == before["fct_job_postings"]


def test_incremental_equals_rebuild(spark, raw, tmp_path, monkeypatch):
    table, root = str(tmp_path / "raw"), str(tmp_path / "state")
    assert incremental.update(spark, table, root) is None
    read, asked = incremental._versions, []

    def noted(part, ordinals, size):
        asked.append(sorted(str(d) for d in ordinals))
        return read(part, ordinals, size)

    monkeypatch.setattr(incremental, "_versions", noted)
    day = F.col("snapshot_date")
    number = F.col("external_id").cast("int")
    older = F.col("fetched_at") - F.expr("INTERVAL 60 DAYS")
    steps = [
        (raw.where(day <= "2026-01-19"), {"2026-01-05", "2026-01-12", "2026-01-19"}),
        (raw.where((day == "2026-02-09")), {"2026-02-09"}),  # out of order
        (raw.where((day == "2026-01-26") | (day == "2026-02-02")), {"2026-01-26", "2026-02-02"}),
        # A second run that takes a third away and changes the rest.
        (raw.where((day == "2026-02-09") & (number % 3 != 0)).withColumn("title", F.lit("Data Engineer II")), None),
        # One fetched before all others: winners are looked for elsewhere.
        (raw.where((day == "2026-02-02") & (F.col("source") == "jobicy")).withColumn("fetched_at", older), None),
        # The first snapshot again, with one board's rows all but gone.
        (raw.where((day == "2026-01-05") & (number < 20)), None),
    ]
    for batch, days in steps:
        upsert_snapshot(batch, table)
        asked.clear()
        version = incremental.update(spark, table, root)
        expected = marts.fct_job_postings(read_raw(spark, table))
        assert rows(incremental.fct_job_postings(spark, root)) == rows(expected)
        if days:
            assert asked == [sorted(days)]
    asked.clear()
    assert incremental.update(spark, table, root) == version and not asked
    # The changed partitions are all that is read of the raw table.
    plan = read_raw(spark, table).where(incremental._in([("2026-02-09", "jobicy")]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    filters = text.split("PartitionFilters: [")[1]
    assert filters.startswith("isnotnull(source") and "(source#" in filters.split("PushedFilters")[0]


def test_a_removed_partition_takes_its_postings_along(spark, raw, tmp_path):
    import shutil

    table, root = str(tmp_path / "raw"), str(tmp_path / "state")
    upsert_snapshot(raw.where("snapshot_date >= '2026-02-02'"), table)
    incremental.update(spark, table, root)
    shutil.rmtree(tmp_path / "raw" / "snapshot_date=2026-02-16", ignore_errors=True)
    shutil.rmtree(tmp_path / "raw" / "snapshot_date=2026-02-09" / "source=remotive")
    spark.catalog.refreshByPath(table)
    incremental.update(spark, table, root)
    assert rows(incremental.fct_job_postings(spark, root)) == rows(marts.fct_job_postings(read_raw(spark, table)))


def test_bitmaps_beyond_one_word(spark):
    rng = random.Random(4)
    sets = [sorted(rng.sample(range(200), n)) for n in (0, 1, 5, 60, 200)] + [[63], [64], [127, 128]]
    df = spark.createDataFrame([(s,) for s in sets], "o array<int>")
    words = df.withColumn("w", incremental._words(F.col("o"), 4))
    found = words.select("o", incremental._set_bits(F.col("w")).alias("bits")).collect()
    assert all(sorted(r.o) == r.bits for r in found)
    assert version_folder("r", "v") == "r/versions/v"


def test_new_snapshots_are_merged_in_one_pass(spark, raw, tmp_path, monkeypatch):
    """No winner is lost where no partition was replaced, so nothing is written in between."""
    table, root = str(tmp_path / "raw"), str(tmp_path / "state")
    upsert_snapshot(raw.where("snapshot_date <= '2026-01-12'"), table)
    incremental.update(spark, table, root)
    monkeypatch.setattr(incremental, "scratch_folder", lambda _: pytest.fail("written in between"))
    upsert_snapshot(raw.where("snapshot_date = '2026-01-19'"), table)
    incremental.update(spark, table, root)
    assert rows(incremental.fct_job_postings(spark, root)) == rows(marts.fct_job_postings(read_raw(spark, table)))


def test_versions_hold_the_bits_of_many_snapshots(spark, raw):
    days = [None, *(f"day {n}" for n in range(129))]
    ordinals = {day: len(days) - 1 - n for n, day in enumerate(days)}
    one = raw.limit(1).drop("snapshot_date", "external_id")
    held = {"a": days, "b": [None], "c": ["day 0", "day 1", "day 65"], "d": ["day 128"]}
    made = spark.createDataFrame([(k, d) for k, ds in held.items() for d in ds * 2], "external_id string, snapshot_date string")
    listed = one.crossJoin(made).select(*RAW.names)
    spark.conf.set("spark.sql.ansi.enabled", "false")  # the days are no dates
    try:
        found = incremental._versions(listed, ordinals, 3)
        assert "ObjectHashAggregate" not in found._jdf.queryExecution().executedPlan().toString()
        bits = found.select(F.substring_index("identity", ":", -1).alias("k"), incremental._set_bits(F.col("seen")).alias("o"))
        assert {r.k: r.o for r in bits.collect()} == {k: sorted(ordinals[d] for d in ds) for k, ds in held.items()}
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")

"""What the physical plans must look like at scale."""

import re
from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from jobtide import fixed_values as V
from jobtide.plans import build, ingest, marts, quality, reports, staging
from jobtide.sources import boards
from jobtide.sources.tables import (
    read_mart,
    read_raw,
    scratch_folder,
    upsert_snapshot,
    write_mart,
)
from jobtide.sources.taxonomy import default_skills, default_taxonomy
from jobtide.schemas import RAW
from jobtide.verification import payloads, postings
from jobtide.verification.postings import raw_postings


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store") / "raw")
    raw = raw_postings(spark, sf_dir).withColumns(
        {
            "fetched_at": F.col("fetched_at").cast("timestamp"),
            "snapshot_date": F.col("snapshot_date").cast("string"),
        }
    )
    upsert_snapshot(raw.select(*RAW.names), path)
    return read_raw(spark, path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(text):
    return set(re.findall(r"ReadSchema: struct<(.*?)>", text))


def shuffles(text):
    return len(re.findall(r"Exchange (?:hash|range)partitioning", text))


def test_fact_table_has_one_shuffle_and_no_description(stored):
    text = plan(marts.fct_job_postings(stored))
    assert shuffles(text) == 1
    assert "description_text" not in text
    assert "Window" not in text and "Join" not in text


def test_market_snapshot_reads_no_data_column(stored):
    text = plan(marts.fct_job_postings(stored))
    assert "" in scanned(text)


def test_trend_reads_one_data_column(stored):
    text = plan(marts.agg_skill_by_snapshot(staging.stg_jobs(stored)))
    assert scanned(text) == {"skills:string"}
    assert shuffles(text) == 1
    assert "IsNotNull(skills)" in text


def test_mentions_add_no_shuffle(spark, stored):
    fct = marts.fct_job_postings(stored)
    text = plan(marts.fct_skill_mentions(fct, default_taxonomy(spark)))
    assert shuffles(text) == 1
    assert "BroadcastHashJoin" in text and "BuildRight" in text


def test_no_cross_join_anywhere(spark, sf_dir):
    import __spark_entry__ as entry

    for name in entry.QUERIES:
        text = plan(entry.queries()[name](spark, sf_dir))
        assert "CartesianProduct" not in text, name
        assert "NestedLoop" not in text, name


def test_raw_stats_neither_expands_nor_sorts(stored):
    text = plan(reports.raw_stats(stored))
    assert "Expand" not in text and "SortAggregate" not in text
    # The counts per snapshot read no data column.
    assert "" in scanned(text)


def test_benchmarks_hold_one_value_map(stored):
    text = plan(marts.agg_salary_benchmarks(marts.fct_job_postings(stored)))
    assert "partial_percentile" in text
    assert max(line.count("partial_percentile(") for line in text.splitlines()) == 1


def test_freshness_reads_raw_once(stored):
    moments = [datetime(2026, 9, day) for day in (1, 2, 3)]
    text = plan(quality.freshness(stored, *moments))
    assert text.count("FileScan") == 1


def test_scratch_needs_a_shared_folder():
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(session)


def test_reports_prune_to_active_partition(spark, stored, tmp_path):
    fct = write_mart(
        marts.fct_job_postings(stored), str(tmp_path), "fct_job_postings"
    )
    text = plan(fct.where("is_active").select("role_family"))
    assert "PartitionFilters: [isnotnull(is_active" in text
    assert scanned(text) == {"role_family:string"}


def test_scratch_folder_is_below_the_shared_one():
    settings = {"spark.checkpoint.dir": "/shared/folder/"}
    session = SimpleNamespace(conf=SimpleNamespace(get=settings.get))
    first, second = scratch_folder(session), scratch_folder(session)
    assert first.startswith("/shared/folder/jobtide-") and first != second


def test_snapshot_filter_prunes_partitions(stored):
    text = plan(stored.where("snapshot_date = '2026-01-12' and source = 'jobicy'"))
    assert "PartitionFilters: [isnotnull(snapshot_date" in text


def test_rebuild_replaces_marts(spark, stored, tmp_path):
    taxonomy, root = default_taxonomy(spark), str(tmp_path)
    first = build.build_marts(stored, taxonomy, root)
    n = first["fct_job_postings"].count()
    build.build_marts(stored.where("source = 'jobicy'"), taxonomy, root)
    again = read_mart(spark, root, "fct_job_postings")
    assert again.count() < n
    assert {row.source for row in again.select("source").distinct().collect()} == {"jobicy"}


@pytest.mark.parametrize(
    ("board", "expected"), [("remoteok", 0), ("jobicy", 0), ("arbeitnow", 0), ("remotive", 1)]
)
def test_ingest_shuffles_only_to_dedupe(spark, board, expected):
    payloads = spark.createDataFrame([("[]", "p")], "value string, page string")
    given = {name: payloads for name in V.REMOTIVE_FEEDS} if board == "remotive" else payloads
    records = getattr(boards, board)(given)
    text = plan(ingest.enrich(records, default_skills(), "2026-09-07", datetime(2026, 9, 7)))
    assert shuffles(text) == expected
    assert text.count("ArrowEvalPython") == 0
    # The text is cleaned once, although both the record and the matching use it.
    assert text.count("<[^>]+>") == 1


def test_tasks_of_postings_are_bounded_by_rows(spark, sf_dir, monkeypatch):
    """However few bytes the rows are that postings come from."""
    monkeypatch.setattr(postings, "_ROWS_PER_TASK", 300)
    raw = raw_postings(spark, sf_dir)
    sizes = [r["count"] for r in raw.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == raw.count() and max(sizes) < 600


def test_published_builds_read_a_stored_raw_table(spark, sf_dir, monkeypatch):
    """Or each build and each check would make all postings anew."""
    import __spark_entry__ as entry

    given, publish = [], build.publish
    monkeypatch.setattr(build, "publish", lambda raw, *rest: given.append(plan(raw)) or publish(raw, *rest))
    assert entry.queries()["published_demand"](spark, sf_dir).count() == 30
    assert len(given) == 2 and not any("Exchange" in text or "lineitem" in text for text in given)


def test_code_of_stored_postings_is_compiled(spark, sf_dir):
    """The JVM only ever interprets methods above 8,000 bytes."""
    from jobtide.verification.registry import Relations

    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = Relations(spark, sf_dir).stored_batch._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


def test_postings_without_keys(spark, tmp_path):
    """A missing key is met by no case."""
    items = [(None, 1, 5, 7), (8, None, 5, 7), (8, 1, 5, 7), (9, 1, None, 7), (10, 1, 5, None), (11, 1, None, None)]
    columns = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint"
    spark.createDataFrame(items, columns).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    given = spark.createDataFrame(items, "k bigint, n int, pk bigint, sk bigint")
    as_written = [f"{text.replace('{NTZ}', 'TIMESTAMP_NTZ')} AS {name}" for name, text in postings._COLUMNS.items()]
    found = raw_postings(spark, str(tmp_path))
    assert sorted(map(str, found.collect())) == sorted(map(str, given.selectExpr(*as_written).collect()))


def test_a_document_is_parsed_once_and_its_jobs_are_not_parsed_for_the_filter(spark):
    documents = spark.createDataFrame([("p", "{}")], "page string, value string")
    for read in (boards.jobicy, boards.arbeitnow):
        lines = plan(read(documents)).splitlines()
        assert not any("from_json(StructField" in line for line in lines if "Filter" in line)
    cut = documents.select("page", F.lit(0).alias("position"), F.col("value").alias("element"))
    lines = plan(boards.arbeitnow(cut)).splitlines()
    assert sum("from_json(StructField" in line for line in lines) == 1


def test_documents_are_made_where_their_orders_are(spark, sf_dir):
    documents = payloads.jobicy(raw_postings(spark, sf_dir, payloads.BY_PAGE))
    text = plan(documents)
    assert shuffles(text) == 1 and "jobDescription" not in text[text.index("Exchange") :]
    same = payloads.jobicy(raw_postings(spark, sf_dir))
    kept = ["page", "value"]
    assert sorted(documents.select(kept).collect()) == sorted(same.select(kept).collect())

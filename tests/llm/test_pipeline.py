import hashlib
import sys
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parents[2]))

import corpus_pipeline  # noqa: E402
from jobtide.llm import common, decontamination, jaccard, queries  # noqa: E402
from jobtide.llm.common import table, workspace  # noqa: E402

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def test_every_operator_is_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    result = con.execute(queries.SQL[name])
    columns = [c[0] for c in result.description]
    expected = sorted(map(str, result.fetchall()))
    df = queries.QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(str(tuple(r)) for r in df.select(*columns).collect()) == expected


def test_stages_one_by_one(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    folder = workspace(spark)
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        out.write.parquet(f"{folder}/{number}")
        out = spark.read.parquet(f"{folder}/{number}")
        before = {r.doc_id: r.text for r in docs.collect()}
        after = {r.doc_id: r.text for r in out.collect()}
        assert after.keys() <= before.keys() and len(after) > 0.8 * len(before)
        if number == 1:
            low = {r.component_id for r in jaccard.similar_documents(docs).where("n_shingles > 0").collect()}
            assert low <= after.keys()
        if number == 2:
            bad = decontamination.contamination(docs, table(spark, sf_dir, "benchmark")).where("contaminated")
            assert before.keys() - after.keys() == {r.doc_id for r in bad.collect()}
        if number == 3:
            assert after.keys() == before.keys() and after != before
            assert all(r.n_chars == len(r.text) for r in out.collect())
        docs = out
    final = {r.doc_id: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()}
    for doc, text in after.items():
        ids = np.frombuffer(final[doc].ids, "<u4")
        assert len(ids) == final[doc].n_tokens
        assert hashlib.sha256(ids.tobytes()).hexdigest() == final[doc].ids_sha256
    whole = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert whole == {doc: r.ids_sha256 for doc, r in final.items()}




@pytest.mark.parametrize("sent", [1 << 20, 0])
def test_rows_are_taken_away_without_moving_texts(spark, sent, monkeypatch):
    monkeypatch.setattr(common, "SENT_ROWS", sent)
    monkeypatch.setattr(common, "_SIEVE_BITS", 128)
    rows = [(i if i % 7 else None, f"text {i % 50}", i) for i in range(300)] + [(3, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word int")
    chosen = docs.where("word % 3 = 0 and text is not null")
    gone = common.settle(chosen.select(F.col("doc_id").alias("a"), F.xxhash64("text").alias("b")).distinct(), workspace(spark), "gone")
    lost = {(r.doc_id, r.text) for r in chosen.collect()}
    out = common.without(docs, gone)
    assert out.columns == docs.columns
    key = lambda r: (str(r[0]), str(r[1]), r[2])
    assert sorted(map(tuple, out.collect()), key=key) == sorted((r for r in rows if (r[0], r[1]) not in lost), key=key)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and (sent == 0 or "Exchange hashpartitioning" not in plan)


def test_a_stage_starts_on_collected_executors(spark, sf_dir):
    """Each executor's heap is collected between stages, or the next stage's workers have no room beside it."""
    beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()

    def full_collections():
        return sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())

    docs = table(spark, sf_dir, "documents").limit(5)
    for _, stage in corpus_pipeline.STAGES[1:]:
        before = full_collections()
        stage(spark, docs, sf_dir)
        assert full_collections() > before


def test_near_copies_below_the_contract_of_op7(spark, sf_dir):
    """0.8 of five-word shingles: a passage appended to a copy takes it below 0.85."""
    base = [f"w{i}" for i in range(104)]  # 100 shingles of five words
    texts = {1: base, 2: base + [f"x{i}" for i in range(22)], 3: base + [f"y{i}" for i in range(26)]}
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    kept = corpus_pipeline.join_duplicates(spark, docs, sf_dir)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]  # 100/122 and 100/126

import math
import random

import numpy as np
from pyspark.sql import functions as F

from jobtide.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, k=20, every=20):
    usable = []
    for i, vector, _ in rows:
        if i is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        usable.append((i, [math.floor(64 * x) for x in np.array(vector, np.float32).astype(float).tolist()]))
    out = []
    for n, (q, whole) in enumerate(usable):
        if q % every == 0:
            found = [
                (-sum(a * b for a, b in zip(whole, v, strict=True)), i)
                for m, (i, v) in enumerate(usable)
                if m != n and len(v) == len(whole)
            ]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


def found(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    result = topk.top_products(df, F.col("vec_id") % 20 == 0)
    assert [f.dataType.simpleString() for f in result.schema] == ["bigint", "int", "bigint", "bigint"]
    return sorted(tuple(r) for r in result.collect())


def test_against_brute_force_with_ties(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 64)
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    random = np.random.default_rng(5)
    vectors = random.normal(size=(400, 12)) * random.exponential(size=(400, 1))
    vectors[100:220] = vectors[100]  # a third are one vector
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    rows += [(400, None, 0), (401, [None] * 12, 0), (420, [float("nan")] * 12, 0), (None, [1.0] * 12, 0)]
    rows += [(440, [float("inf")] * 12, 0), rows[20], (60, (vectors[60] + 1).tolist(), 0)]
    assert found(spark, rows) == expected(rows)


def test_few_rows_and_odd_vectors(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0], 1)]) == []
    rows = [(0, [1.0, -0.01], 1), (1, [0.5, 0.5], 1), (20, [2.0], 1), (21, [3.0], 1), (40, [], 1), (41, [], 1)]
    assert found(spark, rows) == expected(rows)
    # Products beyond what doubles hold exactly, and beyond a long.
    rows = [(0, [2e7, 1.0], 0), (1, [2e7, 2.0], 0), (2, [2e7, 1.5], 0), (3, [-2e7, 5.0], 0)]
    assert found(spark, rows) == expected(rows)
    rows = [(0, [1e12], 0), (1, [1e12], 0), (2, [-1e12], 0)]
    assert [r[3] for r in found(spark, rows)] == [2**63 - 1, -(2**63 - 1)]


def test_rows_that_share_an_id_are_rows_of_their_own(spark):
    """The issue of one id with a short and a long vector: the better hit must not be lost."""
    rows = [(0, [1.0, 0.0], 0), (5, [1.0, 0.0], 0), (5, [3.0, 0.0], 0), (7, [0.0, 1.0], 0), (0, [2.0, 0.0], 0)]
    assert found(spark, rows) == expected(rows)
    assert (0, 1, 5, 12288) in found(spark, rows) and (0, 1, 5, 24576) in found(spark, rows)


def test_small_components_beside_a_huge_one(spark, monkeypatch):
    rows = [(1, [2.0**60, 0.51, -0.51], 0), (2, [0.0, 1.0, 0.0], 0), (3, [0.0, 0.0, 1.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.vec_id: r.v for r in topk._quantized(df).collect()}[1] == [2.0**66, 32.0, -33.0]
    got = topk.top_products(df, F.col("vec_id") == 1, 2).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in got) == [(1, 2, 2048), (2, 3, -2112)]


def test_merge_in_parts(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 8)
    draw = random.Random(8)
    rows = [(i, [float(draw.randrange(-3, 4)) for _ in range(3)], 0) for i in range(80)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = topk.top_products(df, F.col("vec_id") < 3, 5).collect()
    vectors = {i: v for i, v, _ in rows}
    for q in range(3):
        scores = sorted((-sum(int(a * 64) * int(b * 64) for a, b in zip(vectors[q], v, strict=True)), i) for i, v in vectors.items() if i != q)
        assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] == [(i, -s) for s, i in scores[:5]]

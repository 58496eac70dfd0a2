import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from jobtide.llm import jaccard

SCHEMA = "doc_id long, text string, node string"


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 4:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 4]) for i in range(len(words) - 3)}


def expected(rows):
    sets = [shingle_set(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                parent[root(i)] = root(j)
    ids = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[root(i)].append(doc)
    out = [(doc, len(sets[i]), min(ids[root(i)], default=None)) for i, (doc, _) in enumerate(rows)]
    return sorted(out, key=str)


def found(spark, rows):
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], SCHEMA)
    result = jaccard.similar_documents(df).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in result), key=str)


def edited(words, number, draw):
    words = list(words)
    for _ in range(number):
        words[draw.randrange(len(words))] = f"new{draw.random()}"
    return words


@pytest.mark.parametrize("block", [8])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK_NODES", block)
    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    for group in range(4):
        base = [draw.choice(vocabulary) for _ in range(120)]
        chain = base
        for _ in range(25):  # copies of a base, and a chain of copies of copies
            rows.append(" ".join(edited(base, draw.randrange(5), draw)))
            chain = edited(chain, 1, draw)
            rows.append(" ".join(chain))
    rows += [" ".join(draw.choice(vocabulary) for _ in range(draw.randrange(1, 60))) for _ in range(60)]
    passage = " ".join(draw.choice(vocabulary) for _ in range(40))
    rows += [f"{passage} " + " ".join(f"u{i}x{k}" for k in range(draw.randrange(3, 40))) for i in range(40)]
    rows = [(1000 - i, text) for i, text in enumerate(rows)]
    assert found(spark, rows) == expected(rows)


def test_edge_cases(spark):
    rows = [
        (5, None), (6, ""), (7, " \n"), (8, "a b"), (3, "A  b"), (9, "a b c"), (9, "a b c"),
        (None, "x y z"), (4, "x y z"), (None, "alone here"), (10, "é b c d e"), (11, "É b c d e"),
        (12, "a b c"), (13, "a b c"), (14, "long " * 3000), (15, "long " * 200),
    ]
    assert found(spark, rows) == expected(rows)
    assert found(spark, []) == []


def test_threshold_is_exact(spark):
    # 17 of 20 shingles in common is the border itself, 16 of 19 lies below it.
    at = ["%d" % i for i in range(20)]
    rows = [(1, " ".join(at + ["x"] * 0)), (2, " ".join(at[:20] + ["y", "z", "q"]))]
    assert found(spark, rows) == expected(rows)


def test_one_of_each(spark):
    rows = [(2, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (3, None), (4, ""), (5, "other words")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA).withColumn("n", F.lit(1))
    kept = jaccard.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5]

import random
import zlib

import numpy as np
import pytest

from jobtide.llm import quality

DOCS = "doc_id long, text string, score int"
LABELS = "doc_id long, quality int, toxic int"


def corpus(rows, good=0.8, seed=2):
    draw = random.Random(seed)
    out = []
    for i in range(rows):
        words = ["w" + "abcdefghij"[draw.randrange(10)] * draw.randrange(1, 7) for _ in range(draw.randrange(20, 90))]
        fine = draw.random() < good
        text = " ".join(words) if fine else " ".join(w.upper() + "!!" for w in words)
        out.append((i, text, int(fine)))
    return out


def test_held_out_ranking_and_decisions(spark):
    rows = corpus(1500)
    docs = spark.createDataFrame([(i, t, 0) for i, t, _ in rows], DOCS)
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows[::2]], LABELS)
    result = {r.doc_id: r for r in quality.score_documents(docs, labels).collect()}
    truth = {i: q for i, _, q in rows}
    held = {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert {i for i, r in result.items() if r.held_out} == held
    assert np.mean([result[i].predicted == truth[i] for i in held]) > 0.95
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in result.values())


def test_negative_labels_are_not_needed_and_held_out_ones_unseen(spark):
    rows = corpus(600)
    docs = spark.createDataFrame([(i, t, 0) for i, t, _ in rows], DOCS)
    kept = [(i, q, 0) for i, _, q in rows if q == 1]
    hidden = [(i, 1 - q, 0) for i, q, _ in kept if zlib.crc32(str(i).encode()) % 4 == 2]
    seen = [row for row in kept if zlib.crc32(str(row[0]).encode()) % 4 != 2]
    one = quality.score_documents(docs, spark.createDataFrame(seen, LABELS)).collect()
    two = quality.score_documents(docs, spark.createDataFrame(seen + hidden, LABELS)).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))


def test_edge_cases(spark):
    rows = corpus(300)
    texts = [(i, t, 0) for i, t, _ in rows] + [(None, "a b", 0), (900, None, 0), (901, "", 0), (901, "", 0), (902, "x " * 100_000, 0)]
    marks = [(i, q, 0) for i, _, q in rows] + [(None, 1, 0), (5000, 1, 0), (1, None, 0), (2, 1, 0), (2, 0, 0)]
    result = quality.score_documents(
        spark.createDataFrame(texts, DOCS), spark.createDataFrame(marks, LABELS)
    ).collect()
    assert len(result) == len(texts)
    assert all(r.score is not None for r in result)


@pytest.mark.parametrize("texts", [[], [(1, "some text", 0)]])
def test_nothing_to_learn_from(spark, texts):
    result = quality.score_documents(
        spark.createDataFrame(texts, DOCS), spark.createDataFrame([], LABELS)
    ).collect()
    assert [(r.score, r.predicted) for r in result] == [(0.5, 0)] * len(texts)


def test_prior_of_a_known_mixture():
    draw = np.random.default_rng(1)
    positive = draw.normal(3, 1, 5000)
    unlabelled = np.concatenate([draw.normal(3, 1, 6000), draw.normal(-3, 1, 4000)])
    assert abs(quality.estimate_prior(positive, unlabelled) - 0.6) < 0.04


def test_sample_stays_bounded_under_one_id(spark, monkeypatch):
    monkeypatch.setattr(quality, "UNLABELLED_ROWS", 200)
    monkeypatch.setattr(quality, "POSITIVE_ROWS", 100)
    sizes = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda p, u, *rest: sizes.append((len(p), len(u))) or fit(p, u, *rest))
    rows = corpus(1500)
    docs = spark.createDataFrame([(None if i % 3 == 0 else 1 if i % 3 == 1 else i, t, 0) for i, t, _ in rows], DOCS)
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows] + [(1, 1, 0)], LABELS)
    result = quality.score_documents(docs, labels).collect()
    assert len(result) == len(rows)
    (positive, unlabelled), = sizes
    assert 40 < positive < 200 and 120 < unlabelled < 300


def test_scores_do_not_depend_on_the_layout(spark, monkeypatch):
    monkeypatch.setattr(quality, "UNLABELLED_ROWS", 300)
    monkeypatch.setattr(quality, "POSITIVE_ROWS", 150)
    rows = corpus(900)
    rows += [(i + 5000, rows[1][1], 0) for i in range(300)]  # a text that is everywhere
    docs = spark.createDataFrame([(i, t, 0) for i, t, _ in rows], DOCS)
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows], LABELS)
    results = [
        sorted(map(tuple, quality.score_documents(d, labels.repartition(n)).collect()))
        for n, d in ((2, docs.repartition(2)), (7, docs.repartition(7, "text")))
    ]
    assert results[0] == results[1]

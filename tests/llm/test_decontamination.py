import hashlib
import re

import pytest
from pyspark.sql import functions as F

from jobtide.llm import decontamination

DOCS = "doc_id long, text string, run string"
ITEMS = "item_id long, text string"


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def expected(text, items):
    found, hit = set(), set()
    own = words(text)
    for item, content in items:
        other = words(content)
        size = min(len(other), 10)
        spans = {tuple(other[i : i + size]) for i in range(len(other) - size + 1)} if size else set()
        for i in range(len(own) - size + 1 if size else 0):
            if tuple(own[i : i + size]) in spans:
                hit |= set(range(i, i + size))
                if item is not None:
                    found.add(str(item))
    joined = ",".join(sorted(found)).encode()
    return len(own), len(hit), len(found), hashlib.sha256(joined).hexdigest(), bool(hit)


PASSAGE = " ".join(f"w{i}" for i in range(25))
ITEM_ROWS = [
    (1, PASSAGE),
    (1, PASSAGE),
    (2, "Short é item"),
    (10, " ".join(f"w{i}" for i in range(8, 18))),
    (3, None),
    (4, "... !!"),
    (None, " ".join(f"n{i}" for i in range(12))),
    (5, " ".join(["tick"] * 14)),
]
TEXTS = [
    PASSAGE,
    "before " + " ".join(f"W{i}" for i in range(3, 13)) + ", after",
    " ".join(f"w{i}" for i in range(9)),
    "a short É item and a short é item",
    " ".join(["tick"] * 30),
    " ".join(f"n{i}" for i in range(12)),
    "",
    None,
    "!!!",
    " ".join(f"filler{i}" for i in range(40_000)) + " " + PASSAGE + " " + PASSAGE,
    " ".join(f"filler{i}" for i in range(16_380)) + " " + PASSAGE,
]


def test_against_brute_force(spark):
    rows = [(i, text, "clash") for i, text in enumerate(TEXTS)] + [(0, PASSAGE, "x"), (None, PASSAGE, "x")]
    result = decontamination.contamination(
        spark.createDataFrame(rows, DOCS), spark.createDataFrame(ITEM_ROWS, ITEMS)
    ).collect()
    got = sorted(
        (str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in result
    )
    assert got == sorted((str(i), *expected(text, ITEM_ROWS)) for i, text, _ in rows)


@pytest.mark.parametrize("docs,items", [([], ITEM_ROWS), ([(1, PASSAGE, "")], [])])
def test_empty_tables(spark, docs, items):
    result = decontamination.contamination(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    ).collect()
    assert [r.contaminated for r in result] == [False] * len(docs)


def test_clean_documents_keep_rows_and_columns(spark):
    docs = spark.createDataFrame(
        [(1, PASSAGE, "a"), (2, "clean", "b"), (2, "clean", "b"), (None, None, "c")], DOCS
    ).withColumn("text_hash", F.lit(0))
    kept = decontamination.clean_documents(docs, spark.createDataFrame(ITEM_ROWS, ITEMS))
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "2", "None"]


def test_sigma_beside_other_punctuation(spark):
    """Full lower case of a sigma depends on its surroundings; the words are equal all the same."""
    names = ["ΟΔΟΣ", "ΑΒ", "Σ", "Α", "ΛΟΓΟΣ", "ΤΗΣ", "ΝΗΣΟΣ", "ΚΑΙ", "ΜΕΣ", "ΠΟΛΙΣ"]
    items = [(1, " ".join(names)), (2, ".".join(f"Q{w}" for w in names))]
    texts = [".".join(names), "'".join(names), " ".join(names), " ".join(f"Q{w}" for w in names)]
    out = decontamination.contamination(
        spark.createDataFrame([(i, t, "") for i, t in enumerate(texts)], DOCS),
        spark.createDataFrame(items, ITEMS),
    ).collect()
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in out}
    assert got == {i: expected(t, items) for i, t in enumerate(texts)}
    assert all(r.n_hit == 10 for r in out)

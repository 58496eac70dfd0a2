"""Language identification: sparse multinomial logistic regression on character n-grams.

Texts become TF-IDF vectors of hashed 1- to 3-grams of letters.  Document frequencies are counted
over every labelled row that may be learnt from.  Weights are fitted by follow the regularized
leader with elastic-net penalties, on a bounded sample of those rows: of each language its share of
``SAMPLE_ROWS``, but ``LANGUAGE_ROWS`` at least, or all it has.  Equal rows are drawn as copies of
one, which counts for as many.  No more than the ``LANGUAGES`` most frequent languages are learnt.
A fifth of the sample is held back to calibrate the temperature of the probabilities.
"""

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import claim, copies_drawn, release_memory, settle, workspace

BUCKETS = 1 << 14
SAMPLE_ROWS = 4000  # expected size of the sample that the weights are fitted on
LANGUAGE_ROWS = 200  # of a language, so many are expected in the sample at least, or all
LANGUAGES = 1000  # the most frequent languages, by name where they are as frequent
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.001
UNKNOWN = "und"
MIN_SCORE = 0.35
_STEP = 1 << 20
_SLICE_BYTES = 1 << 22
_SPACE = 32


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray  # language x bucket
    bias: np.ndarray
    idf: np.ndarray
    temperature: float


def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


_IS_LETTER = _letters()


def counts(text: str | None) -> np.ndarray:
    """How often each bucket occurs; None where the text has no letter."""
    found = np.zeros(BUCKETS, np.int64)
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = False
    for start in range(0, len(codes), _STEP):
        # Two more characters than the step, for the grams that begin in it.
        part = codes[start : start + _STEP + 2]
        known = _IS_LETTER[part]
        letter |= bool(known.any())
        part = np.where(known, part, np.uint32(_SPACE)).astype(np.uint64)
        gram = np.zeros(len(part), np.uint64)
        for size in (1, 2, 3):
            gram = gram[: len(part) - size + 1] * np.uint64(0x9E3779B97F4A7C15) + part[size - 1 :]
            starts = gram[:_STEP]
            if size > 1:
                # A gram within a gap says nothing about the language.
                starts = starts[(part[: len(starts)] != _SPACE) | (part[1 : len(starts) + 1] != _SPACE)]
            mixed = (starts ^ (starts >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9 + size)
            found += np.bincount((mixed >> np.uint64(50)).astype(np.int64), minlength=BUCKETS)
    return found if letter else None


def _vector(found: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(found)
    value = np.log1p(found[at]) * idf[at]
    return at, value / max(1e-12, np.linalg.norm(value))


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], targets: np.ndarray, classes: int):
    """Weights and bias by FTRL; a constant feature stands for the bias."""
    z = np.zeros((classes, BUCKETS + 1))
    n = np.zeros((classes, BUCKETS + 1))

    def weights(at):
        zs = z[:, at]
        w = -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(n[:, at])) / ALPHA + L2)
        return np.where(np.abs(zs) <= L1, 0.0, w)

    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            at, value = rows[i]
            at, value = np.append(at, BUCKETS), np.append(value, 1.0)
            w = weights(at)
            error = _softmax(w @ value)
            error[targets[i]] -= 1.0
            g = error[:, None] * value[None, :]
            old = n[:, at]
            sigma = (np.sqrt(old + g * g) - np.sqrt(old)) / ALPHA
            z[:, at] += g - sigma * w
            n[:, at] = old + g * g
    full = weights(np.arange(BUCKETS + 1))
    return full[:, :-1], full[:, -1]


def _temperature(logits: np.ndarray, targets: np.ndarray) -> float:
    """The temperature of least loss, by golden section over its logarithm."""
    if not len(targets):
        return 1.0

    def loss(log_t):
        p = _softmax(logits / np.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(targets)), targets], 1e-12)).mean()

    low, high, ratio = -4.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _forget() -> None:
    """Nothing is kept from task to task."""


def id_checksum(column: str) -> Column:
    """The checksum of an id as text; that of an empty text for null."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def train(labelled: DataFrame, folder: str) -> Model:
    """A model from ``text`` and ``lang``."""
    usable = labelled.where("lang is not null and text is not null")

    def document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("langid", _forget)
        total, rows = np.zeros(BUCKETS, np.int64), Counter()
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found = counts(text.as_py())
                if found is not None:
                    total += found > 0
                    rows[lang] += 1
        # Rows by bucket, and with a language that language's.
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None, *rows], pa.string()),
                pa.array([total, *[[n] for n in rows.values()]], pa.list_(pa.int64())),
            ],
            ["lang", "n"],
        )

    counted = usable.select("text", "lang").mapInArrow(document_counts, "lang string, n array<bigint>")
    summed = (
        counted.select("lang", F.posexplode("n").alias("bucket", "n"))
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    summed = settle(summed, folder, "df")
    seen = np.zeros(BUCKETS, np.int64)
    for bucket, number in summed.where("lang is null").select("bucket", "n").collect():
        seen[bucket] = number
    frequent = summed.where("lang is not null").orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    by_language = {row["lang"]: row["n"] for row in frequent.collect()}
    total = summed.where("lang is not null").agg(F.sum("n")).first()[0] or 0
    idf = np.log((1.0 + total) / (1.0 + seen)) + 1.0
    if not total:
        return Model([], np.zeros((0, BUCKETS)), np.zeros(0), idf, 1.0)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = set()
        for batch in batches:
            rows = []
            for text, lang, own, weight in zip(*batch.columns, strict=True):
                key = lang.as_py(), own.as_py()
                if key in done:
                    continue
                done.add(key)
                found = counts(text.as_py())
                if found is not None:
                    at, value = _vector(found, idf)
                    rows.append((*key, weight.as_py(), at.astype("<u2").tobytes(), value.astype("<f4").tobytes()))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["lang", "own", "weight", "at", "value"],
            )

    shares = [(k, max(SAMPLE_ROWS / total, LANGUAGE_ROWS / n)) for k, n in by_language.items()]
    shares = labelled.sparkSession.createDataFrame(shares, "lang string, share double")
    hashed = usable.select("text", "lang", F.xxhash64("text").alias("own"))
    # Both small sides are bounded: by ``LANGUAGES``, and by the sample.
    narrow = hashed.select("lang", "own").join(F.broadcast(shares), "lang")
    picked = settle(copies_drawn(narrow, ["lang", "own"], F.col("share")), folder, "picked")
    sample = hashed.join(F.broadcast(picked), ["lang", "own"]).select("text", "lang", "own", "weight")
    rows = (
        sample.mapInArrow(features, "lang string, own bigint, weight bigint, at binary, value binary")
        .groupBy("lang", "own")
        .agg(F.min("weight").alias("weight"), F.min("at").alias("at"), F.min("value").alias("value"))
        .collect()
    )
    if not rows:
        return Model([], np.zeros((0, BUCKETS)), np.zeros(0), idf, 1.0)
    # An order of their own, whichever task they come from.
    rows.sort(key=lambda r: (r["lang"], r["own"]))
    languages = sorted({r["lang"] for r in rows})
    vectors, targets, held, met = [], [], [], Counter()
    for r in rows:
        vector = (np.frombuffer(r["at"], "<u2").astype(np.int64), np.frombuffer(r["value"], "<f4").astype(float))
        met[r["lang"]] += 1
        vectors += [vector] * r["weight"]
        targets += [languages.index(r["lang"])] * r["weight"]
        held += [met[r["lang"]] % 5 == 0] * r["weight"]
    targets, held = np.array(targets, np.int64), np.array(held)
    weights, bias = fit(
        [v for v, h in zip(vectors, held, strict=True) if not h], targets[~held], len(languages)
    )
    logits = np.array(
        [weights[:, at] @ value + bias for (at, value), h in zip(vectors, held, strict=True) if h]
    ).reshape(-1, len(languages))
    return Model(languages, weights, bias, idf, _temperature(logits, targets[held]))


def predict(model: Model, text: str | None) -> tuple[str, float]:
    found = counts(text) if text else None
    if found is None or not model.languages:
        return UNKNOWN, 0.0
    at, value = _vector(found, model.idf)
    p = _softmax((model.weights[:, at] @ value + model.bias) / model.temperature)
    best = int(p.argmax())
    return model.languages[best], float(p[best])


def _predicted(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with ``lang_pred`` and ``score``, from its last column, the text."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, batch.num_rows * _SLICE_BYTES // max(1, batch.nbytes))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                found = [predict(shared.value, t.as_py()) for t in part.columns[-1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:-1],
                        pa.array([lang for lang, _ in found], pa.string()),
                        pa.array([score for _, score in found], pa.float64()),
                    ],
                    [*part.schema.names[:-1], "lang_pred", "score"],
                )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return rows.mapInArrow(work, f"{kept}, lang_pred string, score double")


def fitted(documents: DataFrame, folds: int = 5) -> Model:
    """The model of the rows of ``documents`` that are not held out."""
    held_out = id_checksum("doc_id") % folds == 0
    labelled = documents.where(~held_out).select("text", "lang")
    return train(labelled, workspace(documents.sparkSession))


def identify(documents: DataFrame, folds: int = 5) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row of ``documents``.

    Needs ``doc_id``, ``text`` and ``lang``.  Learns from rows with a language whose id's checksum
    is not a multiple of ``folds``; a null id counts as an empty text, so it is held out.  A null
    text or one without a letter is ``und`` with score 0, as is every text if there is nothing to
    learn from.  Equal scores go to the first language by name.  Repeated rows repeat.
    """
    model = fitted(documents, folds)
    held_out = (id_checksum("doc_id") % folds == 0).alias("held_out")
    return _predicted(documents.select("doc_id", held_out, "text"), model)


def known_language(documents: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``documents`` without those in no language the model is at least so sure of.

    All columns and other rows stay, and each row goes through the workers once.
    """
    model = documents.sparkSession.sparkContext.broadcast(fitted(documents))
    at = [c.lower() for c in documents.columns].index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, batch.num_rows * _SLICE_BYTES // max(1, batch.nbytes))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                found = [predict(model.value, t.as_py()) for t in part.column(at)]
                sure = [lang != UNKNOWN and score >= min_score for lang, score in found]
                yield part.filter(pa.array(sure, pa.bool_()))
        release_memory()

    return documents.mapInArrow(work, documents.schema)

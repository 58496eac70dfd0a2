"""Text quality by positive-unlabelled learning.

A document becomes a few figures about its words, characters and lines, each cut into quantile
bins; the score is the logistic function of a sum of bin weights.  Weights minimize the
non-negative unbiased risk of du Plessis, Niu and others: trusted positives and unlabelled text
stand in for labels, with the share of positives in the unlabelled text (the class prior)
estimated beforehand from how the scores of a positive-against-unlabelled model are spread.

Weights are fitted on bounded samples (``POSITIVE_ROWS``, ``UNLABELLED_ROWS``), which like all else
do not depend on how the rows are laid out; bin borders, class
prior and the border of the decision come from all rows that may be learnt from, and every document
is scored on its whole text.
"""

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import copies_drawn, settle, workspace
from jobtide.llm.langid import id_checksum

POSITIVE_ROWS = 6000  # expected sizes of the samples
UNLABELLED_ROWS = 12000
BINS = 24
STEPS = 600
RATE = 0.05
PENALTY = 1e-4
THRESHOLD = 0.7
_SLICE_BYTES = 1 << 22
_ENDS = ".,;:!?"
_FIGURES = 21


class Model(NamedTuple):
    edges: np.ndarray  # figure x inner bin border
    weights: np.ndarray  # figure x bin
    bias: float
    prior: float


def figures(text: str | None) -> list[float]:
    """What is measured on a text; all zero for an empty one."""
    text = text or ""
    words = text.split()
    if not words:
        return [0.0] * _FIGURES
    n, c = len(words), len(text)
    by_word = Counter(words)
    lengths = np.fromiter(map(len, words), np.int32, n)
    lines = text.split("\n")
    by_line = Counter(lines)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    at = np.bincount(raw, minlength=256)
    digits = at[48:58].sum()
    small, large = at[97:123].sum(), at[65:91].sum()
    ends = sum(at[ord(x)] for x in _ENDS)
    signs = at[33:48].sum() + at[58:65].sum() + at[91:97].sum() + at[123:127].sum()
    pairs = len(set(zip(words, words[1:], strict=False)))
    triples = len(set(zip(words, words[1:], words[2:], strict=False)))
    return [
        np.log1p(n),
        lengths.mean(),
        lengths.std(),
        lengths.max(),
        (lengths <= 3).mean(),
        len(by_word) / n,
        len(by_word) / np.sqrt(n),
        max(by_word.values()) / n,
        pairs / max(1, n - 1),
        triples / max(1, n - 2),
        digits / c,
        large / max(1, small + large),
        ends / c,
        (signs - ends) / c,
        at[ord("!")] / c,
        at[ord("|")] / c,
        (at[128:].sum()) / len(raw),
        len(lines) / n,
        len(by_line) / len(lines),
        max(len(line) for line in lines) / c,
        sum(len(line) * k for line, k in by_line.items() if k > 1) / c,
    ]


def _binned(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.stack(
        [np.searchsorted(edges[j], values[:, j], side="right") for j in range(len(edges))], axis=1
    )


def _sums(model_weights: np.ndarray, bias: float, bins: np.ndarray) -> np.ndarray:
    return bias + model_weights[np.arange(bins.shape[1])[None, :], bins].sum(axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _descend(positive: np.ndarray, unlabelled: np.ndarray, slopes) -> tuple[np.ndarray, float]:
    """Adam over bin weights; ``slopes`` gives the loss slopes by row from the rows' sums."""
    shape = (positive.shape[1], BINS)
    weights, bias = np.zeros(shape), 0.0
    first, second = np.zeros(weights.size + 1), np.zeros(weights.size + 1)
    columns = np.arange(shape[0]) * BINS
    flat_p, flat_u = (positive + columns).ravel(), (unlabelled + columns).ravel()
    for step in range(1, STEPS + 1):
        dp, du = slopes(_sums(weights, bias, positive), _sums(weights, bias, unlabelled))
        g = np.bincount(flat_p, np.repeat(dp, shape[0]), weights.size)
        g += np.bincount(flat_u, np.repeat(du, shape[0]), weights.size)
        g = np.append(g + PENALTY * weights.ravel(), dp.sum() + du.sum())
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights -= move[:-1].reshape(shape)
        bias -= move[-1]
    return weights, bias


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among the unlabelled, from scores that order both.

    At any threshold the unlabelled hold at least prior x (positives above it), so the least
    ratio of the two shares bounds the prior; each share is moved by its sampling error.
    """
    cuts = _cuts(positive)
    u = 1.0 - np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    return _prior(positive, u, len(unlabelled))


def _cuts(positive: np.ndarray) -> np.ndarray:
    return np.quantile(positive, np.linspace(0.0, 0.9, 91))


def _prior(positive: np.ndarray, u: np.ndarray, number: int) -> float:
    """The prior from the shares ``u`` of ``number`` unlabelled scores from each cut on."""
    p = 1.0 - np.searchsorted(np.sort(positive), _cuts(positive)) / len(positive)
    error = np.sqrt(1.0 / len(positive)) + np.sqrt(1.0 / number)
    ratio = (u + error) / (p + error)
    return float(np.clip(ratio.min(), 0.01, 0.99))


def fine_counts(rows: DataFrame, size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each place of the arrays ``v``, its values to eleven binary digits and their counts.

    The same for any layout of the rows; there are at most as many values as such numbers.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Counter() for _ in range(size)]
        for batch in batches:
            values = np.asarray(batch.column(0).flatten()).reshape(-1, size).astype(np.float32)
            cut = (values.view(np.uint32) & np.uint32(0xFFFFE000)).view(np.float32)
            for j in range(size):
                held[j].update(dict(zip(*(a.tolist() for a in np.unique(cut[:, j], return_counts=True)), strict=True)))
        for j, counter in enumerate(held):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([j] * len(counter), pa.int32()),
                    pa.array(list(counter), pa.float64()),
                    pa.array(list(counter.values()), pa.int64()),
                ],
                ["j", "value", "n"],
            )

    summed = rows.mapInArrow(work, "j int, value double, n bigint").groupBy("j", "value").agg(F.sum("n").alias("n"))
    found = [[] for _ in range(size)]
    for row in summed.collect():
        found[row["j"]].append((row["value"], row["n"]))
    return [tuple(np.array(sorted(own)).reshape(-1, 2).T) for own in found]


def _at_shares(values: np.ndarray, counts: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """The least values up to which at least these shares of the rows lie."""
    below = np.cumsum(counts)
    return values[np.minimum(np.searchsorted(below, shares * below[-1]), len(values) - 1)]


def fit(positive: np.ndarray, unlabelled: np.ndarray, rows: DataFrame | None = None) -> Model:
    """Weights from the samples; what is a matter of the corpus from ``v`` of ``rows``, if given."""
    shares = np.linspace(0, 1, BINS + 1)[1:-1]
    if rows is None:
        edges = np.quantile(np.concatenate([positive, unlabelled]), shares, axis=0).T
    else:
        edges = np.array([_at_shares(*c, shares) for c in fine_counts(rows.select("v"), _FIGURES)])
    p, u = _binned(positive, edges), _binned(unlabelled, edges)

    def against(sp, su):
        return (_sigmoid(sp) - 1.0) / (2 * len(sp)), _sigmoid(su) / (2 * len(su))

    half = np.arange(len(p)) % 2 == 0, np.arange(len(u)) % 2 == 0
    scores, models = ([], []), []
    for side in (0, 1):  # scored by the model of the other half
        own = [h if side else ~h for h in half]
        weights, bias = _descend(p[own[0]], u[own[1]], against)
        models.append((weights, bias))
        scores[0].append(_sums(weights, bias, p[~own[0]]))
        scores[1].append(_sums(weights, bias, u[~own[1]]))
    found = np.concatenate(scores[0])
    if rows is None:
        prior = estimate_prior(found, np.concatenate(scores[1]))
    else:
        above = [F.count_if(F.col("s") >= float(c)) for c in _cuts(found)]
        number, *counts = _summed(rows, edges, models).agg(F.count("*"), *above).first()
        prior = _prior(found, np.array(counts) / number, number)

    def non_negative(sp, su):
        # Logistic loss: softplus(-s) for a positive, softplus(s) for a negative.
        negative = np.logaddexp(0, su).mean() - prior * np.logaddexp(0, sp).mean()
        up = prior * (_sigmoid(sp) - 1.0) / len(sp)
        down_p, down_u = -prior * _sigmoid(sp) / len(sp), _sigmoid(su) / len(su)
        if negative < 0:  # step back until the risk of negatives is one again
            return -down_p, -down_u
        return up + down_p, down_u

    weights, bias = _descend(p, u, non_negative)
    # The decision threshold is to admit the estimated share of the unlabelled.
    if rows is None:
        border = np.quantile(_sums(weights, bias, u), 1.0 - prior)
    else:
        sums = _summed(rows, edges, [(weights, bias)]).select(F.array("s").alias("v"))
        border = _at_shares(*fine_counts(sums, 1)[0], np.array([1.0 - prior]))[0]
    return Model(edges, weights, bias + np.log(THRESHOLD / (1 - THRESHOLD)) - border, prior)


def scores(model: Model, values: np.ndarray) -> np.ndarray:
    return _sigmoid(_sums(model.weights, model.bias, _binned(values, model.edges)))


def _summed(rows: DataFrame, edges: np.ndarray, models: list[tuple[np.ndarray, float]]) -> DataFrame:
    """``s``: the sum of each row, by one of the models, which its figures choose."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.asarray(batch.column(0).flatten()).reshape(-1, _FIGURES)
            bins, chosen = _binned(values, edges), batch.column(1).to_numpy()
            sums = np.empty(len(bins))
            for k, (weights, bias) in enumerate(models):
                sums[chosen == k] = _sums(weights, bias, bins[chosen == k])
            yield pa.RecordBatch.from_arrays([pa.array(sums, pa.float64())], ["s"])

    chosen = F.pmod(F.xxhash64("v"), F.lit(len(models))).cast("int").alias("chosen")
    return rows.select("v", chosen).mapInArrow(work, "s double")


def _measured(rows: DataFrame) -> DataFrame:
    """``doc_id`` and the figures ``v`` of each text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.asarray(figures(t.as_py()), float).tolist() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.float64()))], ["doc_id", "v"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, v array<double>")


def _sample(rows: DataFrame, size: int, folder: str, name: str) -> np.ndarray:
    """The figures of about ``size`` rows, in an order of their own.

    Rows with the same figures are drawn as copies of one, so neither a text that is everywhere
    nor the layout of the table changes the sample.
    """
    share = F.lit(size / max(1, rows.count()))
    hashed = rows.select(F.xxhash64("v").alias("own"), "v")
    picked = settle(copies_drawn(hashed.select("own"), ["own"], share), folder, name)

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = set()
        for batch in batches:
            first = []
            for own in batch.column(0).to_pylist():
                first.append(own not in done)
                done.add(own)
            yield batch.filter(pa.array(first, pa.bool_()))

    # About ``size`` rows at most.
    met = hashed.join(F.broadcast(picked), "own").select("own", "weight", "v")
    met = met.mapInArrow(once, "own bigint, weight bigint, v array<double>").dropDuplicates(["own"])
    found = sorted((row["v"], row["weight"]) for row in met.collect())
    values = np.array([v for v, _ in found], float).reshape(-1, _FIGURES)
    return np.repeat(values, [weight for _, weight in found], axis=0)


def train(documents: DataFrame, labels: DataFrame, learnt: Column) -> Model:
    """From the rows whose id meets ``learnt``; without positives or text, no figure has weight."""
    texts = documents.select("doc_id", "text").where(learnt)
    trusted = (
        labels.where("doc_id is not null and quality is not null")
        .where(learnt)
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .where("quality = 1")
        .select("doc_id")
    )
    folder = workspace(documents.sparkSession)
    rows = settle(_measured(texts), folder, "figures")
    unlabelled = _sample(rows, UNLABELLED_ROWS, folder, "unlabelled-drawn")
    trusted_rows = settle(rows.join(trusted, "doc_id"), folder, "positive")
    positive = _sample(trusted_rows, POSITIVE_ROWS, folder, "positive-drawn")
    if len(positive) < 2 or len(unlabelled) < 2:
        return Model(np.zeros((_FIGURES, BINS - 1)), np.zeros((_FIGURES, BINS)), 0.0, 0.5)
    return fit(positive, unlabelled, rows)


def score_documents(documents: DataFrame, labels: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``documents``.

    Needs ``doc_id`` and ``text``, and ``doc_id`` and ``quality`` of ``labels``.  Labels are learnt
    from where the id's checksum mod ``folds`` is not ``fold``.  A document is trusted if all its
    labels are 1; labels without id or quality, or of no document, say nothing.  Null texts count
    as empty and are scored like any other.  Without positives every score is 0.5.  Repeated rows
    repeat; a null id counts as an empty text for ``held_out``.
    """
    held_out = id_checksum("doc_id") % folds == fold
    model = documents.sparkSession.sparkContext.broadcast(train(documents, labels, ~held_out))
    rows = documents.select("doc_id", held_out.alias("held_out"), "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, batch.num_rows * _SLICE_BYTES // max(1, batch.nbytes))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                values = np.array([figures(t.as_py()) for t in part.column(2)], float)
                found = scores(model.value, values.reshape(-1, _FIGURES))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(found, pa.float64())],
                    ["doc_id", "held_out", "score"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(work, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))

"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The matrix A holds one centred row per distinct vector and stays where Spark has it.  Each step
has two passes over its rows: one gives A z, the other Aᵀ u, and each sends a handful of sums.  The left
vectors are as long as the table and are never kept: every u is A y for a y as short as a row, so
a pass works out the entries of all earlier u for the rows it has and sends their products with
the new one.  Both sides are orthogonalised in full, twice.  The singular values and vectors of
the small bidiagonal matrix give the components.  One start vector can meet one vector of a repeated
singular value only, so a second run beside the components found must find nothing larger.
"""

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import settle, workspace

SCALE = 256
COMPONENTS = 4
CONVERGED = 1e-15
NOTHING = 1e-11
_LARGEST = (1 << 63) - 1
_WIDTHS = {2: "<i2", 4: "<i4", 8: "<i8"}


def _packed(numbers: np.ndarray) -> list[bytes]:
    """Rows of whole numbers, each in the narrowest of three widths that holds it."""
    low, high = numbers.min(axis=1), numbers.max(axis=1)
    narrow = (low >= -(1 << 15)) & (high < 1 << 15)
    middle = ~narrow & (low >= -(1 << 31)) & (high < 1 << 31)
    rows = [b""] * len(numbers)
    for kind, chosen in (("<i2", narrow), ("<i4", middle), ("<i8", ~narrow & ~middle)):
        for i in np.flatnonzero(chosen):
            rows[i] = numbers[i].astype(kind).tobytes()
    return rows


def _unpacked(column: pa.Array, width: int) -> np.ndarray:
    rows = column.to_pylist()
    found = np.empty((len(rows), width), np.int64)
    sizes = np.fromiter(map(len, rows), np.int64, len(rows)) // width
    for size, kind in _WIDTHS.items():
        at = np.flatnonzero(sizes == size)
        found[at] = np.frombuffer(b"".join(rows[i] for i in at), kind).reshape(-1, width)
    return found


def _whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * value); beyond a long its end."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * float(scale))
    inside = np.clip(scaled, -(2.0**62), 2.0**62).astype(np.int64)
    beyond = np.abs(scaled) > 2.0**62
    for i in zip(*np.nonzero(beyond), strict=True):
        value = scaled[i]
        inside[i] = max(-_LARGEST - 1, min(_LARGEST, int(value))) if np.isfinite(value) else (
            _LARGEST if value > 0 else -_LARGEST - 1
        )
    return inside


def _lattice(embeddings: DataFrame, scale: int) -> tuple[DataFrame, int]:
    """``vec_id, x`` of the vectors that take part, and the length of the longest of them."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    usable = embeddings.where(F.col("embedding").isNotNull() & ~F.exists("embedding", bad)).select(
        "vec_id", "embedding"
    )
    width = usable.agg(F.max(F.size("embedding"))).first()[0] or 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
            lengths = np.diff(column.offsets.to_numpy())
            # Shorter vectors end in zeros.
            values = np.zeros((len(lengths), width))
            values[np.arange(width) < lengths[:, None]] = flat
            rows = _packed(_whole(values, scale)) if len(lengths) else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["vec_id", "x"])

    kind = embeddings.schema["vec_id"].dataType.simpleString()
    return usable.mapInArrow(pack, f"vec_id {kind}, x binary"), width


class Centred:
    """The distinct vectors less their mean, met in passes."""

    def __init__(self, fit: DataFrame, width: int):
        self.fit, self.width = fit, width
        self.n = fit.count()
        high = self._summed(lambda x: (x >> 32).sum(axis=0), np.int64, "bigint", "decimal(38,0)")
        low = self._summed(lambda x: (x & 0xFFFFFFFF).sum(axis=0), np.int64, "bigint", "decimal(38,0)")
        self.sums = [(int(high[i]) << 32) + int(low[i]) for i in range(width)]

    def _summed(
        self, measure: Callable[[np.ndarray], np.ndarray], dtype=np.float64, kind="double", total="double"
    ) -> dict:
        """The sum of ``measure`` over all rows, by place."""
        width = self.width

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = None
            for batch in batches:
                if batch.num_rows:
                    found = np.asarray(measure(_unpacked(batch.column(0), width)), dtype)
                    held = found if held is None else held + found
            if held is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(held), dtype=np.int32)), pa.array(held)], ["place", "value"]
                )

        parts = self.fit.mapInArrow(work, f"place int, value {kind}")
        rows = parts.groupBy("place").agg(F.sum(F.col("value").cast(total)).alias("value")).collect()
        return {r["place"]: r["value"] for r in rows}

    def summed(self, measure: Callable[[np.ndarray], np.ndarray], length: int) -> np.ndarray:
        """The sum over all rows of what ``measure`` makes of some centred rows."""
        centre = centred(self.n, self.sums)
        found = self._summed(lambda x: measure(centre(x)))
        return np.array([found[i] for i in range(length)])


def centred(n: int, sums: list[int]) -> Callable[[np.ndarray], np.ndarray]:
    """Rows of whole numbers less the mean, subtracted before anything is rounded."""
    largest = max(map(abs, sums), default=0)
    mean = np.array([float(Fraction(s, n)) for s in sums])

    def centre(x: np.ndarray) -> np.ndarray:
        reach = max(int(x.max(initial=0)), -int(x.min(initial=0)))
        if n * reach < 1 << 62 and largest < 1 << 62:
            return (n * x - np.array(sums, np.int64)) / n
        return x.astype(np.float64) - mean

    return centre


def deviations(n: int, sums: list[int], x: np.ndarray) -> list[int | None]:
    """The sum over dimensions of (n*x - S)^2, exactly; None beyond a long."""
    reach = n * max(int(x.max(initial=0)), -int(x.min(initial=0))) + max(map(abs, sums), default=0)
    if reach * reach * max(1, len(sums)) <= _LARGEST:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    found = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1)
    return [int(v) if v <= _LARGEST else None for v in found]


def _away(v: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """``v`` made orthogonal to orthonormal vectors, twice."""
    if others:
        basis = np.array(others)
        for _ in range(2):
            v = v - basis.T @ (basis @ v)
    return v


def bidiagonalise(
    a: Centred, found: list[np.ndarray], wanted: int, converged: float, seed: int = 0
) -> tuple[np.ndarray, np.ndarray, bool]:
    """Leading singular values and right vectors of ``a`` beside the vectors ``found``.

    The last value tells whether the whole space was gone through, so that nothing is left out.
    """
    rng = np.random.default_rng(seed)
    space = a.width - len(found)
    right: list[np.ndarray] = []
    short: list[np.ndarray] = []  # u = A y
    back: list[np.ndarray] = []  # Aᵀ u
    alphas: list[float] = []
    betas: list[float] = []
    scale = 0.0
    v, beta = None, 0.0
    while True:
        if v is None:
            # The start, or the rest of a space that the products no longer reach.
            v = _away(rng.standard_normal(a.width), found + right)
            v, beta = v / np.linalg.norm(v), 0.0
        z = v - beta * short[-1] if beta else v
        ys = np.array(short).reshape(-1, a.width)

        def forth(rows: np.ndarray, z=z, ys=ys) -> np.ndarray:
            u = rows @ z
            return np.append(u @ (rows @ ys.T), u @ u)

        sums = a.summed(forth, len(ys) + 1)
        before = np.sqrt(max(sums[-1], 0.0))
        z = z - ys.T @ sums[:-1]

        def forth_and_back(rows: np.ndarray, z=z, ys=ys) -> np.ndarray:
            u = rows @ z
            return np.concatenate([u @ rows, u @ (rows @ ys.T), [u @ u]])

        sums = a.summed(forth_and_back, a.width + len(ys) + 1)
        back_z, again, norm = sums[: a.width], sums[a.width : -1], sums[-1]
        z = z - ys.T @ again
        if len(ys):
            back_z = back_z - np.array(back).T @ again
        alpha = np.sqrt(max(norm - again @ again, 0.0))
        scale = max(scale, alpha, before)
        right.append(v)
        betas.append(beta)
        if alpha > NOTHING * 1e-3 * scale:
            alphas.append(alpha)
            short.append(z / alpha)
            back.append(back_z / alpha)
            rest = _away(back[-1] - alpha * v, found + right)
            beta = float(np.linalg.norm(rest))
        else:
            alphas.append(0.0)
            short.append(np.zeros(a.width))
            back.append(np.zeros(a.width))
            beta = 0.0
        k = len(right)
        b = np.diag(alphas) + np.diag(betas[1:], 1)
        left, values, turned = np.linalg.svd(b)
        whole = k == space
        near = np.abs(left[-1]) * beta <= converged * max(values[0], 1e-300)
        if whole or (k >= wanted and beta > 0 and near[:wanted].all()):
            vectors = turned[:wanted] @ np.array(right)
            return values[:wanted], vectors / np.linalg.norm(vectors, axis=1)[:, None], whole
        if beta > NOTHING * 1e-3 * scale:
            v = rest / beta
        else:
            v = None


def components(a: Centred, wanted: int) -> np.ndarray:
    """Orthonormal right singular vectors of the largest singular values, as rows."""
    wanted = min(wanted, a.width)
    values, vectors, whole = bidiagonalise(a, [], wanted, CONVERGED)
    seed = 1
    while not whole and len(vectors) < a.width:
        more, others, _ = bidiagonalise(a, list(vectors), 1, 1e-6, seed)
        if more[0] <= values[wanted - 1] * (1 + 1e-9):
            break
        # A repeated value: this vector to full precision, then the largest of all.
        more, others, _ = bidiagonalise(a, list(vectors), 1, CONVERGED, seed)
        order = np.argsort(-np.append(values, more), kind="stable")[: max(wanted, len(values) + 1)]
        values, vectors = np.append(values, more)[order], np.vstack([vectors, others])[order]
        seed += 1
    vectors = vectors[:wanted]
    return np.array([v / np.linalg.norm(v) for v in vectors])


def whiten(embeddings: DataFrame, count: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``.

    ``embeddings`` needs ``vec_id`` and ``embedding``; other columns are not read.  Rows whose
    vector is null or holds null or non-finite entries are left out.  The others become whole
    numbers x = floor(scale * entry), at a long's end if beyond it; shorter vectors count as ending
    in zeros.  Each distinct x is fitted on once, every row is whitened: repeated rows repeat, a
    null id stays null.  There are at most ``count`` components, fewer if the vectors vary in fewer
    directions, and no rows at all if they do not vary (one distinct vector, none, an empty
    table).  Equal eigenvalues have any orthonormal vectors of their space.  ``deviation`` is null
    beyond a long.
    """
    spark = embeddings.sparkSession
    folder = workspace(spark)
    id_kind = embeddings.schema["vec_id"].dataType.simpleString()
    kind = (
        f"vec_id {id_kind}, component int, n bigint, deviation bigint, whitened double, "
        "explained double, identity_error double"
    )
    rows, width = _lattice(embeddings, scale)
    if not width:
        return spark.createDataFrame([], kind)
    rows = settle(rows, folder, "rows")
    a = Centred(settle(rows.select("x").distinct(), folder, "fit"), width)
    trace = float(a.summed(lambda r: np.array([(r * r).sum()]), 1)[0]) / a.n
    if not trace > 0:
        return spark.createDataFrame([], kind)
    basis = components(a, count)
    own = a.summed(lambda r: ((r @ basis.T) ** 2).sum(axis=0), len(basis)) / a.n
    order = np.argsort(-own, kind="stable")
    basis, own = basis[order], own[order]
    kept = own > NOTHING**2 * own[0]
    basis, own = basis[kept], own[kept]
    k, n, sums = len(own), a.n, a.sums
    root = np.sqrt(own)

    def spread(r: np.ndarray) -> np.ndarray:
        w = r @ basis.T / root
        return np.concatenate([(w.T @ w).ravel(), w.sum(axis=0)])

    total = a.summed(spread, k * k + k) / n
    covariance = total[: k * k].reshape(k, k) - np.outer(total[k * k :], total[k * k :])
    error = float(np.abs(covariance - np.eye(k)).max())
    centre, explained = centred(n, sums), own / trace

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unpacked(batch.column(1), width)
            w = centre(x) @ basis.T / root
            size = len(x) * k
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(size, n, np.int64)),
                    pa.array([d for d in deviations(n, sums, x) for _ in range(k)], pa.int64()),
                    pa.array(w.ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(size, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(work, kind)

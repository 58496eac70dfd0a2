import math
from fractions import Fraction

import numpy as np
import pytest

from jobtide.llm import whitening

KIND = "vec_id long, embedding array<float>, label int, x string"


def brute(rows, count=4):
    """Components by numpy's eigenvalues; rows are (id, vector)."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in kept), default=0)
    x = [
        [math.floor(Fraction(256) * Fraction(c)) for c in v] + [0] * (width - len(v)) for _, v in kept
    ]
    fit = sorted(set(map(tuple, x)))
    n = len(fit)
    s = [sum(column) for column in zip(*fit)]
    a = np.array([[float(Fraction(n * c - t, n)) for c, t in zip(r, s)] for r in fit]).reshape(n, width)
    values, vectors = np.linalg.eigh(a.T @ a / max(n, 1))
    order = [i for i in np.argsort(-values) if values[i] > 1e-9 * values.max()][:count]
    out = []
    for (i, _), r in zip(kept, x):
        deviation = sum((n * c - t) ** 2 for c, t in zip(r, s))
        d = np.array([float(Fraction(n * c - t, n)) for c, t in zip(r, s)])
        out.append((i, n, deviation if deviation < 2**63 else None, d @ vectors[:, order] / np.sqrt(values[order])))
    return out, values[order] / np.trace(a.T @ a / max(n, 1))


def compare(spark, rows, exact=True):
    found = whitening.whiten(spark.createDataFrame([(i, v, 1, "x") for i, v in rows], KIND)).collect()
    expected, explained = brute([(i, None if v is None else [c if c is None else float(np.float32(c)) for c in v]) for i, v in rows])
    k = len(explained)
    assert len(found) == len(expected) * k
    if not k:
        return
    np.testing.assert_allclose([r.explained for r in found[:k]], explained, rtol=1e-10)
    assert max(r.identity_error for r in found) < 1e-9 and len({r.identity_error for r in found}) == 1
    key = lambda r: (r[0] is None, r[0] or 0, str(r[2]))
    got = {}
    for r in found:
        got.setdefault(r.component, []).append((r.vec_id, r.n, r.deviation, r.whitened))
    assert sorted(got) == list(range(1, k + 1))
    for c, mine in got.items():
        mine.sort(key=key)
        theirs = sorted(((i, n, d, w[c - 1]) for i, n, d, w in expected), key=key)
        assert [m[:3] for m in mine] == [t[:3] for t in theirs]
        if exact:
            w, t = np.array([m[3] for m in mine]), np.array([t[3] for t in theirs])
            sign = np.sign(w @ t)
            np.testing.assert_allclose(sign * w, t, atol=1e-8)


def test_equals_eigenvectors(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 12)) * np.linspace(2, 0.1, 12)
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(100, rows[0][1]), (100, rows[1][1]), (None, rows[2][1])]  # repeated ids, vectors, a null id
    rows += [(7, None), (8, [1.0, None]), (9, [float("nan")] * 12), (10, [float("inf")] * 12), (11, [0.5] * 5), (12, [])]
    compare(spark, rows)


def test_repeated_eigenvalues_and_low_rank(spark):
    corners = [(i, [s * (3.0 if j == i // 2 else 0.0) for j in range(5)]) for i, s in zip(range(10), [1, -1] * 5)]
    compare(spark, corners, exact=False)  # every eigenvalue is the same
    line = [(i, [float(i), 2.0 * i, 0.0, 0.0, 0.0, 0.0]) for i in range(9)]
    compare(spark, line)
    two = [(i, [float(i % 3), float(i // 3) * 2, 1.0, 1.0, 1.0]) for i in range(9)]
    compare(spark, two)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, []), (2, [])], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])]])
def test_nothing_varies(spark, rows):
    compare(spark, rows)


def test_very_large_entries(spark):
    found = whitening.whiten(
        spark.createDataFrame([(1, [3e38, 0.0], 1, ""), (2, [0.0, 1.0], 1, ""), (3, [-3e38, 2.0], 1, "")], KIND)
    ).collect()
    assert {r.vec_id for r in found} == {1, 2, 3} and {r.deviation for r in found if r.vec_id != 2} == {None}
    near = [(1, [2.0**40, 1.0]), (2, [-(2.0**39), 7.0]), (3, [0.0, -3.0])]
    compare(spark, near)


def test_a_repeated_largest_value_is_found_twice():
    """Beside numpy only: a matrix whose leading value one start vector meets once."""

    class Held:
        def __init__(self, rows):
            self.rows, self.width = rows, rows.shape[1]

        def summed(self, measure, length):
            return measure(self.rows)

    rng = np.random.default_rng(1)
    left, _ = np.linalg.qr(rng.standard_normal((200, 30)))
    turned, _ = np.linalg.qr(rng.standard_normal((30, 30)))
    values = np.r_[9.0, 9.0, 9.0, 5.0, 5.0, np.linspace(1, 0.01, 25)]
    found = whitening.components(Held(left * values @ turned.T), 4)
    np.testing.assert_allclose(found @ found.T, np.eye(4), atol=1e-12)
    own = np.linalg.norm((left * values @ turned.T) @ found.T, axis=0)
    np.testing.assert_allclose(np.sort(own)[::-1], [9, 9, 9, 5], rtol=1e-12)

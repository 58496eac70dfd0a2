"""Exact top-k inner products over norm-sorted, rotated vectors.

Components are quantized to integers.  All vectors are dealt by descending length into blocks of
about ``BLOCK_ROWS`` rows (ties in length split by id) and rotated by the right singular vectors
of the whole set, which gather most of a product in the first ``HEAD`` components.  A query meets
the first block, which gives it a k-th best score to beat, and then each further block whose
longest vector could still beat it.  Within a block rows are visited by descending length; by
Cauchy-Schwarz a row is skipped if head product plus the product of the tail lengths stays below
the score to beat.  What is left gets its exact integer product.

Query blocks meet candidate blocks in one group per pair of blocks, whose size is bounded however
many rows there are.  The driver sees the moments of the components (one square matrix) and the
largest length of each block.
"""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import settle, workspace

SCALE = 64
K = 20
BLOCK_ROWS = 8192
QUERY_ROWS = 1024
HEAD = 16
CHUNK = 1024
# Sums of products below this are exact in double precision.
_EXACT = float(1 << 52)
_LONG = (1 << 63) - 1
_FOUND = "query_row bigint, query_id bigint, vec_id bigint, score bigint"


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), width)


def _exact_products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products; in Python integers where doubles could round."""
    width = max(1, queries.shape[1])
    top = np.abs(queries).max(initial=0.0) * np.abs(rows).max(initial=0.0)
    if top * width < _EXACT:
        return queries @ rows.T
    as_int = np.vectorize(int, otypes=[object])
    return np.clip(as_int(queries).dot(as_int(rows).T), -_LONG, _LONG)


class Search:
    """The best ``k`` rows so far for each query of a block."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray):
        self.own, self.ids, self.k, self.floor = rows, ids, k, floor.astype(np.float64)
        self.best: list[list[tuple]] = [[] for _ in ids]

    def visit(
        self, q: np.ndarray, qr: np.ndarray, rows: np.ndarray, ids: np.ndarray, c: np.ndarray, cr: np.ndarray
    ):
        """Rows in descending length: ``q``, ``c`` integers, ``qr``, ``cr`` rotated."""
        head = min(HEAD, q.shape[1])
        q_tail = np.linalg.norm(qr[:, head:], axis=1)
        c_tail = np.linalg.norm(cr[:, head:], axis=1)
        q_len, c_len = np.linalg.norm(q, axis=1), np.linalg.norm(c, axis=1)
        for start in range(0, len(ids), CHUNK):
            part = slice(start, start + CHUNK)
            # Rotation rounds; the slack is far above what it can lose.
            slack = 1e-9 * (1.0 + q_len * c_len[start])
            alive = q_len * c_len[start] + slack >= self.floor
            if not alive.any():
                return
            at = np.flatnonzero(alive)
            bound = qr[at, :head] @ cr[part, :head].T + np.outer(q_tail[at], c_tail[part])
            near = bound + slack[at, None] >= self.floor[at, None]
            near &= self.own[at, None] != rows[None, part]
            columns = np.flatnonzero(near.any(axis=0))
            if not len(columns):
                continue
            scores = _exact_products(q[at], c[part][columns])
            near = near[:, columns]
            found_ids = ids[part][columns]
            for i, row in enumerate(at):
                good = np.flatnonzero(near[i] & (scores[i] >= self.floor[row]))
                if len(good) > self.k:
                    least = np.partition(scores[i][good], len(good) - self.k)[-self.k]
                    good = good[scores[i][good] >= least]  # ties of the last one stay
                if not len(good):
                    continue
                better = [(-scores[i, j], found_ids[j]) for j in good]
                kept = sorted(self.best[row] + better)[: self.k]
                self.best[row] = kept
                if len(kept) == self.k:
                    # Beyond exact doubles a step lower, so that no tie is lost.
                    last = float(-kept[-1][0])
                    last = last if abs(last) < _EXACT else np.nextafter(last, -np.inf)
                    self.floor[row] = max(self.floor[row], last)

    def rows(self) -> pd.DataFrame:
        return pd.DataFrame(
            [
                (int(own), int(query), int(vec), int(-score))
                for own, query, found in zip(self.own, self.ids, self.best, strict=True)
                for score, vec in found
            ],
            columns=["query_row", "query_id", "vec_id", "score"],
        )


def _quantized(embeddings: DataFrame) -> DataFrame:
    """``vec_id``, ``v``, ``row`` of the rows whose vector is usable; ``row`` is theirs alone."""
    # ``floor`` of a double is a long; beyond its range doubles are whole numbers already.
    big = lambda x: F.abs(x) >= F.lit(float(1 << 53))
    scaled = lambda x: x.cast("double") * F.lit(float(SCALE))
    vector = F.transform(
        "embedding", lambda x: F.when(big(x), scaled(x)).otherwise(F.floor(scaled(x)).cast("double"))
    )
    usable = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    rows = embeddings.where("vec_id is not null and embedding is not null").where(usable)
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    return rows.select("vec_id", vector.alias("v"), F.monotonically_increasing_id().alias("row"))


def top_products(embeddings: DataFrame, is_query, k: int = K) -> DataFrame:
    """The ``k`` highest integer inner products of each query with all other rows.

    ``embeddings`` needs ``vec_id`` and ``embedding``; ``is_query`` is a condition on ``vec_id``.
    Returns ``query_id, rank, vec_id, score``; equal scores rank by smaller id.  Rows without an
    id, null vectors and vectors with null or non-finite components take no part.  Every
    row is a candidate of its own and, if it meets the condition, a query of its own, also where
    rows share an id or a vector.  Only vectors of one length (dimension) are compared; empty ones
    score 0.  Scores beyond a long stay at its ends.  No row, or only
    one, gives no result.
    """
    spark = embeddings.sparkSession
    folder = workspace(spark)
    base = settle(
        _quantized(embeddings)
        .withColumn("width", F.size("v"))
        .withColumn("len", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))),
        folder,
        "quantized",
    )
    parts, blocks = [], 0
    for row in base.groupBy("width").count().collect():  # one row per dimension
        parts.append(_search(base.where(F.col("width") == row["width"]), row["width"], row["count"], is_query, k, f"{folder}/{row['width']}"))
        blocks += -(-row["count"] // BLOCK_ROWS)
    schema = _FOUND
    found = spark.createDataFrame([], schema)
    for part in parts:
        found = found.unionByName(part)
    order = F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("v"))
    # A query's finds are at most k from each candidate block: first the best of each of some
    # parts, then of these.
    split = F.pmod(F.xxhash64("vec_id"), F.lit(max(1, math.isqrt(blocks))))
    first = (
        found.groupBy("query_row", "query_id", split.alias("split"))
        .agg(F.slice(F.sort_array(F.collect_list(order)), 1, k).alias("b"))
        .select("query_row", "query_id", F.explode("b").alias("b"))
    )
    best = first.groupBy("query_row", "query_id").agg(F.slice(F.sort_array(F.collect_list("b")), 1, k).alias("b"))
    return best.select("query_id", F.posexplode("b").alias("at", "b")).select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("b.v").alias("vec_id"),
        (-F.col("b.s")).alias("score"),
    )


def _search(base: DataFrame, width: int, count: int, is_query, k: int, folder: str) -> DataFrame:
    blocks = max(1, -(-count // BLOCK_ROWS))
    query_blocks = max(1, -(-base.where(is_query).count() // QUERY_ROWS))
    safe = 1.0 if width == 0 else max(1.0, base.agg(F.max("len")).first()[0])

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for batch in batches:
            rows = np.array(batch["v"].tolist(), np.float64).reshape(len(batch), width) / safe
            total += rows.T @ rows
        yield pd.DataFrame({"m": [total.tobytes()]})

    total = np.zeros((width, width))
    for row in base.select("v").coalesce(64).mapInPandas(moments, "m binary").toLocalIterator():
        total += np.frombuffer(row["m"], np.float64).reshape(width, width)
    # Right singular vectors of the set: eigenvectors of its moments, the strongest first.
    turn = np.linalg.eigh(total)[1][:, ::-1] if width else total

    def block(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId()
        for batch in batches:
            rows = np.array(batch["v"].tolist(), np.float64).reshape(len(batch), width)
            yield pd.DataFrame(
                {
                    "block": number,
                    "row": batch["row"],
                    "vec_id": batch["vec_id"],
                    "len": batch["len"],
                    "v": [r.tobytes() for r in rows],
                    "r": [r.tobytes() for r in rows @ turn],
                }
            )

    kind = "block int, row bigint, vec_id bigint, len double, v binary, r binary"
    dealt = base.repartitionByRange(blocks, F.desc("len"), "vec_id", "row")
    rows = settle(dealt.mapInPandas(block, kind), folder, "blocks")
    longest = {
        row["block"]: row["top"]
        for row in rows.groupBy("block").agg(F.max("len").alias("top")).collect()
    }
    tops = np.array([longest.get(b, 0.0) for b in range(max(longest, default=0) + 1)])
    queries = rows.where(is_query).withColumn(
        "qblock", F.pmod(F.xxhash64("row"), F.lit(query_blocks)).cast("int")
    )
    if tops.size == 0:
        return base.sparkSession.createDataFrame([], _FOUND)

    def meet(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        search = Search(left["row"].to_numpy(), left["vec_id"].to_numpy(), k, left["floor"].to_numpy())
        if len(left) and len(right):
            right = right.sort_values(["len", "vec_id"], ascending=[False, True])
            search.visit(
                _matrix(left["v"], width),
                _matrix(left["r"], width),
                right["row"].to_numpy(),
                right["vec_id"].to_numpy(),
                _matrix(right["v"], width),
                _matrix(right["r"], width),
            )
        return search.rows()

    def grid(left: DataFrame, right: DataFrame) -> DataFrame:
        return (
            left.groupBy("qblock", "block")
            .cogroup(right.groupBy("qblock", "block"))
            .applyInPandas(meet, _FOUND)
        )

    lowest = F.lit(float("-inf"))
    first = settle(
        grid(
            queries.select(
                "qblock", F.lit(0).alias("block"), "row", "vec_id", "v", "r", lowest.alias("floor")
            ),
            rows.where("block = 0").withColumn(
                "qblock", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
            ),
        ),
        folder,
        "first",
    )
    floors = (
        first.groupBy("query_row")
        .agg(F.count("*").alias("n"), F.min("score").alias("floor"))
        .where(F.col("n") >= k)
        # The next double below, where doubles no longer hold every whole number.
        .withColumn(
            "floor",
            F.when(F.abs("floor") < _EXACT, F.col("floor").cast("double")).otherwise(
                F.col("floor").cast("double") - F.abs(F.col("floor").cast("double")) * 1e-15
            ),
        )
        .select(F.col("query_row").alias("row"), "floor")
    )

    def onward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each query once for every further block that could hold a better row."""
        for batch in batches:
            reach = batch["len"].to_numpy()[:, None] * tops[None, 1:] * (1 + 1e-9) + 1e-9
            query, other = np.nonzero(reach >= batch["floor"].to_numpy()[:, None])
            for at in range(0, len(query), 4096):
                out = batch.iloc[query[at : at + 4096]].copy()
                out["block"] = other[at : at + 4096] + 1
                yield out[["qblock", "block", "row", "vec_id", "v", "r", "floor"]]

    kind = "qblock int, block int, row bigint, vec_id bigint, v binary, r binary, floor double"
    later = settle(
        queries.join(floors, "row", "left")
        .select("qblock", "row", "vec_id", "len", "v", "r", F.coalesce("floor", lowest).alias("floor"))
        .mapInPandas(onward, kind),
        folder,
        "later",
    )
    # A block's rows go to the query blocks that have a query for it, and to no other.
    cells = settle(later.select("qblock", "block").distinct(), folder, "cells")
    return first.unionByName(grid(later, rows.join(cells, "block")))

"""Exact Jaccard join of word shingle sets by prefixes under several global token orders.

Two sets are linked from ``NUM / DEN`` on.  Such a pair shares a token within the first
``n - ceil(n * NUM / DEN) + 1`` tokens of either set, whatever the order of all tokens.  The
orders here all begin with the number of sets that hold a token and differ in the hash that
breaks ties.  So tokens of a single set stand first in each of them, and a set whose prefix they
fill has no partner: it leaves before any pair is thought of.  The others meet in the buckets of
their rarest shared tokens; buckets that hang together form a cluster, and within a cluster a pair
counts as a candidate only if its prefixes meet under every order and its sizes allow the link.
Candidates are verified on their whole sets.

What moves: documents are read in chunks of about a million tokens.  A chunk sends its distinct
tokens once, cut by hash range; a range counts them and answers with those that occur elsewhere
too.  A token that stands in many documents of a chunk is sent and answered once for all of them,
so no group grows with a hot passage.  Equal sets are one node from the start.  Large clusters
are cut into blocks that meet pairwise; a pair of blocks reports one edge per node at most.
"""

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import claim, release_memory, settle, unused, without, workspace
from jobtide.llm.components import components

WORDS = 4
NUM, DEN = 85, 100
ORDERS = 3
CHUNK_TOKENS = 1 << 20
CHUNK_DOCS = 50_000
MANY = 0xFFFF  # in place of a document: the token stands in several of the chunk
BLOCK_NODES = 512
BLOCK_TOKENS = 1 << 20
RANGE_TOKENS = 1 << 19
_COLUMNS = 4096
_MASK = (1 << 64) - 1
_KEPT_WORDS = 200_000


class _Words(dict):
    """64-bit hashes of words, kept."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _Words()


def _forget() -> None:
    _HASHES.clear()


def _mix(values: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finalizer: each seed orders the values in another way."""
    x = values + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles; of a shorter text the whole sequence is one."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    values = np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found))
    length = min(words, len(values))
    count = len(values) - length + 1
    joined = np.full(count, length, np.uint64)
    for k in range(length):
        joined = _mix(joined * np.uint64(0x100000001B3) + values[k : k + count], k + 1)
    return np.unique(joined)


def node_of(tokens: np.ndarray) -> int:
    """A signed 64-bit name of a set of shingles."""
    return struct.unpack("<q", xxhash.xxh3_64_digest(tokens.tobytes()))[0]


def prefix_length(n, num: int = NUM, den: int = DEN):
    return n - (num * n + den - 1) // den + 1


def _planes(tokens: np.ndarray) -> bytes:
    """Sorted tokens byte by byte, without the last: equal leading bytes compress well."""
    return tokens.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :7].T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    rows = np.frombuffer(data, np.uint8).reshape(7, -1)
    full = np.zeros((rows.shape[1], 8), np.uint8)
    full[:, :7] = rows.T
    return full.view(">u8").ravel().astype(np.uint64)


_SENT = pa.schema(
    [
        ("range", pa.int32()),
        ("chunk", pa.int64()),
        ("header", pa.bool_()),
        ("tokens", pa.binary()),
        ("places", pa.binary()),
        ("counts", pa.binary()),
        ("nodes", pa.binary()),
        ("sizes", pa.binary()),
    ]
)
_SENT_SQL = (
    "range int, chunk bigint, header boolean, tokens binary, places binary, counts binary, "
    "nodes binary, sizes binary"
)


def _chunk_rows(chunk: int, sets: dict[int, np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    """What a chunk sends: a header with its nodes, and its tokens by range."""
    sizes = np.array([len(s) for s in sets.values()], np.int32)
    tokens = np.concatenate(list(sets.values())) & np.uint64(0xFFFFFFFFFFFFFF00)
    places = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, places = tokens[order], places[order]
    first = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
    counts = np.diff(np.r_[first, len(tokens)])
    many = counts > 1
    inside = np.repeat(many, counts)
    distinct, place = tokens[first], places[first].copy()
    place[many] = MANY
    rows = [
        {
            "range": int(xxhash.xxh3_64_intdigest(str(chunk)) >> (64 - bits)),
            "chunk": chunk,
            "header": True,
            "tokens": tokens[inside].tobytes(),
            "places": places[inside].tobytes(),
            "counts": b"",
            "nodes": np.fromiter(sets, np.int64, len(sets)).tobytes(),
            "sizes": sizes.tobytes(),
        }
    ]
    owners, starts = np.unique(distinct >> np.uint64(64 - bits), return_index=True)
    ends = np.r_[starts[1:], len(distinct)]
    for number, start, end in zip(owners, starts, ends, strict=True):
        part = slice(start, end)
        rows.append(
            {
                "range": int(number),
                "chunk": chunk,
                "header": False,
                "tokens": _planes(distinct[part]),
                "places": place[part].tobytes(),
                "counts": counts[part][many[part]].astype(np.int32).tobytes(),
                "nodes": None,
                "sizes": None,
            }
        )
    for start in range(0, len(rows), 256):
        yield pa.RecordBatch.from_pylist(rows[start : start + 256], schema=_SENT)


def _shared_sets(documents: DataFrame, total: int, words: int, num: int, den: int) -> DataFrame:
    """``node, n, take, tokens, spread``: the sets that may have a partner.

    ``tokens`` are those that other sets hold too, ``spread`` in how many places, ``take`` the
    number of them in a prefix.  ``total`` is the number of tokens of all documents.
    """
    bits = max(8, (total // RANGE_TOKENS).bit_length())

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("jaccard", _forget)
        # The same on every attempt, as partitions and their rows are.
        chunk = TaskContext.get().partitionId() << 32
        sets: dict[int, np.ndarray] = {}
        held = 0
        for batch in batches:
            for text in batch.column(0):
                tokens = shingles(text.as_py(), words)
                if not len(tokens):
                    continue
                node = node_of(tokens)
                if node in sets:
                    continue
                sets[node] = tokens
                held += len(tokens)
                if held >= CHUNK_TOKENS or len(sets) >= CHUNK_DOCS:
                    yield from _chunk_rows(chunk, sets, bits)
                    chunk, sets, held = chunk + 1, {}, 0
        if sets:
            yield from _chunk_rows(chunk, sets, bits)
        sets = {}
        release_memory()

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        headers = pdf[pdf["header"]]
        asked = pdf[~pdf["header"]]
        if not len(asked):
            return headers
        parts = [_from_planes(t) for t in asked["tokens"]]
        tokens = np.concatenate(parts)
        places = np.frombuffer(b"".join(asked["places"]), np.uint16)
        weights = np.ones(len(tokens), np.int64)
        weights[places == MANY] = np.frombuffer(b"".join(asked["counts"]), np.int32)
        order = np.argsort(tokens, kind="stable")
        first = np.flatnonzero(np.r_[True, tokens[order][1:] != tokens[order][:-1]])
        totals = np.add.reduceat(weights[order], first)
        spread = np.empty(len(tokens), np.int64)
        spread[order] = np.repeat(totals, np.diff(np.r_[first, len(tokens)]))
        spread = np.minimum(spread, 0x7FFFFFFF).astype(np.int32)
        rows, start = [], 0
        for chunk, part in zip(asked["chunk"], parts, strict=True):
            here = slice(start, start + len(part))
            start += len(part)
            shared = spread[here] > 1
            if shared.any():
                rows.append(
                    (chunk, _planes(part[shared]), places[here][shared].tobytes(), spread[here][shared].tobytes())
                )
        answers = pd.DataFrame(rows, columns=["chunk", "tokens", "places", "counts"])
        answers["range"], answers["header"] = 0, False
        answers["nodes"] = answers["sizes"] = None
        answered = pd.concat([headers, answers])[list(pdf.columns)]
        release_memory()
        return answered

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        columns = ["node", "n", "take", "tokens", "spread"]
        head = pdf[pdf["header"]].iloc[0]
        answers = pdf[~pdf["header"]]
        nodes = np.frombuffer(head["nodes"], np.int64)
        sizes = np.frombuffer(head["sizes"], np.int32).astype(np.int64)
        if not len(answers):
            return pd.DataFrame([], columns=columns)
        tokens = np.concatenate([_from_planes(t) for t in answers["tokens"]])
        places = np.frombuffer(b"".join(answers["places"]), np.uint16)
        spread = np.frombuffer(b"".join(answers["counts"]), np.int32)
        one = places != MANY
        # Tokens of several documents of this chunk: their places stand in the header.
        order = np.argsort(tokens[~one])
        many_tokens, many_spread = tokens[~one][order], spread[~one][order]
        own_tokens = np.frombuffer(head["tokens"], np.uint64)
        own_places = np.frombuffer(head["places"], np.uint16)
        at = np.searchsorted(many_tokens, own_tokens)
        tokens = np.concatenate([tokens[one], own_tokens])
        places = np.concatenate([places[one], own_places])
        spread = np.concatenate([spread[one], many_spread[at] if len(own_tokens) else many_spread[:0]])
        order = np.lexsort((tokens, places))
        tokens, places, spread = tokens[order], places[order], spread[order]
        shared = np.bincount(places, minlength=len(nodes))
        take = prefix_length(sizes, num, den) - (sizes - shared)
        ends = np.cumsum(shared)
        rows = [
            (nodes[i], sizes[i], take[i], tokens[ends[i] - shared[i] : ends[i]].tobytes(), spread[ends[i] - shared[i] : ends[i]].tobytes())
            for i in np.flatnonzero((take > 0) & (shared > 0))
        ]
        gathered = pd.DataFrame(rows, columns=columns)
        release_memory()
        return gathered

    kind = "node bigint, n bigint, take bigint, tokens binary, spread binary"
    sent = documents.select("text").mapInArrow(send, _SENT_SQL)
    answered = sent.groupBy("range").applyInPandas(answer, _SENT_SQL)
    return answered.groupBy("chunk").applyInPandas(gather, kind).dropDuplicates(["node"])


def _prefix(tokens: bytes, spread: bytes, take: int, seed: int) -> np.ndarray:
    """The first ``take`` tokens under an order: the rarest first, ties by a hash."""
    values = np.frombuffer(tokens, np.uint64)
    order = np.lexsort((_mix(values, 1000 + seed), np.frombuffer(spread, np.int32)))
    return values[order[:take]]


def _meetings(owners: np.ndarray, tokens: np.ndarray, nodes: int) -> np.ndarray:
    """How many tokens each two of the nodes share."""
    shared = np.zeros((nodes, nodes), np.float32)
    _, column, counts = np.unique(tokens, return_inverse=True, return_counts=True)
    keep = counts[column] > 1
    renumber = np.cumsum(counts > 1) - 1
    owners, column = owners[keep], renumber[column[keep]]
    order = np.argsort(column, kind="stable")
    owners, column = owners[order], column[order]
    total = int(column[-1]) + 1 if len(column) else 0
    for start in range(0, total, _COLUMNS):
        low, high = np.searchsorted(column, (start, start + _COLUMNS))
        dense = np.zeros((nodes, min(_COLUMNS, total - start)), np.float32)
        dense[owners[low:high], column[low:high] - start] = 1
        shared += dense @ dense.T
    return shared


def links(group: pd.DataFrame, num: int, den: int) -> list[tuple[int, int]]:
    """Edges that connect what the linked pairs of the group connect: one per node at most.

    If the group is a meeting of two blocks (``side`` 0 and 1), pairs within a block are left to
    the block's own group.
    """
    nodes = len(group)
    if nodes < 2:
        return []
    n = group["n"].to_numpy()
    near = np.minimum.outer(n, n) * den >= np.maximum.outer(n, n) * num
    np.fill_diagonal(near, False)
    side = group["side"].to_numpy()
    if side.any():
        near &= side[:, None] != side[None, :]
    for seed in range(ORDERS):
        if not near.any():
            return []
        parts = [
            _prefix(t, s, k, seed)
            for t, s, k in zip(group["tokens"], group["spread"], group["take"], strict=True)
        ]
        owners = np.repeat(np.arange(nodes), [len(p) for p in parts])
        near &= _meetings(owners, np.concatenate(parts), nodes) > 0
    kept = np.flatnonzero(near.any(axis=0))
    if not len(kept):
        return []
    parts = [np.frombuffer(group["tokens"].iloc[i], np.uint64) for i in kept]
    owners = np.repeat(np.arange(len(kept)), [len(p) for p in parts])
    common = _meetings(owners, np.concatenate(parts), len(kept)).astype(np.int64)
    n, near = n[kept], near[np.ix_(kept, kept)]
    linked = near & (den * common >= num * (n[:, None] + n[None, :] - common))
    label = np.arange(len(kept))
    while True:
        # The smallest label in reach, until it stays.
        lowest = np.minimum(label, np.where(linked, label[None, :], len(kept)).min(axis=1))
        lowest = lowest[lowest]
        if (lowest == label).all():
            break
        label = lowest
    names = group["node"].to_numpy()[kept]
    return [
        (int(names[i]), int(names[label[i]])) for i in range(len(kept)) if label[i] != i
    ]


def similar_documents(
    documents: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, text_hash``.

    ``documents`` needs ``doc_id`` and ``text``; other columns are not read.  The component is
    the smallest id reachable over links.  A null, empty or blank text has no shingles and is
    linked with nothing, not even with another such text.  Rows repeat as they come in, so a
    repeated row is a copy of itself; a null id takes the smallest id of its component, or null
    if there is none.  A text of fewer words than a shingle has its whole sequence as one.
    """
    spark = documents.sparkSession
    folder = workspace(spark)
    documents = documents.select("doc_id", "text")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("jaccard", _forget)
        for batch in batches:
            sizes, nodes = [], []
            for text in batch.column(2):
                found = shingles(text.as_py(), words)
                sizes.append(len(found))
                nodes.append(node_of(found) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.int64()),
                ],
                ["doc_id", "text_hash", "n_shingles", "node"],
            )
        release_memory()

    kind = documents.schema["doc_id"].dataType.simpleString()
    named = settle(
        documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
            name, f"doc_id {kind}, text_hash bigint, n_shingles bigint, node bigint"
        ),
        folder,
        "named",
    )
    total = named.agg(F.sum("n_shingles")).first()[0] or 0
    sets = settle(_shared_sets(documents, total, words, num, den), folder, "sets")

    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prefixes = [
                _prefix(tokens, spread, take, 0)
                for tokens, spread, take in zip(
                    batch["tokens"], batch["spread"], batch["take"], strict=True
                )
            ]
            if prefixes:
                nodes = np.repeat(batch["node"].to_numpy(), [len(p) for p in prefixes])
                yield pd.DataFrame({"token": np.concatenate(prefixes).view(np.int64), "node": nodes})

    postings = settle(sets.mapInPandas(post, "token bigint, node bigint"), folder, "postings")
    buckets = settle(
        postings.groupBy("token")
        .agg(F.min("node").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("token", "first"),
        folder,
        "buckets",
    )
    tied = postings.join(buckets, "token").where("node <> first")
    clusters = settle(
        components(tied.select(F.col("node").alias("a"), F.col("first").alias("b")), f"{folder}/c"),
        folder,
        "clusters",
    )
    sizes = settle(
        clusters.join(sets.select("node", F.octet_length("tokens").alias("bytes")), "node")
        .groupBy("label")
        .agg(F.count("*").alias("m"), F.sum(F.col("bytes") / 8).alias("t"))
        .select(
            "label",
            F.greatest(
                F.ceil(F.col("m") / BLOCK_NODES), F.ceil(F.col("t") / BLOCK_TOKENS)
            ).cast("int").alias("blocks"),
        ),
        folder,
        "sizes",
    )
    total = sizes.agg(F.sum("blocks")).first()[0] or 1
    placed = sets.join(clusters, "node").join(sizes, "label")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = placed.select("label", "node", "n", "take", "tokens", "spread", "blocks", block.alias("own"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    cells = placed.select("*", other).select(
        # Small clusters go to a task together; they are told apart there.
        F.when(F.col("blocks") > 1, F.xxhash64("label"))
        .otherwise(F.pmod(F.xxhash64("label"), F.lit(max(256, int(total) // 32))))
        .alias("bin"),
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        "label",
        F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"),
        "node",
        "n",
        "take",
        "tokens",
        "spread",
    )

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [edge for _, group in pdf.groupby("label") for edge in links(group, num, den)]
        return pd.DataFrame(found, columns=["a", "b"])

    edges = settle(
        cells.groupBy("bin", "low", "high").applyInPandas(meet, "a bigint, b bigint"),
        folder,
        "links",
    )
    labels = settle(components(edges, f"{folder}/l"), folder, "labels")
    joined = settle(
        named.join(labels, "node", "left").select(
            "doc_id", "text_hash", "n_shingles", F.coalesce("label", "node").alias("label")
        ),
        folder,
        "joined",
    )
    lowest = settle(
        joined.where("label is not null")
        .groupBy("label")
        .agg(F.min("doc_id").alias("low"), F.count("*").alias("n"))
        .where("n > 1")
        .select("label", "low"),
        folder,
        "lowest",
    )
    return joined.join(lowest, "label", "left").select(
        "doc_id", "n_shingles", F.coalesce("low", "doc_id").alias("component_id"), "text_hash"
    )


def one_of_each(
    documents: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN
) -> DataFrame:
    """``documents`` with one row of each group of similar ones: that with the smallest id.

    All columns stay.  Documents without words are no copies of each other and all stay.  Where
    similar texts share the smallest id, each distinct one of them stays once; groups of which no
    row has an id stay whole but for repeated texts.
    """
    folder = workspace(documents.sparkSession)
    found = settle(
        similar_documents(documents, words, num, den).where("n_shingles > 0"), folder, "similar"
    )
    id_name, hash_name, own = unused(documents, "other_id", "other_hash", "text_hash")
    # An id and its text: the same id may stand for other texts, too.
    extra = settle(
        found.where("component_id is not null and (doc_id is null or doc_id <> component_id)")
        .select(F.col("doc_id").alias(id_name), F.col("text_hash").alias(hash_name))
        .distinct(),
        folder,
        "extra",
    )
    kept = without(documents, extra)
    # Rows that repeat an id and its set are copies as well; the texts of others are not moved.
    repeated = settle(
        found.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(
            F.col("doc_id").alias(id_name), F.lit(True).alias(hash_name)
        ),
        folder,
        "repeated",
    )
    if repeated.isEmpty():
        return kept
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    again = F.col(hash_name).isNotNull() & has_words
    marked = kept.withColumn(own, F.xxhash64("text"))
    marked = marked.join(repeated, F.col("doc_id").eqNullSafe(F.col(id_name)), "left")
    return (
        marked.where(~again)
        .unionByName(marked.where(again).dropDuplicates(["doc_id", own]))
        .select(*documents.columns)
    )

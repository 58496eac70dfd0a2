"""The trie of what conversations have in common at their starts, by adaptive radix trees.

A turn's id is the first 16 bytes of a digest of role and text, read as a big-endian number.  A
conversation is the key of its turn ids.  Distinct keys are dealt in ranges; a task builds a radix
tree over its range, with node layouts for 4, 16, 48 and 256 children and compressed paths, and emits a
trie node wherever a whole number of turns ends, inside compressed paths too.  Nodes that lie on
the path of a range's first or last key may occur in several ranges: their counts are added up,
less what neighbouring ranges counted twice, which their border keys tell.

Keys are cut into layers of ``LAYER_TURNS`` turns, so that a conversation of any length is many
short rows.  A layer's keys begin with the digest of all layers before, and what lies below its
deepest nodes is handed up through one conversation that stands for each node.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.common import settle, workspace
from jobtide.llm.turns import cut

WIDTH = 16
LAYER_TURNS = 256
HEADER = 4 + WIDTH
RANGE_KEYS = 50_000
RANGE_BYTES = 32 << 20
_LEAST_KEYS = 1024


def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()[:WIDTH]


def _digest(data: Column) -> Column:
    return F.unhex(F.substring(F.sha2(data, 256), 1, 2 * WIDTH))


ROOT = digest(b"")


class Node:
    """A radix tree node: its compressed path, children in one of four layouts, a value."""

    __slots__ = ("path", "layout", "index", "kids", "value")

    def __init__(self, path: bytes, value=None):
        self.path, self.value = path, value
        self.layout, self.index, self.kids = 4, bytearray(), []

    def child(self, byte: int) -> "Node | None":
        if self.layout <= 16:
            at = self.index.find(byte)
            return self.kids[at] if at >= 0 else None
        if self.layout == 48:
            at = self.index[byte]
            return self.kids[at - 1] if at else None
        return self.kids[byte]

    def add(self, byte: int, kid: "Node") -> None:
        if self.layout < 256 and len(self.kids) == self.layout:
            self._grow()
        if self.layout <= 16:
            at = sum(b < byte for b in self.index)
            self.index.insert(at, byte)
            self.kids.insert(at, kid)
        elif self.layout == 48:
            self.kids.append(kid)
            self.index[byte] = len(self.kids)
        else:
            self.kids[byte] = kid

    def _grow(self) -> None:
        pairs = list(self.children())
        if self.layout == 4:
            self.layout = 16
        elif self.layout == 16:
            self.layout, self.index = 48, bytearray(256)
            for place, (byte, _) in enumerate(pairs):
                self.index[byte] = place + 1
        else:
            self.layout, self.index = 256, bytearray()
            self.kids = [None] * 256
            for byte, kid in pairs:
                self.kids[byte] = kid

    def children(self) -> Iterator[tuple[int, "Node"]]:
        """Children by byte, in order."""
        if self.layout <= 16:
            return zip(self.index, self.kids, strict=True)
        if self.layout == 48:
            return ((b, self.kids[at - 1]) for b, at in enumerate(self.index) if at)
        return ((b, kid) for b, kid in enumerate(self.kids) if kid is not None)


def shared(a: bytes, b: bytes) -> int:
    """The number of leading bytes that two texts share."""
    size = min(len(a), len(b))
    differ = int.from_bytes(a[:size]) ^ int.from_bytes(b[:size])
    return size - (differ.bit_length() + 7) // 8


class RadixTree:
    def __init__(self):
        self.root = None

    def insert(self, key: bytes, value) -> None:
        """Adds a key that the tree does not hold."""
        if self.root is None:
            self.root = Node(key, value)
            return
        node, at = self.root, 0
        while True:
            path = node.path
            if not key.startswith(path, at):
                same = shared(path, key[at : at + len(path)])
                below = Node(path[same + 1 :], node.value)
                below.layout, below.index, below.kids = node.layout, node.index, node.kids
                node.path, node.value = path[:same], None
                node.layout, node.index, node.kids = 4, bytearray(), []
                node.add(path[same], below)
                path = node.path
            at += len(path)
            if at == len(key):
                node.value = value
                return
            kid = node.child(key[at])
            if kid is None:
                node.add(key[at], Node(key[at + 1 :], value))
                return
            node, at = kid, at + 1

    def first(self) -> list[Node]:
        """The nodes from the top to the end of the smallest key."""
        nodes = [self.root]
        while nodes[-1].value is None:
            nodes.append(next(iter(nodes[-1].children()))[1])
        return nodes

    def last(self) -> list[Node]:
        """The nodes from the top to the end of the largest key."""
        nodes = [self.root]
        while nodes[-1].kids:
            nodes.append(max(nodes[-1].children(), key=lambda pair: pair[0])[1])
        return nodes


def node_id(key: bytes, depth: int, size: int) -> bytes:
    """The id of the node ``depth`` turns into the layer of a key."""
    prefix, ids = key[4:HEADER], key[HEADER : HEADER + WIDTH * depth]
    if not depth:
        return prefix
    return digest(prefix + digest(ids)) if depth == size else digest(prefix + ids)


INNER, MERGED, HEAD, EDGE = range(4)
_KIND = (
    "kind int, node binary, parent binary, depth bigint, n bigint, low bigint, children bigint, "
    "leaves bigint, saved bigint, parent_low bigint, first binary, first_bytes binary, last binary, part int"
)
_FIELDS = [f.split()[0] for f in _KIND.split(", ")]
_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
_SCHEMA = pa.schema([(f.split()[0], _ARROW[f.split()[1]]) for f in _KIND.split(", ")])


def walk(tree: RadixTree, size: int) -> Iterator[dict]:
    """The trie nodes of a radix tree whose values are ``(key, lens, n, n_on, low, leaves, saved)``.

    ``lens`` are the bytes of each turn, ``n_on`` of the ``n`` conversations go on in the next
    layer; ``leaves`` and ``saved`` are what lies below the key's end there.
    """
    border = {id(x) for x in tree.first()} | {id(x) for x in tree.last()}
    rows: list[dict] = []
    # A node is met twice: on the way down, and when its children's sums are known.
    stack = [(tree.root, 0, False)]
    done: list[tuple] = []  # n, low, leaves, saved, tops (rows of the next turn), a value below
    while stack:
        node, start, back = stack.pop()
        end = start + len(node.path)
        if not back:
            stack.append((node, start, True))
            stack.extend((kid, end + 1, False) for _, kid in node.children())
            continue
        n, low, leaves, saved, tops, some = 0, None, 0, 0, [], node.value
        goes_on = False
        if some:
            n, low, leaves, saved = some[2], some[4], some[5], some[6]
            goes_on = some[3] > 0
        for _ in node.children():
            m, lowest, k, s, t, found = done.pop()
            n, leaves, saved, some = n + m, leaves + k, saved + s, some or found
            low = lowest if low is None else min(low, lowest)
            tops += t
        key, lens = some[0], some[1]
        # The byte before the path belongs to this node as well: it chose the node.
        above = start - 1 if start else -1
        depth = (end - HEADER) // WIDTH
        while depth >= 0 and HEADER + WIDTH * depth > above:
            head = depth == 0 and key[:4] != b"\0\0\0\0"
            if not head:
                if not tops and not goes_on:
                    leaves += 1
                if depth:
                    saved += (n - 1) * int(lens[depth - 1])
            layer = int.from_bytes(key[:4])
            kind = HEAD if head else MERGED if id(node) in border or (goes_on and depth == size) else INNER
            me = node_id(key, depth, size)
            rows.append(
                {
                    "kind": kind,
                    "node": me,
                    "parent": node_id(key, depth - 1, size) if depth else None,
                    "depth": layer * size + depth,
                    "n": 0 if head else n,
                    "low": None if head else low,
                    "children": len(tops),
                    "leaves": leaves,
                    "saved": saved,
                }
            )
            if kind == INNER:
                for i in tops:
                    rows[i]["parent_low"] = low
            # A layer's top has its row in the layer above.
            tops, goes_on, depth = [len(rows) - 1], False, depth - 1
        done.append((n, low, leaves, saved, tops, some))
    yield from rows


def _ranges(keys: DataFrame, size: int) -> DataFrame:
    """Nodes and border keys of the radix trees over ranges of ``keys``."""
    spark = keys.sparkSession
    count, held = keys.agg(F.count("*"), F.sum(F.octet_length("ids"))).first()
    tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), count // _LEAST_KEYS)
    parts = 1 + max(tasks, count // RANGE_KEYS, (held or 0) // RANGE_BYTES)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = RadixTree()
        for batch in batches:
            for row in batch.to_pylist():
                key = row["layer"].to_bytes(4) + row["prefix"] + row["ids"]
                tree.insert(
                    key,
                    (key, row["lens"], row["n"], row["n_on"], row["low"], row["leaves"], row["saved"]),
                )
        if tree.root is None:
            return
        held = []
        for row in walk(tree, size):
            held.append(row)
            if len(held) == 8192:
                yield pa.RecordBatch.from_pylist(held, schema=_SCHEMA)
                held = []
        first, last = tree.first()[-1].value, tree.last()[-1].value
        held.append(
            {
                "kind": EDGE,
                "first": first[0],
                "first_bytes": np.array(first[1], "<i8").tobytes(),
                "last": last[0],
                "part": TaskContext.get().partitionId(),
            }
        )
        yield pa.RecordBatch.from_pylist(held, schema=_SCHEMA)

    dealt = keys.repartitionByRange(parts, "layer", "prefix", "ids")
    return dealt.select("layer", "prefix", "ids", "lens", "n", "n_on", "low", "leaves", "saved").mapInArrow(
        build, _KIND
    )


def twice(before: bytes, key: bytes, lens: np.ndarray, size: int) -> list[dict]:
    """What to take from the sums of nodes that a range shares with the one before.

    ``before`` is the last key of that range, ``key`` the first of this one.
    """
    same = shared(before, key)
    if same < HEADER:
        return []
    deepest = (same - HEADER) // WIDTH
    layer = int.from_bytes(key[:4])
    # The last key of the range before was taken for a leaf, though this one goes on from it.
    leaf = len(before) == HEADER + WIDTH * deepest
    rows, saved = [], 0
    for depth in range(deepest, -1, -1):
        if depth:
            saved += int(lens[depth - 1])
        rows.append(
            {
                "kind": HEAD if depth == 0 and layer else MERGED,
                "node": node_id(key, depth, size),
                "parent": node_id(key, depth - 1, size) if depth else None,
                "depth": layer * size + depth,
                "n": 0,
                "children": -1 if depth < deepest else 0,
                "leaves": -1 if leaf else 0,
                "saved": saved,
            }
        )
    return rows


def _counted(keys: DataFrame, size: int, folder: str, name: str) -> tuple[DataFrame, DataFrame]:
    """Nodes that lie within a range, and the parts of those that may lie in several."""
    found = settle(_ranges(keys, size), folder, name)

    def mend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for before, key, lens in zip(batch["before"], batch["first"], batch["first_bytes"], strict=True):
                rows += twice(before, key, np.frombuffer(lens, "<i8"), size)
            for start in range(0, len(rows), 8192):
                frame = pd.DataFrame(rows[start : start + 8192]).reindex(columns=_FIELDS)
                yield frame

    # As many rows as ranges.
    edges = found.where(F.col("kind") == EDGE).select(
        "first", "first_bytes", F.lag("last").over(Window.orderBy("part")).alias("before")
    )
    mended = edges.where("before is not null").mapInPandas(mend, _KIND)
    parts = found.where(F.col("kind").isin(MERGED, HEAD)).unionByName(mended)
    return found.where(F.col("kind") == INNER), settle(parts, folder, f"{name}-parts")


def _keys(rows: DataFrame) -> DataFrame:
    return rows.groupBy("layer", "prefix", "ids").agg(
        F.count("*").alias("n"),
        F.count_if(~F.col("last")).alias("n_on"),
        F.min("conv_id").alias("low"),
        F.first("lens").alias("lens"),
        F.sum("leaves").alias("leaves"),
        F.sum("saved").alias("saved"),
    )


def _with_prefix(layers: DataFrame, folder: str) -> tuple[DataFrame, bool]:
    """``layers`` with the digest of what comes before, and whether there are several."""
    first = F.lit(ROOT).alias("prefix")
    several = layers.where("layer > 0").select(F.col("conv_id").alias("deep_id")).distinct()
    several = settle(several, folder, "several")
    if several.isEmpty():
        return layers.select("*", first), False
    deep = layers.join(several, F.col("conv_id") == F.col("deep_id"), "left_semi")

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("layer")
        prefixes, prefix = [], ROOT
        for own in pdf["own"]:
            prefixes.append(prefix)
            prefix = digest(prefix + own)
        return pd.DataFrame({"chain_id": pdf["conv_id"], "chain_layer": pdf["layer"], "prefix": prefixes})

    # 16 bytes for each layer of a conversation.
    chained = settle(
        deep.select("conv_id", "layer", _digest(F.col("ids")).alias("own"))
        .groupBy("conv_id")
        .applyInPandas(chain, "chain_id bigint, chain_layer int, prefix binary"),
        folder,
        "chained",
    )
    same = (F.col("conv_id") == F.col("chain_id")) & (F.col("layer") == F.col("chain_layer"))
    deep = deep.join(chained, same).drop("chain_id", "chain_layer")
    flat = layers.join(several, F.col("conv_id") == F.col("deep_id"), "left_anti")
    return flat.select("*", first).unionByName(deep), True


def _handed_up(rows: DataFrame, size: int, folder: str) -> DataFrame:
    """``rows`` with ``leaves`` and ``saved``: what lies in deeper layers below a row's end.

    Each deeper tree counts for the smallest of the conversations that go through its top.
    """
    deep = rows.where("layer > 0")
    _, parts = _counted(_keys(deep), size, folder, "deep")
    trees = (
        parts.where(F.col("kind") == HEAD)
        .groupBy(F.col("node").alias("top"))
        .agg(F.sum("leaves").alias("tree_leaves"), F.sum("saved").alias("tree_saved"))
    )
    spoken = deep.groupBy(F.col("prefix").alias("top")).agg(F.min("conv_id").alias("who"))
    own = settle(
        spoken.join(trees, "top").join(
            deep.select(F.col("prefix").alias("top"), F.col("conv_id").alias("who"), F.col("layer").alias("at")),
            ["top", "who"],
        ),
        folder,
        "spoken",
    )
    whole = rows.join(
        own.select(F.col("who").alias("conv_id"), F.col("at").alias("layer"), "tree_leaves", "tree_saved"),
        ["conv_id", "layer"],
        "left",
    )
    below = Window.partitionBy("conv_id").orderBy(F.desc("layer")).rowsBetween(Window.unboundedPreceding, -1)
    handed = lambda c: F.coalesce(F.sum(c).over(below), F.lit(0)).cast("bigint")
    return settle(
        whole.drop("leaves", "saved")
        .withColumn("leaves", handed("tree_leaves"))
        .withColumn("saved", handed("tree_saved"))
        .drop("tree_leaves", "tree_saved"),
        folder,
        "handed",
    )


def _ended(rows: DataFrame, size: int) -> DataFrame:
    """``end_node, ends_sha256`` of the nodes where conversations end.

    A digest runs over all of a node's ids in order, so one task sees them, one after another;
    it holds a batch of them.
    """
    turns = F.octet_length("ids") / WIDTH
    node = (
        F.when(turns == 0, F.col("prefix"))
        .when(turns == size, _digest(F.concat("prefix", _digest(F.col("ids")))))
        .otherwise(_digest(F.concat("prefix", "ids")))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha, found = None, None, []
        for batch in batches:
            for at, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if at == node:
                    sha.update(b",%d" % conv)
                    continue
                if sha:
                    found.append((node, sha.hexdigest()))
                node, sha = at, hashlib.sha256(b"%d" % conv)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.string())],
                ["end_node", "ends_sha256"],
            )
            found = []
        if sha:
            yield pa.RecordBatch.from_arrays(
                [pa.array([node], pa.binary()), pa.array([sha.hexdigest()])], ["end_node", "ends_sha256"]
            )

    ends = rows.where("last").select(node.alias("node"), "conv_id").repartition("node")
    return ends.sortWithinPartitions("node", "conv_id").mapInArrow(run, "end_node binary, ends_sha256 string")


def trie(layers: DataFrame, size: int, folder: str) -> DataFrame:
    """The nodes of the trie over conversations as ``sequences`` gives them."""
    rows, several = _with_prefix(layers, folder)
    none = F.lit(0).cast("bigint")
    rows = settle(rows.select("*", none.alias("leaves"), none.alias("saved")), folder, "rows")
    if several:
        rows = _handed_up(rows, size, folder)
    inner, parts = _counted(settle(_keys(rows), folder, "keys"), size, folder, "nodes")
    own = F.col("kind") == MERGED
    merged = settle(
        parts.groupBy("node").agg(
            F.max("parent").alias("parent"),
            # A node that goes on in the next layer may still hang below one of a single range.
            F.max("parent_low").alias("parent_low"),
            F.max("depth").alias("depth"),
            F.sum("n").alias("n"),
            F.min("low").alias("low"),
            F.sum("children").alias("children"),
            F.sum(F.when(own, F.col("leaves")).otherwise(0)).alias("leaves"),
            F.sum(F.when(own, F.col("saved")).otherwise(0)).alias("saved"),
        ),
        folder,
        "merged",
    )
    columns = ["node", "parent", "depth", "n", "low", "children", "leaves", "saved", "parent_low"]
    nodes = inner.select(*columns).unionByName(merged)
    # A parent is missing where it lies in several ranges: there are few of those.
    tops = merged.select(F.col("node").alias("top"), F.col("low").alias("top_low"))
    ended = settle(_ended(rows, size), folder, "ended")
    return (
        nodes.join(tops, (F.col("parent") == F.col("top")) & F.col("parent_low").isNull(), "left")
        .join(ended, F.col("node") == F.col("end_node"), "left")
        .select(
            F.col("low").alias("conv_id"),
            "depth",
            F.coalesce("parent_low", "top_low").alias("parent_conv_id"),
            F.col("n").alias("n_convs"),
            F.col("children").alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


def _own_turns(conversations: DataFrame) -> DataFrame:
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # The length of the role tells where it ends.
    data = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        role.alias("role"),
        _digest(data).alias("id"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )


def sequences(
    conversations: DataFrame, every: int, heads: int, size: int, folder: str
) -> DataFrame:
    """``conv_id, layer, last, ids, lens``: conversations rebuilt on others' heads, in layers.

    With ``every`` 1 and ``heads`` 1 they are as they are.
    """
    order = ["turn", "role", "id"]
    short, long_ = cut(_own_turns(conversations), order, size, folder)
    pair = lambda t: F.struct(t["id"].alias("id"), t["bytes"].alias("bytes"))
    kept = heads - 1
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads)).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % every
    listed = settle(
        short.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct(*order, "bytes"))).alias("turns"))
        .select("conv_id", F.transform("turns", pair).alias("turns")),
        folder,
        "short",
    )
    starts = listed.select("conv_id", F.slice("turns", 1, kept).alias("head"))
    if long_ is not None:
        first = long_.where(F.col("place") < max(kept, 1)).groupBy("conv_id")
        first = first.agg(F.sort_array(F.collect_list(F.struct("place", "id", "bytes"))).alias("turns"))
        starts = starts.unionByName(
            first.select("conv_id", F.slice(F.transform("turns", pair), 1, kept).alias("head"))
        )
    starts = starts.where(F.col("conv_id") == base).select(F.col("conv_id").alias("base_id"), "head")
    none = F.array().cast("array<struct<id:binary,bytes:bigint>>")
    taken = lambda: F.slice(F.coalesce("head", none), F.lit(1), h)
    whole = listed.join(starts, base == F.col("base_id"), "left").select(
        "conv_id",
        F.concat(taken(), F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"),
    )
    count = F.greatest(F.ceil(F.size("turns") / size), F.lit(1)).cast("int")
    cut_up = F.transform(
        F.sequence(F.lit(0), count - 1), lambda i: F.slice(F.col("turns"), i * size + 1, F.lit(size))
    )
    layers = whole.select("conv_id", F.posexplode(cut_up).alias("layer", "turns"), count.alias("count"))
    layers = layers.select("conv_id", "layer", (F.col("layer") == F.col("count") - 1).alias("last"), "turns")
    if long_ is not None:
        ends = long_.groupBy("conv_id").agg(F.max("place").alias("top"))
        based = settle(
            ends.join(starts, base == F.col("base_id"), "left").select(
                F.col("conv_id").alias("long_id"), taken().alias("taken"), h.alias("h"), "top"
            ),
            folder,
            "based",
        )
        moved = F.col("place") - F.col("h") + F.size("taken")
        own = long_.join(based, F.col("conv_id") == F.col("long_id")).where("place >= h")
        rows = own.select("conv_id", moved.alias("place"), "id", "bytes").unionByName(
            based.select(F.col("long_id").alias("conv_id"), F.posexplode("taken").alias("place", "t")).select(
                "conv_id", F.col("place").cast("bigint"), "t.id", "t.bytes"
            )
        )
        layer = F.floor(F.col("place") / size).cast("int").alias("layer")
        lists = rows.groupBy("conv_id", layer).agg(
            F.sort_array(F.collect_list(F.struct("place", "id", "bytes"))).alias("turns")
        )
        final = F.floor((F.col("top") - F.col("h") + F.size("taken")) / size).cast("int")
        layers = layers.unionByName(
            lists.join(based, F.col("conv_id") == F.col("long_id")).select(
                "conv_id", "layer", (F.col("layer") == final).alias("last"), F.transform("turns", pair).alias("turns")
            )
        )
    ids = F.aggregate(F.col("turns"), F.lit(b""), lambda held, t: F.concat(held, t["id"]))
    return layers.select("conv_id", "layer", "last", ids.alias("ids"), F.col("turns")["bytes"].alias("lens"))


def prefix_trie(
    conversations: DataFrame, every: int = 1, heads: int = 1, size: int = LAYER_TURNS
) -> DataFrame:
    """One row per distinct start of the conversations, from the empty one.

    ``conversations`` needs a whole-number ``conv_id``, ``turn``, ``role`` and ``text``; other
    columns are not read.  Turns follow each other by ``turn`` (null first), then role and turn
    id; a repeated row is a turn of its own.  A null role or text counts as empty; rows with a null
    ``conv_id`` belong to no conversation and are left out.  An empty table has no nodes.

    With ``every`` and ``heads`` each conversation first gets the head of another: of conversation
    c - c % every the first h turns, in place of its own first h, with h = crc32(c) % heads.
    Columns: ``conv_id`` (the smallest member), ``depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``.
    """
    if size < max(heads - 1, 1):
        raise ValueError("a layer must hold the longest head")
    folder = workspace(conversations.sparkSession)
    layers = settle(sequences(conversations, every, heads, size, folder), folder, "layers")
    return trie(layers, size, folder)

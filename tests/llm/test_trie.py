import hashlib
import random
import zlib

import pytest

from jobtide.llm import trie

KIND = "conv_id long, turn long, role string, text string, node string, layer int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows, every, heads):
    convs = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role, tie, text))
    convs = {c: [(r, x) for *_, r, _, x in sorted(t)] for c, t in convs.items()}
    rebuilt = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (abs(c) % every) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(convs.get(base, [])[:h] + own[h:])
    members, ended = {}, {}
    for c, seq in rebuilt.items():
        ended.setdefault(seq, []).append(c)
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    kids, leaves, saved = {}, {}, {}
    for node in sorted(members, key=len, reverse=True):
        kids.setdefault(node, 0)
        leaves[node] = leaves.get(node, 0) + (not kids[node])
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = saved.get(node, 0) + own
        if node:
            up = node[:-1]
            kids[up] = kids.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[node]
            saved[up] = saved.get(up, 0) + saved[node]
    return sorted(
        (
            min(m), len(node), min(members[node[:-1]]) if node else None, len(m), kids[node], leaves[node],
            saved[node], sha(",".join(map(str, sorted(ended.get(node, []))))),
        )
        for node, m in members.items()
    )


def made(seed, count, longest, words=3):
    rng = random.Random(seed)
    rows = []
    for conv in [rng.randint(-30, 400) for _ in range(count)]:
        for turn in range(rng.randint(1, longest)):
            role, text = rng.choice(["user", "user", "assistant", None]), rng.choice(["", "é", "a b", None, "x" * 50][: words + 1])
            rows.append((conv, rng.choice([turn, turn, turn, None]), role, text, "n", 1))
    return rows


def check(spark, rows, every=1, heads=1, size=trie.LAYER_TURNS):
    found = trie.prefix_trie(spark.createDataFrame(rows, KIND), every, heads, size)
    got = sorted(map(tuple, found.collect()), key=lambda r: (r[0], r[1], r[2] is not None, r[2] or 0, *r[3:]))
    assert got == sorted(brute(rows, every, heads), key=lambda r: (r[0], r[1], r[2] is not None, r[2] or 0, *r[3:]))


def test_rebuilt_conversations(spark):
    check(spark, made(1, 200, 12), 5, 9)


def test_plain_with_nulls_and_repeats(spark):
    rows = made(2, 80, 6, 1)
    check(spark, rows + rows[:20] + [(None, 1, "user", "x", "n", 1), (500, None, None, None, "n", 1)])


def test_layers_and_ranges(spark, monkeypatch):
    """Keys longer than a layer, and ranges of a few keys, so that most nodes lie in several."""
    monkeypatch.setattr(trie, "RANGE_KEYS", 7)
    rows = made(3, 150, 14, 0) + [(900 + i, t, "user", "a", "n", 1) for i in range(3) for t in range(30 + i % 2)]
    check(spark, rows, 1, 1, 3)
    check(spark, rows, 5, 9, 8)


def test_long_conversation_over_several_layers(spark):
    rows = [(c, t, "user", str(t), "n", 1) for c, n in ((1, 700), (2, 700), (3, 512), (4, 256), (5, 255), (6, 1)) for t in range(n)]
    check(spark, rows, 5, 9)


def test_empty_table(spark):
    assert trie.prefix_trie(spark.createDataFrame([], KIND), 5, 9).count() == 0


@pytest.mark.parametrize("keys", [1, 4, 16, 48, 256])
def test_layouts_grow(keys):
    tree = trie.RadixTree()
    made_keys = [bytes([b, 7, 7]) for b in range(keys)] + [bytes([b]) for b in range(0, keys, 3)]
    random.Random(0).shuffle(made_keys)
    for key in made_keys:
        tree.insert(key, (key,))
    assert tree.first()[-1].value[0] == min(made_keys) and tree.last()[-1].value[0] == max(made_keys)
    found, stack = [], [tree.root]
    while stack:
        node = stack.pop()
        if node.value:
            found.append(node.value[0])
        stack.extend(kid for _, kid in reversed(list(node.children())))
    assert found == sorted(made_keys)
    top = tree.root
    assert top.layout == next(size for size in (4, 16, 48, 256) if size >= len(list(top.children())))


def test_shared_bytes():
    assert [trie.shared(*p) for p in ((b"", b"a"), (b"abc", b"abd"), (b"ab", b"abc"), (b"x", b"y"))] == [0, 2, 2, 0]

import random
import struct

import numpy as np
import pytest

from jobtide.llm import viterbi


@pytest.fixture(scope="module")
def counter():
    return viterbi.Counter(viterbi.read(viterbi.default_model()))


def brute_force(data, text):
    """The whole text at once, forward, by a dictionary and no automaton, chunks or memory."""
    pieces, fallback, prefix = viterbi.read_model(data)
    single = lambda x: struct.unpack("<f", struct.pack("<f", x))[0]
    normal = {t: s for t, s, kind in pieces if kind == 1}
    unknown = single(min(normal.values()) - 10.0)
    longest = max(map(len, normal))
    if not text:
        return 0
    text = ("▁" if prefix else "") + text.replace(" ", "▁")
    best, count = [0.0] + [None] * len(text), [0] * (len(text) + 1)
    for start in range(len(text)):
        one = False
        ends = range(start + 1, min(len(text), start + longest) + 1)
        steps = [(e, normal[text[start:e]], 1) for e in ends if text[start:e] in normal]
        one = any(e == start + 1 for e, _, _ in steps)
        if not one:
            size = len(text[start].encode()) if fallback else 1
            steps.append((start + 1, unknown, size))
        for end, score, size in steps:
            if best[end] is None or score + best[start] > best[end]:
                best[end], count[end] = single(score + best[start]), count[start] + size
    return count[-1]


def test_against_whole_text(counter, spark, sf_dir):
    data = viterbi.read(viterbi.default_model())
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    for text in [r.text for r in docs][:40]:
        assert counter.count(text) == brute_force(data, text)


def test_random_texts(counter):
    data = viterbi.read(viterbi.default_model())
    draw = random.Random(4)
    signs = list("ab cde\n  .!éЖ漢▁") + ["the", "in", "   ", "🎉"]
    for _ in range(200):
        text = "".join(draw.choices(signs, k=draw.randrange(400)))
        assert counter.count(text) == brute_force(data, text), text


def test_cache_limit_changes_nothing(counter, monkeypatch):
    text = "one two three four. Five six\nseven " * 50
    whole = counter.count(text)
    monkeypatch.setattr(viterbi, "CACHED_CHUNKS", 3)
    assert [counter.count(text) for _ in range(3)] == [whole] * 3


def test_rows(spark):
    df = spark.createDataFrame(
        [(1, "the", 0), (1, "the", 0), (None, None, 0), (2, "", 0)], "doc_id long, text string, x int"
    )
    got = sorted((str(r.doc_id), r.n_tokens, r.n_chars) for r in viterbi.token_counts(df).collect())
    assert got == [("1", 2, 3), ("1", 2, 3), ("2", 0, 0), ("None", 0, 0)]
    assert viterbi.token_counts(df.limit(0)).collect() == []


def test_single_precision_after_unknown_characters(counter):
    """An unknown character moves the sums to where single precision rounds early."""
    data = viterbi.read(viterbi.default_model())
    draw = random.Random(11)
    words = "the quick brown fox jumps over lazy dogs while seventeen engineers reconsider".split()
    differ = 0
    for unknown in (1, 3, 9, 40):
        text = "漢字🎉"[0] * unknown + " " + " ".join(draw.choices(words, k=300))
        text += "\U000F0000" * unknown + " ".join(draw.choices(words, k=300))
        whole = brute_force(data, text)
        assert counter.count(text) == whole
        assert counter.count(text) == whole  # from the kept outcomes
        parts = viterbi.Counter(data).cut("▁" + text.replace(" ", "▁"))
        differ += sum(counter.walk_within(part, 0.0, 0.0)[1] for part in parts) != whole
    assert differ  # sums without rounding give other counts


def test_chunks_are_worked_out_together(monkeypatch):
    """Few chunks run through the recurrence one by one, before and after rounding sets in."""
    data = viterbi.read(viterbi.default_model())
    counter, alone = viterbi.Counter(data), []
    for name in ("walk", "walk_within"):
        own = getattr(counter, name)
        monkeypatch.setattr(counter, name, lambda *args, own=own: alone.append(args) or own(*args))
    words = [f"w{i * 7919 % 1000}x{i}" for i in range(1000)]
    texts = [" ".join(words), "漢字 " + " ".join(reversed(words)), "", "x" * 200 + " the " + "漢" * 90]
    assert counter.count_all(texts) == [brute_force(data, text) for text in texts]
    assert len(alone) < 100


@pytest.mark.parametrize("zone", [0, 25, 30, 34])
def test_joint_outcomes_equal_single_ones(counter, zone):
    draw = random.Random(zone)
    chunks = ["".join(draw.choices("▁aeinrst漢é🎉.", k=draw.randrange(1, 60))) for _ in range(200)]
    counter.count_all(chunks)
    (lattice,) = counter._lattices([n for chunk, n in counter.ids.items() if len(chunk) <= 64][-150:])
    unit = 2.0 ** (zone - 24) if zone else 0.0
    for odd in (0, 1):
        before = -unit * ((3 << 22) + odd)
        chosen = draw.sample(range(len(lattice.ids)), 90)
        got = lattice.walk(np.array(chosen), np.full(90, unit), odd)
        for place, change, number, tied in zip(chosen, *got, strict=True):
            after, pieces, half_way = counter.walk_within(counter.chunks[lattice.ids[place]], before, unit)
            assert (change, number) == (after - before, pieces)
            assert tied == half_way or not zone

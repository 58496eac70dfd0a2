import hashlib
import random

from pyspark.sql import functions as F

from jobtide.llm import chat

KIND = "conv_id long, turn long, role string, text string, place int, block string"
BAD = [r"\### Assistant: </turn> ok", "####", "&amp;&lt;/turn>&num;", "</turn>\n### user: x", "", None, "é:##&\n", "<</turn>>"]


def rows():
    rng = random.Random(5)
    found = []
    for conv in [*range(-3, 12), None]:
        for turn in range(rng.choice([1, 2, 3, 8, 17])):
            role = rng.choice(["user", "assistant", "assistant", "system", "a: b</turn>\n", None])
            found.append((conv, rng.choice([turn, turn, None, 2]), role, rng.choice(BAD), 1, "x"))
    return [*found, *found[:9]]


def in_order(found):
    groups = {}
    for conv, turn, role, text, *_ in found:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [(r, x) for *_, r, x in sorted(g)] for conv, g in groups.items()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_digests_of_short_and_long(spark):
    found = rows()
    df = spark.createDataFrame(found, KIND)
    texts = {}
    for size in (64, 3, 1):
        short, long_ = chat.examples(df, size)
        assert (long_ is None) == (size == 64)
        got = {r.conv_id: r for r in chat.digests(short, long_).collect()}
        assert got.keys() == in_order(found).keys()
        for conv, turns in in_order(found).items():
            r, replies = got[conv], [x for role, x in turns if role == "assistant"]
            assert r.n_turns == len(turns)
            assert r.turns_sha256 == sha("".join(f"{a}\n{b}\n" for a, b in turns))
            assert (r.loss_chars, r.loss_sha256) == (len("".join(replies)), sha("".join(replies)))
        texts[size] = {c: r.formatted_chars for c, r in got.items()}
    assert texts[64] == texts[3] == texts[1]


def test_examples_hold_their_context(spark):
    found = rows()
    df = spark.createDataFrame(found, KIND)

    def whole(size):
        """All examples, those of blocks put together."""
        short, long_ = chat.examples(df, size)
        every = short.collect() + (long_.collect() if long_ is not None else [])
        closed = {(r.conv_id, r.block): r.text for r in every if r.closes}
        out = []
        for r in every:
            if r.trainable:
                before = "".join(closed[r.conv_id, b] for b in range(r.block))
                assert len(before) == r.context_chars
                out.append((str(r.conv_id), r.target, before + r.text, len(before) + r.loss_start, r.loss_chars))
            else:
                assert r.loss_chars == 0 and r.closes
        return sorted(out)

    plain = whole(64)
    assert plain == whole(4) == whole(1)
    expected = in_order(found)
    assert len(plain) == sum(role == "assistant" for g in expected.values() for role, _ in g)
    for conv, target, text, start, length in plain:
        turns = expected[None if conv == "None" else int(conv)]
        assert text.count(chat.END) == target + 1 and text.count("##") == target + 1
        body = text[start : start + length]
        assert text[start + length :] == chat.END
        for name, sign in (("&num;", "#"), ("&lt;", "<"), ("&amp;", "&")):
            body = body.replace(name, sign)
        assert body == turns[target][1] and turns[target][0] == "assistant"


def test_empty_long_text_and_native_plan(spark):
    empty = spark.createDataFrame([], KIND)
    assert chat.digests(*chat.examples(empty)).count() == 0
    text = "a&</##" * 100_000
    df = spark.createDataFrame([(1, 0, "user", text, 1, ""), (1, 1, "assistant", text, 1, "")], KIND)
    (r,) = chat.digests(*chat.examples(df)).collect()
    assert r.loss_chars == len(text) and r.loss_sha256 == sha(text)
    long_ = df.unionByName(df.withColumn("turn", F.col("turn") + 2))
    for size in (64, 2):
        plan = chat.digests(*chat.examples(long_, size))._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_rows_of_a_conversation_do_not_depend_on_the_others(spark):
    turns = [(0, "user", "a"), *[(t, "assistant" if t % 2 else "user", f"x{t}") for t in range(1, 9)]]
    alone = spark.createDataFrame([(1, *t, 1, "") for t in turns[:4]], KIND)
    beside = alone.unionByName(spark.createDataFrame([(2, *t, 1, "") for t in turns], KIND))

    def rows_of(found, conv):
        short, long_ = found
        every = short.collect() + (long_.collect() if long_ is not None else [])
        return sorted(map(str, (r for r in every if r.conv_id == conv)))

    assert rows_of(chat.examples(alone, 4), 1) == rows_of(chat.examples(beside, 4), 1)
    # The first block of a long conversation holds what a short one of the same turns holds.
    first = [r.replace("conv_id=2", "conv_id=1") for r in rows_of(chat.examples(beside, 4), 2) if "block=0" in r]
    assert first == rows_of(chat.examples(alone, 4), 1)


def test_replies_of_long_conversations_get_all_turns_before_them(spark):
    df = spark.createDataFrame(rows(), KIND)
    listed = lambda found: sorted(map(str, found.collect()))
    uncut, none = chat.examples(df, 64)
    assert none is None and listed(chat.whole(uncut, None)) == listed(uncut)
    for size in (1, 3, 4):
        short, long_ = chat.examples(df, size)
        found = chat.whole(short, long_)
        assert found.columns == uncut.columns and listed(found) == listed(uncut)
    turns = [(1, t, "assistant" if t % 2 else "user", f"x{t}", 1, "") for t in range(150)]
    found = chat.whole(*chat.examples(spark.createDataFrame(turns, KIND))).collect()
    assert sorted((r.target, r.text.count(chat.END)) for r in found) == [(t, t + 1) for t in range(1, 150, 2)]


def test_the_digests_read_whole_examples(spark, monkeypatch):
    turns = [(1, t, "assistant", f"x{t}", 1, "") for t in range(9)]
    seen, real = [], chat._read
    monkeypatch.setattr(chat, "_read", lambda found, *keys: (seen.append(found), real(found, *keys))[1])
    chat.digests(*chat.examples(spark.createDataFrame(turns, KIND), 2))
    texts = [r.text for found in seen for r in found.collect()]
    assert sorted(text.count(chat.END) for text in texts) == list(range(1, 10))

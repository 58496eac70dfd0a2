import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from jobtide.llm import bpe


@pytest.fixture(scope="module")
def both():
    path = bpe.default_tokenizer()
    return bpe.Tokenizer(bpe._read(path)), Tokenizer.from_file(path)


def check(both, texts):
    own, library = both
    for text, ids in zip(texts, own.encode(texts), strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected, text
        assert own.decode(ids) == library.decode(expected, skip_special_tokens=False)


def test_odd_texts(both):
    check(both, [
        "", " ", "\n\t", "ΑΣ ΟΔΟΣ Σ", "it's we'll 'S 'D a'", "aaaaaaaaaaaa zzzzz", "é é ́x",
        "<|endoftext|>a<|startoftext|> b<|ENDOFTEXT|>", "İstanbul ǅ ẞ", "a\x1cb\x1fc\x85d\xa0e",
        "日本語 текст 🎉🎉 ١٢٣", "x" * 5000, "... !!! 12 345",
    ])


def test_random_texts(both):
    draw = random.Random(1)
    signs = "ab cde'\n\t.!é½́Σ<|>漢\U00011de0ſ"
    check(both, ["".join(draw.choices(signs, k=draw.randrange(80))) for _ in range(3000)])


def test_pieces_and_cache(both, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE_CHARS", 50)
    monkeypatch.setattr(bpe, "CACHED_CHUNKS", 20)
    draw = random.Random(2)
    words = ["hello", "world!", "<|endoftext|>", "Straße", "naïve,", "x1y2"]
    check(both, [" ".join(draw.choices(words, k=200)) for _ in range(20)])


def test_rows(spark):
    rows = [(1, "Hello world", 9), (None, None, 9), (2, "", 9), (1, "Hello world", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = sorted((str(r.doc_id), r.n_tokens, r.decoded) for r in bpe.encode(df).collect())
    assert got == [("1", 2, "hello</w> world</w>")] * 2 + [("2", 0, ""), ("None", 0, "")]
    assert bpe.encode(df.limit(0)).collect() == []


def test_documents_match_library(spark, sf_dir, both):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in df.collect()}
    for r in bpe.encode(df).collect():
        expected = both[1].encode(texts[r.doc_id], add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == expected


def test_words_are_merged_in_parts(monkeypatch):
    """The index of places holds a bounded number of characters, however many words are new."""
    tokenizer = bpe.Tokenizer(bpe._read(bpe.default_tokenizer()))
    text = " ".join(f"word{i * 7919}" for i in range(5000))
    (whole,) = tokenizer.encode([text])
    tokenizer = bpe.Tokenizer(bpe._read(bpe.default_tokenizer()))
    own, sizes = tokenizer.merge_all, []
    monkeypatch.setattr(bpe, "MERGED_CHARS", 1000, raising=False)
    monkeypatch.setattr(
        tokenizer, "merge_all", lambda words: sizes.append(sum(map(len, words))) or own(words)
    )
    assert tokenizer.encode([text]) == [whole]
    assert max(sizes) < 1100

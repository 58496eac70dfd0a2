"""Byte-pair encoding and decoding with a pair occurrence index.

A task splits the texts of a batch at blanks and encodes the chunks it has not met.  All words of
these chunks lie in one symbol list; the index maps each mergeable pair to the places where it
stands.  Ranks are applied from the lowest on, each to all its places at once; a merge enters the
pairs it creates into the index.  Texts are then put together from their chunks.

The vocabulary is a file of the ``tokenizers`` library with a lower-casing word model: NFC,
lower case, a split into words, bytes as characters, merges with a mark on word ends.  It is sent
to the tasks as it is (a few MB, however large the data).
"""

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Regex, normalizers, pre_tokenizers

from jobtide.llm.common import claim, release_memory

PIECE_CHARS = 1 << 20  # longer texts are worked on in pieces, cut at blanks
BATCH_CHARS = 1 << 21  # texts of a batch whose words are looked up together
MERGED_CHARS = 1 << 17  # of words merged together: an index takes some hundred bytes for each
CACHED_CHUNKS = 300_000  # beyond, a cache keeps what the batch at hand uses
_BASE = 1 << 20  # above every id: a pair of ids is one number
# From here on engines differ in the characters their Unicode version knows.
_RECENT = regex.compile("[\u0530-\U0010ffff]").search
# Blanks to ``str.split`` but not to the tokenizer.
_CONTROLS = regex.compile("[\x1c-\x1f]").search

_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]


def _byte_characters() -> list[str]:
    """The character that stands for each byte: itself where printable, else one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def _lower(text: str) -> str:
    """Each character's own lower case; ``str.lower`` has another sigma at word ends."""
    return "σ".join(part.lower() for part in text.split("Σ"))


class Tokenizer:
    """Words to ids and back, by the content of a tokenizer file."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        splits = spec["pre_tokenizer"]["pretokenizers"]
        plain = not any(
            model.get(k) for k in ("dropout", "unk_token", "fuse_unk", "byte_fallback", "ignore_merges")
        )
        if (
            spec["normalizer"].get("normalizers") != _NORMALIZERS
            or [s["type"] for s in splits] != ["Split", "ByteLevel"]
            or not splits[0]["invert"]
            or spec["decoder"] is not None
            or model.get("continuing_subword_prefix")
            or not plain
        ):
            raise ValueError("a lower-casing word model without decoder is needed")
        pattern = splits[0]["pattern"]["Regex"]
        # The file's engine takes the Unicode property for \s, ``regex`` a few controls too.
        self.words = regex.compile(pattern.replace("\\s", "\\p{White_Space}")).findall
        self.library = (
            normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]).normalize_str,
            pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str,
        )
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        by_length = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, by_length)) + ")").split
        self.vocab = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        by_id = {i: token for token, i in (self.vocab | self.special).items()}
        self.shown = [by_id.get(i) for i in range(max(by_id) + 1)]
        # Ranks by pair, a pair being one number; what a rank makes.
        self.merges: dict[int, int] = {}
        self.results: list[int] = []
        made: dict[int, int] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            a, b, new = self.vocab[left], self.vocab[right], self.vocab[left + right]
            if max(made.get(a, -1), made.get(b, -1)) >= rank:
                raise ValueError("a merge precedes the one that makes its parts")
            self.merges.setdefault(a * _BASE + b, rank)
            self.results.append(new)
            made.setdefault(new, rank)
        pairs = sorted(self.merges)
        self.pairs = np.array(pairs, np.int64)
        self.ranks = np.array([self.merges[pair] for pair in pairs], np.int64)
        characters = _byte_characters()
        self.inner = np.array([self.vocab[c] for c in characters], np.int64)
        self.last = np.array([self.vocab[c + self.end] for c in characters], np.int64)
        self.known: dict[str, bytes] = {}
        self.known_words: dict[str, bytes] = {}

    def merge_all(self, words: list[str]) -> list[bytes]:
        """The ids of each word, packed."""
        coded = [word.encode() for word in words]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        raw = np.frombuffer(b"".join(coded), np.uint8)
        ends = np.cumsum(sizes)
        start = self.inner[raw]
        start[ends - 1] = self.last[raw[ends - 1]]
        # A border after each word, which no pair crosses.
        border = ends + np.arange(len(coded))
        grown = np.full(len(raw) + len(coded), -1, np.int64)
        kept = np.ones(len(grown), bool)
        kept[border] = False
        grown[kept] = start

        # The index: places by rank.
        first, second = grown[:-1], grown[1:]
        pairs = np.where((first >= 0) & (second >= 0), first * _BASE + second, -1)
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        found = np.flatnonzero(self.pairs[at] == pairs)
        ranks = self.ranks[at[found]]
        order = np.argsort(ranks, kind="stable")
        found, ranks = found[order], ranks[order]
        cuts = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]][: len(ranks)])
        places = {
            int(ranks[low]): part.tolist()
            for low, part in zip(cuts, np.split(found, cuts[1:]), strict=True)
        } if len(ranks) else {}

        symbols = grown.tolist()
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        merges, results = self.merges.get, self.results
        active = list(places)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            here = places.pop(rank)
            new = results[rank]
            for i in sorted(here) if len(here) > 1 else here:
                left = symbols[i]
                if left < 0:
                    continue  # merged into its left neighbour
                j = after[i]
                if merges(left * _BASE + symbols[j]) != rank or symbols[j] < 0:
                    continue  # a neighbour has changed meanwhile
                symbols[i] = new
                symbols[j] = -2
                after[i] = k = after[j]
                before[k] = i
                h = before[i]
                if h >= 0 and (other := symbols[h]) >= 0:
                    next_rank = merges(other * _BASE + new)
                    if next_rank is not None:
                        if next_rank in places:
                            places[next_rank].append(h)
                        else:
                            places[next_rank] = [h]
                            heapq.heappush(active, next_rank)
                if (other := symbols[k]) >= 0:
                    next_rank = merges(new * _BASE + other)
                    if next_rank is not None:
                        if next_rank in places:
                            places[next_rank].append(i)
                        else:
                            places[next_rank] = [i]
                            heapq.heappush(active, next_rank)
        merged = np.array(symbols, np.int64)
        alive = merged >= 0
        packed = merged[alive].astype("<u4").tobytes()
        stops = (np.cumsum(alive)[border - 1] * 4).tolist() if len(coded) else []
        return [packed[low:high] for low, high in zip([0, *stops], stops, strict=False)]

    def learn(self, chunks: set[str]) -> None:
        """Enter the chunks that are new into the cache."""
        new = chunks.difference(self.known)
        if not new:
            return
        if len(self.known) + len(new) > CACHED_CHUNKS:
            # Chunks of this batch stay, and the words of those that go.
            self.known = {c: self.known[c] for c in chunks.intersection(self.known)}
        words = {chunk: self.cut_words(chunk) for chunk in new}
        distinct = {word for found in words.values() for word in found}
        if len(self.known_words) + len(distinct) > CACHED_CHUNKS:
            self.known_words = {w: self.known_words[w] for w in distinct.intersection(self.known_words)}
        fresh = sorted(distinct.difference(self.known_words))
        known = self.known_words
        for part in _groups(fresh, MERGED_CHARS):
            known.update(zip(part, self.merge_all(part), strict=True))
        self.known.update(
            (chunk, known[found[0]] if len(found) == 1 else b"".join([known[w] for w in found]))
            for chunk, found in words.items()
        )

    def cut_words(self, normal: str) -> list[str]:
        if _RECENT(normal):
            return [word for word, _ in self.library[1](normal)]
        return self.words(normal)

    def split(self, text: str) -> list[str]:
        """Normalized chunks of the text, cut where words end."""
        if _RECENT(text):
            return self.cut_words(self.library[0](text))
        text = text.lower() if text.isascii() else _lower(unicodedata.normalize("NFC", text))
        return self.words(text) if _CONTROLS(text) else text.split()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        out = []
        for group in _groups(texts, BATCH_CHARS):
            # Every second part is a special token.
            split = [
                [part if n % 2 else self.split(part) for piece in _pieces(text)
                 for n, part in enumerate(self.cut(piece))]
                for text in group
            ]
            chunks: set[str] = set()
            for parts in split:
                for part in parts:
                    if isinstance(part, list):
                        chunks.update(part)
            self.learn(chunks)
            find, special = self.known.__getitem__, self.special
            for parts in split:
                out.append(
                    b"".join(
                        b"".join(map(find, part))
                        if isinstance(part, list)
                        else special[part].to_bytes(4, "little")
                        for part in parts
                    )
                )
        return out

    def decode(self, ids: bytes) -> str:
        """What the ids stand for: tokens with blanks between; unknown ids are left out."""
        numbers = memoryview(ids).cast("I") if ids else ()
        try:
            return " ".join(map(self.shown.__getitem__, numbers))
        except (IndexError, TypeError):
            shown = dict(enumerate(self.shown))
            return " ".join(shown[i] for i in numbers if shown.get(i) is not None)


def _groups(texts: list[str], chars: int) -> Iterator[list[str]]:
    """The texts in parts of about so many characters."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= chars:
            yield group
            group, size = [], 0
    if group:
        yield group


def _pieces(text: str) -> Iterator[str]:
    """The text cut before blanks, where neither words nor normal forms reach across."""
    start = 0
    while len(text) - start > PIECE_CHARS:
        cut = text.find(" ", start + PIECE_CHARS)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


_LOADED: dict[int, Tokenizer] = {}


def _load(content: str) -> Tokenizer:
    """One tokenizer per worker process, kept between tasks."""
    key = hash(content)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Tokenizer(content)
    return _LOADED[key]


def _forget() -> None:
    _LOADED.clear()


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode(documents: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit integers), ``decoded``.

    ``documents`` needs ``doc_id`` and ``text``; other columns are not read.  ``path`` is that of
    the tokenizer file on the driver.  A null text counts as empty: no ids and an empty decoded
    text.  Every row gives a row, so repeated rows repeat and a null id stays null.  Special
    tokens in a text become their ids.
    """
    content = documents.sparkSession.sparkContext.broadcast(_read(path or default_tokenizer()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("bpe", _forget)
        tokenizer = _load(content.value)
        release_memory()
        for batch in batches:
            for rows in _slices(batch):
                coded = tokenizer.encode([t or "" for t in rows.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.array([len(ids) // 4 for ids in coded], pa.int64()),
                        pa.array(coded, pa.binary()),
                        pa.array(map(tokenizer.decode, coded), pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids", "decoded"],
                )
        release_memory()

    ids = documents.select("doc_id", "text")
    kind = ids.schema["doc_id"].dataType.simpleString()
    return ids.mapInArrow(work, f"doc_id {kind}, n_tokens bigint, ids binary, decoded string")


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of some MB of text, so that what a task holds stays small."""
    rows = max(1, batch.num_rows * BATCH_CHARS // max(1, batch.nbytes))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)

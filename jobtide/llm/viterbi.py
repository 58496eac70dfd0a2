"""Token counts of a unigram vocabulary: Aho-Corasick matches and a count-only Viterbi pass.

An automaton over the vocabulary lists the pieces that end at each character; dynamic programming
carries the best score and its number of pieces, never the path.  The tie rules are those of the
public unigram encoder: of the pieces that end at a place the one that starts first stands, and a
later one replaces it only if its sum, before rounding, is larger than the sum that stands there,
which is rounded to single precision.  A character that is no piece is unknown, at the lowest score
less a fixed penalty, and counts as its bytes if the model falls back to bytes.

Pieces never reach over some borders (before a blank, around a line end), so a text is a chain of
chunks.  The score before a chunk changes its outcome only through rounding, and a sum that falls
out of the zone (binade) of the score stays below those within.  Near zero nothing is rounded: sums
of multiples of a power of two are exact down to -2^24 times it, and a chunk has one outcome.
Beyond, outcomes are kept by chunk, binade and last bit, as sums that agree in them round alike.
A chunk whose best sum leaves its zone is worked out at its place.

The chunks that a slice of texts brings are worked out together: their pieces are found by a trie
at all characters at once, and the recurrence runs over all chunks, place by place.  Unrounded sums
foretell the binades a chunk is met in; where they err, it is worked out at its place as well.
"""

import math
import re
import struct
from collections.abc import Iterable, Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from jobtide.llm.common import claim

SPACE = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value of the public encoder
SLICE_BYTES = 1 << 22
CACHED_CHUNKS = 600_000  # the cache starts anew beyond
CACHED_CHARS = 1 << 24
JOINT_LENGTH = 64  # longer chunks are worked out one by one
JOINT_CHARS = 1 << 18  # of chunks worked out together
JOINT_PIECES = 1 << 18

_NORMAL, _UNKNOWN, _USER, _UNUSED = 1, 2, 4, 5
_pack, _unpack = struct.Struct("<f").pack, struct.Struct("<f").unpack


def _single(value: float) -> float:
    return _unpack(_pack(value))[0]


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, data[at : at + size]
        at += size


def read_model(data: bytes) -> tuple[list[tuple[str, float, int]], bool, bool]:
    """Pieces (text, score, kind), byte fallback, and whether a blank is put before the text."""
    pieces, fallback, prefix = [], False, True
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            score = _unpack(piece[2])[0] if 2 in piece else 0.0
            pieces.append((piece.get(1, b"").decode(), score, piece.get(3, _NORMAL)))
        elif number == 2:
            fallback = bool(dict(_fields(value)).get(35, 0))
        elif number == 3:
            rules = dict(_fields(value))
            prefix = bool(rules.get(3, 1))
            if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1):
                raise ValueError("a model without text normalization is needed")
    return pieces, fallback, prefix


def _quantum(value: float) -> float:
    """The largest power of two that ``value`` is a multiple of."""
    above, below = value.as_integer_ratio()
    return (above & -above) / below if above else math.inf


class Counter:
    """Piece counts by a model file's content."""

    def __init__(self, data: bytes):
        pieces, self.fallback, self.prefix = read_model(data)
        normal = [score for _, score, kind in pieces if kind == _NORMAL]
        lowest, highest = min(normal, default=0.0), max(normal, default=0.0)
        self.unknown = _single(lowest - UNKNOWN_PENALTY)
        self.automaton = ahocorasick.Automaton()
        texts, lengths, scores = [], [1], [self.unknown]  # 0 stands for the unknown character
        for text, score, kind in pieces:
            if kind in (_NORMAL, _USER):
                if kind == _USER:
                    score = len(text.encode()) * highest - 0.1
                self.automaton.add_word(text, len(scores))
                texts.append(text)
                lengths.append(len(text))
                scores.append(score)
        self.automaton.make_automaton()
        self.lengths, self.scores = lengths, scores
        self.score_of = np.array(scores)
        used = set().union(*texts)
        self.border = next(c for c in map(chr, chain(range(0xE000, 0xF900), range(0xD7FF))) if c not in used)
        # Chunks end where no piece reaches over.
        joined = any(SPACE in text.lstrip(SPACE) for text in texts)
        lines = any("\n" in text for text in texts)
        if joined or lines:
            self.cut = lambda text: [text]
        else:
            self.cut = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+").findall
        # Sums never rise above the score before a chunk unless a piece's score is positive.
        self.falling = max(scores) <= 0.0
        self.exact = -math.ldexp(min(map(_quantum, scores)), 24)
        self.trie = Trie(texts)
        self._clear()

    def walk(self, chunk: str, before: float) -> tuple[float, int]:
        """Score after ``chunk`` and its pieces, with sums rounded to single precision."""
        lengths, scores = self.lengths, self.scores
        best, counts = [before], [0]
        ends = iter([*self.automaton.iter(chunk), (len(chunk), None)])
        end, found = next(ends)
        for at, character in enumerate(chunk):
            score = None
            length = 0
            while end == at:  # the longest piece first, so by ascending start
                length = lengths[found]
                start = at + 1 - length
                candidate = scores[found] + best[start]
                if score is None or candidate > score:
                    score, count = _single(candidate), counts[start] + 1
                end, found = next(ends)
            if length != 1:
                candidate = self.unknown + best[at]
                if score is None or candidate > score:
                    score = _single(candidate)
                    count = counts[at] + (len(character.encode()) if self.fallback else 1)
            best.append(score)
            counts.append(count)
        return best[-1], counts[-1]

    def walk_within(self, chunk: str, before: float, unit: float) -> tuple[float, int, bool]:
        """As ``walk`` where sums stay in the binade of ``unit``, or in the exact zone for 0.

        The last value tells whether a sum stood half-way, so that the last bit decided.
        """
        pivot, half = unit * (3 << 51), unit / 2 or math.inf
        unknown, tied = self.unknown, False
        lengths, scores = self.lengths, self.scores
        best, counts = [before], [0]
        ends = iter([*self.automaton.iter(chunk), (len(chunk), None)])
        end, found = next(ends)
        for at in range(len(chunk)):
            score = -math.inf
            length = 0
            while end == at:
                length = lengths[found]
                start = at + 1 - length
                candidate = scores[found] + best[start]
                if candidate > score:
                    score, origin = candidate + pivot - pivot, start
                    count = 1
                    if score - candidate == half or candidate - score == half:
                        tied = True
                end, found = next(ends)
            if length != 1:
                candidate = unknown + best[at]
                if candidate > score:
                    score, origin = candidate + pivot - pivot, at
                    count = len(chunk[at].encode()) if self.fallback else 1
                    if score - candidate == half or candidate - score == half:
                        tied = True
            best.append(score)
            counts.append(counts[origin] + count)
        return best[-1], counts[-1], tied

    def _clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.chunks: list[str] = []
        self.chars = 0
        # By chunk: change of the score and pieces in the exact zone.
        self.changes, self.pieces = np.empty(0), np.empty(0, np.int64)
        # By binade, by chunk and for an even and an odd last bit: the same; NaN is not known yet.
        self.zones: dict[int, np.ndarray] = {}

    def _learn(self, chunks: set[str]) -> list["Lattice"]:
        """Numbers and exact outcomes for the chunks that are new."""
        new = chunks.difference(self.ids)
        if not new:
            return []
        chars = sum(map(len, new))
        if len(self.ids) + len(new) > CACHED_CHUNKS or self.chars + chars > CACHED_CHARS:
            self._clear()
            new, chars = chunks, sum(map(len, chunks))
        self.chars += chars
        known = len(self.chunks)
        self.chunks += new
        size = len(self.chunks)
        self.ids.update(zip(self.chunks[known:], range(known, size), strict=True))
        if size > len(self.changes):
            room = size + size // 2 - len(self.changes)
            self.changes = np.r_[self.changes, np.zeros(room)]
            self.pieces = np.r_[self.pieces, np.zeros(room, np.int64)]
            for zone, kept in self.zones.items():
                self.zones[zone] = np.r_[kept, _outcomes(room)]
        lattices = self._lattices(range(known, size))
        for lattice in lattices:
            all_of_it = np.arange(len(lattice.ids))
            self.changes[lattice.ids], self.pieces[lattice.ids], _ = lattice.walk(
                all_of_it, np.zeros(len(all_of_it))
            )
        for i in range(known, size):
            if len(self.chunks[i]) > JOINT_LENGTH:
                self.changes[i], self.pieces[i], _ = self.walk_within(self.chunks[i], 0.0, 0.0)
        return lattices

    def _lattices(self, ids: Iterable[int]) -> list["Lattice"]:
        """The chunks of these numbers that are worked out together, in parts."""
        lattices, group, size = [], [], 0
        for i in ids:
            length = len(self.chunks[i])
            if length <= JOINT_LENGTH:
                group.append(i)
                size += length
                if size >= JOINT_CHARS:
                    lattices.append(Lattice(self, group))
                    group, size = [], 0
        if group:
            lattices.append(Lattice(self, group))
        return lattices

    def _enter(self, met: dict[int, np.ndarray], lattices: list["Lattice"]) -> None:
        """Outcomes in each zone for the chunks met there that lack them."""
        if not met:
            return
        size, room = len(self.chunks), len(self.changes)
        lacking = {}
        for zone, ids in met.items():
            if zone not in self.zones:
                self.zones[zone] = _outcomes(room)
            lacking[zone] = np.zeros(size, bool)
            lacking[zone][ids[np.isnan(self.zones[zone]["change"][ids, 0])]] = True
        known = min((int(lattice.ids[0]) for lattice in lattices), default=size)
        before = np.zeros(known, bool)
        for wanted in lacking.values():
            before |= wanted[:known]
        for lattice in [*self._lattices(np.flatnonzero(before).tolist()), *lattices]:
            chosen = [np.flatnonzero(wanted[lattice.ids]) for wanted in lacking.values()]
            zones = np.repeat(list(lacking), list(map(len, chosen)))
            chosen = np.concatenate(chosen)
            tied = self._walk(lattice, chosen, zones, (0, 1))
            self._walk(lattice, chosen[tied], zones[tied], (1,))

    def _walk(self, lattice: "Lattice", chosen: np.ndarray, zones: np.ndarray, bits: tuple) -> np.ndarray:
        """Enter the outcomes of a lattice's chunks in their zones, for the first of the last bits."""
        change, number, tied = lattice.walk(chosen, np.ldexp(1.0, zones - 24), bits[0])
        for zone in np.unique(zones).tolist():
            here = zones == zone
            at = lattice.ids[chosen[here]]
            for bit in bits:
                self.zones[zone]["change"][at, bit] = change[here]
                self.zones[zone]["number"][at, bit] = number[here]
        return tied

    def count(self, text: str) -> int:
        return self.count_all([text])[0]

    def count_all(self, texts: list[str]) -> list[int]:
        """Pieces of each text."""
        totals = [0] * len(texts)
        filled = [n for n, text in enumerate(texts) if text]
        if not filled:
            return totals
        blank = SPACE if self.prefix else ""
        split = [self.cut(blank + texts[n].replace(" ", SPACE)) for n in filled]
        if not self.falling:
            for n, chunks in zip(filled, split, strict=True):
                score = 0.0
                for chunk in chunks:
                    score, number = self.walk(chunk, score)
                    totals[n] += number
            return totals
        flat = list(chain.from_iterable(split))
        lattices = self._learn(set(flat))
        ids = np.fromiter(map(self.ids.__getitem__, flat), np.int64, len(flat))
        changes = self.changes[ids]
        stops = np.cumsum([len(chunks) for chunks in split])
        starts = np.r_[0, stops[:-1]]
        sums = np.empty(len(flat))
        for low, high in zip(starts.tolist(), stops.tolist(), strict=True):
            np.cumsum(changes[low:high], out=sums[low:high])
        pieces = np.add.reduceat(self.pieces[ids], starts)
        # The zone a chunk begins in, 0 where its text is in the exact zone yet.
        zones = np.zeros(len(flat), np.int64)
        zones[1:] = np.where(sums[:-1] <= self.exact, np.frexp(sums[:-1])[1], 0)
        zones[starts] = 0
        outcomes = _outcomes(len(flat))
        places = {zone: np.flatnonzero(zones == zone) for zone in np.unique(zones).tolist() if zone}
        self._enter({zone: ids[here] for zone, here in places.items()}, lattices)
        for zone, here in places.items():
            outcomes[here] = self.zones[zone].take(ids[here])
        for n, low, high, whole in zip(filled, starts.tolist(), stops.tolist(), pieces.tolist(), strict=True):
            if sums[high - 1] > self.exact:
                totals[n] = whole
                continue
            first = low + int(np.argmax(sums[low:high] <= self.exact))
            score = float(sums[first - 1]) if first > low else 0.0
            here = slice(first, high)
            totals[n] = int(self.pieces[ids[low:first]].sum()) + self._rounded(
                flat[here], score, zones[here].tolist(), outcomes[here]
            )
        return totals

    def _rounded(self, chunks: list[str], score: float, zones: list[int], outcomes: np.ndarray) -> int:
        """Pieces of the chunks that come after ``score``, the first of which leaves its zone.

        ``zones`` are those foretold.
        """
        total = zone = 0
        floor = unit = 0.0
        even, odd = outcomes["change"].T.tolist()
        of_even, of_odd = outcomes["number"].T.tolist()
        for at, foretold in enumerate(zones):
            if foretold == zone and zone:
                if int(score / unit) & 1:
                    after, number = score + odd[at], of_odd[at]
                else:
                    after, number = score + even[at], of_even[at]
                if after > floor:  # not so for NaN
                    score = after
                    total += number
                    continue
            score, number = self.walk(chunks[at], score)
            total += number
            if score <= self.exact:
                zone = math.frexp(score)[1]  # 2^(zone-1) <= -score < 2^zone
                floor, unit = -math.ldexp(1.0, zone), math.ldexp(1.0, zone - 24)
        return total


_OUTCOME = np.dtype([("change", float, 2), ("number", np.int32, 2)])


def _outcomes(size: int) -> np.ndarray:
    """Room for outcomes, none of them known."""
    room = np.zeros(size, _OUTCOME)
    room["change"] = np.nan
    return room


class Trie:
    """Steps from node to node by a character, in a table by hash, for many places at once."""

    _MIX = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, texts: list[str]):
        steps: dict[int, int] = {}
        piece = [0]
        for number, text in enumerate(texts, 1):
            node = 0
            for character in text:
                node = steps.setdefault(node << 21 | ord(character), len(piece))
                if node == len(piece):
                    piece.append(0)
            piece[node] = number
        self.piece = np.array(piece, np.int32)
        bits = max(4, (4 * len(steps)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.nodes = np.zeros(1 << bits, np.int32)
        keys = np.fromiter(steps, np.int64, len(steps))
        nodes = np.fromiter(steps.values(), np.int32, len(steps))
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] < 0
            self.keys[slots[free]] = keys[free]
            self.nodes[slots[free]] = nodes[free]
            left = self.keys[slots] != keys
            keys, nodes = keys[left], nodes[left]
            slots = (slots[left] + 1) & (len(self.keys) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * self._MIX >> self.shift).astype(np.int64)

    def pieces(self, codes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Length, places and numbers of the pieces that begin anywhere in ``codes``.

        The last of the codes is in no piece.
        """
        places = np.arange(len(codes), dtype=np.int32)
        nodes = np.zeros(len(codes), np.int64)
        length = 0
        while len(places):
            keys = nodes << 21 | codes[places + length]
            slots = self._slots(keys)
            met = self.keys[slots]
            astray = np.flatnonzero((met != keys) & (met >= 0))
            while len(astray):
                slots[astray] = (slots[astray] + 1) & (len(self.keys) - 1)
                met[astray] = self.keys[slots[astray]]
                astray = astray[(met[astray] != keys[astray]) & (met[astray] >= 0)]
            gone = np.flatnonzero(met == keys)
            length += 1
            places, nodes = places[gone], self.nodes[slots[gone]].astype(np.int64)
            numbers = self.piece[nodes]
            ends = np.flatnonzero(numbers)
            if len(ends):
                yield length, places[ends], numbers[ends]


class Lattice:
    """The pieces of many chunks, which lie behind one another with a border after each."""

    def __init__(self, counter: Counter, ids: list[int]):
        self.ids = np.array(ids)
        chunks = [counter.chunks[i] for i in ids]
        joined = counter.border.join(chunks) + counter.border
        codes = np.frombuffer(joined.encode("utf-32-le"), np.int32)
        sizes = np.fromiter(map(len, chunks), np.int32, len(chunks))
        self.stops = np.cumsum(sizes + 1, dtype=np.int32) - 1
        self.starts = self.stops - sizes
        # Characters that are no piece are one of their own.
        plain = np.ones(len(codes), bool)
        plain[self.stops] = False
        starts, pieces, lengths, numbers = [], [], [], []
        for length, places, piece in counter.trie.pieces(codes):
            if length == 1:
                plain[places] = False
            starts.append(places)
            pieces.append(piece)
            lengths.append(np.full(len(places), length, np.int32))
            numbers.append(np.ones(len(places), np.int32))
        unknown = np.flatnonzero(plain).astype(np.int32)
        code = codes[unknown]
        more = (code > 0x7F).astype(np.int32) + (code > 0x7FF) + (code > 0xFFFF)
        starts.append(unknown)
        pieces.append(np.zeros(len(unknown), np.int32))
        lengths.append(np.ones(len(unknown), np.int32))
        numbers.append(1 + more * counter.fallback)
        start, length = np.concatenate(starts), np.concatenate(lengths)
        owner = np.repeat(np.arange(len(chunks), dtype=np.int32), sizes + 1)[start]
        order = np.argsort(owner, kind="stable")
        start, length, owner = start[order], length[order], owner[order]
        self.first = np.searchsorted(owner, np.arange(len(chunks) + 1))
        self.origins = start - self.starts[owner]
        self.ends = self.origins + length
        # By the place they end at in their chunk, the longest first, so by ascending start.
        longest = int(length.max())
        self.key = self.ends * (longest + 1) + longest - length
        if JOINT_LENGTH * (longest + 1) + longest < 1 << 15:
            self.key = self.key.astype(np.int16)  # sorted faster
        self.numbers = np.concatenate(numbers)[order].astype(np.int32)
        self.scores = counter.score_of[np.concatenate(pieces)[order]]

    def walk(self, chosen: np.ndarray, units: np.ndarray, odd: int = 0) -> tuple[np.ndarray, ...]:
        """What ``Counter.walk_within`` gives for the chosen chunks, with the change of the score.

        Each has its unit, 0 for the exact zone; the score before has an even or an odd last bit.
        """
        total = np.cumsum(self.first[chosen + 1] - self.first[chosen])
        cuts = np.searchsorted(total, np.arange(JOINT_PIECES, total[-1] if len(total) else 0, JOINT_PIECES))
        parts = [
            self._walk(*part, odd)
            for part in zip(np.split(chosen, cuts), np.split(units, cuts), strict=True)
            if len(part[0])
        ]
        if not parts:
            return np.empty(0), np.empty(0, np.int32), np.empty(0, bool)
        return tuple(np.concatenate(column) for column in zip(*parts, strict=True))

    def _walk(self, chosen: np.ndarray, units: np.ndarray, odd: int) -> tuple[np.ndarray, ...]:
        sizes = (self.stops - self.starts)[chosen]
        stops = np.cumsum(sizes + 1) - 1
        starts = stops - sizes
        # The pieces of the chosen chunks, place by place.
        held = self.first[chosen + 1] - self.first[chosen]
        piece = np.arange(held.sum()) + np.repeat(self.first[chosen] - np.cumsum(held) + held, held)
        order = np.argsort(self.key.take(piece), kind="stable")
        piece = piece.take(order)
        key = self.key.take(piece)
        owner = np.repeat(np.arange(len(chosen)), held).take(order)
        ends = starts.take(owner)
        origins = ends + self.origins.take(piece)
        ends += self.ends.take(piece)
        scores, numbers = self.scores.take(piece), self.numbers.take(piece)
        rounds = bool(units.any())
        pivots = (units * (3 << 51)).take(owner) if rounds else None
        before = -units * ((3 << 22) + odd)
        best = np.full(int(stops[-1]) + 1, -np.inf)
        best[starts] = before
        counts = np.zeros(len(best), np.int32)
        tied = np.zeros(len(chosen), bool)
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        # In a step each chunk has one piece at most, and no step reads what it writes.
        for low, high in zip(cuts, cuts[1:], strict=False):
            end, origin = ends[low:high], origins[low:high]
            candidate = best.take(origin)
            candidate += scores[low:high]
            better = np.flatnonzero(candidate > best.take(end))
            end, candidate = end.take(better), candidate.take(better)
            counts[end] = counts.take(origin.take(better)) + numbers[low:high].take(better)
            if not rounds:
                best[end] = candidate
                continue
            pivot = pivots[low:high].take(better)
            rounded = candidate + pivot
            rounded -= pivot
            best[end] = rounded
            # A sum half a unit off: the pivot is 3 * 2^52 halves.
            half_way = np.flatnonzero(np.abs(rounded - candidate) * (3 << 52) == pivot)
            tied[owner[low:high].take(better.take(half_way))] = True
        return best[stops] - before, counts[stops], tied


_LOADED: dict[int, Counter] = {}


def _load(data: bytes) -> Counter:
    key = hash(data)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Counter(data)
    return _LOADED[key]


def _forget() -> None:
    _LOADED.clear()


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def token_counts(documents: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_chars``: pieces on the best path over each whole text.

    ``documents`` needs ``doc_id`` and ``text``; other columns are not read.  ``path`` is that of
    a model file on the driver; its pieces and scores are taken as a unigram vocabulary.  A null
    or empty text has no tokens.  Every row gives a row, so repeated rows repeat and a null id
    stays null.  A text without blanks and line ends is one chunk.
    """
    data = documents.sparkSession.sparkContext.broadcast(read(path or default_model()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("viterbi", _forget)
        counter = _load(data.value)
        for batch in batches:
            step = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
            for start in range(0, batch.num_rows, step):
                rows = batch.slice(start, step)
                texts = [text or "" for text in rows.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.array(counter.count_all(texts), pa.int64()),
                        pa.array([len(text) for text in texts], pa.int64()),
                    ],
                    ["doc_id", "n_tokens", "n_chars"],
                )

    rows = documents.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, n_tokens bigint, n_chars bigint")

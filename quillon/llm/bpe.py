"""Byte-level BPE encoding and decoding, by batched numpy merge rounds.

A text is cut into units at every space that follows a non-space character; pre-tokens never cross such a place, so a unit's
ids do not depend on its neighbours. A task encodes each unit it has not met before: the pre-tokens of many units lie in
one flat array of symbols, and in each round every pre-token finds its pair of lowest rank by binary search over the sorted
pair keys and merges all its occurrences, until no pair has a rank. Texts are then put together from the units' ids.

Defined results: a null text is empty and has no ids; ids are bound to no text length (a text without spaces is one unit);
repeated rows give equal results; empty tables give empty results; input columns named like a result column are replaced.
Units of equal hash and different bytes (texts can be made that way) cost time, never a wrong id.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from quillon.llm.common import pieces, utf8_of, with_fields, without

#: Fixed value: the pre-token pattern of the public byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Units that a worker remembers, about 100 bytes each; beyond that, or 16 ids or 64 bytes a unit, it keeps the most used ones only.
MOST_UNITS = 300_000
#: Bytes beyond which a text is cut into parts before it is encoded.
LONG = 4 << 20
_SAFE = re.compile(rb"[0-9A-Za-z] ")
NO_RANK = np.iinfo(np.int64).max


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    return public_tokenizers.path(name)


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it is printable, else the next one from U+0100 on."""
    own = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = itertools.count(256)
    return [chr(b if b in own else next(spare)) for b in range(256)]


def unit_starts(data: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Where units start in UTF-8 bytes: at heads (starts of texts), and at every space that follows no white space."""
    mark = np.zeros(len(data), bool)
    mark[heads] = True
    at = np.flatnonzero(data[1:] == 0x20) + 1
    prior = data[at - 1]
    blank = (prior == 0x20) | ((prior >= 0x09) & (prior <= 0x0D)) | ((prior >= 0x1C) & (prior <= 0x1F))
    # White space outside of ASCII: U+0085, U+00A0, U+1680, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
    wide = np.flatnonzero((prior >= 0x80) & (prior < 0xC0))
    one, two, three = prior[wide], data[at[wide] - 2], data[np.maximum(at[wide] - 3, 0)]
    blank[wide] = (
        ((two == 0xC2) & ((one == 0x85) | (one == 0xA0)))
        | ((three == 0xE1) & (two == 0x9A) & (one == 0x80))
        | ((three == 0xE2) & (two == 0x80) & ((one <= 0x8A) | (one == 0xA8) | (one == 0xA9) | (one == 0xAF)))
        | ((three == 0xE2) & (two == 0x81) & (one == 0x9F))
        | ((three == 0xE3) & (two == 0x80) & (one == 0x80))
    )
    mark[at[~blank]] = True
    return np.flatnonzero(mark)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of runs of these sizes from these starts on, one run after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


class Growing:
    """An array that values are appended to, with room to spare."""

    def __init__(self, dtype):
        self.size, self.room = 0, np.zeros(1 << 12, dtype)

    def append(self, values: np.ndarray) -> None:
        end = self.size + len(values)
        if end > len(self.room):
            room = np.zeros(max(end, 3 * len(self.room) // 2), self.room.dtype)
            room[: self.size] = self.room[: self.size]
            self.room = room
        self.room[self.size : end] = values
        self.size = end


class Hashes:
    """64-bit hashes of parts of a byte array by prefix sums, and a check value of each part's first bytes and length (up to
    255). Equal hashes only propose that parts are equal; whoever asks compares the bytes."""

    STEP = np.uint64(0xD1342543DE82EF95)
    BACK = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))

    def __init__(self):
        self.table = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.powers = self.inverse = np.ones(1, np.uint64)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            if len(self.powers) < len(data):
                self.powers = np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(len(data), self.STEP))])
                self.inverse = np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(len(data), self.BACK))])
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(self.table[data] * self.powers[: len(data)], out=sums[1:])
            sizes = (ends - starts).astype(np.uint64)
            key = (sums[ends] - sums[starts]) * self.inverse[starts] + sizes * self.STEP
            key = (key ^ (key >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            key ^= key >> np.uint64(29)
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        first = np.ndarray(len(data), "<u8", padded, strides=(1,))[starts]
        held = np.minimum(sizes, np.uint64(7)) * np.uint64(8)
        check = (first & ((np.uint64(1) << held) - np.uint64(1))) | (np.minimum(sizes, np.uint64(255)) << np.uint64(56))
        return np.maximum(key, np.uint64(1)), check


class Units:
    """Ids of texts, put together from remembered ids of their units.

    Numbers of units are found by hash for all units of some texts at once, in an open-addressing table. Every unit that is
    found is then compared with the remembered one byte by byte; where the bytes differ, the unit is encoded by itself.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = MOST_UNITS):
        """encode: units to all their ids in one array and the number of ids of each; most: units to remember."""
        self.encode, self.most, self.hashes = encode, most, Hashes()
        self.bits = max(4, (2 * most).bit_length())
        self.reset()

    def reset(self) -> None:
        self.ids, self.starts, self.counts, self.uses = Growing(np.uint32), Growing(np.int32), Growing(np.int32), Growing(np.int32)
        self.keys, self.checks = Growing(np.uint64), Growing(np.uint64)
        self.bytes, self.places, self.sizes = Growing(np.uint8), Growing(np.int64), Growing(np.int64)
        self.slots = np.full(1 << self.bits, -1, np.int32)

    def find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Numbers of units; -1 for those that are new."""
        out = np.full(len(keys), -1, np.int64)
        left, slot = np.arange(len(keys)), (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(left):
            held = self.slots[slot]
            hit = (held >= 0) & (self.keys.room[held] == keys[left]) & (self.checks.room[held] == checks[left])
            out[left[hit]] = held[hit]
            going = (held >= 0) & ~hit
            left, slot = left[going], (slot[going] + 1) & (len(self.slots) - 1)
        return out

    def keep(self, data: np.ndarray, sizes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """The bytes (one after the other) and ids of more units."""
        self.places.append(self.bytes.size + np.cumsum(sizes) - sizes)
        self.sizes.append(sizes)
        self.bytes.append(data)
        self.starts.append(self.ids.size + np.cumsum(counts) - counts)
        self.counts.append(counts)
        self.ids.append(ids)
        self.uses.append(np.zeros(len(sizes), np.int32))

    def add(self, keys: np.ndarray, checks: np.ndarray) -> None:
        """Units to be found by their hashes; their bytes and ids are kept next."""
        number = self.keys.size + np.arange(len(keys))
        self.keys.append(keys)
        self.checks.append(checks)
        if 2 * self.keys.size > len(self.slots):
            self.bits += 1
            self.slots = np.full(1 << self.bits, -1, np.int32)
            keys, number = self.keys.room[: self.keys.size], np.arange(self.keys.size)
        slot = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(number):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = number[free]
            going = self.slots[slot] != number  # taken before, or just now by another
            number, slot = number[going], (slot[going] + 1) & (len(self.slots) - 1)

    def forget(self) -> None:
        """Starts anew with the units that were used most since the last time, half as many as fit at most."""
        uses, counts = self.uses.room[: self.keys.size], self.counts.room
        often = np.flatnonzero(uses > 1)
        often = np.sort(often[np.argsort(-uses[often], kind="stable")[: self.most // 2]])
        keys, checks, sizes = self.keys.room[often], self.checks.room[often], counts[often].astype(np.int64)
        held = self.ids.room[spread(self.starts.room[often], sizes)]
        lengths = self.sizes.room[often]
        data = self.bytes.room[spread(self.places.room[often], lengths)]
        self.reset()
        if len(held) <= 8 * self.most and len(data) <= 32 * self.most:
            self.add(keys, checks)
            self.keep(data, lengths, held, sizes)

    def differ(self, at: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which of these parts of data are not, byte by byte, the units whose numbers they were given."""
        sizes = ends - starts
        out = np.flatnonzero(self.sizes.room[at] != sizes)
        same = np.flatnonzero(self.sizes.room[at] == sizes)
        unequal = np.flatnonzero(self.bytes.room[spread(self.places.room[at[same]], sizes[same])] != data[spread(starts[same], sizes[same])])
        return np.union1d(out, same[np.searchsorted(np.cumsum(sizes[same]), unequal, "right")])

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of UTF-8 texts in one array, and the number of ids of each text."""
        if max(map(len, texts), default=0) <= LONG:
            return self.numbered(texts)
        # Long texts are cut where a unit starts for sure; what cannot be cut is encoded as it is.
        found, counts = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            at = 0
            while at < len(text):
                cut = _SAFE.search(text, at + LONG) if len(text) - at > LONG else None
                end = cut.end() - 1 if cut else len(text)
                part = text[at:end]
                ids = self.encode([part.decode("utf-8", "replace")])[0] if len(part) > 2 * LONG else self.numbered([part])[0]
                found.append(ids.astype(np.uint32))
                counts[i] += len(ids)
                at = end
        return np.concatenate(found), counts

    def numbered(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts that are not long."""
        if self.counts.size > self.most or self.ids.size > 16 * self.most or self.bytes.size > 64 * self.most:
            self.forget()
        joined = b"".join(texts)
        data = np.frombuffer(joined, np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        heads = np.cumsum(lengths) - lengths
        starts = unit_starts(data, heads[lengths > 0]) if len(data) else np.empty(0, np.int64)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        keys, checks = self.hashes(data, starts, ends)
        at = self.find(keys, checks)
        new = np.flatnonzero(at < 0)
        if len(new):
            both = np.empty(len(new), [("k", "u8"), ("c", "u8")])
            both["k"], both["c"] = keys[new], checks[new]
            order = np.lexsort((both["c"], both["k"]))
            fresh = np.concatenate([[True], both[order[1:]] != both[order[:-1]]])
            firsts = new[order[fresh]]
            units = [joined[a:b].decode("utf-8", "replace") for a, b in zip(starts[firsts].tolist(), ends[firsts].tolist())]
            ids, counts = self.encode(units)
            base = self.keys.size
            self.add(keys[firsts], checks[firsts])
            lengths = (ends - starts)[firsts]
            self.keep(data[spread(starts[firsts], lengths)], lengths, ids, counts)
            at[new[order]] = base + np.cumsum(fresh) - 1
        np.add.at(self.uses.room, at, 1)
        odd = self.differ(at, data, starts, ends)
        if len(odd):
            return self.each(joined, starts, ends, at, odd, heads)
        return self.put_together(at, starts, heads, len(data))

    def put_together(self, at: np.ndarray, starts: np.ndarray, heads: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that begin at heads, of units with these numbers."""
        counts = self.counts.room[at]
        marks = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        out = self.ids.room[spread(self.starts.room[at], counts.astype(np.int64))]
        # A text's units end where the next text's begin.
        return out, np.diff(marks[np.searchsorted(starts, np.append(heads, end))])

    def each(self, joined: bytes, starts: np.ndarray, ends: np.ndarray, at: np.ndarray, odd: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Units at odd share their hash with another unit: they are encoded anew and stay without a place in the table, so all
        units are forgotten afterwards (numbers of units and of keys must agree)."""
        parts = [joined[a:b] for a, b in zip(starts[odd].tolist(), ends[odd].tolist())]
        ids, counts = self.encode([x.decode("utf-8", "replace") for x in parts])
        at = at.copy()
        at[odd] = self.counts.size + np.arange(len(odd))
        self.keep(np.frombuffer(b"".join(parts), np.uint8), np.fromiter(map(len, parts), np.int64, len(parts)), ids, counts)
        out = self.put_together(at, starts, heads, len(joined))
        self.reset()
        return out


class ByteBPE:
    """Encoder and decoder of a byte-level BPE vocabulary in the tokenizers library's file form."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = byte_characters()
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.size = 1 + max([*vocab.values(), *(x["id"] for x in spec["added_tokens"])])
        self.first = np.array([vocab[c] for c in chars], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)[order]
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.added_split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.pattern = regex.compile(PATTERN)
        value = {c: b for b, c in enumerate(chars)}
        table = [b""] * self.size
        for token, i in vocab.items():
            table[i] = bytes(value[c] for c in token)
        for token, i in self.added.items():
            table[i] = token.encode()
        self.token_sizes = np.array([len(x) for x in table], np.int64)
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes
        self.token_bytes = np.frombuffer(b"".join(table), np.uint8)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and the number of ids of each word."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.first[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            rank = np.full(len(symbols), NO_RANK)
            to = np.zeros(len(symbols), np.int64)
            key = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = np.flatnonzero((self.keys[at] == key) & (word[:-1] == word[1:]))
            rank[found], to[found] = self.ranks[at[found]], self.merged[at[found]]
            heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            runs = np.diff(np.concatenate([heads, [len(word)]]))
            lowest = np.repeat(np.minimum.reduceat(rank, heads), runs)
            over = lowest == NO_RANK
            if over.any():
                done.append((word[over], symbols[over]))
                going = ~over
                symbols, word, rank, to, lowest = symbols[going], word[going], rank[going], to[going], lowest[going]
            # Of occurrences that overlap (a symbol beside itself), every second one counts from the left.
            hit = rank == lowest
            place = np.arange(len(hit))
            fresh = hit & ~np.concatenate([[False], hit[:-1]]) if len(hit) else hit
            since = place - np.maximum.accumulate(np.where(fresh, place, 0)) if len(hit) else place
            left = np.flatnonzero(hit & (since % 2 == 0))
            symbols[left] = to[left]
            keep = np.ones(len(symbols), bool)
            keep[left + 1] = False
            symbols, word = symbols[keep], word[keep]
        if not done:
            return np.empty(0, np.int64), np.zeros(len(words), np.int64)
        word, ids = np.concatenate([x for x, _ in done]), np.concatenate([x for _, x in done])
        order = np.argsort(word, kind="stable")
        return ids[order], np.bincount(word, minlength=len(words))

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words: dict[bytes, int] = {}
        seen: list[int] = []
        sizes: list[int] = []
        for unit in units:
            n = len(seen)
            for part in self.added_split.split(unit) if self.added and any(x in unit for x in self.added) else [unit]:
                if part in self.added:
                    seen.append(-1 - self.added[part])
                else:
                    seen += [words.setdefault(x.encode("utf-8", "replace"), len(words)) for x in self.pattern.findall(part)]
            sizes.append(len(seen) - n)
        ids, counts = self.merge(list(words))
        # An added token is a word of its own behind the others, with its one id.
        extra = sorted({x for x in seen if x < 0})
        number = {x: len(words) + i for i, x in enumerate(extra)}
        ids, counts = np.concatenate([ids, [-1 - x for x in extra]]).astype(np.int64), np.concatenate([counts, np.ones(len(extra), np.int64)]).astype(np.int64)
        which = np.array([x if x >= 0 else number[x] for x in seen], np.int64)
        starts, own = (np.cumsum(counts) - counts)[which], counts[which]
        ends = np.cumsum(own)
        out = ids[np.repeat(starts - (ends - own), own) + np.arange(int(own.sum()))]
        marks = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)]
        return out, np.diff(marks)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of these ids, counts of them each; bytes that are no UTF-8 become U+FFFD."""
        sizes = self.token_sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        data = self.token_bytes[np.repeat(self.token_starts[ids] - (ends - sizes), sizes) + np.arange(total)].tobytes()
        marks = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(marks, marks[1:])]


@functools.cache
def codec(path: str) -> tuple[ByteBPE, Units]:
    """The vocabulary, and the units that a Python worker has met in all its tasks."""
    bpe = ByteBPE(path)
    return bpe, Units(bpe.encode_units)


def packed(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Ids of each text as little-endian unsigned 32-bit integers in one binary value."""
    offsets = np.concatenate([[0], np.cumsum(counts) * 4]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())])


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """docs with ids, the text's token ids as little-endian unsigned 32-bit integers (binary)."""
    return _mapped(without(docs, "ids"), path or vocabulary_path(), decoding=False)


def decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """docs (with ids as encode() gives them; null is empty) with decoded, their text."""
    path, docs = path or vocabulary_path(), without(docs, "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, _ = codec(path)
        for batch in batches:
            for part in pieces(batch, "ids"):
                each = [np.frombuffer(x or b"", "<u4") for x in part.column("ids").to_pylist()]
                counts = np.array([len(x) for x in each], np.int64)
                yield part.append_column("decoded", pa.array(bpe.decode(np.concatenate(each).astype(np.int64), counts), pa.string()))

    return docs.mapInArrow(run, with_fields(docs, "decoded string"))


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """docs with ids as encode() gives them and decoded, the text of these ids, in one pass."""
    return _mapped(without(docs, "ids", "decoded"), path or vocabulary_path(), decoding=True)


def _mapped(docs: DataFrame, path: str, decoding: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, units = codec(path)
        for batch in batches:
            for part in pieces(batch, "text"):
                ids, counts = units(utf8_of(part))
                part = part.append_column("ids", packed(ids, counts))
                yield part.append_column("decoded", pa.array(bpe.decode(ids.astype(np.int64), counts), pa.string())) if decoding else part

    return docs.mapInArrow(run, with_fields(docs, "ids binary, decoded string" if decoding else "ids binary"))

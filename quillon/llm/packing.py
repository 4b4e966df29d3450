"""Packing of documents into training sequences of at most a window of tokens.

A task encodes its documents, an end id behind each, and packs them pool by pool. A document of more than a window is first
cut into full windows, each a sequence. What is left is packed by best-fit decreasing: pieces from the longest to the
shortest, each into the open window with the least room that still holds it. A segment tree whose leaves are the numbers of
open windows of each remaining capacity finds that window in as many steps as the window has bits. Windows that then still
have room are closed by cutting pieces of the emptiest of them, so a pool leaves full sequences and one rest, which goes
into the next pool. A task's last rest becomes sequences whose lengths are powers of two, which need no padding.

Words are told apart by ASCII white space, which the vocabulary drops and no pre-token crosses, so a word's ids do not depend
on its neighbours; the tokenizers library encodes each word that a worker has not met before.

Defined results: a null or empty text is the end id alone; a null doc_id stays null; each row of docs is a document of its own,
also where doc_ids repeat; equal lengths are packed in the order of the rows; an empty table gives no row; the result has its
own columns only. Sequence ids name partition and number within it. A task holds one pool of tokens, or its longest text.
"""

from __future__ import annotations

import functools
import itertools
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.bpe import packed, vocabulary_path
from quillon.llm.common import pieces, utf8_of

WINDOW = 2048
#: Tokens that a task packs together.
POOL = 1 << 22
#: Words that a worker remembers; beyond that (or 8 ids a word) it starts anew.
MOST_WORDS = 500_000
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
#: New words that make one text for the tokenizers library.
BATCH = 200
#: Fixed value of the vocabulary: what a token has behind it that ends a pre-token.
WORD_END = "</w>"
#: Sequences of a partition; the ids of the next partition's begin behind.
PER_PARTITION = 1 << 40


class Numbers(dict):
    """Numbers of words in the order in which they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def one_run_of_letters(word: bytes) -> bool:
    """Whether a word is letters only, also in lower case, and composed."""
    if word.isascii():
        return word.isalpha()
    text = word.decode("utf-8", "replace")
    return text.isalpha() and text.lower().isalpha() and unicodedata.is_normalized("NFC", text)


class Words:
    """Ids of texts by the tokenizers library, which sees each word once until MOST_WORDS are remembered."""

    def __init__(self, path: str, most: int = MOST_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.most = most
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(1 + max(vocabulary.values()), bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.reset()

    def reset(self) -> None:
        self.numbers = Numbers()
        self.ids, self.counts, self.starts = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of UTF-8 texts in one array, and the number of ids of each text."""
        if len(self.numbers) > self.most or len(self.ids) > 8 * self.most:
            self.reset()
        split = [self.folded(t).split() for t in texts]
        known = len(self.numbers)
        at = np.fromiter(map(self.numbers.__getitem__, itertools.chain.from_iterable(split)), np.int64, sum(map(len, split)))
        if len(self.numbers) > known:
            self.learn(list(itertools.islice(self.numbers, known, None)))
        counts = self.counts[at]
        ends = np.cumsum(counts)
        ids = self.ids[np.repeat(self.starts[at] - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)]
        marks = np.concatenate([[0], ends])[np.cumsum([0, *map(len, split)])]
        return ids, np.diff(marks)

    @staticmethod
    def folded(text: bytes) -> bytes:
        """The text with A to Z in lower case, as the vocabulary folds it anyway; not where that could make a special token, or
        a letter that a combining mark (U+0300 to U+036F) composes with in one case only."""
        return text if b"<|" in text or b"\xcc" in text or b"\xcd" in text else text.lower()

    def learn(self, words: list[bytes]) -> None:
        """Encodes words some at a time, with spaces between."""
        plain = np.fromiter(map(one_run_of_letters, words), bool, len(words))
        counts, parts = np.zeros(len(words), np.int64), []
        for rows, tell in ((np.flatnonzero(plain), self.of_letters), (np.flatnonzero(~plain), self.of_places)):
            own = [rows[i : i + BATCH] for i in range(0, len(rows), BATCH)]
            found = tell([[words[k].decode("utf-8", "replace") for k in part.tolist()] for part in own])
            for part, (ids, n) in zip(own, found):
                counts[part] = n
                parts.append((part, ids))
        # Ids of letters and of other words lie apart: each word's start is where its batch put it.
        starts, at = np.zeros(len(words), np.int64), len(self.ids)
        for own, ids in parts:
            starts[own] = at + np.cumsum(counts[own]) - counts[own]
            at += len(ids)
        self.starts = np.concatenate([self.starts, starts])
        self.counts = np.concatenate([self.counts, counts])
        self.ids = np.concatenate([self.ids, *(ids for _, ids in parts)])

    def of_letters(self, batches: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of batches of words of letters, each of which is one pre-token: it ends with the token that ends a word. Every
        word has one such token at least, so where the library takes a letter for something else their number tells."""
        out = []
        for words, x in zip(batches, self.tokenizer.encode_batch_fast([" ".join(b) for b in batches], add_special_tokens=False)):
            ids = np.array(x.ids, np.uint32)
            ends = np.flatnonzero(self.closes[ids])
            out.append((ids, np.diff(ends, prepend=-1)) if len(ends) == len(words) else self.of_places([words])[0])
        return out

    def of_places(self, batches: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of batches of any words: a token belongs to the word that it starts in."""
        out = []
        for words, x in zip(batches, self.tokenizer.encode_batch([" ".join(b) for b in batches], add_special_tokens=False)):
            heads = np.cumsum([0, *(len(w) + 1 for w in words[:-1])])
            at = np.searchsorted(heads, np.fromiter((a for a, _ in x.offsets), np.int64, len(x.ids)), "right") - 1
            out.append((np.array(x.ids, np.uint32), np.bincount(at, minlength=len(words))))
        return out


@functools.cache
def encoder(path: str) -> Words:
    """The words that a Python worker has met in all its tasks."""
    return Words(path)


class Capacities:
    """Open windows by remaining capacity: a segment tree over the numbers of windows of each."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(self.leaves)]

    def _count(self, capacity: int, by: int) -> None:
        at = self.leaves + capacity
        while at:
            self.tree[at] += by
            at >>= 1

    def put(self, window: int, capacity: int) -> None:
        self.windows[capacity].append(window)
        self._count(capacity, 1)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """Takes a window of the least capacity that holds size: (window, its capacity); None if there is none."""
        at = self.leaves + size
        if not self.tree[at]:
            # Up to the first ancestor whose right neighbour holds a window, then down to the leftmost such leaf.
            while at > 1 and (at & 1 or not self.tree[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at *= 2
                if not self.tree[at]:
                    at += 1
        capacity = at - self.leaves
        self._count(capacity, -1)
        return self.windows[capacity].pop(), capacity


def best_fit(sizes: list[int], window: int) -> list[list[int]]:
    """Windows as lists of the numbers of their pieces, by best-fit decreasing; every size is at most a window."""
    open_, out = Capacities(window), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = open_.tightest(sizes[i])
        if found:
            w, capacity = found
            out[w].append(i)
        else:
            w, capacity = len(out), window
            out.append([i])
        if capacity > sizes[i]:
            open_.put(w, capacity - sizes[i])
    return out


class Piece:
    """Consecutive ids of a document, from its id number `start` on."""

    __slots__ = ("doc_id", "doc_tokens", "ids", "start")

    def __init__(self, doc_id: int | None, start: int, ids: np.ndarray, doc_tokens: int):
        self.doc_id, self.start, self.ids, self.doc_tokens = doc_id, start, ids, doc_tokens

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc_id, self.start, self.ids[:n], self.doc_tokens), Piece(self.doc_id, self.start + n, self.ids[n:], self.doc_tokens)


def closed(windows: list[list[Piece]], window: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows and the rest of less than one: the emptiest windows give their pieces, cut where one is too long."""
    fill = [sum(len(p.ids) for p in w) for w in windows]
    order = sorted(range(len(windows)), key=lambda i: -fill[i])
    out = [windows[i] for i in order]
    room = [window - fill[i] for i in order]
    i, j = 0, len(out) - 1
    while i < j:
        while room[i] and i < j:
            piece = out[j].pop()
            if len(piece.ids) > room[i]:
                head, piece = piece.cut(room[i])
                out[j].append(piece)
                piece = head
            out[i].append(piece)
            room[i] -= len(piece.ids)
            room[j] += len(piece.ids)
            if not out[j]:
                out.pop()
                j -= 1
        if not room[i]:
            i += 1
    rest = out.pop() if out and room[len(out) - 1] else []
    return out, rest


def power_parts(pieces_: list[Piece]) -> list[list[Piece]]:
    """These pieces as sequences whose lengths are powers of two, the largest first."""
    total, out, queue = sum(len(p.ids) for p in pieces_), [], list(reversed(pieces_))
    for bit in reversed(range(total.bit_length())):
        if not total >> bit & 1:
            continue
        room, sequence = 1 << bit, []
        while room:
            piece = queue.pop()
            if len(piece.ids) > room:
                piece, left = piece.cut(room)
                queue.append(left)
            sequence.append(piece)
            room -= len(piece.ids)
        out.append(sequence)
    return out


class Packer:
    """Sequences of one task's documents, in pools."""

    def __init__(self, window: int, pool: int, base: int):
        if window < 1:
            raise ValueError("a window holds a token at least")
        self.window, self.pool, self.base = window, pool, base
        self.full: list[list[Piece]] = []
        self.waiting: list[Piece] = []
        self.tokens = self.made = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        piece = Piece(doc_id, 0, ids, len(ids))
        while len(piece.ids) > self.window:
            head, piece = piece.cut(self.window)
            self.full.append([head])
        self.waiting.append(piece)
        self.tokens += len(ids)

    def take(self, last: bool) -> pa.RecordBatch | None:
        """The sequences of a pool that is full, or of the last one."""
        if not last and self.tokens < self.pool:
            return None
        packed_ = [[self.waiting[i] for i in w] for w in best_fit([len(p.ids) for p in self.waiting], self.window)]
        full, rest = closed(packed_, self.window)
        out = [*self.full, *full, *(power_parts(rest) if last else [])]
        self.full, self.waiting = [], [] if last else rest
        self.tokens = sum(len(p.ids) for p in self.waiting)
        if not out:
            return None
        each = [p for s in out for p in s]
        lengths = np.fromiter((len(p.ids) for p in each), np.int64, len(each))
        sizes = np.fromiter(map(len, out), np.int64, len(out))
        ends = np.cumsum(lengths)
        heads = np.cumsum(sizes) - sizes
        sequence = np.repeat(self.base + self.made + np.arange(len(out)), sizes)
        offset = ends - lengths - np.repeat((ends - lengths)[heads], sizes)
        self.made += len(out)
        column = lambda f: pa.array([f(p) for p in each], pa.int64())
        ids = packed(np.concatenate([p.ids for p in each]), lengths)
        return pa.RecordBatch.from_arrays(
            [column(lambda p: p.doc_id), column(lambda p: p.start), pa.array(lengths), ids, column(lambda p: p.doc_tokens), pa.array(sequence), pa.array(offset)],
            ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
        )


def pack_sequences(docs: DataFrame, path: str | None = None, window: int = WINDOW, end_id: int = 1, pool: int = POOL) -> DataFrame:
    """Pieces of docs (doc_id, text) with their ids (binary, little-endian unsigned 32-bit) and places: see SCHEMA."""
    path = path or vocabulary_path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = encoder(path), Packer(window, pool, TaskContext.get().partitionId() * PER_PARTITION)
        for batch in batches:
            for part in pieces(batch, "text"):
                ids, counts = words(utf8_of(part))
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id).astype(np.uint32)
                marks = np.concatenate([[0], np.cumsum(counts + 1)]).tolist()
                for doc_id, a, b in zip(part.column("doc_id").to_pylist(), marks, marks[1:]):
                    packer.add(doc_id, ids[a:b])
                if (made := packer.take(last=False)) is not None:
                    yield made
        if (made := packer.take(last=True)) is not None:
            yield made

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)

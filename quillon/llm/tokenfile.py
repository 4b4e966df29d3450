"""Token-id files: documents' ids in Simple-8b word-aligned blocks, written and read back by Spark tasks.

A file holds documents in ascending doc_id order. Its ids are cut into blocks of BLOCK ids; a block is a run of 64-bit words,
each with a 4-bit selector on top and as many ids of equal width below as fit its 60 bits. Selector 15 is the escape: the
next word holds one id of more than 60 bits as it is. Layout, little-endian:

    words of all blocks (uint64) | block offsets in words (uint64, one more than blocks) | doc ids (int64) | doc id is null (uint8)
    | ids of each document (uint64) | footer: numbers of words, blocks, documents, ids (uint64), MAGIC

Blocks are packed side by side: in step k the k-th word of every block is made at once. A reader fetches any range of blocks
by their offsets and unpacks all words of one selector at once.

Texts are encoded whole by the tokenizers library, but each of their units, at whose ends no pre-token crosses (see `bpe`), only
once: a worker remembers the ids that the library gave it.

Defined results: a null text has no ids but the end id; a null doc_id comes first; rows with equal doc_id are ordered by text;
an empty table gives no file and no row; the result has its own columns only.
"""

from __future__ import annotations

import functools
import itertools
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillon.llm.bpe import Units, packed, vocabulary_path
from quillon.llm.common import materialized, pieces, shared_dir, shared_files, utf8_of

BLOCK, MAGIC = 256, b"S8B1IDS\n"
#: Ids in a word by selector (its index); the width of each is 60 // count bits. Fixed values of the coding.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
ESCAPE = 15
#: Ids read and unpacked at a time.
READ_IDS = 1 << 19
#: Texts that are given to the tokenizers library at once, and units.
BATCH, UNIT_BATCH = 64, 4096
#: Widths of ids of up to 16 bits.
SMALL_WIDTHS = np.maximum(1, np.frexp(np.arange(1 << 16, dtype=np.float64))[1]).astype(np.uint8)


def bit_widths(values: np.ndarray) -> np.ndarray:
    """Bits of each unsigned 64-bit value, 1 at least."""
    if values.max(initial=0) < 1 << 16:
        return SMALL_WIDTHS[values]
    values = values.astype(np.uint64)
    high = (values >> np.uint64(32)).astype(np.uint32)
    low = values.astype(np.uint32)
    part = np.where(high > 0, high, low)
    return np.maximum(1, np.frexp(part.astype(np.float64))[1] + np.where(high > 0, 32, 0)).astype(np.uint8)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of all blocks of these ids, and the number of words of each block."""
    values = np.ascontiguousarray(values, np.uint64)
    blocks = -(-len(values) // BLOCK)
    if not blocks:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    if values.max() < 1 << 32:
        values = values.astype(np.uint32)
    full = np.zeros(blocks * BLOCK, values.dtype)
    full[: len(values)] = values
    grid = np.zeros((blocks, BLOCK + COUNTS[0]), values.dtype)
    grid[:, :BLOCK] = full.reshape(blocks, BLOCK)
    # The most ids that fit a word from each place on: a window of n ids fits if its largest width is at most 60 // n. Rows
    # follow each other in one flat array; a window that begins within a block's ids ends before the next block.
    width = np.ones(grid.shape, np.uint8)
    width[:, :BLOCK] = bit_widths(full).reshape(blocks, BLOCK)
    spans, size = {1: width.ravel()}, 1
    while size < COUNTS[0]:
        wider = spans[size].copy()
        np.maximum(wider[:-size], spans[size][size:], out=wider[:-size])
        spans[2 * size] = wider
        size *= 2
    selector = np.full(grid.size, ESCAPE, np.uint8)
    widest = np.empty(grid.size, np.uint8)
    for s in reversed(range(len(COUNTS))):
        n = COUNTS[s]
        half = 1 << (n.bit_length() - 1)
        shift, end = n - half, grid.size - (n - half)
        np.maximum(spans[half][:end], spans[half][shift:], out=widest[:end])
        widest[end:] = 1
        np.putmask(selector, widest <= 60 // n, s)
    selector = selector.reshape(grid.shape)
    ends = np.full(blocks, BLOCK)
    ends[-1] = len(values) - (blocks - 1) * BLOCK
    # In each step every block that goes on starts one word.
    held = np.array([*COUNTS, 0, 1])
    made, at, going, starts, places = np.zeros(blocks, np.int64), np.zeros(blocks, np.int64), np.arange(blocks), [], []
    while len(going):
        chosen = selector[going, at[going]]
        starts.append(going * grid.shape[1] + at[going])
        places.append(made[going])
        made[going] += 1 + (chosen == ESCAPE)
        at[going] += held[chosen]
        going = going[at[going] < ends[going]]
    start, flat = np.concatenate(starts), grid.ravel()
    place = np.concatenate(places) + (np.cumsum(made) - made)[start // grid.shape[1]]
    words, chosen = np.zeros(int(made.sum()), np.uint64), selector.ravel()[start]
    for s in np.unique(chosen).tolist():
        rows = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            words[place[rows]], words[place[rows] + 1] = np.uint64(ESCAPE << 60), flat[start[rows]]
            continue
        word, first = np.full(len(rows), s << 60, np.uint64), start[rows]
        for k in range(COUNTS[s]):
            word |= flat[first + k].astype(np.uint64) << np.uint64(k * (60 // COUNTS[s]))
        words[place[rows]] = word
    return words, made


def unpack(words: np.ndarray, block_sizes: np.ndarray, n_ids: np.ndarray) -> np.ndarray:
    """Ids of blocks from their words; block_sizes: words of each block; n_ids: ids of each."""
    escape = words >> np.uint64(60) == ESCAPE
    # A word behind an escape is an id as it is, whatever its top bits say.
    for i in np.flatnonzero(escape).tolist():
        if escape[i]:
            escape[i + 1 : i + 2] = False
    raw = np.concatenate([[False], escape[:-1]]) if len(words) else escape
    selector = (words >> np.uint64(60)).astype(np.int64)
    table = np.array([*COUNTS, 0, 0], np.int64)
    held = np.where(raw, 1, np.where(escape, 0, table[selector]))
    block = np.repeat(np.arange(len(block_sizes)), block_sizes)
    ends = np.cumsum(held)
    heads = np.cumsum(block_sizes) - block_sizes
    base = (ends - held)[heads] if len(heads) else heads
    starts = ends - held - base[block]
    plain = ~raw & ~escape
    found = np.unique(selector[plain]).tolist()
    narrow = not raw.any() and all(60 // COUNTS[s] <= 30 for s in found)
    out = np.zeros((len(block_sizes), BLOCK + COUNTS[0]), np.uint32 if narrow else np.uint64)
    if raw.any():
        out[block[raw], starts[raw]] = words[raw]
    flat, first = out.ravel(), block * out.shape[1] + starts
    for s in found:
        rows = np.flatnonzero(plain & (selector == s))
        word, at, width = words[rows], first[rows], 60 // COUNTS[s]
        for k in range(COUNTS[s]):
            flat[at + k] = (word >> np.uint64(k * width)) & np.uint64((1 << width) - 1)
    # Only a file's last block is not full.
    if not len(out):
        return flat
    return np.concatenate([out[:-1, :BLOCK].ravel(), out[-1, : n_ids[-1]]])


class Writer:
    """One token-id file, written as its documents come."""

    def __init__(self, sink):
        self.sink, self.rest, self.sizes, self.docs, self.counts, self.total = sink, np.empty(0, np.uint64), [], [], [], 0

    def add(self, doc_ids: list, ids: np.ndarray, counts: np.ndarray) -> None:
        self.docs += doc_ids
        self.counts.append(counts.astype(np.uint64))
        self.total += len(ids)
        ids = np.concatenate([self.rest, ids.astype(np.uint64)])
        full = len(ids) - len(ids) % BLOCK
        self._blocks(ids[:full])
        self.rest = ids[full:]

    def _blocks(self, ids: np.ndarray) -> None:
        words, sizes = pack(ids)
        self.sink.write(words.astype("<u8").tobytes())
        self.sizes.append(sizes)

    def close(self) -> None:
        self._blocks(self.rest)
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(self.sizes))])
        missing = np.array([x is None for x in self.docs], np.uint8)
        parts = [offsets.astype("<u8"), np.array([x or 0 for x in self.docs], "<i8"), missing, np.concatenate([*self.counts, np.empty(0, np.uint64)]).astype("<u8"), np.array([offsets[-1], len(offsets) - 1, len(self.docs), self.total], "<u8")]
        for part in parts:
            self.sink.write(part.tobytes())
        self.sink.write(MAGIC)
        self.sink.close()


def read_file(source) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Doc ids, ids and number of ids of each document, some documents at a time, from an open random-access file."""
    size = source.size()
    foot = source.read_at(32 + len(MAGIC), size - 32 - len(MAGIC))
    if foot[32:] != MAGIC:
        raise ValueError("no token-id file")
    n_words, n_blocks, n_docs, total = (int(x) for x in np.frombuffer(foot[:32], "<u8"))
    at = 8 * n_words
    offsets = np.frombuffer(source.read_at(8 * (n_blocks + 1), at), "<u8").astype(np.int64)
    at += 8 * (n_blocks + 1)
    docs = np.frombuffer(source.read_at(8 * n_docs, at), "<i8").tolist()
    missing = np.frombuffer(source.read_at(n_docs, at + 8 * n_docs), np.uint8)
    counts = np.frombuffer(source.read_at(8 * n_docs, at + 9 * n_docs), "<u8").astype(np.int64)
    docs = [None if m else d for d, m in zip(docs, missing)]
    ends = np.cumsum(counts)
    i = 0
    while i < n_docs:
        start = int(ends[i] - counts[i])
        j = max(i + 1, int(np.searchsorted(ends, start + READ_IDS, "right")))
        stop = int(ends[j - 1])
        a, b = start // BLOCK, -(-stop // BLOCK)
        words = np.frombuffer(source.read_at(8 * int(offsets[b] - offsets[a]), 8 * int(offsets[a])), "<u8")
        n_ids = np.minimum(BLOCK, total - np.arange(a, b) * BLOCK)
        ids = unpack(words, np.diff(offsets[a : b + 1]), n_ids)
        yield docs[i:j], ids[start - a * BLOCK : stop - a * BLOCK], counts[i:j]
        i = j


@functools.cache
def library_tokenizer(path: str):
    """The tokenizers library's encoder, without truncation and padding, one a Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def library_ids(path: str, texts: list[str], batch: int = BATCH) -> tuple[np.ndarray, np.ndarray]:
    """All ids of whole texts by the tokenizers library in one array, and the number of ids of each text."""
    found, counts = [], np.zeros(len(texts), np.int64)
    for i in range(0, len(texts), batch):
        own = [x.ids for x in library_tokenizer(path).encode_batch_fast(texts[i : i + batch], add_special_tokens=False)]
        counts[i : i + batch] = list(map(len, own))
        found.append(np.fromiter(itertools.chain.from_iterable(own), np.uint32, int(counts[i : i + batch].sum())))
    return np.concatenate([*found, np.empty(0, np.uint32)]), counts


@functools.cache
def library_units(path: str) -> Units:
    """Ids of whole texts by the tokenizers library, which sees each unit (see bpe) once while a Python worker remembers it."""
    return Units(lambda units: library_ids(path, units, UNIT_BATCH))


def write_tokens(docs: DataFrame, path: str | None = None, end_id: int = 2) -> tuple[str, DataFrame]:
    """Token-id files of docs in ascending doc_id order below the shared folder: the folder, and the table of its files
    (part, file, n_docs, n_ids) in the order of part. A retried task writes a file of its own; the table names one each."""
    path = path or vocabulary_path()
    folder = shared_dir(docs.sparkSession, "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, writer = TaskContext.get().partitionId(), None
        for batch in batches:
            for piece in pieces(batch, "text"):
                if writer is None:
                    fs, place = shared_files(folder)
                    name = f"{place}/part-{part:06d}-{uuid.uuid4().hex}.s8b"
                    writer = Writer(fs.open_output_stream(name))
                ids, counts = library_units(path)(utf8_of(piece))
                ends = np.cumsum(counts)
                writer.add(piece.column("doc_id").to_pylist(), np.insert(ids, ends, end_id), counts + 1)
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "file": [name.rsplit("/", 1)[1]], "n_docs": pa.array([len(writer.docs)], pa.int64()), "n_ids": pa.array([writer.total], pa.int64())})

    sorted_docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return folder, materialized(sorted_docs.mapInArrow(run, "part int, file string, n_docs long, n_ids long"), "token-files")


def read_tokens(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids (binary, little-endian unsigned 32-bit) of all files."""
    prior = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    placed = files.withColumn("base", F.coalesce(F.sum("n_ids").over(prior), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, place = shared_files(folder)
                base = row["base"]
                with fs.open_input_file(f"{place}/{row['file']}") as source:
                    for docs, ids, counts in read_file(source):
                        ends = base + np.cumsum(counts)
                        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(ends - counts), pa.array(counts), packed(ids, counts)], ["doc_id", "start", "n_tokens", "ids"])
                        base = int(ends[-1])

    spread = placed.select("file", "base").repartition(max(1, files.count()))
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")

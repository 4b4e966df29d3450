"""Alignment of two tokenizers over the same bytes: groups of tokens between common ends, and links between their ids.

A byte-level BPE vocabulary (A) and a sentencepiece model (B) encode each text with a space in front. A task lays all documents
of a chunk one behind the other, counts the ends of A and of B tokens by place in one array each, and cuts where both occur;
prefix sums over the cuts give each token its group, and differences of prefix sums at the documents' ends give back what
belongs to each. Every A token of a group is linked to every B token of it.

How many documents hold a pair of ids linked is counted over the corpus: a chunk sends each of its distinct pairs once, with
the number of its documents, so no pair meets in more rows than there are chunks. The sums go back to the chunks that asked.

Defined results: a null or empty text, or one whose tokens of either side do not join to its bytes (a sentencepiece model maps
U+2581 to a space), has no tokens, groups or links; a null doc_id stays null; each row is a document, also where rows repeat;
pairs of equal count are all best; an empty table gives no row; the result has its own columns only. A chunk is of about
CHUNK_LINKS links between ids, or one text; a group of many tokens is expanded BLOCK links at a time.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillon.llm.bpe import ByteBPE, Units, spread, vocabulary_path
from quillon.llm.common import materialized, pieces

#: Different links (of documents) that make a chunk full.
CHUNK_LINKS = 1 << 21
#: Links that are made at a time.
BLOCK = 1 << 21
TOKENS = "doc_id long, chunk long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary, times binary"


class Pieces:
    """A sentencepiece model, and the bytes of its pieces."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        name = self.model.id_to_piece
        table = [bytes([int(name(i)[3:-1], 16)]) if self.model.is_byte(i) else name(i).replace("▁", " ").encode() for i in range(self.size)]
        self.token_sizes = np.array([len(x) for x in table], np.int64)
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes
        self.token_bytes = np.frombuffer(b"".join(table), np.uint8)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.model.encode(texts, num_threads=1)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for x in found for i in x), np.int64, int(counts.sum())), counts


class Aligner:
    """Both vocabularies, and the decimal forms of ids with what may follow them."""

    def __init__(self, path_a: str, path_b: str):
        self.a = ByteBPE(path_a)
        self.a.added = {}
        self.units = Units(self.a.encode_units)
        self.b = Pieces(path_b)
        self.pair_type = np.dtype("<u4" if self.a.size * self.b.size <= 1 << 32 else "<u8")
        self.forms = [f"{i}{mark}" for mark in ",|;" for i in range(max(self.a.size, self.b.size))]

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a * self.b.size + b


@functools.cache
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def joins(side, ids: np.ndarray, counts: np.ndarray, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of which documents (of these sizes, one behind the other in data) the tokens join to the bytes."""
    lengths = side.token_sizes[ids]
    marks = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
    good = np.diff(marks) == sizes
    held = np.repeat(good, counts)
    same = side.token_bytes[spread(side.token_starts[ids[held]], lengths[held])] == data[np.repeat(good, sizes)]
    wrong = np.concatenate([[0], np.cumsum(~same)])[np.concatenate([[0], np.cumsum(sizes[good])])]
    good[good] = np.diff(wrong) == 0
    return good


def summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of the times of each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[heads], np.add.reduceat(times[order], heads) if len(heads) else times[:0]


def linked(a: np.ndarray, group_a: np.ndarray, b: np.ndarray, group_b: np.ndarray, doc_of_group: np.ndarray, size_a: int, size_b: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, A id, B id) as one number each, in order, and how often each is linked: all pairs within groups."""
    one = np.int64(1)
    rows_a, times_a = summed(group_a * size_a + a, np.full(len(a), one))
    rows_b, times_b = summed(group_b * size_b + b, np.full(len(b), one))
    of_a, of_b = rows_a // size_a, rows_b // size_b
    held_b = np.bincount(of_b, minlength=len(doc_of_group))
    first_b = np.cumsum(held_b) - held_b
    made = held_b[of_a]
    marks = np.cumsum(made)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    at = 0
    while at < len(rows_a):
        end = max(at + 1, int(np.searchsorted(marks, (marks[at - 1] if at else 0) + BLOCK, "right")))
        part = np.arange(at, end)
        left = np.repeat(part, made[part])
        right = spread(first_b[of_a[part]], made[part])
        keys = (doc_of_group[of_a[left]] * size_a + rows_a[left] % size_a) * size_b + rows_b[right] % size_b
        found.append(summed(keys, times_a[left] * times_b[right]))
        at = end
        if len(found) == 16:
            found = [summed(*map(np.concatenate, zip(*found)))]
    return summed(*map(np.concatenate, zip(*found))) if found else (rows_a, times_a)


class Side:
    """Tokens of one side of good documents: ids, the group of each, and how many each document has."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, ends: np.ndarray):
        self.ids, self.counts, self.ends = ids, counts, ends


def align_texts(both: Aligner, texts: list[bytes]) -> dict[str, list | np.ndarray]:
    """For each text: n_a, n_b, n_groups, n_links, groups, pairs (sorted) and times."""
    n = len(texts)
    asked = np.flatnonzero([bool(t) for t in texts])
    own = [b" " + texts[i] for i in asked.tolist()]
    out = {k: np.zeros(n, np.int64) for k in ("n_a", "n_b", "n_groups", "n_links")} | {"groups": [""] * n, "pairs": [b""] * n, "times": [b""] * n}
    if not own:
        return out
    data, sizes = np.frombuffer(b"".join(own), np.uint8), np.fromiter(map(len, own), np.int64, len(own))
    sides = [(both.a, *both.units(own)), (both.b, *both.b([x[1:].decode() for x in own]))]
    good = np.ones(len(own), bool)
    for side, ids, counts in sides:
        good &= joins(side, ids.astype(np.int64), counts, data, sizes)
    docs, sizes = asked[good], sizes[good]
    if not len(docs):
        return out
    a, b = (Side(i := ids.astype(np.int64)[np.repeat(good, counts)], counts[good], np.cumsum(side.token_sizes[i])) for side, ids, counts in sides)
    # Where tokens of both sides end, a group ends; cut[e] stands for place e.
    end = int(sizes.sum())
    cut = (np.bincount(a.ends, minlength=end + 1) > 0) & (np.bincount(b.ends, minlength=end + 1) > 0)
    before = np.cumsum(cut)
    group_a, group_b = (before[s.ends] - cut[s.ends] for s in (a, b))
    marks = np.concatenate([[0], before[np.cumsum(sizes)]])
    n_groups = np.diff(marks)
    doc_of_group = np.repeat(np.arange(len(docs)), n_groups)
    in_a, in_b = np.bincount(group_a, minlength=len(doc_of_group)), np.bincount(group_b, minlength=len(doc_of_group))
    links = np.concatenate([[0], np.cumsum(in_a * in_b)])
    for name, values in (("n_a", a.counts), ("n_b", b.counts), ("n_groups", n_groups), ("n_links", np.diff(links[marks]))):
        out[name][docs] = values
    # Text of the groups: A tokens stand behind the B tokens of all groups before, B tokens behind the A tokens of theirs.
    form = np.zeros(len(a.ids) + len(b.ids), np.int64)
    last_a, last_b = np.cumsum(in_a) - 1, np.cumsum(in_b) - 1
    step = len(both.forms) // 3
    for s, group, last, mark, other in ((a, group_a, last_a, 1, np.concatenate([[0], np.cumsum(in_b)])), (b, group_b, last_b, 2, np.cumsum(in_a))):
        kind = np.zeros(len(s.ids), np.int64)
        kind[last] = mark
        form[np.arange(len(s.ids)) + other[group]] = s.ids + kind * step
    ends = np.cumsum(a.counts + b.counts)
    keys, times = linked(a.ids, group_a, b.ids, group_b, doc_of_group, both.a.size, both.b.size)
    space = both.a.size * both.b.size
    bounds = np.searchsorted(keys, np.arange(len(docs) + 1) * space)
    pairs, times = (keys % space).astype(both.pair_type), times.astype("<u4" if times.max() < 1 << 32 else "<u8")
    for i, d in enumerate(docs.tolist()):
        out["groups"][d] = "".join([both.forms[k] for k in form[ends[i - 1] if i else 0 : ends[i]].tolist()])[:-1]
        out["pairs"][d] = pairs[bounds[i] : bounds[i + 1]].tobytes()
        out["times"][d] = times[bounds[i] : bounds[i + 1]].tobytes()
    return out


def token_groups(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Of every row of docs (doc_id, text) its groups and its different links: see TOKENS. Pairs are numbers A id * size of B + B id."""
    path_a, path_b = path_a or vocabulary_path(), path_b or vocabulary_path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, chunk, held = aligner(path_a, path_b), TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for part in pieces(batch, "text"):
                found = align_texts(both, [x or b"" for x in part.column("text").cast(pa.binary()).to_pylist()])
                own = pa.array(np.full(part.num_rows, chunk))
                columns = [pa.array(v, pa.string() if k == "groups" else pa.binary()) if isinstance(v, list) else pa.array(v) for k, v in found.items()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), own, *columns], ["doc_id", "chunk", *found])
                held += sum(map(len, found["pairs"])) // both.pair_type.itemsize
                if held >= CHUNK_LINKS:
                    chunk, held = chunk + 1, 0

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, TOKENS)


def pairs_of_chunks(tokens: DataFrame, pair_type: np.dtype) -> DataFrame:
    """(chunk, pair, n_docs): in how many documents of a chunk each of its pairs is linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held = None, []

        def counted() -> Iterator[pa.RecordBatch]:
            if held:
                pairs, n = np.unique(np.frombuffer(b"".join(held), pair_type), return_counts=True)
                if len(pairs):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), chunk)), pa.array(pairs.astype(np.int64)), pa.array(n.astype(np.int64))], ["chunk", "pair", "n_docs"])

        for batch in batches:
            for c, pairs in zip(batch.column("chunk").to_pylist(), batch.column("pairs").to_pylist()):
                if c != chunk or len(held) * 32 > CHUNK_LINKS:
                    yield from counted()
                    chunk, held = c, []
                held.append(pairs)
        yield from counted()

    parts = tokens.filter(F.octet_length("pairs") > 0).select("chunk", "pairs").mapInArrow(run, "chunk long, pair long, n_docs long")
    return parts.groupBy("chunk", "pair").agg(F.sum("n_docs").alias("n_docs"))


def links_by_count(tokens: DataFrame, size_b: int, pair_type: np.dtype) -> DataFrame:
    """doc_id, counts and groups of tokens, with n_best and count_sum: what its links' counts over the corpus come to."""
    counted = pairs_of_chunks(tokens, pair_type).select("chunk", "pair", F.sum("n_docs").over(W.partitionBy("pair")).alias("n"))
    counted = materialized(counted, "pair-counts")
    id_a = F.expr(f"pair div {size_b}")
    # As many rows as A has ids at most.
    best = F.broadcast(counted.groupBy(id_a.alias("a")).agg(F.max("n").alias("most")))
    counted = counted.join(best, id_a == F.col("a")).select("chunk", "pair", "n", (F.col("n") == F.col("most")).alias("best"))

    def run(key: tuple, own: pa.Table, pairs: pa.Table) -> pa.Table:
        if pairs.num_rows:
            order = np.argsort(pairs.column("pair").to_numpy(), kind="stable")
            known, n, top = (pairs.column(c).to_numpy()[order] for c in ("pair", "n", "best"))
        else:  # such a table has no columns
            known, n, top = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
        sums, best_sums = [], []
        for x, t, width in zip(own.column("pairs").to_pylist(), own.column("times").to_pylist(), own.column("width").to_pylist()):
            at = np.searchsorted(known, np.frombuffer(x, pair_type).astype(np.int64))
            times = np.frombuffer(t, f"<u{width}").astype(np.int64)
            sums.append(int((n[at] * times).sum()))
            best_sums.append(int(times[top[at]].sum()))
        return own.drop_columns(["chunk", "pairs", "times", "width"]).append_column("n_best", pa.array(best_sums, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))

    numbers = [c for c in tokens.columns if c not in ("chunk", "pairs", "times")]
    width = F.expr(f"case when octet_length(pairs) > 0 then cast(octet_length(times) * {pair_type.itemsize} div octet_length(pairs) as int) else 4 end")
    asked = tokens.select(*numbers, "chunk", "pairs", "times", width.alias("width"))
    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tokens.schema if f.name in numbers)
    return asked.groupBy("chunk").cogroup(counted.groupBy("chunk")).applyInArrow(run, f"{out}, n_best long, count_sum long")


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, groups: Column | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups, n_best and count_sum of every row of docs (doc_id, text).

    groups is what is kept of each text of groups (`a1,a2|b1;a3|b2,b3`), by default itself; it may be a digest.
    """
    path_a, path_b = path_a or vocabulary_path(), path_b or vocabulary_path("piece_bpe_32k.model")
    both = aligner(path_a, path_b)
    tokens = token_groups(docs, path_a, path_b)
    if groups is not None:
        tokens = tokens.withColumn("groups", groups)
    return links_by_count(materialized(tokens, "token-groups"), both.b.size, both.pair_type)

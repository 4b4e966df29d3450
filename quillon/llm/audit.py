"""Audit of filters that interact: what each filter removes, loses and repeats at every step of every order.

Failures of the filters, labels and parts of documents form a packed bitmap index, chunk by chunk: rows are sorted by part, each
part begins at a 64-bit word, and every filter and label is one bitset over all of them. For each set of filters applied
before, AND-NOT leaves the documents alive, AND with a filter those that it removes; counts of set bits are summed by part
within the chunk and then by Spark over the chunks. Orders only look up these sums, so their number never meets the data.

A filter on copies needs the corpus: a chunk sends each of its text digests once, with its least doc_id, so copies of one text
meet in as many rows as there are chunks; the least over all goes back to the chunks that hold copies.

Defined results: a null text is empty; a null source is the part of the empty string; a null doc_id has no labels, is no
smaller id and no copy of one; rows of equal least doc_id are no copies of each other; a document counts as good or toxic if
any row of labels with its id says so; each row of docs is a document; an empty table gives no row; the result has its own columns
only. Parts may be as many as rows: counts are of the parts that a chunk holds.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillon.llm.common import WORD, materialized, words_count

#: The filter that fails copies of a text with a smaller doc_id; it stands behind the filters on texts.
COPIES = "E"
#: Rows of a chunk at most.
CHUNK_ROWS = 1 << 18
COUNTS = ("alive", "removed", "good_lost", "toxic_lost")


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions on a text by the letters of their filters."""
    n_words = words_count(text)
    distinct = F.size(F.array_distinct(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {"A": n_words < 200, "B": 100 * distinct < 50 * n_words, "C": 100 * capitals > 2 * F.length(text), "D": text.rlike(r"[#$%&*|]")}


def facts(docs: DataFrame, labels: DataFrame, filters: dict[str, Column]) -> DataFrame:
    """(doc_id, part, fails as bits, digest, good, toxic) of every row of docs (doc_id, text, source)."""
    text = F.coalesce("text", F.lit(""))
    bits = sum((F.when(fail, F.lit(1 << i)).otherwise(F.lit(0)) for i, fail in enumerate(filters.values())), F.lit(0))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"), text.alias("text"))
    narrow = narrow.select("doc_id", "part", bits.alias("fails"), F.substring(F.unhex(F.sha2("text", 256)), 1, 16).alias("digest"))
    yes = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(yes("quality").alias("good"), yes("toxic").alias("toxic"))
    # Rows without an id have no labels; they stay out of the join, where they would meet in one task.
    joined = narrow.filter("doc_id is not null").join(known, "doc_id", "left")
    unnamed = narrow.filter("doc_id is null").withColumns({"good": F.lit(None).cast("boolean"), "toxic": F.lit(None).cast("boolean")})
    rows = joined.unionByName(unnamed)
    return rows.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})


def chunked(rows: DataFrame) -> DataFrame:
    """rows with the number of their chunk, written: chunks stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, seen = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            yield batch.append_column("chunk", pa.array(base + (seen + np.arange(batch.num_rows)) // CHUNK_ROWS))
            seen += batch.num_rows

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return materialized(rows.mapInArrow(run, f"{ddl}, chunk long"), "audit-facts")


def first_ids(rows: DataFrame) -> DataFrame:
    """(chunk, copied, first): digests of texts that several rows hold, and the least doc_id over all chunks."""
    own = rows.groupBy("chunk", "digest").agg(F.min("doc_id").alias("low"), F.count("*").alias("n"))
    same = W.partitionBy("digest")
    # A new name for digest: a column that both sides of a cogroup take from one table would be taken from one side only.
    return own.select("chunk", F.col("digest").alias("copied"), F.min("low").over(same).alias("first"), F.sum("n").over(same).alias("n")).filter("n > 1 and first is not null").drop("n")


def packed_bits(flags: np.ndarray, places: np.ndarray, words: int) -> np.ndarray:
    """Flags at these places of a bitset of 64-bit words."""
    bits = np.zeros(words * 64, bool)
    bits[places] = flags
    return np.packbits(bits, bitorder="little").view(np.uint64)


def prefix_counts(part: np.ndarray, fails: list[np.ndarray], good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
    """For each part (numbers from 0, all in use), set of filters before and filter: alive, removed, good_lost, toxic_lost."""
    order = np.argsort(part, kind="stable")
    sizes = np.bincount(part)
    words = -(-sizes // 64)
    starts = np.cumsum(words) - words
    places = np.empty(len(part), np.int64)
    places[order] = np.arange(len(part)) + np.repeat(starts * 64 - (np.cumsum(sizes) - sizes), sizes)
    total = int(words.sum())
    bitset = lambda flags: packed_bits(flags, places, total)
    counted = lambda bits: np.add.reduceat(np.bitwise_count(bits).astype(np.int64), starts)
    every, failing, good, toxic = bitset(np.ones(len(part), bool)), [bitset(f) for f in fails], bitset(good), bitset(toxic)
    rows = []
    for before in range(1 << len(fails)):
        alive = every.copy()
        for i, f in enumerate(failing):
            if before >> i & 1:
                alive &= ~f
        n_alive = counted(alive)
        for i, f in enumerate(failing):
            if not before >> i & 1:
                gone = alive & f
                rows.append((np.full(len(sizes), before), np.full(len(sizes), i), n_alive, counted(gone), counted(gone & good), counted(gone & toxic)))
    out = [np.concatenate(x) for x in zip(*rows)]
    return {"part": np.tile(np.arange(len(sizes)), len(rows))} | dict(zip(("before", "filter", *COUNTS), out))


def index_counts(rows: DataFrame, n_filters: int) -> DataFrame:
    """(part, before, filter) with COUNTS over all chunks; before is the set of filters applied, as bits."""

    def run(key: tuple, own: pa.Table, firsts: pa.Table) -> pa.Table:
        codes = own.column("part").combine_chunks().dictionary_encode()
        bits, ids = own.column("fails").to_numpy(), own.column("doc_id")
        if firsts.num_rows:
            first = pc.take(firsts.column("first"), pc.index_in(own.column("digest"), firsts.column("copied")))
            copies = pc.fill_null(pc.greater(ids, first), False).to_numpy()
        else:  # such a table has no columns
            copies = np.zeros(own.num_rows, bool)
        fails = [*(bits >> i & 1 == 1 for i in range(n_filters - 1)), copies]
        found = prefix_counts(codes.indices.to_numpy(), fails, own.column("good").to_numpy(), own.column("toxic").to_numpy())
        parts = codes.dictionary.take(pa.array(found.pop("part")))
        return pa.Table.from_arrays([parts, *(pa.array(x.astype(np.int64)) for x in found.values())], ["part", *found])

    sums = ", ".join(f"{c} long" for c in COUNTS)
    counts = rows.groupBy("chunk").cogroup(first_ids(rows).groupBy("chunk")).applyInArrow(run, f"part string, before long, filter long, {sums}")
    return counts.groupBy("part", "before", "filter").agg(*[F.sum(c).alias(c) for c in COUNTS])


def all_orders(letters: str) -> list[tuple[str, int, int, int]]:
    """(filter_order, step, filter, before) of each step of each order."""
    out = []
    for order in itertools.permutations(range(len(letters))):
        before = 0
        for step, i in enumerate(order, 1):
            out.append(("".join(letters[k] for k in order), step, i, before))
            before |= 1 << i
    return out


def audit_filters(docs: DataFrame, labels: DataFrame, filters: dict[str, Column] | None = None) -> DataFrame:
    """For each part, order of the filters and step: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley. filters are failure conditions on text (see text_filters), and the filter on copies comes to them."""
    filters = filters or text_filters(F.col("text"))
    letters, n = "".join(filters) + COPIES, len(filters) + 1
    sums = index_counts(chunked(facts(docs, labels, filters)), n)
    own = W.partitionBy("part", "filter")
    # In so many orders exactly the filters of a set come before one filter.
    ways = F.element_at(F.array(*[F.lit(factorial(k) * factorial(n - 1 - k)) for k in range(n)]), F.bit_count("before") + 1)
    over = lambda c: F.max(F.when(c, F.col("removed"))).over(own)
    sums = sums.withColumns({"fails": over(F.col("before") == 0), "unique_fails": over(F.bit_count("before") == n - 1), "shapley": F.sum(F.col("removed") * ways).over(own)})
    orders = F.broadcast(docs.sparkSession.createDataFrame(all_orders(letters), "filter_order string, step int, filter long, before long"))
    return sums.join(orders, ["filter", "before"]).select(
        "part", "filter_order", "step", (F.col("alive") - F.col("removed")).alias("kept"), "removed", (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", "shapley"
    )

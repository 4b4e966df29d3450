"""Exact top-k search by no-random-access aggregation.

Vectors become integers, floor(scale * x). Candidates lie in blocks of bounded size, queries in blocks of their own, and each
pair of blocks is one task's work; a candidate block's lists are sorted once for all queries of the pair. Per block every
dimension is a list sorted by value. A query reads each list whose weight is not 0 in sequence from the end that its sign favours,
and in every round as many entries again as before. What it reads goes into a lower bound of each candidate seen (what was
read, and the least value of each list that was not). Once the sum of the values at which the lists stand, the upper bound of
whatever no list has shown yet, is below the k-th best lower bound, no outsider can qualify; upper bounds of the candidates seen are then
taken, and reading stops when few of these reach the k-th best lower bound. Only those few get their final scores. The best k
of each block meet in one ranking for each query.

Bounds are floating-point numbers of values scaled to 1 with room for their rounding; final scores are exact integers of any size.

Defined results: rows with a null id, or whose vector is null, empty or holds null or non-finite components (or such that
scale * x is not finite), take no part; every other row is a candidate for all rows but itself, so a repeated row ranks for
its own copies and as often as it is there; each row of a query's id has a ranking of its own; components that one of two
vectors lacks count as 0; ties rank by smaller id; an empty table gives an empty result; the result has its own columns only.
`exact` is the score in decimal digits, of any size, `score` the same as a long, null where it does not fit one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Candidates and queries of one task's pair of blocks.
CANDIDATES, QUERIES = 4096, 16384
#: Entries of each list that the first round reads; all rounds so far are doubled by the next.
FIRST_DEPTH = 64
#: Candidates that a query may have left when their final scores are computed.
MOST_LEFT = 128
RESULT = "query_id long, tag_a long, tag_b long, times long, vec_id long, exact string, place string"
#: Room for rounding, as a share of the largest possible score.
SLACK = 1e-9
NINES = str.maketrans("0123456789", "9876543210")


def integers(vectors: pa.ChunkedArray, scale: float) -> np.ndarray:
    """(rows, dimensions) of floor(scale * x) as whole floating-point numbers; shorter vectors are filled up with 0."""
    rows = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(rows.offsets.to_numpy())
    flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(rows), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.floor(scale * flat)
    return out


def exact_integers(values: np.ndarray, fit: bool) -> np.ndarray:
    """Whole numbers as 64-bit integers, or as Python's where products would not fit."""
    return values.astype(np.int64) if fit else np.array([[int(x) for x in row] for row in values], object).reshape(values.shape)


def place_text(score: int) -> str:
    """A text whose order is that of the numbers: sign, number of digits, digits; below zero both are turned round."""
    digits = str(abs(score))
    if score >= 0:
        return f"1{len(digits):05d}{digits}"
    return f"0{99999 - len(digits):05d}{digits.translate(NINES)}"


class Block:
    """Candidates of one block with a sorted list for each dimension, read in sequence from either end."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, copies: np.ndarray):
        self.ids, self.values, self.copies = ids, values, copies
        self.n, self.reads = len(ids), 0  # entries read, by all queries
        self.largest = float(np.abs(values).max(initial=0)) or 1.0
        scaled = np.ascontiguousarray((values / self.largest).T)
        order = np.argsort(scaled, axis=1, kind="stable").astype(np.int32)
        ascending = np.take_along_axis(scaled, order, axis=1)
        # Side 0 begins with the least value, for negative weights; side 1 with the greatest.
        self.order = np.ascontiguousarray(np.stack([order, order[:, ::-1]]))
        self.sorted = np.ascontiguousarray(np.stack([ascending, ascending[:, ::-1]]))

    def left(self, query: np.ndarray, k: int, out_of_play: np.ndarray) -> np.ndarray:
        """The candidates of which each may be among the k best for this query (a superset of those), but for those out of play."""
        n = self.n
        weights = query / (np.abs(query).max(initial=0) or 1.0)
        dims = np.flatnonzero(weights)
        side, weights = (weights[dims] > 0).astype(np.int64), weights[dims, None]
        slack = SLACK * (1 + len(dims))
        worst = self.sorted[side, dims, -1:] * weights
        lower = np.full(n, float(worst.sum()))
        lower[out_of_play] = -np.inf
        places, values = [], []
        depth, step = 0, min(FIRST_DEPTH, n)
        while True:
            rows = self.order[side, dims, depth : depth + step].ravel()
            read = self.sorted[side, dims, depth : depth + step] * weights
            self.reads += read.size
            lower += np.bincount(rows, (read - worst).ravel(), n)
            places.append(rows)
            values.append(read)
            depth += step
            least = np.partition(lower, n - k)[n - k] if n > k else -np.inf
            if depth == n:
                return np.flatnonzero((lower >= least - 2 * slack) & ~out_of_play)
            front = read[:, -1:]
            outside = float(front.sum())
            if outside < least - 2 * slack:
                upper = np.bincount(np.concatenate(places), np.concatenate([(x - front).ravel() for x in values]), n) + outside
                found = (upper >= least - 2 * slack) & ~out_of_play
                if np.count_nonzero(found) <= MOST_LEFT:
                    return np.flatnonzero(found)
            step = min(depth, n - depth)

    def best(self, query: np.ndarray, k: int, own: np.ndarray) -> tuple[list[int], list[int]]:
        """Ids and exact scores of the k best candidates; own marks the query's own row, which counts once less."""
        fit = self.largest * float(np.abs(query).max(initial=0)) * max(1, len(query)) < 2.0**62
        rows = self.left(query, k, own & (self.copies == 1))
        scores = exact_integers(self.values[rows], fit) @ exact_integers(query[None], fit)[0]
        ids: list[int] = []
        out: list[int] = []
        for score, i, copies in sorted(zip((-scores).tolist(), self.ids[rows].tolist(), (self.copies[rows] - own[rows]).tolist())):
            more = min(copies, k - len(ids))
            ids += [i] * more
            out += [-score] * more
            if len(ids) == k:
                break
        return ids, out


def best_of_blocks(candidates: pa.Table, queries: pa.Table, scale: float, k: int) -> pa.Table:
    """The k best candidates of one block for each query of one block."""
    columns: list[list] = [[], [], [], [], [], [], []]
    if len(candidates) and len(queries):
        values, asked = integers(candidates.column("vector"), scale), integers(queries.column("vector"), scale)
        width = max(values.shape[1], asked.shape[1])
        values, asked = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (values, asked))
        of = lambda t: [t.column(c).to_numpy() for c in ("vec_id", "tag_a", "tag_b", "copies")]
        ids, tags_a, tags_b, copies = of(candidates)
        block = Block(ids, values, copies)
        for query, *key in zip(asked, *of(queries)):
            found, scores = block.best(query, k, (ids == key[0]) & (tags_a == key[1]) & (tags_b == key[2]))
            for column, x in zip(columns, key):
                column += [int(x)] * len(found)
            columns[4] += found
            columns[5] += map(str, scores)
            columns[6] += map(place_text, scores)
    return pa.table([*(pa.array(x, pa.int64()) for x in columns[:5]), *(pa.array(x, pa.string()) for x in columns[5:])], ["query_id", "tag_a", "tag_b", "times", "vec_id", "exact", "place"])


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: float = 256.0, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score and exact of the k best other rows for each row for which is_query (of column vec_id) holds."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * F.lit(scale)) < float("inf")) & (F.abs(x) < float("inf")))
    own = vectors.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{vector_column}`").cast("array<double>").alias("vector"))
    # Equal rows are one row with a number of copies; two vectors of one id are told apart by 128 bits of hash.
    own = own.filter("vec_id is not null and size(vector) > 0").filter(finite).groupBy("vec_id", "vector").agg(F.count("*").alias("copies"))
    own = own.withColumn("tag_a", F.xxhash64("vector", F.lit(1))).withColumn("tag_b", F.xxhash64("vector", F.lit(2)))
    n, n_queries = own.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    blocks, query_blocks = max(1, -(-n // CANDIDATES)), max(1, -(-n_queries // QUERIES))
    dealt = lambda df, name, of, seed, other, all_: df.withColumn(name, F.pmod(F.xxhash64("vec_id", "tag_a", F.lit(seed)), F.lit(of)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(all_ - 1))))
    candidates = dealt(own, "block", blocks, 1, "asked", query_blocks)
    queries = dealt(own.filter(is_query), "asked", query_blocks, 2, "block", blocks)
    found = candidates.groupBy("block", "asked").cogroup(queries.groupBy("block", "asked")).applyInArrow(lambda a, b: best_of_blocks(a, b, scale, k), RESULT)
    key = ("query_id", "tag_a", "tag_b")
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy(*key).orderBy(F.desc("place"), "vec_id"))).filter(F.col("rank") <= k)
    # Each copy of a query has the same ranking.
    ranked = ranked.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return ranked.select("query_id", "rank", "vec_id", F.expr("try_cast(exact as bigint)").alias("score"), "exact")

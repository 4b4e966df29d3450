"""Language identification by a byte convolutional network, trained in numpy and applied to fixed-length windows.

Texts are cut into windows of WINDOW bytes, the last one filled up with zero bytes. Bytes are embedded, filters of several
widths slide over a window, each filter's largest response is kept (max pooling), and a softmax layer maps these to languages. A
document's score is the softmax of its windows' mean log-probabilities, weighted by their bytes; every byte is read.

For inference the embedding is multiplied into the filters: a response is then the sum of two looked-up rows, one for each
pair of bytes (or one byte) under the filter.

Training sees a bounded sample: about PER_LANGUAGE documents of each language, SAMPLE_WINDOWS windows of each document at
seeded places. Larger corpora do not make it larger.

Defined results: a text that is null or has no letter is `und` with score 0; a corpus without labelled rows makes every text
`und`; repeated rows get equal results; an empty table gives an empty result; input columns named like a result column are
replaced. Only text is read for a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import pieces, texts_of, with_fields, without

WINDOW, WIDTHS, FILTERS, EMBEDDING = 256, (2, 3, 4), 12, 8
#: Bounds of the training sample: documents of a language, windows of a document, languages (the most frequent ones).
PER_LANGUAGE, SAMPLE_WINDOWS, MOST_LANGUAGES = 600, 4, 200
EPOCHS, BATCH, RATE, SEED = 6, 64, 0.01, 7
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
#: Windows that are convolved at a time.
SLICE = 128


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # (256, EMBEDDING)
    filters: list[np.ndarray]  # for each width (width * EMBEDDING, FILTERS)
    bias: np.ndarray  # (all filters,)
    out: np.ndarray  # (all filters, languages)
    out_bias: np.ndarray

    def lookups(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Rows for pairs of bytes that start a filter (all widths side by side), and of what lies behind the pair for each width."""
        each = [[self.embedding @ w[j * EMBEDDING : (j + 1) * EMBEDDING] for j in range(n)] for n, w in zip(WIDTHS, self.filters)]
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, -1).astype(np.float32)
        heads = np.concatenate([pair(x[0], x[1]) for x in each], axis=1)
        return np.ascontiguousarray(heads), [x[2].astype(np.float32) if n == 3 else pair(x[2], x[3]) if n == 4 else np.empty(0) for n, x in zip(WIDTHS, each)]


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = SEED, epochs: int = EPOCHS) -> Network:
    """A network fitted to windows (rows of WINDOW bytes) and the numbers of their languages, by Adam on the weighted cross-entropy."""
    rng = np.random.default_rng(seed)
    n_filters = FILTERS * len(WIDTHS)
    p = {"e": rng.normal(0, 0.5, (256, EMBEDDING)), "b": np.zeros(n_filters), "o": rng.normal(0, 0.1, (n_filters, len(languages))), "c": np.zeros(len(languages))}
    p |= {f"w{n}": rng.normal(0, 1 / np.sqrt(n * EMBEDDING), (n * EMBEDDING, FILTERS)) for n in WIDTHS}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    share = np.bincount(labels, minlength=len(languages)) / max(1, len(labels))
    weights = 1 / np.maximum(share, 1e-9) / len(languages)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            x, y = windows[rows], labels[rows]
            e = p["e"][x]
            pooled, where = [], []
            for n in WIDTHS:
                patches = np.concatenate([e[:, j : WINDOW - n + 1 + j] for j in range(n)], axis=2)
                response = patches @ p[f"w{n}"]
                best = response.argmax(axis=1)
                pooled.append(np.take_along_axis(response, best[:, None, :], axis=1)[:, 0])
                where.append(best)
            h = np.concatenate(pooled, axis=1) + p["b"]
            active = np.maximum(h, 0)
            logits = active @ p["o"] + p["c"]
            probability = np.exp(logits - logits.max(axis=1, keepdims=True))
            probability /= probability.sum(axis=1, keepdims=True)
            probability[np.arange(len(y)), y] -= 1
            d = (probability * (weights[y] / len(y))[:, None]).astype(np.float32)
            g = {"o": active.T @ d, "c": d.sum(axis=0), "e": np.zeros_like(p["e"])}
            dh = (d @ p["o"].T) * (h > 0)
            g["b"] = dh.sum(axis=0)
            for i, (n, best) in enumerate(zip(WIDTHS, where)):
                own = dh[:, i * FILTERS : (i + 1) * FILTERS]
                bytes_ = x[np.arange(len(y))[:, None, None], best[:, :, None] + np.arange(n)]  # the bytes under each filter's best place
                g[f"w{n}"] = np.einsum("bf,bfk->kf", own, p["e"][bytes_].reshape(len(y), FILTERS, -1))
                back = own[:, :, None] * p[f"w{n}"].T[None]
                np.add.at(g["e"], bytes_.ravel(), back.reshape(-1, EMBEDDING))
            step += 1
            for k in p:
                first[k] += 0.1 * (g[k] - first[k])
                second[k] += 0.001 * (g[k] ** 2 - second[k])
                p[k] -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Network(languages, p["e"], [p[f"w{n}"] for n in WIDTHS], p["b"], p["o"], p["c"])


def cut_windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts (rows of WINDOW bytes), their bytes that are text, and the number of windows of each text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = -(-sizes // WINDOW)
    flat = np.frombuffer(b"".join(x + bytes(-len(x) % WINDOW) for x in texts), np.uint8).reshape(-1, WINDOW)
    filled = np.full(len(flat), WINDOW)
    full = np.flatnonzero(counts)
    filled[np.cumsum(counts)[full] - 1] = sizes[full] - (counts[full] - 1) * WINDOW
    return flat, filled, counts


class Classifier:
    def __init__(self, network: Network):
        self.network = network
        self.heads, self.rests = network.lookups()

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        """(windows, languages)."""
        net, out = self.network, []
        for i in range(0, len(windows), SLICE):
            x = windows[i : i + SLICE].astype(np.int32)
            pairs = x[:, :-1] * 256 + x[:, 1:]
            head = self.heads[pairs]
            pooled = []
            for j, (n, rest) in enumerate(zip(WIDTHS, self.rests)):
                response = head[:, : WINDOW - n + 1, j * FILTERS : (j + 1) * FILTERS]
                if n > 2:
                    response = response + rest[x[:, 2:] if n == 3 else pairs[:, 2:]]
                pooled.append(response.max(axis=1))
            logits = np.maximum(np.concatenate(pooled, axis=1) + net.bias, 0) @ net.out + net.out_bias
            logits -= logits.max(axis=1, keepdims=True)
            out.append(logits - np.log(np.exp(logits).sum(axis=1, keepdims=True)))
        return np.concatenate(out) if out else np.empty((0, len(net.languages)), np.float32)

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        known = [bool(self.network.languages) and LETTER.search(x) is not None for x in texts]
        windows, filled, counts = cut_windows([x.encode("utf-8", "replace") if k else b"" for x, k in zip(texts, known)])
        languages, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        rows = np.flatnonzero(counts)
        if len(rows):
            sums = np.add.reduceat(self.log_probabilities(windows).astype(np.float64) * filled[:, None], (np.cumsum(counts) - counts)[rows], axis=0)
            mean = sums / np.add.reduceat(filled, (np.cumsum(counts) - counts)[rows])[:, None]
            probability = np.exp(mean - mean.max(axis=1, keepdims=True))
            probability /= probability.sum(axis=1, keepdims=True)
            for i, best, score in zip(rows.tolist(), probability.argmax(axis=1).tolist(), probability.max(axis=1).tolist()):
                languages[i], scores[i] = self.network.languages[best], min(1.0, score)
        return languages, scores


def held_out() -> Column:
    """Documents that training never sees: crc32 of the doc_id's text leaves 2 when divided by 4 (false for a null doc_id)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, seed: int = SEED) -> Network:
    """A network trained on the bounded sample of the labelled documents (doc_id, text, lang) that are not held out."""
    labelled = docs.filter("doc_id is not null and text is not null and lang is not null").filter(~held_out()).select("doc_id", "text", "lang")
    counts = sorted(labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect(), key=lambda r: r["lang"])
    languages = [r["lang"] for r in counts]
    if not languages:
        return Network([], np.zeros((256, EMBEDDING)), [np.zeros((n * EMBEDDING, FILTERS)) for n in WIDTHS], np.zeros(FILTERS * len(WIDTHS)), np.zeros((FILTERS * len(WIDTHS), 0)), np.zeros(0))
    # Rates follow the counts, so the sample has about as many documents of each language, whatever the corpus.
    rates = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, 1.2 * PER_LANGUAGE / r["count"]))])
    order = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / (1 << 30)
    span = F.greatest(F.octet_length("text") - WINDOW, F.lit(0)) + 1
    place = lambda k: (F.pmod(F.xxhash64("doc_id", F.lit(seed), F.lit(k)), span) + 1).cast("int")
    chosen = labelled.withColumn("_order", order).filter(F.col("_order") < F.try_element_at(rates, F.col("lang")))
    cuts = chosen.select("lang", "doc_id", "_order", F.array(*[F.substring(F.col("text").cast("binary"), place(k), F.lit(WINDOW)) for k in range(SAMPLE_WINDOWS)]).alias("cuts"))
    sample = cuts.orderBy("_order", "doc_id", "lang").limit(2 * PER_LANGUAGE * len(languages)).collect()
    number = {x: i for i, x in enumerate(languages)}
    pairs = sorted({(bytes(x), number[r["lang"]]) for r in sample for x in r["cuts"] if x})
    windows = np.frombuffer(b"".join(x.ljust(WINDOW, b"\0") for x, _ in pairs), np.uint8).reshape(-1, WINDOW)
    return train(windows, np.array([y for _, y in pairs]), languages, seed)


def identify(docs: DataFrame, network: Network) -> DataFrame:
    """docs with lang_pred and score."""
    docs = without(docs, "lang_pred", "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(network)
        for batch in batches:
            for part in pieces(batch, "text"):
                languages, scores = classifier.predict(texts_of(part))
                yield part.append_column("lang_pred", pa.array(languages, pa.string())).append_column("score", pa.array(scores, pa.float64()))

    return docs.mapInArrow(run, with_fields(docs, "lang_pred string, score double"))

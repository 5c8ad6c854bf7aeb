"""Quality classifier: a byte-level convolutional network in numpy.

A text's bytes are cut into overlapping chunks that cover all of it. Each byte
becomes a short learned vector, learned filters run over windows of bytes, and
each filter keeps its highest response in the chunk. The mean and the maximum of
these over all chunks go through one logistic unit: the probability that the
text is good. The network is fitted on the driver to a bounded sample of
labelled rows, and applied to whole texts on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.llm import common

CHUNK = 256      # bytes in a chunk
STEP = 224       # bytes from one chunk to the next
WINDOW = 8       # bytes a filter sees
STRIDE = 2       # bytes from one window to the next
WIDTH = 6        # numbers a byte becomes
FILTERS = 48

# The fitting sample: at most so many labelled rows, of at most so many bytes each.
TRAIN_ROWS = 3000
TRAIN_BYTES = 32_768

EPOCHS = 12
BATCH = 32
LEARNING_RATE = 0.01
SEED = 20

# Chunks whose windows are held at once.
SLAB = 128

# Held-out rows: crc32(doc_id as text) mod 5 = 0.
FOLDS, FOLD = 5, 0
ACCEPT = 0.3


@dataclass
class Network:
    bytes_: np.ndarray    # 256 x WIDTH
    filters: np.ndarray   # WINDOW * WIDTH x FILTERS
    bias: np.ndarray      # FILTERS
    out: np.ndarray       # 2 * FILTERS: of the mean, of the maximum
    out_bias: np.ndarray  # 1

    @staticmethod
    def new(rng: np.random.Generator) -> Network:
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        return Network(draw(256, WIDTH, scale=0.5), draw(WINDOW * WIDTH, FILTERS, scale=0.3),
                       np.zeros(FILTERS, np.float32), draw(2 * FILTERS, scale=0.1), np.zeros(1, np.float32))

    def arrays(self) -> list[np.ndarray]:
        return [self.bytes_, self.filters, self.bias, self.out, self.out_bias]


def chunks(text: bytes) -> np.ndarray:
    """The chunks of a text, the last filled up with zero bytes; an empty text is one chunk of zeros."""
    n = max(1, -(-(len(text) - (CHUNK - STEP)) // STEP))
    padded = np.zeros((n - 1) * STEP + CHUNK, np.uint8)
    padded[:len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STEP]


def _windows(slab: np.ndarray) -> np.ndarray:
    """Windows of bytes: chunks x positions x WINDOW."""
    return np.lib.stride_tricks.sliding_window_view(slab, WINDOW, axis=1)[:, ::STRIDE]


def _respond(net: Network, slab: np.ndarray) -> np.ndarray:
    """Responses of all filters at all positions: chunks x positions x FILTERS."""
    seen = net.bytes_[_windows(slab)]
    return seen.reshape(*seen.shape[:2], -1) @ net.filters


def _pooled(net: Network, all_chunks: np.ndarray) -> np.ndarray:
    parts = [_respond(net, all_chunks[k:k + SLAB]).max(axis=1) for k in range(0, len(all_chunks), SLAB)]
    return np.maximum(np.concatenate(parts) + net.bias, 0)


def score(net: Network, texts: list[bytes]) -> np.ndarray:
    """The probability of each text, in [0, 1]."""
    scores = np.empty(len(texts))
    for k in range(0, len(texts), 16):
        cut = [chunks(t) for t in texts[k:k + 16]]
        starts = np.cumsum([0, *map(len, cut)])[:-1]
        h = _pooled(net, np.concatenate(cut))
        mean = np.add.reduceat(h, starts) / np.array([len(c) for c in cut])[:, None]
        logit = np.hstack([mean, np.maximum.reduceat(h, starts)]) @ net.out + net.out_bias
        scores[k:k + 16] = 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -500, 500)))
    return scores


def fit(texts: list[bytes], labels: list[int], epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """A network fitted by Adam; the same rows in the same order give the same network."""
    rng = np.random.default_rng(seed)
    net = Network.new(rng)
    if not texts:
        return net
    y = np.asarray(labels, np.float32)
    cut = [chunks(t) for t in texts]
    moment = [(np.zeros_like(a), np.zeros_like(a)) for a in net.arrays()]
    step, steps = 0, epochs * -(-len(texts) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for k in range(0, len(order), BATCH):
            rows = order[k:k + BATCH]
            step += 1
            rate = LEARNING_RATE * (1 - (step - 1) / steps)
            for a, g, (m, v) in zip(net.arrays(), _gradients(net, [cut[i] for i in rows], y[rows]), moment):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                a -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return net


def _gradients(net: Network, cut: list[np.ndarray], y: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean log loss; only the windows that win the pooling count."""
    sizes = np.array([len(c) for c in cut])
    starts = np.cumsum([0, *sizes])[:-1]
    slabs = np.concatenate(cut)
    of = np.repeat(np.arange(len(cut)), sizes)
    best = np.empty((len(slabs), FILTERS), np.int64)
    top = np.empty((len(slabs), FILTERS), np.float32)
    for k in range(0, len(slabs), SLAB):
        r = _respond(net, slabs[k:k + SLAB])
        best[k:k + SLAB] = r.argmax(axis=1)
        top[k:k + SLAB] = r.max(axis=1)
    h = np.maximum(top + net.bias, 0)
    mean, most = np.add.reduceat(h, starts) / sizes[:, None], np.maximum.reduceat(h, starts)
    features = np.hstack([mean, most])
    p = 1 / (1 + np.exp(-np.clip(features @ net.out + net.out_bias, -50, 50)))
    d = ((p - y) / len(y)).astype(np.float32)
    first = np.zeros_like(h, dtype=bool)  # one chunk holds each maximum
    rank = np.where(h == most[of], np.arange(len(h))[:, None], len(h))
    lead = np.minimum.reduceat(rank, starts)
    first[lead, np.arange(FILTERS)[None, :]] = True
    dh = d[of, None] * (net.out[:FILTERS] / sizes[of, None] + np.where(first, net.out[FILTERS:], 0))
    dh = np.where(h > 0, dh, 0).astype(np.float32)
    won = _windows(slabs)[np.arange(len(slabs))[:, None], best]           # chunks x FILTERS x WINDOW
    seen = net.bytes_[won].reshape(len(slabs), FILTERS, -1)
    d_filters = np.einsum("cf,cfk->kf", dh, seen)
    back = (dh[:, :, None] * net.filters.T[None]).reshape(-1, WIDTH)
    d_bytes = np.stack([np.bincount(won.reshape(-1), back[:, w], 256) for w in range(WIDTH)], axis=1).astype(np.float32)
    return [d_bytes, d_filters, dh.sum(axis=0), features.T @ d, d.sum(keepdims=True)]


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[list[bytes], list[int]]:
    """The fitting sample: labelled rows outside the held-out fold, lowest hashes of the id first.

    At most ``rows`` rows come to the driver, each of at most ``TRAIN_BYTES``
    bytes; the labels are cut to that many before they meet the texts. Rows without a label
    are left out.
    """
    marked = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter(F.col("quality").isin(0, 1))
    marked = marked.filter(~common.held_out("doc_id", FOLDS, FOLD)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    some = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)  # bounded, so the join may broadcast it
    found = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").filter(
        F.coalesce(F.octet_length("text"), F.lit(0)) <= TRAIN_BYTES)
    sample = found.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(rows).collect()
    return [(r["text"] or "").encode() for r in sample], [r["quality"] for r in sample]


def scored(docs: DataFrame, net: Network, column: str = "score") -> DataFrame:
    """``docs`` with the probability of its text column; null counts as empty."""
    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(score(net, [(t or "").encode() for t in texts]))
    return docs.withColumn(column, probability(F.col("text")))


def classify(docs: DataFrame, labels: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """``docs`` with the columns held_out, score and predicted (1 if score >= ``accept``).

    The network learns from ``labels`` (doc_id, quality) outside the held-out
    fold and sees nothing of a row but its text. Null and empty texts are scored
    as a text without bytes; rows that repeat get equal scores. Without labelled
    rows the network is unfitted, but scores are defined. An empty table gives no
    rows. All columns of ``docs`` are kept unless their names are taken by the new ones.
    """
    net = fit(*training_rows(docs, labels))
    kept = docs.drop(*(c for c in docs.columns if c.lower() in ("held_out", "score", "predicted")))
    marked = scored(kept, net).withColumn("held_out", common.held_out("doc_id", FOLDS, FOLD))
    return marked.withColumn("predicted", (F.col("score") >= accept).cast("int"))

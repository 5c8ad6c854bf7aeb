"""Language identification by nearest centroids.

A text becomes a vector of hashed character n-grams (of one to three letters,
words kept apart), weighted by TF-IDF and scaled to length one. Each language has
several centroids, found by clustering a bounded sample of its texts, since one
language holds texts of unlike kinds. A text gets the language of the centroid
with the highest cosine; it is marked as rejected if that cosine is below what
nearly all of the language's own sample reaches. Document frequencies are counted
over all texts that may be learned from. Languages are sampled and clustered on the
executors, one group for each; the model, CENTROIDS vectors of 16 KB for each
language, is all that comes to the driver.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpath.llm import common
from clickpath.sources.tables import broadcast_if_small

DIMENSIONS = 4096
CENTROIDS = 3
ROUNDS = 12
SEED = 7

# The clustering sample: at most so many texts of each language.
SAMPLE_TEXTS = 300

# Largest table of sampled ids that is broadcast, in bytes of its stored files.
BROADCAST_BYTES = 16 << 20

# A text is rejected below this quantile of its language's own sample.
REJECT_QUANTILE = 0.002

# Held-out rows: crc32(doc_id as text) mod 4 = 2.
FOLDS, FOLD = 4, 2
UNKNOWN = "und"

# Characters of a text that are counted at once.
CHARS = 1 << 20

# Odd multipliers that spread n-grams over the dimensions.
SPREAD = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint64)


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """True at each code point of a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _add(found: np.ndarray, before: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Count the n-grams that end in ``new``, which follows the (at most two) letters ``before``; the last two of both."""
    c, t = np.concatenate([before, new]), len(before)
    one, c2, c3 = new[new != 0] * SPREAD[0], c[t - 1:], c[max(0, t - 2):]
    two = (c2[:-1] * SPREAD[1] + c2[1:] * SPREAD[0])[(c2[:-1] + c2[1:]) != 0]
    three = (c3[:-2] * SPREAD[2] + c3[1:-1] * SPREAD[1] + c3[2:] * SPREAD[0])[c3[1:-1] != 0]
    grams = np.concatenate([one, two + np.uint64(1), three + np.uint64(2)]) & np.uint64(0xFFFFFFFF)
    grams = (grams * SPREAD[1] >> np.uint64(17)) % np.uint64(DIMENSIONS)
    found += np.bincount(grams.astype(np.int64), minlength=DIMENSIONS)
    return c[-2:]


def counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams of a whole text; None if it has no letter.

    Letters and single gaps (0) form one sequence with a gap at both ends. It is read
    in stretches that carry the last two letters over, so every n-gram counts once.
    """
    text, found, lettered = (text or "").lower(), np.zeros(DIMENSIONS, np.int64), False
    before, after_letter = np.zeros(1, np.uint64), True
    for k in range(0, len(text), CHARS):
        points = np.frombuffer(text[k:k + CHARS].encode("utf-32-le", "surrogatepass"), "<u4")
        letter = _letters()[points]
        kept = letter | np.concatenate([[after_letter], letter[:-1]])
        before = _add(found, before, np.where(letter, points, 0)[kept].astype(np.uint64))
        after_letter, lettered = letter[-1], lettered or letter.any()
    if not lettered:
        return None
    _add(found, before, np.zeros(1, np.uint64))
    return found


@dataclass
class Centroids:
    idf: np.ndarray        # DIMENSIONS
    languages: list[str]   # of each centroid
    points: np.ndarray     # centroids x DIMENSIONS, of length one
    least: np.ndarray      # of each centroid: the cosine below which a text is rejected

    def vector(self, n: np.ndarray) -> np.ndarray:
        v = np.log1p(n) * self.idf
        return v / (np.sqrt((v * v).sum()) or 1)

    def nearest(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine and whether the text is rejected."""
        n = counts(text)
        if n is None or not self.languages:
            return UNKNOWN, 0.0, True
        near = self.points @ self.vector(n)
        k = int(near.argmax())
        return self.languages[k], float(min(1.0, max(0.0, near[k]))), bool(near[k] < self.least[k])


def _cluster(vectors: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Up to CENTROIDS unit vectors by spherical k-means."""
    k = min(CENTROIDS, len(vectors))
    points = vectors[rng.choice(len(vectors), k, replace=False)]
    for _ in range(ROUNDS):
        of = (vectors @ points.T).argmax(axis=1)
        sums = np.stack([vectors[of == j].sum(axis=0) if (of == j).any() else points[j] for j in range(k)])
        points = sums / np.maximum(np.sqrt((sums * sums).sum(axis=1, keepdims=True)), 1e-12)
    return points


def _sparse_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The n-gram counts of each text as a byte string of (dimension u2, count u4) arrays."""
    for batch in batches:
        langs, packed = [], []
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            n = counts(text)
            if n is not None:
                at = np.flatnonzero(n)
                langs.append(lang)
                packed.append(at.astype("<u2").tobytes() + n[at].astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(packed, pa.binary())], names=["lang", "packed"])


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of the partition each dimension occurs; dimension -1 counts the texts."""
    df, texts = np.zeros(DIMENSIONS, np.int64), 0
    for batch in batches:
        for text in batch.column("text").to_pylist():
            n = counts(text)
            if n is not None:
                df += n > 0
                texts += 1
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array([-1, *at.tolist()], pa.int32()), pa.array([texts, *df[at].tolist()], pa.int64())], names=["dim", "n"])


def _sample(rows: DataFrame) -> DataFrame:
    """At most SAMPLE_TEXTS rows (lang, text) of each language, drawn by a hash of doc_id.

    Ranking sees ids only, and each task keeps no more than the sample of a language, so a
    language of most rows is no hot group. Rows that share an id are ranked again by their text.
    """
    draw = F.xxhash64("doc_id").alias("draw")
    ranked = Window.partitionBy("lang").orderBy("draw", "doc_id")
    ids = rows.select("lang", "doc_id", draw).withColumn("k", F.row_number().over(ranked)).filter(F.col("k") <= SAMPLE_TEXTS)
    ids = common.materialise(ids.select(F.col("lang").alias("l"), F.col("doc_id").alias("d")), "language-sample")
    texts = rows.join(broadcast_if_small(ids, BROADCAST_BYTES), (F.col("lang") == F.col("l")) & F.col("doc_id").eqNullSafe(F.col("d")), "left_semi")
    ranked = Window.partitionBy("lang").orderBy("h", "doc_id")
    return texts.withColumn("h", F.xxhash64("text")).withColumn("k", F.row_number().over(ranked)).filter(
        F.col("k") <= SAMPLE_TEXTS).select("lang", "text")


def _clustered(model: Centroids):
    """The centroids of one language, and the cosine below which a text is rejected."""
    def run(found: pd.DataFrame) -> pd.DataFrame:
        vectors = []
        for packed in sorted(map(bytes, found["packed"])):
            m, n = len(packed) // 6, np.zeros(DIMENSIONS)
            n[np.frombuffer(packed, "<u2", m)] = np.frombuffer(packed, "<u4", m, 2 * m)
            vectors.append(model.vector(n))
        lang, vectors = found["lang"].iloc[0], np.stack(vectors)
        own = _cluster(vectors, np.random.default_rng([SEED, zlib.crc32(lang.encode())]))
        least = np.quantile((vectors @ own.T).max(axis=1), REJECT_QUANTILE)
        return pd.DataFrame({"lang": lang, "k": range(len(own)), "least": least, "point": [p.astype("<f4").tobytes() for p in own]})
    return run


def fit(docs: DataFrame) -> Centroids:
    """Centroids from the rows outside the held-out fold that have a lang.

    Document frequencies cover all such rows, the clustering a sample of SAMPLE_TEXTS rows
    of each language, of however many languages. Texts without a letter teach nothing.
    """
    rows = docs.filter(F.col("lang").isNotNull() & ~common.held_out("doc_id", FOLDS, FOLD)).select("doc_id", "lang", "text")
    df = {r["dim"]: r["n"] for r in rows.select("text").mapInArrow(_document_counts, "dim int, n long")
          .groupBy("dim").agg(F.sum("n").alias("n")).collect()}  # at most DIMENSIONS + 1 rows
    idf = np.log((1 + df.get(-1, 0)) / (1 + np.array([df.get(d, 0) for d in range(DIMENSIONS)]))) + 1
    model = Centroids(idf, [], np.zeros((0, DIMENSIONS)), np.zeros(0))
    vectors = _sample(rows).mapInArrow(_sparse_counts, "lang string, packed binary")
    found = vectors.groupBy("lang").applyInPandas(_clustered(model), "lang string, k int, least double, point binary").collect()
    found = sorted(found, key=lambda r: (r["lang"], r["k"]))
    model.languages = [r["lang"] for r in found]
    if found:
        model.points = np.stack([np.frombuffer(bytes(r["point"]), "<f4") for r in found])
        model.least = np.array([r["least"] for r in found])
    model.idf = idf.astype(np.float32)
    return model


def identify(docs: DataFrame, model: Centroids, reject: bool = False) -> DataFrame:
    """``docs`` with the columns held_out, lang_pred, score (the cosine) and rejected.

    Only the text is looked at. A null text, or one without a letter, is ``und``
    with score 0 and rejected. With ``reject``, rejected texts are ``und`` too;
    otherwise lang_pred is the nearest language all the same. Rows that repeat get
    equal results; an empty table gives no rows; a model without languages calls
    all ``und``. Columns of ``docs`` with the new names are replaced.
    """
    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([model.nearest(t) for t in texts], columns=["lang_pred", "score", "rejected"])
    new = ("held_out", "lang_pred", "score", "rejected")
    kept = docs.drop(*(c for c in docs.columns if c.lower() in new))
    at = common.fresh(kept, "guess")
    found = kept.withColumn(at, guess(F.col("text"))).withColumn("held_out", common.held_out("doc_id", FOLDS, FOLD))
    pred = F.when(F.col(at)["rejected"], UNKNOWN).otherwise(F.col(at)["lang_pred"]) if reject else F.col(at)["lang_pred"]
    return found.select(*kept.columns, "held_out", pred.alias("lang_pred"), F.col(at)["score"].alias("score"), F.col(at)["rejected"].alias("rejected"))

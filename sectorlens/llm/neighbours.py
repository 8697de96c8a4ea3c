"""Quality by nearest-neighbour voting in a latent-semantic space.

Features are hashed character n-grams (case and punctuation kept) and a few
buckets that tell how repetitive, capitalised and littered a text is, weighted by
TF-IDF with document frequencies from all documents. A truncated singular value
decomposition of at most ``SAMPLE_PER_LABEL`` labelled rows per label gives the
latent space; their vectors are what is broadcast (bounded by 2 x SAMPLE_PER_LABEL x
DIMENSIONS). Every document is compared with all of them, a block of documents at a
time; the ``NEIGHBOURS`` nearest vote with their cosine, and each label's votes
are weighted by how many rows one sampled row stands for.

Labels are learnt from folds 0 and 2 only. A null text is empty; a text without any
feature, or one that resembles no neighbour, gets the share of label 1. Repeated labels
of one document count once (the larger). Without labels the score is 0.5. An
empty table gives an empty result; null ids are kept; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sectorlens.llm.common import fold, held_out
from sectorlens.llm.features import code_points, document_counts, gram_counts, inverse_frequency, per_text, tf_idf

BITS, DIMENSIONS, NEIGHBOURS = 12, 48, 15
SAMPLE_PER_LABEL = 1500
_STYLE = 32  # places for the style buckets, after the n-grams
_SIZE = (1 << BITS) + 4 * _STYLE


@dataclass
class Voters:
    idf: np.ndarray
    axes: np.ndarray  # features x dimensions
    vectors: np.ndarray  # voters x dimensions, unit length
    labels: np.ndarray
    weights: np.ndarray  # rows each voter stands for
    share: float


def text_counts(text: str) -> np.ndarray:
    """n-gram counts, and one place in each of four rows of buckets."""
    out = np.zeros(_SIZE, np.int64)
    codes = code_points(text)
    if not codes.size:
        return out
    grams = gram_counts(codes, BITS)
    out[: 1 << BITS] = grams
    n = len(codes)
    upper = ((codes >= 65) & (codes <= 90)).sum() / n
    marks = ((codes < 127) & (codes > 32) & ~((codes >= 65) & (codes <= 90)) & ~((codes >= 97) & (codes <= 122))).sum() / n
    words = text.split()
    repeats = sum(a == b for a, b in zip(words, words[1:])) / max(1, len(words))
    spread = len(set(words)) / max(1, len(words))
    for i, x in enumerate((upper, marks, repeats, 1 - spread)):
        # alike texts share this bucket, so it weighs as much as a frequent n-gram
        out[(1 << BITS) + i * _STYLE + min(_STYLE - 1, int(np.sqrt(x) * _STYLE))] = n
    return out


def truncated_svd(rows: np.ndarray, k: int, rounds: int = 4) -> np.ndarray:
    """Right singular vectors (features x k) by subspace iteration from a fixed start."""
    k = min(k, *rows.shape)
    q = np.random.default_rng(5).standard_normal((rows.shape[1], min(k + 8, rows.shape[1]))).astype(np.float32)
    for _ in range(rounds):
        q = np.linalg.qr(rows.T @ (rows @ q))[0]
    _, _, v = np.linalg.svd(rows @ q, full_matrices=False)
    return (q @ v.T[:, :k]).astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norm > 0, norm, 1)


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality") -> Voters | None:
    marked = labels.filter(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 1))
    marked = marked.groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))
    sizes = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    rows, frequency = document_counts(docs.select("text"), text_counts, _SIZE)
    idf = inverse_frequency(rows, frequency)
    # ids are unique here, so a threshold on their hash leaves about three times the sample, whatever the table's size
    top, hashed = (1 << 63) - 1, F.shiftrightunsigned(F.xxhash64(F.lit(31), "doc_id"), 1)
    drawn = [
        marked.filter((F.col("label") == label) & (hashed <= min(top, 3 * SAMPLE_PER_LABEL * top // n)))
        .withColumn("nth", hashed).orderBy("nth", "doc_id").limit(SAMPLE_PER_LABEL)
        for label, n in sorted(sizes.items())
    ]
    chosen = reduce(DataFrame.unionByName, drawn)
    # 2 x SAMPLE_PER_LABEL ids at most
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").filter(F.col("text").isNotNull())
    tie = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text")))
    found = found.withColumn("tie", tie).filter("tie = 1")

    def vectors(texts):
        got = [tf_idf(text_counts(t), idf) for t in texts]
        at = [np.flatnonzero(v).astype(np.int32) for v in got]
        return [pa.array(at, pa.list_(pa.int32())), pa.array([v[i] for v, i in zip(got, at)], pa.list_(pa.float32()))]

    kept = [F.col("label"), F.col("nth")]
    sample = per_text(found, kept, vectors, "label int, nth long, at array<int>, value array<float>", ["at", "value"]).toPandas()
    if not len(sample):
        return None
    sample = sample.sort_values(["label", "nth"], ignore_index=True)
    dense = np.zeros((len(sample), _SIZE), np.float32)
    for i, (a, v) in enumerate(zip(sample["at"], sample["value"])):
        dense[i, np.asarray(a, int)] = v
    axes = truncated_svd(dense, DIMENSIONS)
    marks = sample["label"].to_numpy()
    present = {k: int((marks == k).sum()) for k in sizes}
    weights = np.array([sizes[k] / present[k] for k in marks], np.float32)
    share = sizes.get(1, 0) / sum(sizes.values())
    return Voters(idf, axes, _unit(dense @ axes).astype(np.float32), marks.astype(np.float32), weights, share)


def votes(vectors: np.ndarray, voters: Voters) -> np.ndarray:
    """Share of label 1 among the votes of each row's nearest voters."""
    cosine = vectors @ voters.vectors.T
    k = min(NEIGHBOURS, cosine.shape[1])
    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    strength = np.maximum(np.take_along_axis(cosine, near, 1), 0) * voters.weights[near]
    total = strength.sum(axis=1)
    one = (strength * voters.labels[near]).sum(axis=1)
    return np.where(total > 0, one / np.where(total > 0, total, 1), voters.share)


def score_quality(docs: DataFrame, labels: DataFrame, column: str = "quality") -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    voters = fit(docs, labels, column)

    def score(texts):
        if voters is None:
            return [pa.array(np.full(len(texts), 0.5)), pa.array(np.ones(len(texts), np.int32))]
        rows = np.stack([tf_idf(text_counts(t or ""), voters.idf) for t in texts])
        found = np.clip(votes(_unit(rows @ voters.axes).astype(np.float32), voters).astype(float), 0.0, 1.0)
        return [pa.array(found), pa.array((found >= 0.5).astype(np.int32))]

    kept = [F.col("doc_id").cast("long").alias("doc_id"), held_out()]
    return per_text(docs, kept, score, "doc_id long, held_out boolean, score double, predicted int", ["score", "predicted"])

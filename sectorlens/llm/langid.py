"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed 1- to 3-grams of the whole text's letters (case folded, all else
one space). Document frequencies come from all rows that may be learnt from; the
weights from a sample of at most ``SAMPLE_PER_CLASS`` of them per language and ``SAMPLE_ROWS`` together. The sample
is drawn by a hash of id and text, and each language's smallest hash is always in it, so no language
with a learnable row is without one, whatever its ids are. Training is
follow-the-regularised-leader with an L1 and an L2 penalty; a fifth of the sample is kept
for the temperature that calibrates the probabilities.

Language, source and id are never inputs of a prediction. A text that is null or has no
letter is ``und`` with score 0. With nothing to learn from, every text is ``und``.
An empty table gives an empty result; null ids are kept; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sectorlens.llm.common import fold, held_out
from sectorlens.llm.features import document_counts, folded, gram_counts, inverse_frequency, per_text, tf_idf

BITS = 13
#: Rows that the weights are learnt from: so many of a language, so many together, but one of each language at least.
SAMPLE_PER_CLASS, SAMPLE_ROWS = 600, 12_000
#: Weights are learnt for so many languages, the most frequent ones; each takes a column of 2**BITS weights.
MOST_CLASSES = 2000
UNKNOWN = "und"


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features x languages
    bias: np.ndarray
    temperature: float


def text_counts(text: str) -> np.ndarray:
    return gram_counts(folded(text), BITS)


def ftrl(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, size: int, alpha: float = 0.3,
    beta: float = 1.0, l1: float = 0.02, l2: float = 0.05, epochs: int = 3,
) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with elastic net: weights (size x classes, exact zeros where |z| <= l1) and biases."""
    z, n = np.zeros((size + 1, classes)), np.zeros((size + 1, classes))

    def solved(at):
        return np.where(np.abs(z[at]) <= l1, 0.0, -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    order = np.random.default_rng(11)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, value = np.append(rows[i][0], size), np.append(rows[i][1], 1.0)
            w = solved(at)
            p = softmax(value @ w)
            p[labels[i]] -= 1
            g = value[:, None] * p
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    w = solved(np.arange(size + 1))
    return w[:-1], w[-1]


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the smallest log loss, from 1/20 to 20."""
    if not len(labels):
        return 1.0
    steps = np.geomspace(0.05, 20, 121)
    loss = [-np.log(softmax(logits / t)[np.arange(len(labels)), labels] + 1e-12).mean() for t in steps]
    return float(steps[int(np.argmin(loss))])


def fit(docs: DataFrame) -> LanguageModel | None:
    """Learns from rows whose id falls in fold 0 or 2 and whose language and text are given."""
    given = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != 1))
    # a number of 63 bits; rows equal in id and text are drawn together
    at = F.shiftrightunsigned(F.xxhash64(F.lit(29), "doc_id", "text"), 1)
    given = given.withColumn("at", at)
    sizes = given.groupBy("lang").agg(F.count("*").alias("n"), F.min("at").alias("first")).orderBy(F.desc("n"), "lang").limit(MOST_CLASSES).collect()
    if not sizes:
        return None
    rows, frequency = document_counts(given.select("text"), text_counts, 1 << BITS)
    idf = inverse_frequency(rows, frequency)
    per = max(1, min(SAMPLE_PER_CLASS, SAMPLE_ROWS // len(sizes)))
    top = (1 << 63) - 1
    limits = [(r["lang"], max(r["first"], min(top, 3 * per * top // r["n"]))) for r in sizes]
    # one row a language, MOST_CLASSES at most
    bounds = docs.sparkSession.createDataFrame(limits, "lang string, most long")
    thin = given.join(F.broadcast(bounds), "lang").filter(F.col("at") <= F.col("most"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("at", "doc_id", F.xxhash64("text")))
    sample = thin.withColumn("nth", nth).filter(F.col("nth") <= per)

    def vectors(texts):
        found = [tf_idf(text_counts(t), idf) for t in texts]
        at = [np.flatnonzero(v).astype(np.int32) for v in found]
        return [pa.array(at, pa.list_(pa.int32())), pa.array([v[i] for v, i in zip(found, at)], pa.list_(pa.float32()))]

    schema = "lang string, nth int, at array<int>, value array<float>"
    rows = per_text(sample, [F.col("lang"), F.col("nth")], vectors, schema, ["at", "value"]).toPandas()
    rows = rows.sort_values(["lang", "nth"], ignore_index=True)
    languages = sorted(r["lang"] for r in sizes)
    labels = rows["lang"].map({k: i for i, k in enumerate(languages)}).to_numpy()
    kept = (rows["nth"] % 5 == 0).to_numpy()
    sparse = [(np.asarray(a, np.int64), np.asarray(v, float)) for a, v in zip(rows["at"], rows["value"])]
    weights, bias = ftrl([sparse[i] for i in np.flatnonzero(~kept)], labels[~kept], len(languages), 1 << BITS)
    logits = np.array([sparse[i][1] @ weights[sparse[i][0]] + bias for i in np.flatnonzero(kept)])
    temperature = fit_temperature(logits.reshape(-1, len(languages)), labels[kept])
    return LanguageModel(languages, idf, weights.astype(np.float32), bias.astype(np.float32), temperature)


def predict(docs: DataFrame, model: LanguageModel | None, kept: list | None = None, types: str = "doc_id long, held_out boolean") -> DataFrame:
    """``kept`` columns (doc_id and held_out) with lang_pred and score."""
    kept = kept or [F.col("doc_id").cast("long").alias("doc_id"), held_out()]

    def score(texts):
        best, sure = [UNKNOWN] * len(texts), np.zeros(len(texts))
        rows, at = [], []
        for i, text in enumerate(texts if model else []):
            codes = folded(text or "")
            if (codes != 32).any():
                rows.append(tf_idf(gram_counts(codes, BITS), model.idf))
                at.append(i)
        if rows:
            p = softmax((np.stack(rows) @ model.weights + model.bias).astype(float) / model.temperature)
            for i, k, s in zip(at, p.argmax(axis=1), p.max(axis=1)):
                best[i], sure[i] = model.languages[k], s
        return [pa.array(best, pa.string()), pa.array(sure, pa.float64())]

    return per_text(docs, kept, score, f"{types}, lang_pred string, score double", ["lang_pred", "score"])


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    return predict(docs, fit(docs))


def accepted(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """``docs`` whose language was recognised with a probability of ``least`` or more."""
    kept, types = [F.col(f"`{c}`") for c in docs.columns], ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    wrapped = docs.select("text", F.struct(*kept).alias("row"))
    row_type = f"row struct<{', '.join(f'`{f.name}`:{f.dataType.simpleString()}' for f in docs.schema)}>"
    scored = predict(wrapped, fit(docs), [F.col("row")], row_type)
    return scored.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("row.*")

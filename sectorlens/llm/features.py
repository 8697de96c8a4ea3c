"""Hashed character n-gram counts of whole texts, and their use in every row of a table."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sectorlens.llm.common import text_slices

SPACE = 32
_MIX = np.array([2654435761, 2246822519, 3266489917], np.uint32)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point its lower-case letter, or a space if it is no letter."""
    table = np.full(sys.maxunicode + 1, SPACE, np.uint32)
    for i in range(sys.maxunicode + 1):
        c = chr(i)
        if c.isalpha():
            table[i] = ord(c.lower()[0])
    return table


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def folded(text: str) -> np.ndarray:
    """Lower-case letters of ``text``; everything else becomes one space between them."""
    codes = _letters()[code_points(text)]
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != SPACE) | (codes[:-1] != SPACE)
    return codes[keep]


def gram_counts(codes: np.ndarray, bits: int, orders: int = 3) -> np.ndarray:
    """How often each hashed n-gram of 1 to ``orders`` code points occurs, in 2**bits places."""
    shift = np.uint32(32 - bits)
    hashes, h = [], codes.astype(np.uint32)
    for order in range(orders):
        if order:
            h = h[:-1] * _MIX[1] + codes[order:].astype(np.uint32)
        if not h.size:
            break
        hashes.append((h * _MIX[0] ^ (h >> np.uint32(15)) * _MIX[2]) >> shift)
    if not hashes:
        return np.zeros(1 << bits, np.int64)
    return np.bincount(np.concatenate(hashes), minlength=1 << bits)


def document_counts(texts: DataFrame, counts: Callable[[str], np.ndarray], size: int) -> tuple[int, np.ndarray]:
    """Number of rows of ``texts`` (one text column), and in how many of them each feature occurs.

    Each task adds up its rows; the driver gets one sum per feature, ``size`` at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(size, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen += counts(text or "") > 0
                rows += 1
        hit = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(hit, -1)), pa.array(np.append(seen[hit], rows))], ["feature", "n"]
        )

    summed = texts.mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    frequency, rows = np.zeros(size, np.int64), 0
    for feature, n in summed:
        if feature < 0:
            rows = n
        else:
            frequency[feature] = n
    return rows, frequency


def inverse_frequency(rows: int, frequency: np.ndarray) -> np.ndarray:
    return np.log((1 + rows) / (1 + frequency)).astype(np.float32) + np.float32(1)


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Logarithmic counts times inverse frequency, at unit length (zero stays zero)."""
    vector = np.log1p(counts, dtype=np.float32) * idf
    norm = np.sqrt(vector @ vector)
    return vector / norm if norm else vector


def per_text(docs: DataFrame, kept: list, score: Callable[[list[str | None]], list[pa.Array]], schema: str, names: list[str]) -> DataFrame:
    """The columns ``kept`` and what ``score`` finds for each text; ``schema`` describes all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, column=0, most=1024 * 1024):
            found = score(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *found], [*batch.schema.names[1:], *names])

    return docs.select(F.col("text"), *kept).mapInArrow(run, schema)

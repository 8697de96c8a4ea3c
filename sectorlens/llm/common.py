"""What several operators share: tables, hashing of ids, word-level memory of an encoder."""

from __future__ import annotations

from collections.abc import Callable
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but a space and the controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text() -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col("text"), F.lit(""))


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; rows of fold 1 are never learnt from. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3


def held_out() -> Column:
    return (fold(F.col("doc_id")) == 1).alias("held_out")


class WordMemory:
    """Serialized ids (of numpy type ``kind``) of words an encoder has met in this task.

    ``encode`` turns a list of words into a list of ``bytes``. Memory is bounded:
    beyond ``most`` words, new ones are encoded but not kept.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], kind: str, most: int = 600_000):
        self.encode, self.kind, self.most, self.known = encode, np.dtype(kind), most, {"": b""}

    def look_up(self, texts: list[str]) -> list[bytes]:
        """For each text the joined ids of what its spaces separate; each distinct word is looked up once."""
        if not texts:
            return []
        words = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        coded = words.values.dictionary_encode()
        distinct, at = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        known = self.known
        ids = list(map(known.get, distinct))
        missing = [i for i, found in enumerate(ids) if found is None]
        if missing:
            new = [distinct[i] for i in missing]
            fresh = self.encode(new)
            for i, found in zip(missing, fresh):
                ids[i] = found
            known.update(islice(zip(new, fresh), max(0, self.most - len(known))))
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // self.kind.itemsize
        every = np.frombuffer(b"".join(ids), self.kind)
        start = np.cumsum(size) - size
        per_word = size[at]
        ends = np.concatenate([[0], np.cumsum(per_word)])
        places = np.repeat((start[at] - ends[:-1]).astype(np.int32), per_word)
        places += np.arange(ends[-1], dtype=np.int32)
        laid = every[places]
        cuts = ends[words.offsets.to_numpy()]
        return [laid[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]


def text_slices(batches, column: int = 1, most: int = 4 * 1024 * 1024):
    """Arrow batches cut into runs of rows whose texts are about ``most`` bytes together."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        piece = (np.cumsum(sizes) - sizes) // most
        cuts = np.flatnonzero(np.diff(piece)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield batch.slice(a, b - a)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node each of ``n`` nodes is connected to."""
    label = np.arange(n)
    while a.size:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        label = label[label]
        if np.array_equal(label, before):
            break
    return label

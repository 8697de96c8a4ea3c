"""Words of whole texts as Arrow lists and numpy arrays, for operators that compare stretches of words.

A word is a run of anything but a space and the controls from tab to carriage return, unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def split(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Where each text's words start (and the last one's end), and all words one after the other; null has none."""
    trimmed = pc.ascii_trim_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    lists = pc.ascii_split_whitespace(trimmed)
    # a text without words is split into one empty word
    sizes = np.diff(lists.offsets.to_numpy()) * (pc.binary_length(trimmed).to_numpy(zero_copy_only=False) > 0)
    words = lists.flatten()
    if len(words) != sizes.sum():
        words = words.filter(pc.greater(pc.binary_length(words), 0))
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), words


def joined(words: pa.Array, starts: np.ndarray, kept: np.ndarray) -> pa.Array:
    """The ``kept`` words of each text, joined by one space."""
    counts = np.concatenate([[0], np.cumsum(kept)])[starts]
    if not kept.all():
        words = words.filter(pa.array(kept))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(counts, pa.int32()), words), pa.scalar(" ", words.type))


def codes(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A number for each word, equal for equal words, and the distinct words."""
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def word_hashes(words: pa.Array) -> np.ndarray:
    """Two independent 64-bit hashes of each word (2 rows)."""
    at, distinct = codes(words)
    found = b"".join(map(xxhash.xxh3_128_digest, distinct.cast(pa.large_binary()).to_pylist()))
    return np.frombuffer(found, np.uint64).reshape(-1, 2).T[:, at]


def rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` hashes from each place on; the last places have no such window."""
    n = len(hashes)
    if n < size:
        return np.empty(0, np.uint64)
    up, down = np.full(n, _BASE), np.full(n - size + 1, _BACK)
    up[0] = down[0] = 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * np.multiply.accumulate(up), out=sums[1:])
    return (sums[size:] - sums[: n - size + 1]) * np.multiply.accumulate(down)


def covered(n: int, begins: np.ndarray, size: int) -> np.ndarray:
    """Which of ``n`` places lie within ``size`` places from one of ``begins`` on."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, begins, 1)
    np.add.at(change, np.minimum(np.asarray(begins) + size, n), -1)
    return np.cumsum(change[:n]) > 0

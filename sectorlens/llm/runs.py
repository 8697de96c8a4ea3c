"""Periodic runs of words by descending-LCP Kruskal.

A run is a stretch of words with smallest period q that is at least ``least`` = 24 words and ``power`` = 3
periods long and that no neighbouring word extends. A run that starts at s makes the suffixes from s
and from s + q agree in (length - q) words. So every class of suffixes starts as one
position; neighbours in suffix order are united by decreasing common prefix (LCP), the smaller
ordered position set into the larger. Two positions that become neighbours in a united set,
at a distance d of at most LCP / (power - 1), have d words repeated power times; the one
without an equal word before it begins a run of d + LCP words. Between s and s + q
no position of their class can lie, so each run is found; a multiple of its period is found only while
classes of one LCP are united, at the same stretch, where the smallest period stays.

Classes of fewer common words than any run needs (16) are never united. A document in which no 16
words occur twice has no such class; this is tested by hash before suffixes are sorted.
Documents are independent rows: nothing is shuffled. Suffixes are ordered by doubling,
whose levels also give the LCP exactly; one text's levels are held in memory.

A null text has no words and no runs. Rows of equal id are rows of their own. An empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sectorlens.llm import wordlists
from sectorlens.llm.common import text_slices, whole_text

LEAST, POWER = 24, 3
RUNS = "array<struct<start:long,length:long,period:long>>"


def least_common(least: int, power: int) -> int:
    """The smallest number of words that two neighbouring repeats of a run have in common."""
    return min(max((power - 1) * q, least - q) for q in range(1, least + 1))


def suffix_levels(codes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order, and ranks of the first 1, 2, 4, ... words from each place (one more entry: -1)."""
    n = len(codes)
    _, rank = np.unique(codes, return_inverse=True)
    levels, step = [], 1
    order = np.argsort(rank, kind="stable")
    while True:
        levels.append(np.append(rank, -1))
        if step >= n or rank.max() == n - 1:
            return order, levels
        key = rank.astype(np.int64) * (n + 1)
        key[:-step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        new = np.diff(key[order], prepend=-1) != 0
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        step *= 2


def common_prefix(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that the suffixes from ``a`` and ``b`` (unequal) have in common."""
    a, b = a.copy(), b.copy()
    length = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = np.where(levels[k][a] == levels[k][b], 1 << k, 0)
        a, b, length = a + same, b + same, length + same
    return length


def _united(small: list[int], large: list[int]) -> Iterator[tuple[int, int]]:
    """Puts ``small`` into ``large``, both ordered; neighbours that come from both."""
    at = [bisect_left(large, x) for x in small]
    for i, (x, k) in enumerate(zip(small, at)):
        if k and (i == 0 or at[i - 1] != k):
            yield large[k - 1], x
        if k < len(large) and (i + 1 == len(small) or at[i + 1] != k):
            yield x, large[k]
    for x, k in zip(reversed(small), reversed(at)):
        large.insert(k, x)


def word_runs(codes: np.ndarray, least: int = LEAST, power: int = POWER) -> list[tuple[int, int, int]]:
    """(start, length, period) of each run of one document, by start and period."""
    if len(codes) < least:
        return []
    order, levels = suffix_levels(codes)
    lcp = common_prefix(levels, order[:-1], order[1:])
    links = np.flatnonzero(lcp >= least_common(least, power))
    links = links[np.argsort(-lcp[links], kind="stable")]
    above = list(range(len(order)))  # union-find over places in suffix order
    sets: dict[int, list[int]] = {}

    def top(i: int) -> int:
        while above[i] != i:
            above[i] = above[above[i]]
            i = above[i]
        return i

    found: dict[tuple[int, int], int] = {}
    values, places = codes.tolist(), order.tolist()
    for link, common in zip(links.tolist(), lcp[links].tolist()):
        a, b = top(link), top(link + 1)
        small, large = sets.pop(a, None) or [places[a]], sets.pop(b, None) or [places[b]]
        if len(small) > len(large):
            a, b, small, large = b, a, large, small
        for x, y in list(_united(small, large)):
            period = y - x
            if (power - 1) * period <= common and period + common >= least:
                if x == 0 or values[x - 1] != values[y - 1]:
                    stretch = (x, period + common)
                    found[stretch] = min(period, found.get(stretch, period))
        above[a] = b
        sets[b] = large
    return sorted((start, length, period) for (start, length), period in found.items())


def _repetitive(starts: np.ndarray, codes: np.ndarray, size: int) -> np.ndarray:
    """Numbers of the texts in which ``size`` words in a row occur twice (by hash: perhaps some more)."""
    if len(codes) < size:
        return np.empty(0, np.int64)
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    inside = text[: len(codes) - size + 1] == text[size - 1 :]
    owner = text[: len(inside)][inside]
    key = wordlists.rolling(mixed, size)[inside] + owner.astype(np.uint64) * np.uint64(0x94D049BB133111EB)
    order = np.argsort(key)
    same = (key[order][1:] == key[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    return np.unique(owner[order][1:][same])


def periodic_runs(docs: DataFrame, least: int = LEAST, power: int = POWER) -> DataFrame:
    """doc_id, runs (by start, then period) and collapsed: the text with one period of each run, words joined by one space."""
    common = least_common(least, power)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, column=0):
            starts, words = wordlists.split(batch.column(0))
            codes, _ = wordlists.codes(words)
            kept = np.ones(len(codes), bool)
            runs: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for i in _repetitive(starts, codes, common).tolist():
                own = word_runs(codes[starts[i] : starts[i + 1]], least, power)
                runs[i] = [{"start": s, "length": n, "period": q} for s, n, q in own]
                for s, n, q in own:
                    kept[starts[i] + s + q : starts[i] + s + n] = False
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(runs, kind), wordlists.joined(words, starts, kept).cast(pa.string())], ["doc_id", "runs", "collapsed"]
            )

    given = docs.select(whole_text().alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    return given.mapInArrow(run, f"doc_id long, runs {RUNS}, collapsed string")

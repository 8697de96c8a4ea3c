"""SimHash near-dedup by a segment-popcount embedding.

A fingerprint's 64 bits are 32 segments of two; their bit counts are its place in
a grid. The Manhattan distance of two places is at most the Hamming distance of
the fingerprints. Each group of segments whose counts differ adds at least one to it, so
fingerprints within ``most`` bits agree in all but ``most`` of any number of groups:
each distinct fingerprint goes into one cell for every choice of that many groups (their
counts make the cell). More groups make more cells and far fewer meetings in each, so their number
is chosen from the number of fingerprints (``groups_for``). Inside a cell, fingerprints are sorted
by their whole bit count, which again differs by no more than the distance: those
in range are compared by the Manhattan distance of their counts, and those that pass it exactly. A cell with more than ``CELL_ROWS`` rows is cut
into chunks, and every two chunks meet in a block of their own.

No pairs leave a task: it emits a spanning forest of the links it found. Forests
are joined by alternating large-star and small-star rounds, with checkpoints.
Equal fingerprints are one row throughout. Null and empty texts have fingerprint
zero and are linked like any other; null ids keep their rows and never name a
component unless it has no other id (then component_id is null). An empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sectorlens.llm.common import forest, text_slices
from sectorlens.operators.lookup import lookup_join
from sectorlens.session import pinned

CELL_ROWS = 2048
SEGMENTS = 32
_ODD = 0x5555555555555555


def groups_for(rows: int, most: int) -> int:
    """The number of groups with the least work: one row a cell, and the pairs that random fingerprints make in cells.

    Two groups at least make a cell: one alone is too coarse for texts that are alike. Two random segments of two
    bits have equal counts three times in eight. Real ones are more alike, so a pair counts as a fiftieth of a row.
    """

    def work(groups: int) -> float:
        cells = comb(groups, most)
        return rows * cells + rows * rows / 100 * cells * (3 / 8) ** (SEGMENTS * (groups - most) / groups)

    return min(range(most + 2, min(most + 8, SEGMENTS + 1)), key=work)


def _counts(fp: np.ndarray) -> np.ndarray:
    """The segments' counts in unary (0, 01, 11): two places differ by as many bits as their Manhattan distance."""
    odd = np.uint64(_ODD)
    return (((fp & (fp >> np.uint64(1))) & odd) << np.uint64(1)) | ((fp | (fp >> np.uint64(1))) & odd)


def fingerprint(data: bytes, words: int = 4, seed: int = 42) -> int:
    """Majority bits of the XXH64 hashes of all word shingles, as an unsigned number."""
    found = data.lower().split()  # bytes: A-Z alone become lower case, and white space is that of the contract
    if not found:
        return 0
    text = b" ".join(found)
    ends = [n + i for i, n in enumerate(accumulate(map(len, found)))]
    starts = [0, *[e + 1 for e in ends[:-1]]]
    digest = xxhash.xxh64_intdigest
    if len(found) > words:
        hashes = [digest(text[a:b], seed) for a, b in zip(starts, ends[words - 1 :])]
    else:
        hashes = [digest(text, seed)]
    n = len(hashes)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 65_536):
        bits = np.array(hashes[i : i + 65_536], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, keys: list[Column], words: int = 4, seed: int = 42) -> DataFrame:
    """``keys`` (one long each, named) and ``fp``, the fingerprint's bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, column=0):
            prints = [fingerprint(x or b"", words, seed) for x in batch.column(0).to_pylist()]
            fp = pa.array(np.array(prints, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], fp], [*batch.schema.names[1:], "fp"])

    given = docs.select(F.col("text").cast("binary").alias("text"), *keys)
    names = [f"{n} long" for n in given.columns[1:]]
    return given.mapInArrow(run, ", ".join([*names, "fp long"]))


def _cells(prints: DataFrame, most: int, groups: int) -> DataFrame:
    """cell, fp and the fingerprint's bit count; a row for each choice of ``groups`` less ``most`` groups.

    A cell's number is a hash of the choice and its counts; where two cells share one, more is compared, nothing is missed.
    """
    odd = F.lit(_ODD)
    above = F.shiftrightunsigned("fp", 1)
    both, any_ = F.col("fp").bitwiseAND(above).bitwiseAND(odd), F.col("fp").bitwiseOR(above).bitwiseAND(odd)
    with_counts = prints.select("fp", F.shiftleft(both, 1).bitwiseOR(any_).alias("counts"))
    ends = [SEGMENTS * i // groups for i in range(groups + 1)]
    # shifted up first, so that what stands above a group falls off
    parts = [
        F.shiftrightunsigned(F.shiftleft("counts", 64 - 2 * high), 64 - 2 * (high - low))
        for low, high in zip(ends, ends[1:])
    ]
    grouped = with_counts.select("fp", *[part.alias(f"g{i}") for i, part in enumerate(parts)])
    cells = [
        F.xxhash64(F.lit(k), *[f"g{i}" for i in chosen])
        for k, chosen in enumerate(combinations(range(groups), groups - most))
    ]
    return grouped.select("fp", F.bit_count("fp").cast("int").alias("ones"), F.explode(F.array(*cells)).alias("cell"))


def _blocks(cells: DataFrame, cell_rows: int) -> DataFrame:
    """Adds ``block``: 0 in an ordinary cell, one number for every two chunks of a large one."""
    large = cells.groupBy("cell").agg(F.count("*").alias("rows")).filter(F.col("rows") > cell_rows)
    large = pinned(large.select(F.col("cell").alias("cell_"), F.ceil(F.col("rows") / cell_rows).alias("chunks")))
    marked = lookup_join(cells, large, cells.cell == large.cell_, "left")
    chunk = F.pmod(F.xxhash64(F.lit(3), "fp"), F.col("chunks"))
    low, high = F.least(F.col("other"), chunk), F.greatest(F.col("other"), chunk)
    others = F.when(F.col("chunks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
        F.expr("sequence(0L, coalesce(chunks, 1L) - 1)")
    )
    spread = marked.withColumn("other", F.explode(others))
    block = F.when(F.col("chunks").isNull(), F.lit(0)).otherwise(low * F.col("chunks") + high)
    return spread.select("cell", block.cast("long").alias("block"), "ones", "fp")


def _linked(key: np.ndarray, ones: np.ndarray, fp: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links among rows sorted by cell and bit count."""
    found_a, found_b, held = [], [], 0
    n, counts = len(fp), _counts(fp)
    at, step = np.arange(max(0, n - 1)), 1
    while at.size:
        to = at + step
        near = (key[at] == key[to]) & (ones[to] - ones[at] <= most)
        at, to = at[near], to[near]
        close = np.bitwise_count(counts[at] ^ counts[to]) <= most
        here, there = at[close], to[close]
        hit = np.bitwise_count(fp[here] ^ fp[there]) <= most
        found_a.append(here[hit])
        found_b.append(there[hit])
        held += int(hit.sum())
        if held > 2_000_000:  # no more than a forest is kept of what was found so far
            label = forest(n, np.concatenate(found_a), np.concatenate(found_b))
            kept = np.flatnonzero(label != np.arange(n))
            found_a, found_b, held = [kept], [label[kept]], 0
        step += 1
        at = at[at + step < n]
    if not found_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    label = forest(n, np.concatenate(found_a), np.concatenate(found_b))
    kept = np.flatnonzero(label != np.arange(n))
    return fp[kept], fp[label[kept]]


def links(prints: DataFrame, most: int = 4, cell_rows: int = CELL_ROWS, groups: int | None = None) -> DataFrame:
    """a, b: links among distinct fingerprints (column ``fp``) that connect all within ``most`` bits."""
    groups = groups or groups_for(prints.count(), most)
    if not most < groups <= SEGMENTS:
        raise ValueError(f"{most} bits need more than {most} groups and at most {SEGMENTS}")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rest = None

        def solve(rows: np.ndarray) -> pa.RecordBatch:
            new = np.ones(len(rows), bool)
            new[1:] = (np.diff(rows[:, 0]) != 0) | (np.diff(rows[:, 1]) != 0)
            a, b = _linked(np.cumsum(new), rows[:, 2], rows[:, 3].view(np.uint64), most)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], 1)
            rows = rows if rest is None else np.concatenate([rest, rows])
            if not len(rows):
                continue
            last = (rows[:, :2] == rows[-1, :2]).all(1)  # this cell may go on in the next batch
            whole = int(np.flatnonzero(~last)[-1]) + 1 if (~last).any() else 0
            rest = rows[whole:]
            if whole:
                yield solve(np.ascontiguousarray(rows[:whole]))
        if rest is not None and len(rest):
            yield solve(np.ascontiguousarray(rest))

    blocks = _blocks(_cells(prints, most, groups), cell_rows)
    sorted_ = blocks.repartition("cell", "block").sortWithinPartitions("cell", "block", "ones", "fp")
    return sorted_.mapInArrow(compare, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node reached) for every node of ``edges`` (a, b)."""
    now = pinned(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = pinned(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = pinned(large.unionByName(low.filter("a <> low").select("a", F.col("low").alias("b"))).distinct())
        least = pinned(large.groupBy("a").agg(F.min("b").alias("low")))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = small.unionByName(least.select("a", F.col("low").alias("b"))).filter("a <> b").distinct()
        now = pinned(small)
        was, mark = mark, now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if was == mark:
            return now.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")


def near_classes(prints: DataFrame, most: int = 4, cell_rows: int = CELL_ROWS) -> DataFrame:
    """fp, root, component_id for every distinct fingerprint of ``prints`` (doc_id, fp); a root is a component."""
    ids = pinned(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(ids.select("fp"), most, cell_rows))
    rooted = ids.join(roots, ids.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    rooted = pinned(rooted)
    lowest = pinned(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")))
    return rooted.join(lowest, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, words: int = 4, most: int = 4) -> DataFrame:
    """doc_id, fp, component_id: one row per document."""
    prints = pinned(with_fingerprint(docs, [F.col("doc_id").cast("long").alias("doc_id")], words))
    classes = pinned(near_classes(prints, most))
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, words: int = 4, most: int = 4) -> DataFrame:
    """``docs`` without near duplicates: the row with the smallest id of each component stays.

    Among rows of equal id the one with the smaller text hash stays, of wholly equal rows one.
    """
    id_, mark = F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.lit(5), "text").alias("mark")
    prints = pinned(with_fingerprint(docs, [id_, mark], words))
    classes = pinned(near_classes(prints, most))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id_"), "mark")
    # rows that are equal in id and text are counted, so that only these need to be told apart
    counted = prints.groupBy("fp", order.alias("row")).agg(F.count("*").alias("times"))
    first = F.min(F.struct("row", "times")).alias("first")
    keep = pinned(counted.join(classes, "fp").groupBy("root").agg(first).select("first.row.*", "first.times"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    whole = docs.select(F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id_"), mark, row)
    key = ["no_id", "id_", "mark"]
    single = lookup_join(whole, keep.filter("times = 1").select(*key), key, "left_semi")
    equal = lookup_join(whole, keep.filter("times > 1").select(*key), key, "left_semi").dropDuplicates(key)
    return single.unionByName(equal).select("row.*")

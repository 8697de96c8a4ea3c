"""Spelling variants: words one letter apart, found through a dictionary of trie-node pairs.

The nodes of two tries, of the words and of the words read backwards, are numbered. A
word with the letter at place i skipped is the pair (node of the letters before i, node of the letters after i);
a word cut at i is the pair (node before, node from i on). Two words of one length are one
replacement apart if they share a skipped pair, and a word is another one less a letter if its
cut pair is the other's skipped pair. Integer pairs are equal just if the strings are, so nothing needs
to be verified. A letter that repeats the one before it gives the same shorter word as that one does and
is left out for deletions, so each near pair is met exactly once and near words can be counted by addition.

The words of one pair differ in one letter: a group has at most one word more than the alphabet
has letters (90 for Latin letters with accents), however often the words occur.

Tries are numbered in sorted order, in which a node is new where a word leaves its
predecessor's path. Words are range-partitioned and sorted; each range is scanned on its own, and the
path of the last word before a range (one for each of at most ``MOST_RANGES`` ranges) is carried into it.
Numbers follow the order of the words, so a smaller number is a smaller word.

Words have to be distinct and not null; ``word_counts`` makes them so. A word without near words has
no form and is its own root. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sectorlens.operators.lookup import lookup_join
from sectorlens.session import pinned

LEAST_LETTERS, LEAST_COUNT, RATIO = 7, 2, 10
RANGE_ROWS = 200_000
#: One path a range is carried through the driver; more words make larger ranges instead of more.
MOST_RANGES = 8192


def word_counts(words: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n of the words (column ``word``, null is none) of enough letters that occur often enough."""
    long_enough = words.select("word").filter(F.char_length("word") >= least_letters)
    return long_enough.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


class _Path:
    """Local numbers of the nodes on the newest word's path, root excluded."""

    def __init__(self) -> None:
        self.word, self.nodes, self.made = "", [], 0

    def go(self, word: str) -> list[int]:
        held = _common(self.word, word)
        new = len(word) - held
        self.nodes = self.nodes[:held] + list(range(self.made, self.made + new))
        self.word, self.made = word, self.made + new
        return self.nodes


def _carried(ends: list[dict]) -> dict[int, tuple[list[int], int]]:
    """For each range the numbers of the nodes its first word shares with words before, and the first new number."""
    out: dict[int, tuple[list[int], int]] = {}
    word, path, free = "", [], 1
    for end in sorted(ends, key=lambda e: e["part"]):
        shared = _common(word, end["first"])
        carry = path[:shared]
        out[end["part"]] = (carry, free - shared)
        path = [carry[x] if x < shared else free - shared + x for x in end["path"]]
        word, free = end["last"], free + end["made"] - shared
    return out


def numbered(words: DataFrame, key: Column, name: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``words`` with ``name``, the trie nodes of ``key`` from the root (0) to its end, as array of longs."""
    ranges = max(1, min(MOST_RANGES, math.ceil(words.count() / range_rows)))
    kept = [f.name for f in words.schema]
    dealt = words.withColumn("key_", key).repartitionByRange(ranges, "key_").sortWithinPartitions("key_")
    laid = pinned(dealt.withColumn("part_", F.spark_partition_id()))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, first, part = _Path(), None, None
        for batch in batches:
            for word in batch.column(0).to_pylist():
                first = word if first is None else first
                path.go(word)
            part = batch.column(1)[0].as_py() if batch.num_rows else part
        if first is not None:
            row = {"part": part, "first": first, "last": path.word, "made": path.made, "path": path.nodes}
            yield pa.RecordBatch.from_pylist([row], pa.schema([("part", pa.int32()), ("first", pa.string()), ("last", pa.string()), ("made", pa.int64()), ("path", pa.list_(pa.int64()))]))

    found = laid.select("key_", "part_").mapInArrow(ends, "part int, first string, last string, made long, path array<long>")
    carried = _carried([r.asDict() for r in found.collect()])  # one row a range

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = _Path()
        for batch in batches:
            if not batch.num_rows:
                continue
            carry, offset = carried[batch.column(1)[0].as_py()]
            shared = len(carry)
            nodes = [[0, *[carry[x] if x < shared else offset + x for x in path.go(word)]] for word in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(nodes, pa.list_(pa.int64()))], [*kept, name])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in words.schema)
    return laid.select("key_", "part_", *kept).mapInArrow(number, f"{types}, `{name}` array<long>")


def node_pairs(words: DataFrame) -> DataFrame:
    """before, after (nodes), whole, fresh, id, n: a row for each place a word can be cut or a letter skipped.

    ``words`` has word, n, forward and backward nodes. ``fresh``: the skipped letter differs from the one before.
    """
    length = F.size("letters")
    skip = F.transform(
        F.sequence(F.lit(0), length - 1),
        lambda i: F.struct(
            F.get("forward", i).alias("before"), F.get("backward", length - 1 - i).alias("after"), F.lit(False).alias("whole"),
            ((i == 0) | (F.get("letters", i) != F.get("letters", i - 1))).alias("fresh"),
        ),
    )
    cut = F.transform(
        F.sequence(F.lit(0), length),
        lambda i: F.struct(F.get("forward", i).alias("before"), F.get("backward", length - i).alias("after"), F.lit(True).alias("whole"), F.lit(False).alias("fresh")),
    )
    given = words.select("id", "n", "forward", "backward", F.split("word", "").alias("letters"))
    return given.select("id", "n", F.explode(F.concat(skip, cut)).alias("pair")).select("pair.*", "id", "n")


def near_words(pairs: DataFrame) -> DataFrame:
    """id, n_near and the most frequent near word (best_n, best_id; ties: the smaller) of each word that has near words."""
    member = F.struct("whole", "fresh", "id", "n").alias("member")
    groups = pairs.groupBy("before", "after").agg(F.collect_list(member).alias("members")).filter(F.size("members") > 1)
    each = groups.select("members", F.explode("members").alias("me"))
    me = F.col("me")
    replaced = lambda m: ~me["whole"] & ~m["whole"] & (m["id"] != me["id"])
    shorter = lambda m: me["fresh"] & m["whole"]
    longer = lambda m: me["whole"] & m["fresh"]
    near = F.filter("members", lambda m: replaced(m) | shorter(m) | longer(m))
    each = each.select(F.col("me.id").alias("id"), near.alias("near")).filter(F.size("near") > 0)
    best = F.array_max(F.transform("near", lambda m: F.struct(m["n"].alias("n"), (-m["id"]).alias("back"))))
    each = each.select("id", F.size("near").cast("long").alias("n_near"), best.alias("best"))
    found = each.groupBy("id").agg(F.sum("n_near").alias("n_near"), F.max("best").alias("best"))
    return found.select("id", "n_near", F.col("best.n").alias("best_n"), (-F.col("best.back")).alias("best_id"))


def roots(links: DataFrame) -> DataFrame:
    """id, root: where following ``links`` (id, form_id; without cycles) ends. Each round doubles the step."""
    now = pinned(links.select("id", F.col("form_id").alias("root")))
    while True:
        step = now.select(F.col("id").alias("root"), F.col("root").alias("further"))
        moved = pinned(lookup_join(now, step, "root", "left").select("id", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        now = moved.select("id", "root")
        if moved.filter("moved").isEmpty():
            return now


def variants(words: DataFrame, ratio: int = RATIO, range_rows: int = RANGE_ROWS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``words`` (word, n).

    The form is the most frequent near word, if ``ratio`` times as frequent as the word; forms
    grow in frequency, so following them ends.
    """
    given = pinned(words.select("word", F.col("n").cast("long").alias("n")))
    forward = numbered(given, F.col("word"), "forward", range_rows).withColumn("id", F.element_at("forward", -1))
    both = pinned(numbered(forward, F.reverse("word"), "backward", range_rows))
    near = near_words(node_pairs(both))
    close = F.col("best_n") >= ratio * F.col("n")
    known = both.select("id", "word", "n").join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(close, F.col("best_id")).alias("form_id"), F.when(close, F.col("best_n")).alias("form_n"),
    )
    known = pinned(known)
    ends = roots(known.filter("form_id IS NOT NULL").select("id", "form_id"))
    names = known.select("id", "word")
    rooted = known.join(ends, "id", "left")
    rooted = lookup_join(rooted, names.select(F.col("id").alias("form_id"), F.col("word").alias("form")), "form_id", "left")
    rooted = lookup_join(rooted, names.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root", "left")
    return rooted.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")

"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a key that is random but fixed (md5 of seed and id). Within a
source, documents are put in key order: a range partition on the leading hex
digits (the key is uniform, so ranges are even), a sort inside each range, sums
per range, and a prefix sum over both levels. A source whose budget is larger
than itself is repeated in whole epochs; the rest of the budget is cut at its
exact word.

Nulls: a null text has size 0, a null source is a source of its own (ordered
last), a null id counts as the text "null". Rows alike in source, id and size are
counted first and laid out one after another, so that a crowd of equal ids is one
row until the end. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sectorlens.llm.common import WORD
from sectorlens.operators.lookup import lookup_join
from sectorlens.session import pinned

#: Rows that one range of one source should hold at most.
RANGE_ROWS = 4096


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def mixing_key(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """One row per source: its size and its target.

    Weights repeat over the sources in code point order, null last. The target is
    weight times one common rate, or ``cap`` times the source's size where that is
    less; the rate is the one that makes all targets add up to all words. It is
    found by going through the sources in the order in which they reach their cap.
    One row per source is all that the windows without partition see.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1))
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("weight", weight.cast("double"))
    fill = Window.orderBy(F.col("source_size") * cap / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0))
    rated = totals.withColumn("rate", left / F.sum("weight").over(onward)).withColumn("place", F.row_number().over(fill))
    fits = F.col("rate") <= F.col("source_size") * cap / F.col("weight")
    rate = F.min_by("rate", F.when(fits, F.col("place"))).over(whole)
    limit = (F.col("source_size") * cap).cast("double")
    return rated.select("source", "source_size", F.least(F.col("weight") * rate, limit).alias("target"))


def _in_order(sizes: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """Groups of alike rows with the words of their source before them, and the source's budget."""
    rows = sizes.agg(F.count("*")).first()[0]
    digits = max(0, math.ceil(math.log(max(1, rows / RANGE_ROWS), 16)))
    alike = (
        sizes.groupBy("source", "doc_id", "size")
        .agg(F.count("*").alias("copies"))
        .withColumn("key", mixing_key(F.col("doc_id"), seed))
        .withColumn("range", F.substring("key", 1, digits))
    )
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size")
    words = F.col("size") * F.col("copies")
    placed = alike.withColumn(
        "inside", F.coalesce(F.sum(words).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    ranges = alike.groupBy("source", "range").agg(F.sum(words).alias("words"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        F.col("source").alias("source_"),
        F.col("range").alias("range_"),
        F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"),
    )
    same = placed.source.eqNullSafe(offsets.source_) & (placed.range == offsets.range_)
    placed = placed.join(offsets, same).drop("source_", "range_")
    budget = targets.withColumnRenamed("source", "source_")
    budget = budget.withColumn("budget", F.floor("target")).withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0)).cast("long")
    )
    placed = lookup_join(placed, budget, placed.source.eqNullSafe(budget.source_)).drop("source_")
    return placed.withColumn("before", F.col("offset") + F.col("inside")).withColumn(
        "rest", F.col("budget") - F.col("epochs") * F.col("source_size")
    )


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, seed: int = 17) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words, repeats counted): one row per document."""
    sizes = pinned(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    targets = pinned(source_targets(sizes, weights, cap))
    laid = _in_order(sizes, targets, seed).withColumn("nth", F.explode(F.expr("sequence(0L, copies - 1)")))
    part = F.col("rest") - F.col("before") - F.col("nth") * F.col("size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), part))
    return laid.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + part).alias("taken")
    )


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, seed: int = 17) -> DataFrame:
    """The mixed documents themselves: a document taken k times is k equal rows.

    The document in which the budget ends is taken once more if at least half of it
    lies within; rows equal in source, id and size are treated alike there. Texts are
    not moved: one row per source says how far its key order is taken.
    """
    size = word_count(F.col("text"))
    sizes = pinned(docs.select("doc_id", "source", size.alias("size")))
    targets = pinned(source_targets(sizes, weights, cap))
    inside = F.col("rest") >= F.col("before") + F.expr("(size * copies + 1) div 2")
    place = F.struct("key", F.coalesce(F.col("doc_id"), F.lit(-1)).alias("id"), "size")
    cuts = _in_order(sizes, targets, seed).groupBy("source").agg(
        F.first("epochs").alias("epochs_"), F.max(F.when(inside & (F.col("rest") > 0), place)).alias("last_")
    )
    cuts = pinned(cuts.withColumnRenamed("source", "source_"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    here = F.struct(
        mixing_key(F.col("doc_id"), seed).alias("key"), F.coalesce(F.col("doc_id"), F.lit(-1)).alias("id"), size.alias("size")
    )
    given = docs.select(row, F.col("source").alias("from"), here.alias("here"))
    more = F.when(F.col("last_").isNotNull() & (F.col("here") <= F.col("last_")), 1).otherwise(0)
    taken = lookup_join(given, cuts, F.col("from").eqNullSafe(F.col("source_")))
    taken = taken.withColumn("times", (F.col("epochs_") + more).cast("int")).filter("times > 0")
    return taken.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")

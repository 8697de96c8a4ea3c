"""Document fingerprints from closed syncmers with their positions, with DataFrame functions only.

A text is the sequence of its words (a word longer than 16 characters counts as several). A
k-mer of words is an anchor if the smallest hash among its inner substrings of one word lies at one
of its edges: this depends on the k-mer alone, so equal passages have equal anchors wherever they
stand. There is one scheme for all lengths: k-mers of one word, each of which is an anchor by that rule, and k-mers of
three words, of any two of which in a row at least one is. So texts that share a word share an anchor, and
texts that share a passage share its three-word anchors too. Only a text without words has an empty fingerprint.

Each anchor has its position, the number of its first word. The fingerprint is the hashes of all words in order
(8 hex digits each, so the position is the place), and the three-word anchors as ``position:hash``.

Likeness is positional: two texts are laid over each other, an anchor matches if the other text has it in the same
cell of ``CELL`` = 32 positions, and the likeness is the Dice share of matched (anchor, cell) pairs. Texts are
laid start on start, and, if they have a three-word anchor in common, once more so that the common anchor of
smallest hash lies on itself; the better of the two counts. So a text behind another beginning is
recognised, a passage repeated many times is unlike the passage once, and swapped halves are like by
half. Two empty fingerprints are alike (1).

For the edited text a document needs its successor's text. Documents are put in ranges
of (descending id, text hash) whose limits are found on these two narrow columns; the first
document of each range is sent to the range before as well, so one shuffle of the texts
suffices; a document's anchors are found once and handed to its predecessor. Null ids come last; a null text is empty; documents equal in id are
ordered by text hash. The successor of a single document is itself. An empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sectorlens.llm.common import whole_text

PIECE = r"[^\x20\x09-\x0D]{1,16}"
#: Words of the longer anchors, and positions of a cell (a power of two).
WORDS, CELL = 3, 32
RANGE_BYTES = 4 * 1024 * 1024
#: The limits of the ranges are a literal of the plan; more text makes larger ranges instead of more.
MOST_RANGES = 8192
_LOW = (1 << 32) - 1
#: Keeps positions positive when a text is moved against another.
_BASE = 1 << 29


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often a lambda inside refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _cells(words: Column, mers: Column, places: Column, moved: Column | int = 0) -> Column:
    """Distinct (anchor, cell) pairs as longs: the anchor's 32 bits above the number of its cell."""
    bits = CELL.bit_length() - 1
    cell = lambda x, i: F.shiftleft(x, 31).bitwiseOR(F.shiftright(i + moved + _BASE, bits).cast("long"))
    return F.array_distinct(F.concat(F.transform(words, cell), F.zip_with(mers, places, cell)))


def anchors(text: Column) -> Column:
    """words (hash of each), mers and places (hash and position of the three-word anchors), cells."""

    def from_hashes(h: Column) -> Column:
        at = lambda i, d: F.get(h, i + d)
        inside = F.filter(F.sequence(F.lit(0), F.size(h) - 1), lambda i: i < F.size(h) - (WORDS - 1))
        chosen = F.filter(inside, lambda i: F.least(at(i, 0), at(i, 2)) <= at(i, 1))

        def with_places(places: Column) -> Column:
            mers = F.transform(places, lambda i: F.xxhash64(at(i, 0), at(i, 1), at(i, 2)).bitwiseAND(F.lit(_LOW)))
            words = F.transform(h, lambda x: x.bitwiseAND(F.lit(_LOW)))
            found = F.struct(words.alias("words"), mers.alias("mers"), places.alias("places"))
            return _let(found, lambda f: F.struct(
                f["words"].alias("words"), f["mers"].alias("mers"), f["places"].alias("places"),
                _cells(f["words"], f["mers"], f["places"]).alias("cells"),
            ))

        return _let(chosen, with_places)

    return _let(F.transform(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), lambda w: F.xxhash64(w)), from_hashes)


def as_text(found: Column) -> Column:
    digits = lambda a: F.lower(F.lpad(F.hex(a), 8, "0"))
    mers = F.zip_with(found["mers"], found["places"], lambda a, i: F.concat(i.cast("string"), F.lit(":"), digits(a)))
    words = F.array_join(F.transform(found["words"], digits), "")
    return F.concat(words, F.when(F.size(mers) > 0, F.lit("/")).otherwise(F.lit("")), F.array_join(mers, ","))


def _dice(a: Column, b: Column) -> Column:
    total = F.size(a) + F.size(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / total)


def likeness(a: Column, b: Column) -> Column:
    """Share of anchors that two texts (as ``anchors`` has them) have at the same place, 0 to 1."""
    place = lambda x, mer: F.get(x["places"], (F.array_position(x["mers"], mer) - 1).cast("int"))

    def better(mer: Column) -> Column:
        def laid(moved: Column) -> Column:
            start = _dice(a["cells"], b["cells"])
            again = _dice(a["cells"], _cells(b["words"], b["mers"], b["places"], moved))
            return F.when(F.coalesce(moved, F.lit(0)) == 0, start).otherwise(F.greatest(start, again))

        return _let(place(a, mer) - place(b, mer), laid)

    return _let(F.array_min(F.array_intersect(a["mers"], b["mers"])), better)


def with_next(docs: DataFrame, columns: dict[str, Column], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """doc_id, text, ``columns`` of the text, and next_<name> of each of them and of the text."""
    turned = F.bitwise_not(F.col("doc_id").cast("long"))  # ascending in this is descending in the id
    key = F.struct(F.col("doc_id").isNull().alias("last"), F.coalesce(turned, F.lit(0)).alias("turned"), F.xxhash64(whole_text()).alias("mark"))
    given = docs.select("doc_id", whole_text().alias("text"), key.alias("key"))
    total = given.agg(F.sum(F.octet_length("text").cast("long") + 64)).first()[0] or 0
    wanted = max(1, min(MOST_RANGES, math.ceil(total / range_bytes)))
    ranges = given.select("key").repartitionByRange(wanted, "key").groupBy(F.spark_partition_id().alias("p")).agg(F.min("key").alias("first"))
    firsts = sorted(tuple(r["first"]) for r in ranges.select("first").collect())
    if not firsts:
        firsts = [(False, 0, 0)]
    count = len(firsts)
    # a literal of three plain arrays; its size is bounded by MOST_RANGES
    limits = F.arrays_zip(*[
        F.lit([x[i] for x in firsts]).cast(kind).alias(name)
        for i, (name, kind) in enumerate((("last", "array<boolean>"), ("turned", "array<bigint>"), ("mark", "array<bigint>")))
    ])

    def halve(span: Column, _: Column) -> Column:
        middle = F.expr("cast(0 as int)") + F.floor((span["low"] + span["high"] + 1) / 2).cast("int")
        below = F.element_at(F.col("limits"), middle) <= F.col("key")
        return F.struct(F.when(below, middle).otherwise(span["low"]).alias("low"), F.when(below, span["high"]).otherwise(middle - 1).alias("high"))

    steps = max(1, math.ceil(math.log2(count + 1)))
    span = F.struct(F.lit(1).alias("low"), F.lit(count).alias("high"))
    searched = given.withColumn("limits", limits)
    at = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), span, halve, lambda x: x["low"] - 1)
    searched = searched.withColumn("range", at)
    first = F.element_at(F.col("limits"), F.col("range") + 1) == F.col("key")
    own = F.struct(F.col("range").alias("to"), F.lit(False).alias("guest"))
    before = F.struct(F.pmod(F.col("range") - 1, F.lit(count)).alias("to"), F.lit(True).alias("guest"))
    sent = searched.withColumn("sent", F.explode(F.when(first, F.array(own, before)).otherwise(F.array(own))))
    dealt = sent.select("doc_id", "text", "key", "sent.to", "sent.guest").repartition(count, "to")
    known = dealt.select("*", *[c.alias(name) for name, c in columns.items()])
    order = Window.partitionBy("to").orderBy("guest", "key")
    following = known.select("*", *[F.lead(name).over(order).alias(f"next_{name}") for name in ["text", *columns]])
    return following.filter(~F.col("guest")).drop("key", "to", "guest")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    found = with_next(docs, {"own": anchors(F.col("text"))})
    found = found.withColumn("edited", F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 2) as int))"), F.substring("next_text", F.lit(1), half)))
    found = found.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        "own", anchors(F.col("edited")).alias("changed"), F.col("next_own").alias("next"),
    )
    own, changed = F.col("own"), F.col("changed")
    return found.select(
        "doc_id", "n_chars", "edited_sha256", as_text(own).alias("fingerprint"), as_text(changed).alias("edited_fingerprint"),
        likeness(own, changed).alias("near_edited"), likeness(own, F.col("next")).alias("near_next"),
    )

"""Substring dedup with difference-cover anchors.

A window is ``window`` = 35 words in a row of one document; it is repeated if its words also start
anywhere else, in another document or the same. Words under a repeated window are
removed. Windows are judged on the input, not on what is left.

A difference cover of the period 21 is a set of five remainders of which any two numbers find one
that both reach by the same step below 21. So wherever two equal windows start, some step leads
from both starts to places whose remainders belong to the cover, and the 15 words from there on lie in
both windows. Steps:

1. Anchors: 15 words are hashed at cover places only (24 % of all) and counted; only hashes
   that occur at least twice are kept.
2. Each text's places that have such an anchor are found again; the windows around
   them (starting up to 20 words before) are its candidates. Nothing else can be repeated.
3. Extension: candidates are hashed as a whole (96 bits) and counted by an aggregate that also holds
   one place. A window counted once is alone, and the place that the
   aggregate holds is its own: only these return. No list of a passage's places is ever gathered.
4. What remains of a text's candidates is repeated; its spans of words are joined back by text.

Equal texts are handled once, by 96 bits of hash, and every window of a text that occurs twice is repeated.
All counting is combined before it is shuffled, so a passage in a third of all rows costs one row per task.
Texts without candidates are never moved, unless the candidates' keys measure too large to be copied.

A text that is null or has fewer than 35 words keeps all its words. Rows equal in every column are copies
of each other and lose the same words. Null ids are kept. An empty table gives an
empty result. The words of one text are held in memory by a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sectorlens.llm import wordlists
from sectorlens.llm.common import text_slices, whole_text
from sectorlens.operators.lookup import lookup_join
from sectorlens.session import pinned

WINDOW = 35
PERIOD, COVER = 21, (0, 1, 4, 14, 16)
SPANS = "array<struct<start:int,end:int>>"
#: Shared anchors are one long each; up to this size they are copied to the executors, beyond it the join shuffles.
ANCHOR_BYTES = 128 * 1024 * 1024


def _text_key() -> list[Column]:
    """96 bits that stand for the text."""
    return [F.xxhash64(whole_text()).alias("tid"), F.hash(F.lit(7), whole_text()).alias("tag")]


def _cover_places(starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and place in it of every cover place from which ``size`` words follow."""
    n = np.diff(starts)
    text = np.repeat(np.arange(len(n)), n)
    place = np.arange(starts[-1]) - starts[text]
    member = np.zeros(PERIOD, bool)
    member[list(COVER)] = True
    chosen = member[place % PERIOD] & (place + size <= n[text])
    return text[chosen], place[chosen]


def _anchors(docs: DataFrame, window: int, placed: bool) -> DataFrame:
    """The hash of every anchor, and if ``placed`` its text, place and the text's number of words."""
    size = window - PERIOD + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, column=0):
            starts, words = wordlists.split(batch.column(0))
            text, place = _cover_places(starts, size)
            if not len(text):
                continue
            found = wordlists.rolling(wordlists.word_hashes(words)[0], size)[starts[text] + place]
            columns, names = [pa.array(found.view(np.int64))], ["anchor"]
            if placed:
                at = pa.array(text)
                columns += [batch.column(1).take(at), batch.column(2).take(at), pa.array(place, pa.int32()), pa.array(np.diff(starts)[text], pa.int32())]
                names += ["tid", "tag", "place", "n_words"]
            yield pa.RecordBatch.from_arrays(columns, names)

    given = docs.select(whole_text().alias("text"), *(_text_key() if placed else []))
    return given.mapInArrow(run, "anchor long" + (", tid long, tag int, place int, n_words int" if placed else ""))


def _candidates(n: int, places: np.ndarray, window: int) -> np.ndarray:
    """Starts of the windows that contain the anchor of one of ``places``."""
    first = np.maximum(places - PERIOD + 1, 0)
    change = np.zeros(n + 2, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, places + 1, -1)
    return np.flatnonzero(np.cumsum(change)[: max(0, n - window + 1)] > 0)


def _window_hashes(texts: DataFrame, window: int) -> DataFrame:
    """first, second (hash), tid, tag, start, weight of every candidate of ``texts`` (text, places, tid, tag, copies)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, column=0):
            starts, words = wordlists.split(batch.column(0))
            hashes = wordlists.word_hashes(words)
            places = [np.asarray(p) for p in batch.column(1).to_numpy(zero_copy_only=False)]
            begins = [_candidates(int(n), p, window) for n, p in zip(np.diff(starts), places)]
            if not sum(map(len, begins)):
                continue
            text = pa.array(np.repeat(np.arange(len(begins)), [len(b) for b in begins]))
            at = np.concatenate([b + s for b, s in zip(begins, starts)])
            first, second = (wordlists.rolling(h, window)[at] for h in hashes)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(first.view(np.int64)), pa.array((second >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                    batch.column(2).take(text), batch.column(3).take(text), pa.array(np.concatenate(begins), pa.int32()), batch.column(4).take(text),
                ],
                ["first", "second", "tid", "tag", "start", "weight"],
            )

    given = texts.select("text", "places", "tid", "tag", F.least("copies", F.lit(2)).cast("int").alias("weight"))
    return given.mapInArrow(run, "first long, second int, tid long, tag int, start int, weight int")


def _spans(texts: DataFrame, window: int) -> DataFrame:
    """tid, tag and the spans of repeated words; ``texts`` has n_words, places, alone (starts), copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            columns = (c.to_numpy(zero_copy_only=False) for c in batch.columns[2:])
            for n, copies, places, alone in zip(*columns):
                begins = _candidates(int(n), np.asarray(places), window)
                if copies > 1:
                    begins = np.arange(n - window + 1)
                elif alone is not None:
                    begins = np.setdiff1d(begins, alone, assume_unique=True)
                edge = np.diff(wordlists.covered(int(n), begins, window).astype(np.int8), prepend=0, append=0)
                found.append([{"start": a, "end": b} for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, kind)], ["tid", "tag", "spans"])

    given = texts.select("tid", "tag", "n_words", "copies", "places", "alone")
    return given.mapInArrow(run, f"tid long, tag int, spans {SPANS}").filter(F.size("spans") > 0)


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """tid, tag (the text's key) and spans of repeated words (start, end), one row for each text that has any."""
    if window < PERIOD:
        raise ValueError(f"a window has at least {PERIOD} words, else it holds no anchor")
    shared = _anchors(docs, window, False).groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    places = lookup_join(_anchors(docs, window, True), pinned(shared), "anchor", "left_semi", limit=ANCHOR_BYTES)
    places = places.groupBy("tid", "tag", "place").agg(F.max("n_words").alias("n_words"))
    places = places.groupBy("tid", "tag").agg(F.max("n_words").alias("n_words"), F.sort_array(F.collect_list("place")).alias("places"))
    keys = docs.select(*_text_key(), F.col("doc_id").cast("long").alias("id_"))
    keys = keys.groupBy("tid", "tag").agg(F.count("*").alias("copies"), F.min("id_").alias("id_"))
    places = pinned(places.join(keys, ["tid", "tag"]))
    # one row of each text that has candidates; rows equal in id too are copies, whose windows count twice anyhow
    given = docs.select(*_text_key(), F.col("doc_id").cast("long").alias("id_"), whole_text().alias("text"))
    given = given.withColumns({"no_id": F.col("id_").isNull(), "id_": F.coalesce("id_", F.lit(0))})
    chosen = places.select("tid", "tag", F.coalesce("id_", F.lit(0)).alias("id_"), F.col("id_").isNull().alias("no_id"))
    texts = lookup_join(given, chosen, ["tid", "tag", "id_", "no_id"], "left_semi").drop("id_", "no_id")
    texts = texts.join(places.select("tid", "tag", "places", "copies"), ["tid", "tag"])
    counted = _window_hashes(texts, window).groupBy("first", "second").agg(
        F.sum("weight").alias("n"), F.min("tid").alias("tid"), F.min("tag").alias("tag"), F.min("start").alias("start")
    )
    alone = counted.filter("n = 1").groupBy("tid", "tag").agg(F.collect_list("start").alias("alone"))
    return _spans(places.join(alone, ["tid", "tag"], "left"), window)


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept, the text of the words that stay, joined by one space."""
    spans = pinned(repeated_spans(docs, window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, column=0):
            starts, words = wordlists.split(batch.column(0))
            n, kept = np.diff(starts), np.ones(starts[-1], bool)
            for row in np.flatnonzero(batch.column(2).is_valid().to_numpy(zero_copy_only=False)).tolist():
                for span in batch.column(2)[row].as_py():
                    kept[starts[row] + span["start"] : starts[row] + span["end"]] = False
            left = np.diff(np.concatenate([[0], np.cumsum(kept)])[starts])
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(n, pa.int64()), pa.array(n - left, pa.int64()), wordlists.joined(words, starts, kept).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), *_text_key())
    marked = lookup_join(given, spans, ["tid", "tag"], "left").select("text", "doc_id", "spans")
    return marked.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")

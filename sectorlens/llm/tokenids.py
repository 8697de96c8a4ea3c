"""Token ids in a binary file format: one zstandard frame per document under a shared dictionary.

A segment is a byte string: magic, id width, number of documents, sha256 of the
dictionary, validity and value of every doc_id, an offset index, then the frames.
Any one document is read by its two offsets and the dictionary, without its
neighbours. Segments are rows of a Parquet folder, so that Spark's committer takes
care of lost and repeated tasks; the dictionary is a row of a second folder.

Documents are range-partitioned by doc_id (and text hash, so that a crowd of equal
ids is split), sorted, encoded and packed. A null text is empty; a null doc_id
comes first and is kept; an empty document has its end id alone; an empty table gives
no segments. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sectorlens.llm.common import WordMemory, text_slices, whole_text

MAGIC = b"TIDSEG1\n"
HEAD = struct.Struct("<8sII32s")
#: Serialized ids of one segment, before compression.
SEGMENT_BYTES = 8 * 1024 * 1024
#: The dictionary is trained on one piece of at most so many documents, of at most so many characters (and bytes of ids).
DICTIONARY_DOCS, DICTIONARY_PIECE, DICTIONARY_BYTES = 1500, 16 * 1024, 64 * 1024


#: White space of the pre-tokenizer other than the space itself.
_BLANKS = [chr(c) for c in (*range(9, 14), *range(28, 32), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def _printable_bytes() -> dict[int, int]:
    """The letter that stands for each byte in the vocabulary: itself if printable, else one from 256 up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(others)}


class Encoder:
    """Whole texts to serialized ids (``width`` bytes each), with a memory for words.

    The pre-tokenizer never joins a space to what stands before it unless that is
    white space as well, so a text whose spaces all stand alone is its first word and then,
    for each further word, a space and the word. Any other text, and one that holds an added token, is encoded whole. A word of Latin
    letters is one piece of the pre-tokenizer, and a single mark after it is another; such
    words go straight to the library's model.
    """

    def __init__(self, path: str, width: int):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Spelled out in a text, these are tokens of their own; the library finds them before it splits words.
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.kind, self.letters = np.dtype(f"<u{width}"), _printable_bytes()
        self.feed = self.whole(["\n"])[0]
        self.marks = dict(zip(".,;:!?", self.whole(list(".,;:!?"))))
        self.memory = WordMemory(self._words, self.kind)

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.kind).tobytes() for x in found]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words that follow a space, or of a line feed and the word that follows it."""
        out, others = [], []
        tokenize, code, known = self.tokenizer.model.tokenize, self.kind.char, self.memory.known.get
        for i, word in enumerate(words):
            mark = self.marks.get(word[-1], b"")
            feed = word[0] == "\n"
            core = word[feed : -1 if mark else None]
            if mark and not feed and core[-1:].isalnum() and (ids := known(core)):
                out.append(ids + mark)
            elif core.isalpha() and (core.isascii() or max(core) < "\u0250"):
                spelled = core if core.isascii() else core.encode().decode("latin-1").translate(self.letters)
                ids = array(code, [t.id for t in tokenize(spelled if feed else "\u0120" + spelled)]).tobytes()
                out.append(self.feed + ids + mark if feed else ids + mark)
            else:
                out.append(b"")
                others.append(i)
        for i, ids in zip(others, self.whole([w if (w := words[i])[0] == "\n" else " " + w for i in others])):
            out[i] = ids
        return out

    def texts(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        easy, whole = [], []
        for i, text in enumerate(texts):
            plain = _single_spaced(text) and not any(token in text for token in self.added)
            (easy if plain else whole).append(i)
        split = [texts[i].partition(" ") for i in easy]
        firsts = self.whole([x[0] for x in split])
        # a line feed between words is a piece of its own, so the word after it can stand apart
        rests = [x[2] if "\n\n" in x[2] else x[2].replace("\n", " \n") for x in split]
        for i, first, rest in zip(easy, firsts, self.memory.look_up(rests)):
            out[i] = first + rest
        for i, ids in zip(whole, self.whole([texts[i] for i in whole])):
            out[i] = ids
        return out


def _single_spaced(text: str) -> bool:
    """Whether no space stands at an end or beside white space."""
    if not text or text[0] == " " or text[-1] == " " or "  " in text:
        return False
    return not any(c in text and (" " + c in text or c + " " in text) for c in _BLANKS)


@lru_cache(maxsize=2)
def encoder(path: str, width: int) -> Encoder:
    return Encoder(path, width)


def encode_texts(texts: list[str], path: str, width: int) -> list[bytes]:
    return encoder(path, width).texts(texts)


def pack(doc_ids: list[int | None], frames: list[bytes], width: int, digest: bytes) -> bytes:
    offsets = np.zeros(len(frames) + 1, "<u8")
    np.cumsum([len(f) for f in frames], out=offsets[1:])
    valid = np.array([d is not None for d in doc_ids], "u1").tobytes()
    ids = np.array([d or 0 for d in doc_ids], "<i8").tobytes()
    return b"".join([HEAD.pack(MAGIC, width, len(frames), digest), valid, ids, offsets.tobytes(), *frames])


class Segment:
    """A packed segment; ``ids(i)`` reads document i alone."""

    def __init__(self, data: bytes, dictionary: bytes):
        magic, self.width, self.n, digest = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a segment of token ids")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError("the segment was written with another dictionary")
        at = HEAD.size
        self.valid = np.frombuffer(data, "u1", self.n, at)
        self.doc_ids = np.frombuffer(data, "<i8", self.n, at + self.n)
        self.offsets = np.frombuffer(data, "<u8", self.n + 1, at + 9 * self.n)
        self.start = at + 9 * self.n + 8 * (self.n + 1)
        self.data = memoryview(data)
        self.reader = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def ids(self, i: int) -> np.ndarray:
        frame = self.data[self.start + int(self.offsets[i]) : self.start + int(self.offsets[i + 1])]
        return np.frombuffer(self.reader.decompress(frame), f"<u{self.width}")


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def train_dictionary(docs: DataFrame, path: str, width: int, end_id: int) -> bytes:
    """A dictionary from a bounded sample, trained in one task; empty if there are too few.

    Documents of every length are drawn by a hash of id and text; one longer than ``DICTIONARY_PIECE``
    characters gives a piece of that length from a hashed place.
    """
    rows = docs.count()
    share = min(1.0, 3 * DICTIONARY_DOCS / max(1, rows))
    text, spread = whole_text(), F.lit(1_000_003)
    at = F.pmod(F.xxhash64(F.lit(7), "doc_id", text), spread)
    places = F.greatest(F.length(text) - DICTIONARY_PIECE, F.lit(0)) + 1
    start = (F.pmod(F.xxhash64(F.lit(8), "doc_id", text), places) + 1).cast("int")
    sample = docs.select(at.alias("at"), F.substring(text, start, F.lit(DICTIONARY_PIECE)).alias("text"))
    sample = sample.filter(F.col("at") < share * 1_000_003).orderBy("at", F.xxhash64("text")).limit(DICTIONARY_DOCS).select("text")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = []
        for batch in batches:
            ids += encode_texts(batch.column(0).to_pylist(), path, width)
        end = np.array([end_id], f"<u{width}").tobytes()
        samples = [(x + end)[:DICTIONARY_PIECE] for x in ids]
        try:
            data = zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
        except zstandard.ZstdError:
            data = b""
        yield pa.RecordBatch.from_pydict({"dictionary": pa.array([data], pa.binary())})

    return bytes(sample.coalesce(1).mapInArrow(train, "dictionary binary").first()[0])


def write_token_ids(docs: DataFrame, out: str, tokenizer: str, end_id: int, width: int = 2) -> None:
    """Writes ``out``/segments and ``out``/dictionary. ``width``: bytes of an id on disk, 2 or 4."""
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, tokenizer, width, end_id)
    digest = hashlib.sha256(dictionary).digest()
    spark.createDataFrame([(dictionary, digest)], "dictionary binary, sha256 binary").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{out}/dictionary")
    end = np.array([end_id], f"<u{width}").tobytes()

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth = TaskContext.get().partitionId(), 0
        shared = _dictionary(dictionary)
        if shared:
            shared.precompute_compress(level=1)
        press = zstandard.ZstdCompressor(level=1, dict_data=shared, write_content_size=True)
        ids, frames, size = [], [], 0

        def packed():
            row = {"part": [part], "nth": [nth], "tokens": [size // width], "data": [pack(ids, frames, width, digest)]}
            return pa.RecordBatch.from_pydict(
                row, pa.schema([("part", pa.int32()), ("nth", pa.int32()), ("tokens", pa.int64()), ("data", pa.binary())])
            )

        for piece in text_slices(batches, most=16 * 1024 * 1024):
            for doc_id, raw in zip(piece.column(0).to_pylist(), encode_texts(piece.column(1).to_pylist(), tokenizer, width)):
                raw += end
                ids.append(doc_id)
                frames.append(press.compress(raw))
                size += len(raw)
                if size >= SEGMENT_BYTES:
                    yield packed()
                    ids, frames, size, nth = [], [], 0, nth + 1
        if ids:
            yield packed()

    tie = F.xxhash64("text")
    (
        docs.select("doc_id", whole_text().alias("text"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), tie)
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)
        .mapInArrow(segments, "part int, nth int, tokens long, data binary")
        .write.mode("overwrite")
        .option("compression", "none")
        .parquet(f"{out}/segments")
    )


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and ids, from the files.

    ``start`` adds up the segments of earlier ranges, the earlier segments of the
    same range and the earlier documents of the segment.
    """
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first()["dictionary"])
    segments = spark.read.parquet(f"{path}/segments")
    parts = segments.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("part"), F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    starts = segments.select("part", "nth", F.coalesce(F.sum("tokens").over(inside), F.lit(0)).alias("nth_start"))
    starts = starts.join(parts, "part").select("part", "nth", (F.col("part_start") + F.col("nth_start")).alias("first"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, nth, data in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                segment, before = Segment(data, dictionary), 0
                rows = {"part": [], "nth": [], "doc_id": [], "before": [], "n_tokens": [], "ids_crc32": []}
                for i in range(segment.n):
                    ids = segment.ids(i)
                    rows["part"].append(part)
                    rows["nth"].append(nth)
                    rows["doc_id"].append(int(segment.doc_ids[i]) if segment.valid[i] else None)
                    rows["before"].append(before)
                    rows["n_tokens"].append(len(ids))
                    rows["ids_crc32"].append(zlib.crc32(ids.astype("<u4").tobytes()))
                    before += len(ids)
                kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_pydict(rows, pa.schema(list(zip(rows, kinds))))

    found = segments.select("part", "nth", "data").mapInArrow(
        documents, "part int, nth int, doc_id long, before long, n_tokens long, ids_crc32 long"
    )
    return found.join(starts, ["part", "nth"]).select(
        "doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )

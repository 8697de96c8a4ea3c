"""SentencePiece encoding and decoding, with giant documents split by a max-plus parallel scan.

The model merges byte pairs. A sequence of pieces is the encoding of a text exactly if
every piece encodes to itself and every two neighbours encode, together, to just these
two. So the encoding is the one path through the lattice of pieces whose steps all weigh 0
(fit together) rather than minus infinity, and a long text can be cut anywhere:

* A cut has as boundary states the pieces that may cover the character before it.
* Each chunk, on its own, yields a transfer matrix from the states at its start to those at
  its end (in max-plus: 0 where a path exists, else minus infinity).
* The matrices of a document are combined associatively (prefix products by doubling), which
  settles the state at every cut.
* Each chunk, on its own again, traces its path back between its two states.

Inside a chunk no piece reaches from a letter into a following word boundary, so only the ends
of a chunk need the lattice; what lies between the first and the last boundary, and a
document of ordinary length, is encoded by the library, word by word with a memory.

A null or empty text has no ids. Rows with equal giant texts are encoded once. An
empty table gives an empty result; all columns travel along in a struct, so that names cannot clash.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sectorlens.llm.common import WordMemory, text_slices
from sectorlens.session import pinned

MARK = "▁"
CHUNK_CHARS = 32_768
#: Rows and their lists of ids to a record batch.
Finish = Callable[[pa.Array, pa.Array], pa.RecordBatch]


class Pieces:
    """The model's pieces, which pieces are stable, and which fit side by side."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.sp = sp = SentencePieceProcessor(model_file=path)
        usual = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.id = {sp.id_to_piece(i): i for i in usual}
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in usual}
        self.byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(sp.get_piece_size()) if sp.is_byte(i)}
        self.longest = max(map(len, self.id), default=1)
        self.fits, self.stable = {}, {}
        self.memory = WordMemory(lambda words: [array("i", x).tobytes() for x in sp.encode(words, num_threads=1)], "<i4", most=100_000)

    def merged(self, text: str) -> list[str]:
        """Pairs merged best score first, leftmost among equals; for short texts."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def is_stable(self, piece: str) -> bool:
        if len(piece) == 1:
            return True
        if piece not in self.id:
            return False
        known = self.stable.get(piece)
        if known is None:
            known = self.stable[piece] = self.merged(piece) == [piece]
        return known

    def fit(self, a: str, b: str) -> bool:
        known = self.fits.get((a, b))
        if known is None:
            if len(self.fits) > 50_000:
                self.fits.clear()
            known = self.fits[a, b] = self.merged(a + b) == [a, b]
        return known

    def ids(self, piece: str) -> list[int]:
        at = self.id.get(piece)
        if at is not None:
            return [at]
        return [self.byte[b] for b in piece.encode("utf-8", "surrogatepass")] if self.byte else [self.sp.unk_id()]

    def encode_whole(self, texts: list[str]) -> list[bytes]:
        """Serialized ids of ordinary texts; words are looked up where all spaces stand alone."""
        out: list[bytes] = [b""] * len(texts)
        easy, whole = [], []
        for i, text in enumerate(texts):
            if not text:
                continue
            alone = MARK not in text and "  " not in text and text[0] != " " and text[-1] != " "
            (easy if alone else whole).append(i)
        for i, ids in zip(easy, self.memory.look_up([texts[i] for i in easy])):
            out[i] = ids
        for i in whole:
            out[i] = np.array(self.sp.encode(texts[i]), "<i4").tobytes()
        return out


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


# ---------------------------------------------------------------- the lattice of one chunk


def reachable(model: Pieces, text: str, entries: list[tuple[int, str]], stop: int) -> dict[int, list[tuple[str, int, tuple]]]:
    """By end: (piece, bits of the entries it can be reached from, the step before) of pieces that start before ``stop``.

    An entry is (end, piece); the piece is empty at the start of the text or after a word boundary.
    """
    ends: dict[int, list[tuple[str, int, tuple]]] = {}
    for i, (end, piece) in enumerate(entries):
        ends.setdefault(end, []).append((piece, 1 << i, ()))
    for start in range(min(ends, default=stop), stop):
        before = ends.get(start)
        if not before:
            continue
        for end in range(start + 1, min(start + model.longest, len(text)) + 1):
            piece = text[start:end]
            if end > start + 1 and not model.is_stable(piece):
                continue
            bits, last = 0, ()
            for k, (other, mask, _) in enumerate(before):
                if not other or model.fit(other, piece):
                    bits |= mask
                    last = (start, k)
            if bits:
                ends.setdefault(end, []).append((piece, bits, last))
    return ends


def traced(ends: dict, at: tuple[int, int]) -> list[str]:
    """Pieces of the path that leads to the step ``at``, without the entry."""
    out = []
    while True:
        piece, _, last = ends[at[0]][at[1]]
        if not last:
            return out[::-1]
        out.append(piece)
        at = last


def states(model: Pieces, text: str, cut: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces that may cover the character before ``cut``; at the start of the text (0, 0)."""
    if cut == 0:
        return [(0, 0)]
    reach = model.longest
    return [
        (a, b)
        for a in range(max(0, cut - reach), cut)
        for b in range(cut, min(len(text), a + reach) + 1)
        if b == a + 1 or model.is_stable(text[a:b])
    ]


class Chunk:
    """Characters ``low`` to ``high`` of ``text``, a window that reaches a piece's length beyond them."""

    def __init__(self, model: Pieces, text: str, low: int, high: int, last: bool):
        self.model, self.text, self.low, self.high = model, text, low, high
        self.entry = states(model, text, low)
        self.exit = [s for s in states(model, text, high) if not last or s[1] == high]
        marks = [i for i in self._boundaries(low, high)]
        self.first, self.final = (marks[0], marks[-1]) if marks else (None, None)

    def _boundaries(self, low: int, high: int) -> list[int]:
        """The first and the last place where a word mark follows another character."""
        text = self.text
        first = next((i for i in self._marks(low, high, 1)), None)
        if first is None:
            return []
        return [first, next(i for i in self._marks(low, high, -1))]

    def _marks(self, low: int, high: int, way: int) -> Iterator[int]:
        text = self.text
        i = text.find(MARK, max(low, 1), high) if way > 0 else text.rfind(MARK, max(low, 1), high)
        while i >= 0:
            if text[i - 1] != MARK:
                yield i
            i = text.find(MARK, i + 1, high) if way > 0 else text.rfind(MARK, max(low, 1), i)

    def _into(self, entry: list[tuple[int, int]]) -> dict:
        """From the boundary states to the first word boundary, or on to the end if there is none."""
        given = [(b, self.text[a:b]) for a, b in entry]
        if self.first is None:
            return reachable(self.model, self.text, given, self.high)
        return reachable(self.model, self.text[: self.first], given, self.first)

    def _out(self) -> dict:
        return reachable(self.model, self.text, [(self.final, "")], self.high)

    def _steps(self, ends: dict, state: tuple[int, int]) -> list[tuple[int, int]]:
        piece = self.text[state[0] : state[1]]
        return [(state[1], k) for k, (p, _, last) in enumerate(ends.get(state[1], ())) if p == piece and last]

    def transfer(self) -> np.ndarray:
        out = np.full((len(self.entry), len(self.exit)), -np.inf)
        into = self._into(self.entry)
        if self.first is None:
            for j, state in enumerate(self.exit):
                for end, k in self._steps(into, state):
                    for i in range(len(self.entry)):
                        if into[end][k][1] >> i & 1:
                            out[i, j] = 0
            return out
        mask = 0
        for _, bits, _ in into.get(self.first, ()):
            mask |= bits
        leave = self._out()
        for j, state in enumerate(self.exit):
            if self._steps(leave, state):
                for i in range(len(self.entry)):
                    if mask >> i & 1:
                        out[i, j] = 0
        return out

    def ids(self, entry: int, exit: int) -> list[int]:
        """Ids of the pieces that start in this chunk, on the path between two states."""
        model = self.model
        into = self._into([self.entry[entry]])
        if self.first is None:
            path = traced(into, self._steps(into, self.exit[exit])[0])
            return [x for p in path for x in model.ids(p)]
        head = traced(into, (self.first, 0))
        leave = self._out()
        tail = traced(leave, self._steps(leave, self.exit[exit])[0])
        middle = model.sp.encode(self.text[self.first + 1 : self.final]) if self.final > self.first else []
        return [x for p in head for x in model.ids(p)] + middle + [x for p in tail for x in model.ids(p)]


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return (a[:, :, None] + b[None]).max(axis=1)


def prefix_products(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """All prefix products, by doubling: every round combines each with the one ``step`` before."""
    out, step = list(matrices), 1
    while step < len(out):
        out = [times(out[i - step], m) if i >= step else m for i, m in enumerate(out)]
        step *= 2
    return out


def settle(matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """(entry, exit) of every chunk on the best path through all of them."""
    products = prefix_products(matrices)
    exits = [int(products[-1][0].argmax())]
    for k in range(len(matrices) - 1, 0, -1):
        exits.append(int((products[k - 1][0] + matrices[k][:, exits[-1]]).argmax()))
    exits = exits[::-1]
    return list(zip([0, *exits[:-1]], exits))


def windows(text: str, chunk: int, reach: int) -> Iterator[tuple[int, str, int, int, bool]]:
    """(number, window, low, high, last) of the chunks of a normalised text."""
    n = len(text)
    for k in range(-(-n // chunk)):
        a, b = k * chunk, min(n, (k + 1) * chunk)
        if b < n and n - b < 4 * reach:  # no stub shorter than a piece at the end
            b = n
        start = max(0, a - reach)
        yield k, text[start : min(n, b + reach)], a - start, b - start, b == n
        if b == n:
            return


def encode_giant(model: Pieces, text: str, chunk: int) -> list[int]:
    """The scan in one process (for tests and for reading)."""
    parts = [Chunk(model, w, lo, hi, last) for _, w, lo, hi, last in windows(normalised(text), chunk, model.longest)]
    path = settle([p.transfer() for p in parts])
    return [x for p, (a, b) in zip(parts, path) for x in p.ids(a, b)]


def normalised(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


# ---------------------------------------------------------------- whole tables


def _giant_ids(texts: DataFrame, path: str, chunk: int) -> DataFrame:
    """mark, ids for the distinct texts of (mark, text), all longer than a chunk."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = pieces(path).longest
        for batch in text_slices(batches):
            for mark, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = [(mark, *w) for w in windows(normalised(text), chunk, reach)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["mark", "nth", "text", "low", "high", "last"])

    def transfers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in text_slices(batches, column=2, most=1024 * 1024):
            rows = batch.to_pylist()
            found = [Chunk(model, r["text"], r["low"], r["high"], r["last"]).transfer() for r in rows]
            kinds = pa.schema([("mark", pa.string()), ("nth", pa.int64()), ("entries", pa.int64()), ("open", pa.binary())])
            yield pa.RecordBatch.from_pylist(
                [{"mark": r["mark"], "nth": r["nth"], "entries": len(m), "open": (m == 0).tobytes()} for r, m in zip(rows, found)], kinds
            )

    def combine(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("nth")
        matrices = [np.where(np.frombuffer(o, bool).reshape(n, -1), 0.0, -np.inf) for n, o in zip(rows["entries"], rows["open"])]
        path_ = settle(matrices)
        return pd.DataFrame({"mark": rows["mark"], "nth": rows["nth"], "a": [p[0] for p in path_], "b": [p[1] for p in path_]})

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in text_slices(batches, column=2, most=1024 * 1024):
            rows = batch.to_pylist()
            found = [np.array(Chunk(model, r["text"], r["low"], r["high"], r["last"]).ids(r["a"], r["b"]), np.int32) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["mark"] for r in rows]), pa.array([r["nth"] for r in rows], pa.int64()), pa.array(found, pa.list_(pa.int32()))],
                ["mark", "nth", "part"],
            )

    chunks = texts.mapInArrow(split, "mark string, nth long, text string, low long, high long, last boolean")
    chunks = pinned(chunks.repartition("mark", "nth"))
    matrices = chunks.mapInArrow(transfers, "mark string, nth long, entries long, open binary")
    settled = matrices.groupBy("mark").applyInPandas(combine, "mark string, nth long, a long, b long")
    parts = chunks.join(settled, ["mark", "nth"]).select("mark", "nth", "text", "low", "high", "last", "a", "b")
    parts = parts.mapInArrow(trace, "mark string, nth long, part array<int>")
    whole = parts.groupBy("mark").agg(F.array_sort(F.collect_list(F.struct("nth", "part"))).alias("parts"))
    return whole.select("mark", F.flatten("parts.part").alias("ids"))


def encode(docs: DataFrame, path: str, chunk: int = CHUNK_CHARS, finish: Finish | None = None, types: str = "") -> DataFrame:
    """row (a struct of the columns of ``docs``) and ids, the piece ids of its text.

    ``finish`` turns rows and ids into other columns (``types``) in the task that has
    them, so that ids need not travel on when only something derived from them is wanted.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    types = types or f"row struct<{', '.join(f'`{f.name}`:{f.dataType.simpleString()}' for f in docs.schema)}>, ids array<int>"
    at = docs.columns.index("text")

    def finished(rows: pa.Array, ids: pa.Array) -> pa.RecordBatch:
        return finish(rows, ids) if finish else pa.RecordBatch.from_arrays([rows, ids], ["row", "ids"])

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([pc.struct_field(batch.column(0), at), batch.column(0)], ["text", "row"])
            for part in text_slices([texts], column=0, most=2 * 1024 * 1024):
                found = model.encode_whole([t or "" for t in part.column(0).to_pylist()])
                offsets = np.cumsum([0, *[len(x) // 4 for x in found]], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), "<i4")))
                yield finished(part.column(1), ids)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in id_slices(batches, column=1):
            yield finished(part.column(0), part.column(1))

    long = F.coalesce(F.length("text") > chunk, F.lit(False))
    short = docs.filter(~long).select(row).mapInArrow(plain, types)
    mark = F.sha2("text", 256)
    giants = docs.filter(long).select(mark.alias("mark"), row)
    distinct = giants.select("mark", F.col("row.text").alias("text")).dropDuplicates(["mark"])
    joined = giants.join(_giant_ids(distinct, path, chunk), "mark").select("row", "ids")
    return short.unionByName(joined.mapInArrow(whole, types) if finish else joined)


def id_slices(batches: Iterator[pa.RecordBatch], column: int, most: int = 500_000) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into runs of rows whose ids are about ``most`` together."""
    for batch in batches:
        count = np.asarray(pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        piece = (np.cumsum(count) - count) // most
        cuts = np.flatnonzero(np.diff(piece)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if b > a:
                yield batch.slice(a, b - a)


def decode_ids(ids: np.ndarray, path: str) -> str:
    return pieces(path).sp.decode(ids.tolist())


def decode(encoded: DataFrame, path: str, kept: list, types: str) -> DataFrame:
    """The columns ``kept`` of ``encoded`` with decoded, the text its ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in id_slices(batches, column=0):
            texts = [decode_ids(x.values.to_numpy(), path) for x in part.column(0)]
            yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(texts, pa.string())], [*part.schema.names[1:], "decoded"])

    return encoded.select("ids", *kept).mapInArrow(run, f"{types}, decoded string")

"""Exact top-k inner products from an impact-ordered index, a score level at a time.

Vectors are whole numbers (floor of ``scale`` times each component). They are dealt into
blocks by a hash of id and vector, once, and stay where they are. A block's index holds posting segments: by falling
level of quantised impact, the (vector, dimension, sign) entries of one or more levels, and for each segment how long
what is left out of each vector still is; it is built once and asked by all queries. A query adds up whole
segments in that order. What is not yet seen of a vector, and what
quantisation hides of the seen part, is a remainder of known length, so by Cauchy-Schwarz
each score is known up to remainder length x query length. A query stops once
that proves all but a few vectors out of its first k (or when all segments are done); the
possible members are scored exactly. Only k rows per query and block leave a task.

Queries come in packs of at most ``PACK_BYTES``, which are copied to the tasks, one pack at a time: the index is shuffled
once, whatever the number of queries.

Vectors that are null, hold a null or a component that is not finite take no part; shorter vectors
are filled up with zeros. A query's own row is left out once, so that its copies stay candidates; equal
query rows are answered once each. A null id is no query, and as a candidate it loses ties.
An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sectorlens.session import pinned

BLOCK_ROWS, QUERY_ROWS, LEVEL = 4096, 128, 8
#: Queries of one pack, as bytes of their vectors; a pack passes through the driver.
PACK_BYTES = 32 * 1024 * 1024
#: Levels are put together until a segment holds this share of a block's entries.
SEGMENT_SHARE = 0.2
#: A query stops when this many possible members per wanted row are left.
_FEW = 4
_NO_ID = np.iinfo(np.int64).max


def whole_vectors(table: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """id, vector (whole numbers) of the rows that take part."""
    x = F.col(vector_column)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = table.filter(x.isNotNull() & ~bad)
    return usable.select(
        F.col(id_column).cast("long").alias("id"),
        F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("vector"),
    )


def _packed(groups: DataFrame, by: str, width: int) -> DataFrame:
    """One row per group: its ids and its matrix, row-major."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        matrix = np.zeros((len(rows), width), np.int64)
        for i, v in enumerate(rows["vector"]):
            matrix[i, : len(v)] = v
        ids = rows["id"].fillna(_NO_ID).to_numpy().astype(np.int64) if rows["id"].dtype == object else rows["id"].to_numpy()
        if rows["missing"].any():
            ids = np.where(rows["missing"], _NO_ID, ids)
        extra = {"copies": [rows["copies"].to_numpy(np.int64).tobytes()]} if "copies" in rows else {}
        return pd.DataFrame({by: [rows[by].iloc[0]], "ids": [ids.tobytes()], "matrix": [matrix.tobytes()], **extra})

    named = groups.withColumn("missing", F.col("id").isNull()).withColumn("id", F.coalesce("id", F.lit(0)))
    extra = ", copies binary" if "copies" in groups.columns else ""
    return named.groupBy(by).applyInPandas(pack, f"{by} long, ids binary, matrix binary{extra}")


def impact_segments(rows: np.ndarray, share: float = SEGMENT_SHARE) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(lowest level, row, dimension, quantised impact with sign) of every entry but zeros, highest levels first."""
    levels = (np.abs(rows) + LEVEL - 1) // LEVEL
    row, dim = np.nonzero(levels)
    level = levels[row, dim]
    order = np.argsort(-level, kind="stable")
    row, dim, level = row[order], dim[order], level[order]
    impact = np.sign(rows[row, dim]) * (level * LEVEL - LEVEL / 2)
    ends, least, begun = [], max(1, int(share * len(level))), 0
    for end in [*(np.flatnonzero(np.diff(level)) + 1).tolist(), len(level)]:
        if end - begun >= least or end == len(level) > begun:
            ends.append(end)
            begun = end
    return [(int(level[z - 1]), row[y:z], dim[y:z], impact[y:z]) for y, z in zip([0, *ends], ends)]


class BlockIndex:
    """Segments of one block, and the length of what each vector lacks after each of them."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray):
        self.rows, self.ids, self.segments = rows, ids, impact_segments(rows)
        self.left, rest = [], rows.astype(float)
        for _, row, dim, impact in self.segments:
            rest[row, dim] -= impact
            self.left.append(np.linalg.norm(rest, axis=1))

    def own(self, queries: np.ndarray, query_ids: np.ndarray) -> np.ndarray:
        """Place of each query's own row in this block, -1 without one."""
        where: dict[int, list[int]] = {}
        for i in np.flatnonzero(np.isin(self.ids, query_ids)).tolist():
            where.setdefault(int(self.ids[i]), []).append(i)
        same = lambda i, j: np.array_equal(self.rows[j], queries[i])
        return np.array([next((j for j in where.get(q, ()) if same(i, j)), -1) for i, q in enumerate(query_ids.tolist())], int)

    def possible(self, queries: np.ndarray, k: int) -> np.ndarray:
        """Which rows may be among the k best of which query, its own row apart (queries x rows)."""
        n, q = len(self.rows), len(queries)
        kept = min(k + 1, n)  # one more, for a query's own row
        found = np.ones((q, n), bool)
        if n <= kept:
            return found
        weights = queries.astype(float)
        length = np.linalg.norm(weights, axis=1)
        active, scores = np.arange(q), np.zeros((q, n))
        posting = np.zeros(self.rows.shape)
        for (_, row, dim, impact), left in zip(self.segments, self.left):
            posting[row, dim] = impact
            scores += weights[active] @ posting.T
            posting[row, dim] = 0
            # a little more than the proof needs, for rounding
            bound = np.outer(length[active] * (1 + 1e-9), left) + 1e-6
            low = scores - bound
            low.partition(n - kept, axis=1)
            bound += scores
            may = bound >= low[:, n - kept, None]
            found[active] = may
            more = may.sum(axis=1) > _FEW * k
            active, scores = active[more], scores[more]
            if not len(active):
                break
        return found


def search(index: BlockIndex, queries: np.ndarray, query_ids: np.ndarray, k: int):
    """(query position, id, score) of each query's k best rows, its own row left out once."""
    own, possible = index.own(queries, query_ids), index.possible(queries, k)
    mine = own >= 0
    possible[np.flatnonzero(mine), own[mine]] = False
    at_query, at_row = np.nonzero(possible)
    out = []
    for a in range(0, len(at_query), 200_000):
        p, r = at_query[a : a + 200_000], at_row[a : a + 200_000]
        out.append(np.einsum("ij,ij->i", index.rows[r], queries[p]))
    exact = np.concatenate(out) if out else np.empty(0, np.int64)
    order = np.lexsort((index.ids[at_row], -exact, at_query))
    at_query, at_row, exact = at_query[order], at_row[order], exact[order]
    first = np.searchsorted(at_query, np.arange(len(queries)))
    place = np.arange(len(at_query)) - first[at_query] if len(at_query) else at_query
    best = place < k
    return at_query[best], index.ids[at_row[best]], exact[best]


def _ask(index: DataFrame, pack: int, query_ids: np.ndarray, queries: np.ndarray, copies: np.ndarray, k: int) -> DataFrame:
    """The k best rows of each block for each query of a pack."""
    width = queries.shape[1]

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["pack", "place", "query_id", "copies", "vec_id", "score"]
        for batch in batches:
            for ids, matrix in zip(*(c.to_pylist() for c in batch.columns)):
                block = BlockIndex(np.frombuffer(matrix, np.int64).reshape(-1, width), np.frombuffer(ids, np.int64))
                for a in range(0, len(queries), QUERY_ROWS):
                    z = a + QUERY_ROWS
                    at, found, score = search(block, queries[a:z], query_ids[a:z], k)
                    at = at + a
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), pack)), pa.array(at), pa.array(query_ids[at]), pa.array(copies[at]), pa.array(found), pa.array(score)], names
                    )

    schema = "pack long, place long, query_id long, copies long, vec_id long, score long"
    return index.select("ids", "matrix").mapInArrow(answer, schema)


def top_k(table: DataFrame, k: int, every: int, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank, id and score of the k best rows for each row whose id is divisible by ``every``."""
    vectors = whole_vectors(table, id_column, vector_column, scale)
    mark = F.xxhash64("id", "vector")
    facts = vectors.agg(
        F.count("*").alias("n"), F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("width"),
        F.count(F.when(F.col("id") % every == 0, 1)).alias("q"),
    ).first()
    width = max(1, facts["width"])
    blocks, packs = max(1, math.ceil(facts["n"] / BLOCK_ROWS)), max(1, math.ceil(8 * width * facts["q"] / PACK_BYTES))
    dealt = vectors.withColumn("block", F.pmod(mark, F.lit(blocks))).repartition(blocks, "block")
    index = pinned(_packed(dealt, "block", width))
    asked = vectors.filter(F.col("id") % every == 0).groupBy("id", "vector").agg(F.count("*").alias("copies"))
    asked = pinned(asked.withColumn("pack", F.pmod(F.xxhash64(F.lit(9), "id", "vector"), F.lit(packs))))
    found = []
    for pack in range(packs):
        # bounded by PACK_BYTES, about
        rows = asked.filter(F.col("pack") == pack).orderBy("id", "vector").toArrow()
        queries = np.zeros((rows.num_rows, width), np.int64)
        for i, v in enumerate(rows["vector"].to_pylist()):
            queries[i, : len(v)] = v
        numbers = [rows[c].to_numpy().astype(np.int64) for c in ("id", "copies")]
        best = _ask(index, pack, numbers[0], queries, numbers[1], k)
        found.append(best if packs == 1 else pinned(best))
    best = reduce(DataFrame.unionAll, found)
    order = Window.partitionBy("pack", "place").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    ranked = ranked.withColumn("vec_id", F.when(F.col("vec_id") < _NO_ID, F.col("vec_id")))
    ranked = ranked.withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

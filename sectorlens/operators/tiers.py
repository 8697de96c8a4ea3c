"""Parts of many batches merged into few folders behind one pointer."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sectorlens.sources import landing

_MANIFEST = T.StructType().add("first", T.LongType()).add("n", T.LongType()).add("path", T.StringType()).add("batch", T.LongType())


class Tiers:
    """Size-tiered folders: each batch adds one, and folders of no more batches than the new one has are merged into it.

    So the folders' sizes fall by half at least from one to the next, and n batches are held by at most
    log2(n) + 1 of them, each row having been rewritten as often. Which folders count is said by a manifest for each
    batch, written last and as one file. A merge writes a folder with a name of its own and deletes nothing: a reader that has
    started keeps its files, and a repeated batch starts from the manifest before it. Folders that no recent
    manifest names are left for the storage's own expiry.
    """

    def __init__(self, spark: SparkSession, folder: str, merge: Callable[[DataFrame], DataFrame]):
        self.spark, self.folder, self.merge = spark, folder.rstrip("/"), merge

    def entries(self, before: int | None = None) -> list[tuple[int, int, str]]:
        """(first batch, number of batches, folder) after the newest batch, or the newest one before a given one."""
        stored = landing.read_or_empty(self.spark, f"{self.folder}/_manifest", _MANIFEST)
        if before is not None:
            stored = stored.where(F.col("batch") < before)
        newest = stored.agg(F.max("batch")).first()[0]
        if newest is None:
            return []
        # one row a folder: a handful
        rows = stored.where(F.col("batch") == newest).orderBy("first").collect()
        return [(r["first"], r["n"], r["path"]) for r in rows]

    def add(self, batch: int, path: str) -> None:
        """Count the rows of folder ``path`` in, as those of ``batch``."""
        entries = [*self.entries(batch), (batch, 1, path)]
        size, at = 1, len(entries) - 1
        while at and entries[at - 1][1] <= size:
            at -= 1
            size += entries[at][1]
        if at < len(entries) - 1:
            parts = self.spark.read.parquet(*[place for _, _, place in entries[at:]])
            target = f"{self.folder}/_merged/{entries[at][0]}-{batch}-{uuid.uuid4().hex}"
            self.merge(parts).write.parquet(target)
            entries[at:] = [(entries[at][0], size, target)]
        rows = self.spark.createDataFrame(entries, "first long, n long, path string").coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self.folder}/_manifest/batch={batch}")

    def read(self) -> DataFrame:
        """The rows of all batches; those of one key and window are spread over the folders."""
        return self.spark.read.parquet(*[place for _, _, place in self.entries()])

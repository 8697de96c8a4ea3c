"""The newest rows of each group as a stored table that merges loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sectorlens.operators import sinks, topk
from sectorlens.sources import landing

BUCKETS = 32


class TopList:
    """The ``k`` newest rows of each group, kept up to date by loads of new rows.

    A load cuts its own rows to ``k`` a group (before the shuffle), merges them with the stored
    rows of the buckets it has groups of, and writes these buckets anew; no other stored row is read, nor any
    earlier load. Buckets are folders below the load that wrote them, and a manifest per load says which load's
    folder holds each bucket. The manifest is written last and as one file: readers see a load as a whole or not at
    all, and a load that failed is run again under its number. A number not above the newest one is a
    repeated load and changes nothing. One writer at a time.

    What a group belongs to (a company's sector) is no part of the table: readers join it, so a group that
    moves is counted where it is now, and nothing stored has to be taken back.
    """

    def __init__(
        self, spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str], k: int,
        time: str = "pubdate", ties: Sequence[str] = (), buckets: int = BUCKETS,
    ):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        self.keys, self.k, self.time, self.ties, self.buckets = list(keys), k, time, list(ties), buckets

    def _manifest(self) -> tuple[int | None, dict[int, int]]:
        """The newest load and, for each bucket, the load whose folder holds it (at most one row a bucket)."""
        schema = T.StructType.fromDDL("bucket int, written long, load long")
        stored = landing.read_or_empty(self.spark, f"{self.folder}/manifest", schema)
        newest = stored.agg(F.max("load")).first()[0]
        if newest is None:
            return None, {}
        rows = stored.where(F.col("load") == newest).collect()
        return newest, {r["bucket"]: r["written"] for r in rows if r["bucket"] is not None}

    def _stored(self, buckets: dict[int, int]) -> DataFrame:
        if not buckets:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.folder}/load={load}/bucket={bucket}" for bucket, load in sorted(buckets.items())]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _cut(self, rows: DataFrame) -> DataFrame:
        return topk.newest_per(rows, self.keys, self.k, self.time, self.ties).drop("rn")

    def load(self, rows: DataFrame, load: int) -> bool:
        """Merge ``rows``; False if the load with this number, or a later one, is in already."""
        newest, written = self._manifest()
        if newest is not None and load <= newest:
            return False
        # a stream's batch is of another session
        own = self._cut(rows.select(*self.schema.names))
        bucket = F.pmod(F.hash(*self.keys), F.lit(self.buckets)).alias("bucket")
        hit = [r[0] for r in own.select(bucket).distinct().collect()]
        merged = self._cut(own.unionByName(self._stored({b: n for b, n in written.items() if b in hit})))
        sinks.write_dataset(merged.select(*self.schema.names, bucket), f"{self.folder}/load={load}", "overwrite", ["bucket"])
        entries = sorted((written | dict.fromkeys(hit, load)).items()) or [(None, None)]
        manifest = self.spark.createDataFrame(entries, "bucket int, written long").coalesce(1)
        manifest.write.mode("overwrite").parquet(f"{self.folder}/manifest/load={load}")
        return True

    def read(self) -> DataFrame:
        """The newest rows of each group after the last load."""
        return self._stored(self._manifest()[1])

"""Keys that are stored already, as a bucketed table that is never shuffled."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sectorlens import session
from sectorlens.operators import lookup

BUCKETS = 64


class KeyLedger:
    """Keys of a store in ``buckets`` buckets by one text that stands for all key columns.

    A batch is compared with the ledger without moving the ledger: the batch's distinct keys are either
    copied to the tasks that scan it (if they measure small) or dealt by the buckets' own hash.
    Only files of buckets that the batch has keys of are read. Null keys equal each other.

    A key may be entered more than once, which changes no answer; :meth:`compact` removes repeats and
    leaves one file a bucket. ``load`` numbers the batches of a stream: a batch that is repeated asks for the
    loads before its own. The table is external; a session that does not know it yet finds its rows in ``folder``.
    """

    def __init__(self, spark: SparkSession, table: str, folder: str, keys: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.table, self.keys, self.buckets = spark, table, list(keys), buckets
        self.folder = folder.rstrip("/")
        self._create(table, f"{self.folder}/keys")

    def _create(self, table: str, location: str) -> None:
        columns = ", ".join(f"`{c}` string" for c in ["key", *self.keys])
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}, load bigint) USING parquet"
            f" CLUSTERED BY (key) INTO {self.buckets} BUCKETS LOCATION '{location}'"
        )

    def key(self) -> Column:
        """One text for the key columns; the length before each tells ("a", "bc") from ("ab", "c"), ``~`` is null."""
        texts = [F.col(c).cast("string") for c in self.keys]
        return F.concat(*[F.coalesce(F.concat(F.char_length(t).cast("string"), F.lit(":"), t), F.lit("~")) for t in texts])

    def _bucket(self) -> Column:
        # the hash that Spark deals buckets by
        return F.pmod(F.hash("key"), F.lit(self.buckets))

    def add(self, rows: DataFrame, load: int | None = None) -> None:
        """Enter the keys of ``rows``."""
        named = [F.col(c).cast("string").alias(c) for c in self.keys]
        entries = rows.select(*named).distinct().select(self.key().alias("key"), *self.keys, F.lit(load).cast("long").alias("load"))
        self._insert(entries, self.table)

    def _insert(self, entries: DataFrame, table: str) -> None:
        # dealt like the buckets, so that a bucket gets one file
        dealt = entries.repartition(self.buckets, "key").sortWithinPartitions("key")
        dealt.select("key", *self.keys, "load").write.insertInto(table)

    def follow(self, path: str, schema: T.StructType) -> None:
        """Enter the keys of the files that were added to the store since the last call, late ones in old folders as well.

        The store leads: a run that failed after it wrote, and before its keys were entered, is
        caught up here, so the ledger neither misses stored rows nor knows others.
        """
        reader = self.spark.readStream.schema(schema).option("recursiveFileLookup", "true")
        try:
            stored = reader.option("pathGlobFilter", "*.parquet").parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return  # nothing is stored yet
        (
            stored.select(*self.keys).writeStream.option("checkpointLocation", f"{self.folder}/followed")
            .trigger(availableNow=True)
            .foreachBatch(lambda batch, _: self.add(batch))
            .start()
            .awaitTermination()
        )

    def entries(self, hit: Sequence[int] | None = None, before: int | None = None) -> DataFrame:
        """The ledger, of the ``hit`` buckets only, and of the loads before a given one."""
        # a stream enters keys in a session of its own, whose files this one has not listed
        self.spark.catalog.refreshTable(self.table)
        found = self.spark.table(self.table)
        if hit is not None and len(hit) < self.buckets:
            number = F.regexp_extract("_metadata.file_name", r"_(\d+)\.c\d+", 1).cast("int")
            found = found.where(number.isin([int(b) for b in hit]))
        if before is not None:
            found = found.where(F.col("load") < before)
        return found

    def seen(self, rows: DataFrame, before: int | None = None, limit: int = lookup.BROADCAST_BYTES) -> DataFrame:
        """The key columns of those keys of ``rows`` that the ledger has."""
        mine = session.pinned(rows.select(self.key().alias("key")).distinct())
        hit = [r[0] for r in mine.select(self._bucket()).distinct().collect()]  # at most one number a bucket
        if lookup.fits_broadcast(mine, limit):
            mine = F.broadcast(mine)
        else:
            mine = mine.repartition(self.buckets, "key").hint("merge")
        return self.entries(hit, before).join(mine, "key", "left_semi").select(*self.keys)

    def compact(self) -> None:
        """One file a bucket, each key once (its first load); readers see the old files until the new ones are written."""
        whole = self.entries().groupBy("key", *self.keys).agg(F.min("load").alias("load"))
        target, new = f"{self.folder}/keys-{uuid.uuid4().hex}", f"{self.table}_{uuid.uuid4().hex}"
        self._create(new, target)
        try:
            self._insert(whole, new)
        finally:
            self.spark.sql(f"DROP TABLE {new}")
        self.spark.sql(f"ALTER TABLE {self.table} SET LOCATION '{target}'")
        self.spark.catalog.refreshTable(self.table)

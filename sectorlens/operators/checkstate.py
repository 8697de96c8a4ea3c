"""Declared checks as partial results that merge, so a load checks its own pieces only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sectorlens.operators import lookup, sinks
from sectorlens.sources import landing


class CheckState:
    """Partial results of a table's checks for each piece of it (a day, or a load).

    A piece keeps its number of nulls for each column that must not be null, and for each unique key the distinct
    values with their counts. Both add up over pieces, so the whole table's result comes from
    the partials alone. A piece that is checked again replaces its own partials. A value that occurs in two pieces is a repeat
    although neither piece repeats it. Keys with a null column do not count, as in :mod:`sectorlens.operators.quality`.
    """

    def __init__(
        self, spark: SparkSession, folder: str, not_null: Sequence[str] = (), unique: Sequence[str | Sequence[str]] = ()
    ):
        self.spark, self.folder, self.not_null = spark, folder.rstrip("/"), list(not_null)
        self.unique = [[u] if isinstance(u, str) else list(u) for u in unique]

    def update(self, rows: DataFrame, piece: str) -> None:
        """Check ``rows``, in pieces by the column ``piece`` (a date or text). Other pieces are not read."""
        part = F.col(piece).cast("string").alias("piece")
        if self.not_null:
            counted = rows.groupBy(part).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in self.not_null])
            nulls = counted.unpivot(["piece"], self.not_null, "column", "failures")
            sinks.write_dataset(nulls, f"{self.folder}/nulls", "overwrite_partitions", ["piece"])
        for columns in self.unique:
            texts = [F.col(c).cast("string") for c in columns]
            # the length before each text keeps ("a", "bc") and ("ab", "c") apart
            key = F.concat(*[F.concat(F.char_length(t).cast("string"), F.lit(":"), t) for t in texts])
            keyed = rows.select(part, key.alias("key"))
            # a piece without a key is written too, in place of what it had
            counts = keyed.groupBy("piece", "key").agg(F.count(F.lit(1)).alias("n"))
            sinks.write_dataset(counts, f"{self.folder}/keys/{'-'.join(columns)}", "overwrite_partitions", ["piece"])

    def _keys(self, columns: Sequence[str]) -> DataFrame:
        schema = T.StructType().add("key", T.StringType()).add("n", T.LongType()).add("piece", T.StringType())
        stored = landing.read_or_empty(self.spark, f"{self.folder}/keys/{'-'.join(columns)}", schema)
        return stored.where(F.col("key").isNotNull())

    def result(self) -> DataFrame:
        """``column, test, failures`` of the whole table, from the partials."""
        schema = T.StructType().add("column", T.StringType()).add("failures", T.LongType()).add("piece", T.StringType())
        stored = landing.read_or_empty(self.spark, f"{self.folder}/nulls", schema)
        wanted = self.spark.createDataFrame([(c,) for c in self.not_null], "column string")
        summed = stored.groupBy("column").agg(F.sum("failures").alias("failures"))
        found = wanted.join(F.broadcast(summed), "column", "left").select(
            "column", F.lit("not_null").alias("test"), F.coalesce("failures", F.lit(0)).cast("long").alias("failures")
        )
        for columns in self.unique:
            repeated = self._keys(columns).groupBy("key").agg(F.sum("n").alias("n")).where("n > 1")
            failures = repeated.agg(F.count(F.lit(1)).alias("failures"))
            found = found.unionByName(failures.select(F.lit(", ".join(columns)).alias("column"), F.lit("unique").alias("test"), "failures"))
        return found

    def repeats_in(self, columns: Sequence[str], pieces: Sequence[str], limit: int = lookup.BROADCAST_BYTES) -> DataFrame:
        """``key, n`` of the repeated values that occur in ``pieces``: their keys are looked up among all partials."""
        stored = self._keys(columns)
        own = stored.where(F.col("piece").isin(*pieces)).select("key").distinct()
        of_pieces = lookup.lookup_join(stored, own, "key", "left_semi", limit)
        return of_pieces.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1")

"""Dataset writes and table loads."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from time import time as clock
from typing import Literal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sectorlens import schemas, session
from sectorlens.functions import times
from sectorlens.operators import dedupe, lookup
from sectorlens.sources import landing

Mode = Literal["append", "overwrite", "overwrite_partitions"]


def write_dataset(
    df: DataFrame, path: str, mode: Mode = "overwrite", partition_cols: Sequence[str] = ()
) -> int:
    """Write Parquet, optionally split into ``column=value`` folders; returns the rows written.

    ``overwrite_partitions`` replaces only the folders that ``df`` has rows for.
    Rows are rebalanced on the partition columns first: small folders get few
    files, a folder with a third of all rows is split over many tasks and files.
    The rows are counted while they are written, not in a second pass.
    """
    if mode not in ("append", "overwrite", "overwrite_partitions"):
        raise ValueError(f"unknown write mode {mode!r}")
    if mode == "overwrite_partitions" and not partition_cols:
        raise ValueError("overwrite_partitions needs partition columns")
    if partition_cols:
        df = df.hint("rebalance", *[F.col(c) for c in partition_cols])
    written = Observation()
    df = df.observe(written, F.count(F.lit(1)).alias("n_rows"))
    writer = df.write.mode("append" if mode == "append" else "overwrite").option(
        "partitionOverwriteMode", "dynamic" if mode == "overwrite_partitions" else "static"
    )
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)
    return written.get["n_rows"]


def with_slot(bars: DataFrame) -> DataFrame:
    """Add ``date`` and ``slot`` (HHmm) of each bar's own UTC time.

    Taken from the row, not from the run, so that a first load of a month lands
    under the right days and a reload replaces exactly its own slots.
    """
    return bars.withColumn("date", times.utc_day(F.col("datetime"))).withColumn(
        "slot", times.hhmm_text(F.col("datetime"))
    )


def land_bars(bars: DataFrame, path: str) -> int:
    """Land fetched bars by day, each bar once; returns how many were new.

    A bar whose time and key are landed already, or that comes twice in the batch,
    is not added again, so a retried run changes nothing. Only the batch's days are read.
    """
    keys = ["datetime", *[k for k in schemas.BAR_KEY.values() if k in bars.columns]]
    dated = _one_per_key(bars, keys).withColumn("date", times.utc_day(F.col("datetime")))
    day = times.utc_day(F.col("datetime"))
    first, last = bars.agg(F.min(day), F.max(day)).first()
    stored = landing.read_or_empty(bars.sparkSession, path, dated.schema)
    near = stored.where(F.col("date").between(F.lit(first), F.lit(last)) | F.col("date").isNull())
    return write_dataset(dedupe.drop_seen(dated, near, keys), path, "append", ["date"])


def _one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, of copies that differ the one with the smallest hash, so that reruns agree.

    The fields of a bar have a fixed width, so they are hash-aggregated one by one, map-side first; a
    minimum of whole rows would sort all of them.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    placed = df.withColumn("__place", F.xxhash64(*rest))
    return placed.groupBy(*keys).agg(*[F.min_by(c, "__place").alias(c) for c in rest]).select(*df.columns)


def save_cleaned(bars: DataFrame, path: str) -> int:
    """Write cleaned bars by day and slot; a slot that comes again is replaced."""
    return write_dataset(with_slot(bars), path, "overwrite_partitions", ["date", "slot"])


def save_cleaned_days(bars: DataFrame, path: str) -> int:
    """The same by day alone, with the slot as a column: one folder a day instead of 96. Returns the rows written.

    For loads of many slots, and stores that are read more than written. The stored slots of the days in ``bars`` that do
    not come again are read, kept and written with the new ones; other days are not read.
    """
    spark, slotted = bars.sparkSession, with_slot(bars)
    slots = ["date", "slot"]
    again = session.pinned(slotted.select(*slots).distinct())  # 96 rows a day at most
    first, last = again.agg(F.min("date"), F.max("date")).first()
    stored = landing.read_or_empty(spark, path, slotted.schema)
    near = stored.where(F.col("date").between(F.lit(first), F.lit(last)) | F.col("date").isNull())
    day = F.coalesce(F.col("date").cast("string"), F.lit(""))
    mine = near.withColumn("__day", day)
    days = again.select(day.alias("__day")).distinct()
    # null-safe: bars without a time have neither a day nor a slot
    kept = dedupe.drop_seen(lookup.lookup_join(mine, days, "__day", "left_semi").drop("__day"), again, slots)
    kept = session.pinned(kept) if not again.isEmpty() else kept
    return write_dataset(kept.unionByName(slotted), path, "overwrite_partitions", ["date"])


def ensure_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    location: str | None = None,
    partition_cols: Sequence[str] = (),
) -> None:
    """Create the typed table unless it is there."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    split = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_cols)})" if partition_cols else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{split}{place}")


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}


def _reread_folders(spark: SparkSession, table: str) -> None:
    """Let readers see the partition folders below the table's location."""
    if _described(spark, table).get("Partition Provider") == "Catalog":
        spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def append_by_name(df: DataFrame, table: str) -> None:
    """Append, matching columns by name in any case.

    Columns the table lacks are left out, columns ``df`` lacks become null.
    """
    spark = df.sparkSession
    wanted = {name.lower() for name in spark.table(table).columns}
    shared = [name for name in df.columns if name.lower() in wanted]
    view = f"load_{uuid.uuid4().hex}"
    df.select(*shared).createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT INTO {table} BY NAME SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def append_new(
    df: DataFrame, table: str, keys: Sequence[str], time: str = "datetime"
) -> None:
    """Append the rows whose keys the table lacks, one per key, so a repeated load adds nothing.

    ``time`` is one of the keys. Stored rows outside the span of times in ``df``
    cannot match and are left out of the scan, so a load costs as much as its
    batch, not as the table. Safe against reruns, not against two loads of the
    same keys at the same time.
    """
    micros = F.unix_micros(time)
    first, last = (
        F.timestamp_micros(F.lit(end).cast("long"))
        for end in df.agg(F.min(micros), F.max(micros)).first()
    )
    in_span = F.col(time).between(first, last)
    stored = df.sparkSession.table(table).select(*keys)
    near = stored.where(in_span | F.col(time).isNull())
    append_by_name(dedupe.drop_seen(_one_per_key(df, keys), near, keys), table)


def full_refresh(df: DataFrame, table: str, folder: str, partition_cols: Sequence[str] = ()) -> int:
    """Replace all rows of a table; returns how many it has now.

    The new rows are written to a fresh folder below ``folder`` and only then is
    the table pointed at it. A failed write leaves the old rows in place, readers
    never see half a table, and ``df`` may itself read the table. If its columns changed, or the
    catalog lists its partitions, the table is dropped and created again over the written
    folder; readers that come in between find no table, and a run that fails there is repeated.
    """
    if not folder:
        raise ValueError(f"no folder given to refresh {table} in")
    spark = df.sparkSession
    target = f"{folder.rstrip('/')}/{table.split('.')[-1]}-{uuid.uuid4().hex}"
    df = df.select(*[c for c in df.columns if c not in partition_cols], *partition_cols)
    loaded = write_dataset(df, target, "overwrite", partition_cols)
    if spark.catalog.tableExists(table):
        same = spark.table(table).schema.simpleString() == df.schema.simpleString()
        if same and _described(spark, table).get("Partition Provider") != "Catalog":
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{target}'")
            spark.catalog.refreshTable(table)
            return loaded
        spark.sql(f"DROP TABLE {table}")
    ensure_table(spark, table, df.schema, target, partition_cols)
    if partition_cols:
        _reread_folders(spark, table)
    return loaded


def expire_folders(spark: SparkSession, table: str, folder: str, hours: float = 24) -> list[str]:
    """Remove folders that :func:`full_refresh` wrote for ``table`` and that it no longer points to; returns their names.

    A folder younger than ``hours`` stays, for readers that started before the table was repointed and for a
    refresh that is still writing. Nothing else below ``folder`` is touched. A table that is not there keeps its folders.
    """
    if not spark.catalog.tableExists(table):
        return []
    current = _described(spark, table)["Location"].rstrip("/").split("/")[-1]
    context = spark.sparkContext
    root = context._jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(context._jsc.hadoopConfiguration())
    limit = clock() * 1000 - hours * 3_600_000
    name = re.compile(re.escape(table.split(".")[-1]) + "-[0-9a-f]{32}")
    old = [
        entry.getPath()
        for entry in files.listStatus(root)
        if name.fullmatch(entry.getPath().getName())
        and entry.getPath().getName() != current
        and entry.getModificationTime() <= limit
    ]
    for path in old:
        files.delete(path, True)
    return sorted(path.getName() for path in old)


def refresh_days(
    df: DataFrame, table: str, folder: str, days: Sequence[str | None] | None = None, time: str = "datetime"
) -> int:
    """Keep a table by the UTC day of ``time``, and replace the rows of ``days`` only; returns how many were written.

    Only rows of the span of these days are read (the filter is on ``time`` itself, so it reaches the
    scan), and the folders of other days stay as they are. None among the days stands for rows without a
    time. A day for which ``df`` has no rows keeps what it has. Without ``days``, or if there is
    no such table yet, everything is replaced.
    """
    spark = df.sparkSession
    dated = df.withColumn("date", times.utc_day(F.col(time)))
    if (
        days is None
        or not spark.catalog.tableExists(table)
        or spark.table(table).schema.simpleString() != dated.schema.simpleString()
    ):
        return full_refresh(dated, table, folder, ["date"])
    known = sorted(day for day in days if day is not None)
    touched = F.col("date").isNull() if None in days else F.lit(False)
    if known:
        start, end = (times.run_time(f"{day} 00:00:00") for day in (known[0], known[-1]))
        span = (F.col(time) >= start) & (F.col(time) < end + F.expr("INTERVAL 24 HOURS"))
        dated = dated.where(span | F.col(time).isNull())
        touched = touched | F.col("date").isin(*[F.lit(day).cast("date") for day in known])
    location = _described(spark, table)["Location"]
    written = write_dataset(dated.where(touched), location, "overwrite_partitions", ["date"])
    _reread_folders(spark, table)
    return written


def materialize(
    df: DataFrame,
    database: str,
    name: str,
    folder: str,
    by_day: bool = False,
    days: Sequence[str | None] | None = None,
) -> int:
    """Store a model as a table of its layer's database, rebuilt on each run.

    Of a model kept ``by_day`` only ``days`` are rebuilt, if they are given.
    """
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{folder}'")
    if by_day:
        return refresh_days(df, f"{database}.{name}", folder, days)
    return full_refresh(df, f"{database}.{name}", folder)

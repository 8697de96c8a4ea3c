"""Micro-batch jobs. Each drains what has arrived and stops (``availableNow``).

Checkpoints and outputs belong in storage all executors share. A job that is
started again over the same files adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sectorlens import schemas
from sectorlens.functions import columns, times
from sectorlens.operators import bars as bar_ops
from sectorlens.operators import dedupe
from sectorlens.operators.ledger import KeyLedger
from sectorlens.operators.tiers import Tiers
from sectorlens.operators.toplist import TopList
from sectorlens.sources import landing
from sectorlens.streaming import previous


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    pattern: str = landing.PARQUET_FILES,
    files_per_batch: int | None = None,
    kind: str | None = None,
) -> DataFrame:
    """New Parquet files below ``path``. Bound the batch size for a large backlog.

    ``kind`` leaves files out that lie in a folder of the other kind of bars.
    """
    reader = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(path)
    return stream if kind is None else stream.where(landing.in_kind_folder(path, kind))


def follow_files(spark: SparkSession, path: str, inventory: str, files: str = landing.PARQUET_FILES) -> DataFrame:
    """Names of all files landed below ``path`` so far, kept below ``inventory``: ``path, modified, batch``.

    A stream over names keeps what it has seen. A call adds the files that are new, late ones in old folders as well, opens none of
    them, and readers of the inventory list nothing below ``path``. ``batch`` tells what a call has added.
    """
    schema = "path string, modificationTime timestamp, length long, content binary"
    reader = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", files)
    names = reader.load(path).select("path", F.col("modificationTime").alias("modified"))

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{inventory}/names/batch={batch_id}")

    (
        names.writeStream.option("checkpointLocation", f"{inventory}/seen")
        .trigger(availableNow=True)
        .foreachBatch(keep)
        .start()
        .awaitTermination()
    )
    kept = T.StructType.fromDDL("path string, modified timestamp, batch long")
    return landing.read_or_empty(spark, f"{inventory}/names", kept)


def _keep_state_on_disk(spark: SparkSession) -> None:
    """Hold streaming state in RocksDB instead of the executors' heap.

    A batch then uploads its changes only, not a snapshot of all state.
    """
    store = "spark.sql.streaming.stateStore"
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    spark.conf.set(f"{store}.providerClass", provider)
    spark.conf.set(f"{store}.rocksdb.changelogCheckpointing.enabled", "true")


def _append(df: DataFrame, path: str, checkpoint: str, partition_cols: tuple = ()) -> None:
    writer = (
        df.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.format("parquet").start(path).awaitTermination()


def clean_and_append(landed: DataFrame, kind: str, path: str, checkpoint: str) -> None:
    """Clean newly landed bars and append them by day.

    Bars whose time cannot be read go to the default partition, where the
    not-null check finds them.
    """
    cleaned = columns.clean_bars(landed, kind).withColumn("date", times.utc_day(F.col("datetime")))
    _append(cleaned, path, checkpoint, ("date",))


def append_new_news(news: DataFrame, path: str, checkpoint: str, delay: str = "2 days") -> None:
    """Append news whose key was not seen within ``delay`` of its publication.

    State is bounded by ``delay``: a copy that comes later than that is stored
    again, and news older than the watermark is dropped. Choose it longer than
    the vendor repeats an article; :func:`ingest_new_news` has no such limit.
    News without a time cannot be tracked and is left to that job as well.

    Copies are first removed per input partition, so that an article repeated in
    a third of all rows reaches the task of its key once per partition.
    """
    _keep_state_on_disk(news.sparkSession)
    keys, part = list(schemas.NEWS_KEYS), "__partition"
    timed = news.where(F.col("pubdate").isNotNull()).withColumn(part, F.spark_partition_id())
    once_per_part = timed.withWatermark("pubdate", delay).dropDuplicatesWithinWatermark(
        [*keys, part]
    )
    _append(once_per_part.drop(part).dropDuplicatesWithinWatermark(keys), path, checkpoint)


def ingest_new_news(
    news: DataFrame, path: str, checkpoint: str, ledger: KeyLedger | None = None
) -> None:
    """Append news whose key is not stored yet, whenever it was published.

    Each batch is reduced to one row per key (map-side first) and compared with
    the keys of all earlier batches. A repeated batch replaces its own folder. With a ``ledger``
    no earlier batch is read: their keys are entered under their numbers, and only the buckets that
    the batch has keys of are scanned.
    """
    spark = news.sparkSession
    stored_schema = T.StructType([*news.schema.fields, T.StructField("batch", T.LongType())])

    def add(batch: DataFrame, batch_id: int) -> None:
        if ledger is not None:
            seen = ledger.seen(batch, before=batch_id)
        else:
            stored = landing.read_or_empty(spark, f"{path}", stored_schema)
            seen = stored.where(F.col("batch") < batch_id).select(*schemas.NEWS_KEYS)
        fresh = dedupe.new_unique(batch, seen, schemas.NEWS_KEYS, "pubdate")
        fresh.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if ledger is not None:
            ledger.add(spark.read.schema(batch.schema).parquet(f"{path}/batch={batch_id}"), batch_id)

    (
        news.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(add)
        .start()
        .awaitTermination()
    )


def keep_newest_news(news: DataFrame, store: TopList, checkpoint: str) -> None:
    """Merge each batch of news into the newest rows per company; a repeated batch changes nothing."""
    (
        news.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, batch_id: store.load(batch, batch_id) and None)
        .start()
        .awaitTermination()
    )


def tick_bars(
    ticks: DataFrame,
    key: str,
    path: str,
    checkpoint: str,
    width: str = times.BAR_WIDTH,
) -> None:
    """Keep bars per key and window up to date from a tick stream.

    Every batch writes the partial bars of its own ticks to its own folder, so a batch
    that is repeated after a failure replaces itself. :func:`read_tick_bars` merges the
    parts of each bar. A tick may come as late as it likes: there is no watermark behind
    which ticks are dropped, and no state that grows with the number of windows. Batches are merged in
    size tiers, so that a reader opens a number of folders that grows with the logarithm of theirs.
    """
    parts_of = _bar_tiers(ticks.sparkSession, path, key)

    def write_parts(batch: DataFrame, batch_id: int) -> None:
        parts = bar_ops.partial_bars(batch, [key], width)
        parts.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        parts_of.add(batch_id, f"{path}/batch={batch_id}")

    (
        ticks.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write_parts)
        .start()
        .awaitTermination()
    )


def _bar_tiers(spark: SparkSession, path: str, key: str) -> Tiers:
    return Tiers(spark, path, lambda parts: bar_ops.merge_partial(parts, [key]))


def read_tick_bars(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Each bar of all its ticks so far, merged from the parts of the batches."""
    return bar_ops.widen(_bar_tiers(spark, path, key).read(), [key])


def _changes(stock_sector: DataFrame, keep: str | None) -> DataFrame:
    _keep_state_on_disk(stock_sector.sparkSession)
    return previous.stream_previous(stock_sector, "sector", "datetime", "high", "prev_high", keep)


def follow_sector_changes(
    stock_sector: DataFrame, path: str, checkpoint: str, keep: str | None = None
) -> None:
    """Store each sector bar with the high before it, corrected when bars come late.

    The previous bar is state of the stream: a batch reads its own bars and the state of their
    days, never the stored history. A late bar adds a row for itself and a corrected one for
    its successor. ``keep`` bounds the state; see :func:`previous.stream_previous`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    (
        _changes(stock_sector, keep)
        .writeStream.outputMode("update" if keep is None else "append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
        .awaitTermination()
    )


def _moved(rows: DataFrame) -> DataFrame:
    latest = previous.latest_rows(rows, "sector", "datetime", "high", "prev_high")
    return latest.where(F.col("prev_high").isNotNull())


def read_sector_changes(spark: SparkSession, path: str) -> DataFrame:
    """The last correction of each bar, as :func:`marts.sector_change` has it."""
    return _moved(spark.read.parquet(path)).select(
        "datetime",
        "sector",
        "high",
        "prev_high",
        times.relative_change(F.col("high"), F.col("prev_high")).alias("diff_percent"),
    )


def follow_top_sector(
    stock_sector: DataFrame, path: str, checkpoint: str, keep: str | None = None
) -> None:
    """After each batch of new sector bars, store which sector leads.

    Previous bars are stream state, as in :func:`follow_sector_changes`. Besides the answer, each batch
    keeps the changes at the newest time (a row a sector); the next batch needs only these and
    its own corrections. Should a late bar without a high leave no change at that time, the stored
    corrections are asked once for the newest time before it.
    """
    spark = stock_sector.sparkSession

    def answer(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/changes/batch={batch_id}")
        own = spark.read.schema(batch.schema).parquet(f"{path}/changes/batch={batch_id}")
        schema = T.StructType([*batch.schema.fields, T.StructField("batch", T.LongType())])
        leads = landing.read_or_empty(spark, f"{path}/lead", schema).where(F.col("batch") < batch_id)
        newest = leads.agg(F.max("batch")).first()[0]
        before = leads.where(F.col("batch") == newest).drop("batch")
        micros = F.unix_micros("datetime")
        led, changed = before.agg(F.max(micros)).first()[0], _moved(before.unionByName(own))
        at = changed.agg(F.max(micros)).first()[0]
        if led is not None and (at is None or at < led):
            stored = spark.read.schema(schema).parquet(f"{path}/changes")
            changed = _moved(stored.where(F.col("batch") <= batch_id).drop("batch"))
            at = changed.agg(F.max(micros)).first()[0]
        lead = changed.where(micros == F.lit(at)).select(*batch.columns)
        lead.write.mode("overwrite").parquet(f"{path}/lead/batch={batch_id}")
        rise = times.relative_change(F.col("high"), F.col("prev_high")).alias("diff_percent")
        kept = spark.read.schema(batch.schema).parquet(f"{path}/lead/batch={batch_id}")
        top = kept.select("datetime", "sector", "high", "prev_high", rise)
        top = top.orderBy(F.col("diff_percent").desc_nulls_last(), "sector").limit(1)
        top.write.mode("overwrite").parquet(f"{path}/top/batch={batch_id}")

    (
        _changes(stock_sector, keep)
        .writeStream.outputMode("update" if keep is None else "append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(answer)
        .start()
        .awaitTermination()
    )


def read_top_sector(spark: SparkSession, path: str) -> DataFrame:
    """The answer after the newest batch."""
    stored = spark.read.parquet(f"{path}/top")
    newest = stored.agg(F.max("batch").alias("batch"))
    return stored.join(F.broadcast(newest), "batch").drop("batch")

"""Sharding by a two-pass external shuffle, with DataFrame functions only.

Pass one scatters the records uniformly into buckets that fit in memory, by a
seeded hash of id and text. Pass two gathers each bucket, puts it through Spark's
``shuffle`` (a Fisher-Yates shuffle of the array with a seed) and writes it. The
law is ``rows``: buckets stand one after another, and shard s takes the positions
from floor(s*n/shards) to floor((s+1)*n/shards), so that counts differ by one at
most and a bucket goes to one file or two.

The bucket order inside a task and the order inside a bucket before the shuffle (by the hash of id and text, then
by that of the whole record) are fixed by a sort and the number of partitions is fixed, so a lost task writes the same rows again.
Nulls: a null text is no bytes; null ids hash like any value. Copies with ids of
their own spread over all buckets. Rows equal in id and text share one, unless they are ``HEAVY`` (their hash has
more than that share of a bucket): then equal records are counted before they are moved, each copy gets a number,
and the whole record and the number are hashed, so that copies spread as well and a rerun places them alike. An empty table gives an empty result; any other columns travel
along inside the struct ``record``, so that no name can clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sectorlens.llm.common import whole_text
from sectorlens.operators.lookup import lookup_join
from sectorlens.session import pinned

#: A bucket of text is gathered by one task; beyond ``MOST_BUCKETS`` of them buckets grow instead (1 GB each at 100 TB).
BUCKET_BYTES, MOST_BUCKETS = 16 * 1024 * 1024, 100_000
HEAVY = 0.25
#: Copies of one record that one row stands for, so that a crowd is not one task's work.
COPIES_A_ROW = 10_000


def _hashable(docs: DataFrame) -> list[Column]:
    """The columns; those that hold a map, which has no hash, as JSON."""
    return [F.to_json(F.col(f"`{f.name}`")) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in docs.schema]


def numbered(docs: DataFrame, order: Column, seed: int, heavy_bytes: float) -> DataFrame:
    """order, record and own (the hash of the whole record) of every row; ``order`` differs between the copies of heavy rows.

    There is one heavy hash per ``heavy_bytes`` of input at most; they are copied to the tasks if they measure small.
    """
    record = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record")
    given = docs.select(order.alias("order"), record, F.xxhash64(F.lit(seed), *_hashable(docs)).alias("own"))
    size = (F.octet_length(whole_text()) + 1).cast("long")
    heavy = docs.select(order.alias("order"), size.alias("size")).groupBy("order").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    heavy = pinned(heavy.filter((F.col("bytes") > heavy_bytes) & (F.col("rows") > 1)).select("order"))
    if heavy.isEmpty():
        return given
    light = lookup_join(given, heavy, "order", "left_anti").select("order", "record", "own")
    crowd = lookup_join(given, heavy, "order", "left_semi")
    counted = crowd.groupBy("record", "own").agg(F.count("*").alias("n"))
    tens = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / COPIES_A_ROW).cast("long")))
    blocks = counted.select("record", "own", "n", tens.alias("ten")).repartition("own", "ten")
    upto = F.least(F.col("n"), (F.col("ten") + 1) * COPIES_A_ROW) - 1
    copies = blocks.select("record", "own", F.explode(F.sequence(F.col("ten") * COPIES_A_ROW, upto)).alias("copy"))
    return light.unionAll(copies.select(F.xxhash64(F.lit(seed), "own", "copy").alias("order"), "record", "own"))


def shuffled(docs: DataFrame, shards: int, seed: int = 23, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """record, shard, slot for every row of ``docs`` (which needs doc_id and text)."""
    size = F.octet_length(whole_text()) + 1
    total = docs.agg(F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()[0]
    bucket_bytes = max(bucket_bytes, math.ceil(total / MOST_BUCKETS))
    buckets = max(1, math.ceil(total / bucket_bytes))
    order = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    scattered = numbered(docs, order, seed, HEAVY * bucket_bytes).select(
        F.pmod("order", F.lit(buckets)).cast("int").alias("bucket"), "order", "record", "own"
    )
    counts = scattered.groupBy("bucket").agg(F.count("*").alias("n"))
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pinned(counts.select(
        F.col("bucket").alias("bucket_"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"),
        F.sum("n").over(Window.partitionBy()).alias("rows"),
    ))
    gathered = (
        scattered.repartition(buckets, "bucket")
        .sortWithinPartitions("bucket", "order", "own")
        .groupBy("bucket")
        .agg(F.collect_list("record").alias("records"))
        .select("bucket", F.posexplode(F.shuffle("records", F.lit(seed))).alias("nth", "record"))
    )
    at = F.col("offset") + F.col("nth")
    placed = lookup_join(gathered, offsets, gathered.bucket == offsets.bucket_).withColumn("at", at)
    # the last shard that starts at or before the position
    shard = F.expr(f"((at + 1) * {shards} - 1) div rows").cast("int")
    placed = placed.withColumn("shard", shard)
    return placed.select("record", "shard", (F.col("at") - F.expr(f"(shard * rows) div {shards}")).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int, seed: int = 23, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Writes the shuffled records to ``path``, one folder per shard."""
    shuffled(docs, shards, seed, bucket_bytes).write.mode("overwrite").partitionBy("shard").parquet(path)

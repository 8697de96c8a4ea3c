"""Value of the previous row in time, per key."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sectorlens import session

#: Distinct rows that one range of time holds, about.
RANGE_ROWS = 100_000
#: The limits of the ranges are a parameter of the plan; more rows make larger ranges instead of more.
MOST_RANGES = 4096


def time_limits(merged: DataFrame, range_rows: int) -> list[float]:
    """Times (microseconds) that cut the rows into ranges of about ``range_rows`` each: quantiles of the rows themselves."""
    ranges = min(MOST_RANGES, math.ceil(merged.count() / range_rows))
    if ranges < 2:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    found = merged.agg(F.percentile_approx("__time", shares, 10 * ranges).alias("times")).first()[0]
    return [float(t) for t in sorted(set(found))]


def in_ranges(merged: DataFrame, limits: Sequence[float]) -> DataFrame:
    """Adds ``__range``, the number of the range that ``__time`` lies in: a binary search in the JVM."""
    if not limits:
        return merged.withColumn("__range", F.lit(0.0))
    # microseconds are whole numbers below 2**53 until the year 2255, so a double holds them exactly
    at = merged.withColumn("__at", F.col("__time").cast("double"))
    splits = [float("-inf"), *limits, float("inf")]
    return Bucketizer(splits=splits, inputCol="__at", outputCol="__range").transform(at).drop("__at")


def with_previous(
    rows: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    out: str,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``keys, time, value, copies`` and ``out``: ``value`` at the time just before.

    Rows of one key and time count as one row with the greatest ``value``;
    ``copies`` tells how many there were. They are merged map-side, so copies do
    not gather in a task. Rows without a time have no place in the order and are
    left out.

    A plain window would put the whole history of a key into one task, and there
    are only a handful of sectors. Here a task gets one key and one range of time, of about ``range_rows``
    rows of all keys at most: the limits are quantiles of the rows, so a key with half of all rows
    within one minute is cut within that minute. The last value of the key's range before is added as a
    carried row, so that the first row of a range has its predecessor as well. Only one row
    per key and range is ever ordered per key.
    """
    same, held = value == time, "__time" if value == time else "__value"
    parts = rows.where(F.col(time).isNotNull()).select(
        *keys, F.unix_micros(time).alias("__time"), *([] if same else [F.col(value).alias("__value")])
    )
    greatest = [] if same else [F.max("__value").alias("__value")]
    # fixed-width values are hash-aggregated; the rows are kept, since limits and ranges both read them
    merged = session.pinned(parts.groupBy(*keys, "__time").agg(*greatest, F.count(F.lit(1)).alias("copies")))
    cut = in_ranges(merged, time_limits(merged, range_rows)).withColumn("__held", F.col(held))
    last = F.max("__time") if same else F.max_by("__value", "__time")
    tails = cut.groupBy(*keys, "__range").agg(last.alias("__held"))
    over_ranges = Window.partitionBy(*keys).orderBy("__range")
    carried = tails.select(*keys, "__range", F.lag("__held", 1).over(over_ranges).alias("__held"))
    stacked = cut.unionByName(carried, allowMissingColumns=True)
    # carried rows have no time and sort first
    in_range = Window.partitionBy(*keys, "__range").orderBy(F.asc_nulls_first("__time"))
    paired = stacked.withColumn("__before", F.lag("__held", 1).over(in_range)).where(F.col("__time").isNotNull())
    moment = F.timestamp_micros("__time").alias(time)
    if same:
        return paired.select(*keys, moment, "copies", F.timestamp_micros("__before").alias(out))
    return paired.select(*keys, moment, "copies", F.col("__before").alias(out), F.col("__value").alias(value))

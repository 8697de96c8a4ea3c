"""The leading sector from a small state: one row for each sector and day.

A day's row has its first bar, its last bar, and the newest bar whose predecessor within the day has a known
high. Rows of later days merge onto earlier ones: a day's first bar follows the last bar
before it, and the newest such bar stands. So a load rebuilds the rows of its own days, late
bars among them, and the answer reads these rows only; no bar is read again and no span is guessed.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sectorlens.functions import times
from sectorlens.operators import sinks
from sectorlens.sources import landing

_BAR = "struct<at:bigint,high:double>"
_MOVE = "struct<at:bigint,high:double,prev_high:double>"
_STATE = f"struct<last:{_BAR},lead:{_MOVE}>"


def day_leads(stock_sector: DataFrame) -> DataFrame:
    """``sector, date, first, last, lead`` of each sector and UTC day; equal times count as one bar with the greatest high.

    A task holds the bars of one sector and day.
    """
    bars = stock_sector.where(F.col("datetime").isNotNull()).groupBy("sector", "datetime").agg(F.max("high").alias("high"))
    bar = F.struct(F.unix_micros("datetime").alias("at"), F.col("high").cast("double").alias("high"))
    days = bars.groupBy("sector", times.utc_day(F.col("datetime")).alias("date")).agg(F.sort_array(F.collect_list(bar)).alias("bars"))
    at = lambda i: F.get("bars", i)
    moved = F.filter(F.sequence(F.lit(0), F.size("bars") - 1), lambda i: (i > 0) & at(i - 1)["high"].isNotNull())
    newest = F.array_max(moved)
    lead = F.when(newest.isNotNull(), F.struct(at(newest)["at"].alias("at"), at(newest)["high"].alias("high"), at(newest - 1)["high"].alias("prev_high")))
    return days.select("sector", at(F.lit(0)).alias("first"), F.element_at("bars", -1).alias("last"), lead.alias("lead"), "date")


def _onto(before: Column, day: Column) -> Column:
    """The state after a later day."""
    across = F.when(
        before["last"]["high"].isNotNull(),
        F.struct(day["first"]["at"].alias("at"), day["first"]["high"].alias("high"), before["last"]["high"].alias("prev_high")),
    )
    return F.struct(day["last"].alias("last"), F.coalesce(day["lead"], across, before["lead"]).cast(_MOVE).alias("lead")).cast(_STATE)


def top_sector_of(leads: DataFrame, direction: Literal["signed", "abs"] = "signed") -> DataFrame:
    """The row of :func:`marts.stock_top_sector` from the rows of :func:`day_leads`: a fold over each sector's days."""
    day = F.struct("date", "first", "last", "lead")
    days = leads.groupBy("sector").agg(F.sort_array(F.collect_list(day)).alias("days"))
    start = F.struct(F.lit(None).cast(_BAR).alias("last"), F.lit(None).cast(_MOVE).alias("lead")).cast(_STATE)
    newest = days.select("sector", F.aggregate("days", start, _onto, lambda s: s["lead"]).alias("lead")).where(F.col("lead").isNotNull())
    change = times.relative_change(F.col("lead.high"), F.col("lead.prev_high"))
    moved = newest.select(
        F.timestamp_micros("lead.at").alias("datetime"), "sector", "lead.high", "lead.prev_high", change.alias("diff_percent")
    )
    largest = F.col("diff_percent") if direction == "signed" else F.abs("diff_percent")
    return moved.orderBy(F.col("datetime").desc_nulls_last(), largest.desc_nulls_last(), "sector").limit(1)


def refresh_day_leads(stock_sector: DataFrame, path: str, days: Sequence[str] | None = None) -> int:
    """Store the rows of ``days``, or of all days; returns how many. Only bars of the span of these days are read."""
    bars = stock_sector
    if days:
        start, end = (times.run_time(f"{day} 00:00:00") for day in (min(days), max(days)))
        bars = bars.where((F.col("datetime") >= start) & (F.col("datetime") < end + F.expr("INTERVAL 24 HOURS")))
        bars = bars.where(times.utc_day(F.col("datetime")).isin(*[F.lit(day).cast("date") for day in days]))
    return sinks.write_dataset(day_leads(bars), path, "overwrite_partitions" if days else "overwrite", ["date"])


def read_day_leads(spark: SparkSession, path: str) -> DataFrame:
    fields = {"sector": "string", "first": _BAR, "last": _BAR, "lead": _MOVE, "date": "date"}
    schema = T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in fields.items()))
    return landing.read_or_empty(spark, path, schema)

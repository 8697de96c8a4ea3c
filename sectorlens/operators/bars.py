"""Bars from ticks, wider bars from bars, last bars and freshness."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sectorlens.functions import times
from sectorlens.operators import lookup


class DataNotFound(Exception):
    """A key has no bar at the time it should have one."""


def tick_order(ts: Column, seq: Column) -> Column:
    """One number that orders ticks by time, then by sequence number.

    A decimal fits into the fixed-width aggregation buffer, so first/last can be
    hash-aggregated; a ``struct(ts, seq)`` would force a sort of every input row.
    """
    micros = F.unix_micros(ts).cast("decimal(19,0)")
    place = F.lit(Decimal(10**19))
    sequence = F.coalesce(seq, F.lit(0)).cast("decimal(19,0)")
    return (micros * place + sequence).cast("decimal(38,0)")


def _trades(ticks: DataFrame) -> DataFrame:
    return ticks.where(F.col("ts").isNotNull() & F.col("price").isNotNull())


def partial_bars(ticks: DataFrame, keys: Sequence[str], width: str = times.BAR_WIDTH) -> DataFrame:
    """Bars with ``first_at`` and ``last_at``, from which :func:`widen` merges bars of the same window."""
    order = tick_order(F.col("ts"), F.col("seq"))
    slot = F.window("ts", width)
    # A stream drops old state by the whole window; its start alone is a smaller key.
    slot = slot if ticks.isStreaming else slot["start"]
    sizes = ["size"] if "size" in ticks.columns else []
    volume = F.sum("size") if sizes else F.count(F.lit(1))
    return (
        _trades(ticks)
        .select(*keys, "ts", "price", *sizes, order.alias("at"))
        .groupBy(*keys, slot.alias("slot"))
        .agg(
            F.min_by("price", "at").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "at").alias("close"),
            volume.alias("volume"),
            F.min("at").alias("first_at"),
            F.max("at").alias("last_at"),
        )
        .select(
            F.col("slot.start" if ticks.isStreaming else "slot").alias("datetime"),
            *keys,
            "open",
            "high",
            "low",
            "close",
            "volume",
            "first_at",
            "last_at",
        )
    )


def ohlcv(ticks: DataFrame, keys: Sequence[str], width: str = times.BAR_WIDTH) -> DataFrame:
    """Open, high, low, close and volume per key and time window.

    ``ticks`` has ``ts``, ``price`` and ``seq`` (the order of ticks with equal
    time). Volume is the sum of ``size``, or the number of ticks if they have
    none. All aggregates combine map-side, so a hot key sends one row per
    window and task. Works on batch and streaming frames.
    """
    return partial_bars(ticks, keys, width).drop("first_at", "last_at")


def slot_bars(
    ticks: DataFrame,
    keys: Sequence[str],
    now: datetime | str | Column,
    width: str = times.BAR_WIDTH,
) -> DataFrame:
    """Only the bars of the slot a run at ``now`` expects.

    Ticks outside the slot are left out by a range on their time, which reaches
    the scan; a filter on the finished bars would not.
    """
    start = times.target_slot(now)
    end = start + F.expr(f"INTERVAL {width}")
    found = ohlcv(ticks.where((F.col("ts") >= start) & (F.col("ts") < end)), keys, width)
    return found.where(F.col("datetime") == start)


def _merged(bars: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    return bars.groupBy("datetime", *keys).agg(
        F.min_by("open", "first_at").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "last_at").alias("close"),
        F.sum("volume").alias("volume"),
        *more,
    )


def widen(bars: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge bars with ``first_at``/``last_at`` into bars per ``keys``."""
    return _merged(bars, keys)


def merge_partial(bars: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge bars of the same window into one that can be merged further."""
    ends = (F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"))
    return _merged(bars, keys, *ends)


def sector_bars(
    ticks: DataFrame,
    companies: DataFrame,
    industries: DataFrame,
    width: str = times.BAR_WIDTH,
    limit: int = lookup.BROADCAST_BYTES,
) -> DataFrame:
    """Bars per sector from ticks per company.

    If the sectors of all companies measure small, they are broadcast: one pass,
    one shuffle of partial bars. Otherwise ticks shrink to company bars first, which also
    spreads a hot company over its windows, and only those bars are joined.
    """
    parents = industries.select("industry_key", F.col("sector_key").alias("sector"))
    members = companies.select("company_symbol", "industry_key")
    in_sector = members.join(parents.where(F.col("sector").isNotNull()), "industry_key").drop(
        "industry_key"
    )
    if lookup.fits_broadcast(in_sector, limit):
        return ohlcv(ticks.join(F.broadcast(in_sector), "company_symbol"), ["sector"], width)
    company_bars = partial_bars(ticks, ["company_symbol"], width)
    return widen(company_bars.join(in_sector, "company_symbol"), ["sector"])


def last_bar(bars: DataFrame, key: str) -> DataFrame:
    """Newest bar of each key. Only a running maximum per key and task is shuffled.

    The fields of a bar have a fixed width, so they are hash-aggregated one by one.
    Of several bars with the newest time one is taken whole, the same in every run.
    """
    rest = [name for name in bars.columns if name not in (key, "datetime")]
    place = tick_order(F.col("datetime"), F.xxhash64(*rest) if rest else F.lit(0)).alias("__place")
    placed = bars.select(key, "datetime", *rest, place)
    fields = [F.max_by(name, "__place").alias(name) for name in rest]
    return placed.groupBy(key).agg(F.max("datetime").alias("datetime"), *fields)


def stale_keys(
    keys: DataFrame, bars: DataFrame, key: str, now: datetime | str | Column
) -> DataFrame:
    """Keys whose newest bar is missing or is not in the slot a run at ``now`` expects."""
    slot = times.target_slot(now)
    arrived = bars.groupBy(key).agg(F.max("datetime").alias("last_datetime"))
    reported = keys.select(key).where(F.col(key).isNotNull()).join(arrived, key, "left")
    status = (
        F.when(F.col("last_datetime").isNull(), "missing")
        .when(F.date_trunc("minute", "last_datetime") != slot, "stale")
    )
    return reported.withColumn("status", status).where(F.col("status").isNotNull())


def require_fresh(stale: DataFrame, key: str) -> None:
    """Raise when :func:`stale_keys` reported anything; shows a few of the keys."""
    found = stale.take(5)
    if found:
        raise DataNotFound(", ".join(f"{row[key]}: {row['status']}" for row in found))

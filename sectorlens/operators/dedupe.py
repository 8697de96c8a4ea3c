"""Rows already seen, and repeated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_seen(new: DataFrame, seen: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose keys are not in ``seen``; null keys equal each other.

    Repeats inside ``new`` stay. The keys are compared as one struct, whose null
    fields match. ``seen`` is reduced to distinct columns first and shuffled again
    as a struct: with nothing but a shuffle below the join on either side,
    adaptive execution can split a hot key of ``new``.
    """
    if seen is None:
        return new
    key = F.struct(*keys)
    ledger = seen.select(*keys).distinct().select(key.alias("__key"))
    return new.withColumn("__key", key).join(ledger, "__key", "left_anti").drop("__key")


def new_unique(
    batch: DataFrame, seen: DataFrame | None, keys: Sequence[str], newest: str
) -> DataFrame:
    """One row per key of ``batch`` that is not in ``seen``.

    Among repeats the row with the greatest ``newest`` wins (then the greatest
    remaining columns, so that a rerun gives the same row). Rows without a full key
    are no repeats of each other unless they are equal throughout. The batch is
    reduced before it meets the stored keys, which are never sorted with it.
    """
    apart, rest = _apart(batch, keys, newest)
    rows = batch.select(*keys, apart, F.struct(*rest).alias("row"))
    single = rows.groupBy(*keys, "__apart").agg(F.max("row").alias("row"))
    return drop_seen(single.select(*keys, "row.*").select(*batch.columns), seen, keys)


def _apart(batch: DataFrame, keys: Sequence[str], newest: str) -> tuple[Column, list[str]]:
    """What tells rows without a full key apart (null for others), and the columns that are no keys, ``newest`` first."""
    rest = [newest, *[c for c in batch.columns if c not in (*keys, newest)]]
    keyless = F.lit(False)
    for key in keys:
        keyless = keyless | F.col(key).isNull()
    return F.when(keyless, F.xxhash64(*rest)).alias("__apart"), rest


def heads(batch: DataFrame, keys: Sequence[str], newest: str) -> DataFrame:
    """The rows that :func:`new_unique` keeps of a batch, as ``keys``, ``__apart`` and ``newest`` alone.

    For batches of wide rows: what is stored already is found with these columns, and :func:`rows_of`
    gets the rest of the rows that are left.
    """
    apart, _ = _apart(batch, keys, newest)
    return batch.select(*keys, apart, newest).groupBy(*keys, "__apart").agg(F.max(newest).alias(newest))


def rows_of(batch: DataFrame, kept: DataFrame, keys: Sequence[str], newest: str) -> DataFrame:
    """The whole rows of ``batch`` that ``kept``, some of its :func:`heads`, stand for.

    Both sides meet in one aggregate, combined map-side: a row is moved once, and copies of it not at all.
    """
    apart, (_, *rest) = _apart(batch, keys, newest)
    at = [*keys, "__apart", newest]
    whole = batch.select(*keys, apart, newest, F.struct(*rest).alias("row"), F.lit(False).alias("__kept"))
    asked = kept.select(*at, F.lit(None).cast(whole.schema["row"].dataType).alias("row"), F.lit(True).alias("__kept"))
    met = whole.unionByName(asked).groupBy(*at).agg(F.max("row").alias("row"), F.max("__kept").alias("__kept"))
    return met.where(F.col("__kept") & F.col("row").isNotNull()).select(*keys, newest, "row.*").select(*batch.columns)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key by explicit ``order`` columns; null keys equal each other.

    A running minimum, combined map-side: no sort of a whole group, and the
    result does not depend on the order in which rows arrive.
    """
    rest = [c for c in df.columns if c not in (*keys, *order)]
    firsts = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("row"))
    return firsts.select(*keys, "row.*").select(*df.columns)

"""Bars by industry, rebuilt for exactly the days that a load or a change of the master data touches."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sectorlens.functions import times
from sectorlens.operators import lookup, sinks
from sectorlens.plans import marts
from sectorlens.sources import landing

#: Columns of the company detail that the model shows.
SHOWN = ["company_name", "industry_name", "sector_key"]
INDEX = T.StructType().add("company_symbol", T.StringType()).add("date", T.DateType())


def changed_symbols(before: DataFrame, now: DataFrame) -> DataFrame:
    """Symbols of companies whose shown columns differ between two versions of the detail, or that only one has."""
    row = F.struct(*[F.col(c).cast("string").alias(c) for c in SHOWN])
    # several rows of a symbol are compared as one ordered list
    side = lambda df, name: df.where(F.col("company_symbol").isNotNull()).groupBy("company_symbol").agg(F.sort_array(F.collect_list(row)).alias(name))
    both = side(before, "was").join(side(now, "is"), "company_symbol", "full")
    return both.where(~F.col("was").eqNullSafe(F.col("is"))).select("company_symbol")


def index_days(bars: DataFrame, path: str, days: Iterable[str | None] | None = None) -> None:
    """Store which symbols have bars on which day: for ``days`` anew, or for all."""
    dated = bars.select("company_symbol", times.utc_day(F.col("datetime")).alias("date"))
    if days is not None:
        dated = dated.where(_among(days))
    seen = dated.where(F.col("company_symbol").isNotNull()).distinct()
    sinks.write_dataset(seen, path, "overwrite" if days is None else "overwrite_partitions", ["date"])


def _among(days: Iterable[str | None]):
    days = list(days)
    known = F.col("date").isin(*[F.lit(day).cast("date") for day in days if day is not None])
    return known | F.col("date").isNull() if None in days else known


def days_of(symbols: DataFrame, index: DataFrame) -> list[str | None]:
    """Days on which any of ``symbols`` has a bar; at most one entry a day. None stands for bars without a time."""
    touched = lookup.lookup_join(index, symbols, "company_symbol", "left_semi").select("date").distinct()
    return sorted((r[0] for r in touched.select(F.col("date").cast("string")).collect()), key=lambda day: day or "")


def refresh_stock_with_industry(
    raw: Mapping[str, DataFrame], database: str, folder: str, loaded_days: Iterable[str | None] | None = ()
) -> list[str | None] | None:
    """Bring the stored bars by industry up to date; returns the days that were rebuilt, None for all.

    The detail the table was last built from is stored beside it and compared with the present one. Days of changed
    companies come from an index (symbol, day) of the stored bars, so the caller names only the days that bars were loaded
    for (None: all). Folders of other days are not touched. The stored detail is replaced last: a run
    that failed is simply repeated. A day whose rows all vanish keeps its folder.
    """
    spark, table = raw["stock_company"].sparkSession, f"{database}.stock_with_industry"
    lookups = (raw["company_info"], raw["industry_info"], raw["sector_info"])
    detail = marts.company_detail(*lookups).select("company_symbol", *SHOWN)
    model = marts.stock_with_industry(raw["stock_company"], *lookups)
    index = f"{folder.rstrip('/')}/symbol_days"
    seen = f"{database}.company_detail_seen"
    if loaded_days is None or not spark.catalog.tableExists(table) or not spark.catalog.tableExists(seen):
        days = None
    else:
        moved = changed_symbols(spark.table(seen), detail)
        days = sorted({*loaded_days, *days_of(moved, landing.read_or_empty(spark, index, INDEX))}, key=lambda day: day or "")
    if days is None or loaded_days:
        index_days(raw["stock_company"], index, None if days is None else loaded_days)
    if days is None or days:
        sinks.materialize(model, database, "stock_with_industry", folder, True, days)
    sinks.materialize(detail, database, "company_detail_seen", folder)
    return days

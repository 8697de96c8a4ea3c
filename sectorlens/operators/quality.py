"""Data checks. Each returns the violations as a frame; no rows means it passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sectorlens.functions import times
from sectorlens.operators.previous import with_previous

# The checks declared for each table, as (columns that must not be
# null, columns that must be unique).
DECLARED = {
    "company_info": (["company_symbol"], ["company_symbol"]),
    "industry_info": (["industry_key"], ["industry_key"]),
    "sector_info": (["sector_key"], ["sector_key"]),
    "news": (["content_id", "company_key"], []),
    "stg_company_detail": (["company_symbol"], ["company_symbol"]),
    "stg_stock_top_sector": (["diff_percent"], []),
    "stg_company_sector_con": (["company_symbol", "company_name", "industry_key", "sector"], []),
    "top_sector": (
        ["sector", "industry_key", "industry_name", "market_weight"],
        ["industry_key", "industry_name"],
    ),
    "top_sector_company_news": (
        ["pubdate", "company_name", "sector", "industry_key", "title", "summary"],
        [],
    ),
    "top_sector_news": (["pubdate", "title", "summary", "company_name", "sector"], []),
}


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, failures`` for every listed column, in one pass over the table."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column", "failures")


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count; nulls do not count."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def check_table(
    table: str, df: DataFrame, not_null: Sequence[str], unique: Sequence[str]
) -> DataFrame:
    """``table, column, test, failures`` for the declared checks of one table."""
    parts = []
    if not_null:
        parts.append(null_counts(df, not_null).withColumn("test", F.lit("not_null")))
    for column in unique:
        failures = repeated_values(df, column).agg(F.count(F.lit(1)).alias("failures"))
        parts.append(
            failures.select(
                F.lit(column).alias("column"), "failures", F.lit("unique").alias("test")
            )
        )
    stacked = reduce(DataFrame.unionByName, parts)
    return stacked.select(F.lit(table).alias("table"), "column", "test", "failures")


def check_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The declared checks of all given tables."""
    return reduce(
        DataFrame.unionByName,
        [check_table(name, df, *DECLARED[name]) for name, df in tables.items()],
    )


def news_key_repeats(news: DataFrame) -> DataFrame:
    """News keys stored more than once.

    The check this replaces compares the count the wrong way round and can never
    fail; here ``count > 1`` is a violation, as its name says.
    """
    return (
        news.where(F.col("content_id").isNotNull())
        .groupBy("company_key", "content_id")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .where(F.col("cnt") > 1)
    )


def short_gaps(
    bars: DataFrame,
    key: str = "sector",
    time: str = "datetime",
    minutes: int = times.BAR_GAP_MINUTES,
) -> DataFrame:
    """Bars that follow the bar before them in less than ``minutes``.

    ``n_rows`` tells how many bars a row stands for: copies of one time have a
    gap of zero to each other and are reported together.
    """
    series = bars.select(key, F.col(time).alias("curr"))
    paired = with_previous(series, [key], "curr", "curr", "prev")
    gap = times.minute_gap(F.col("prev"), F.col("curr"))
    first = F.struct("prev", "curr", gap.alias("diff"), F.lit(1).cast("long").alias("n_rows"))
    copies = F.struct(
        F.col("curr").alias("prev"),
        "curr",
        F.lit(0).cast("long").alias("diff"),
        (F.col("copies") - 1).alias("n_rows"),
    )
    found = F.when(F.col("copies") > 1, F.array(first, copies)).otherwise(F.array(first))
    return paired.select(key, F.inline(found)).where(F.col("diff") < minutes)

"""Staging and analytics models.

Large sides (bars, news) stay where they are: they meet lookups that were measured
to be small, or are cut to a few rows per company before they are joined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sectorlens import schemas, session
from sectorlens.functions import times
from sectorlens.operators import lookup, sinks, topk
from sectorlens.operators.previous import with_previous
from sectorlens.operators.toplist import BUCKETS, TopList

NEWS_LIMIT = 5
# Newest first; equal times are ordered by these, so every run ranks alike.
NEWS_TIES = ("content_id", "company_key", "title")


def with_industry(df: DataFrame, industries: DataFrame, sectors: DataFrame) -> DataFrame:
    """Add industry and sector columns to rows with an ``industry_key``."""
    parents = industries.select("industry_key", "industry_name", "sector_key")
    names = sectors.select("sector_key", "sector_name")
    return df.join(parents, "industry_key", "left").join(names, "sector_key", "left")


def company_detail(
    companies: DataFrame, industries: DataFrame, sectors: DataFrame
) -> DataFrame:
    """Companies with their industry and sector; unmatched ones are kept with nulls."""
    return with_industry(companies, industries, sectors).select(
        "company_symbol",
        "company_name",
        "industry_key",
        "industry_name",
        "sector_key",
        "sector_name",
    )


def _from(bars: DataFrame, start: Column) -> DataFrame:
    """Bars from ``start`` on; of a table kept by ``date``, older folders are not listed."""
    recent = bars.where(F.col("datetime") >= start)
    if "date" in bars.columns:
        recent = recent.where(F.col("date") >= times.utc_day(start))
    return recent


def sector_change(
    stock_sector: DataFrame, since: datetime | str | Column | None = None
) -> DataFrame:
    """Relative change of each sector's high against its previous bar.

    A bar that was loaded twice counts once. Bars without a time have no place
    in the order and are left out, as are bars whose previous high is unknown.
    ``since`` leaves older bars out of the scan; of a table kept by ``date``, whole
    folders.
    """
    bars = stock_sector if since is None else _from(stock_sector, times.run_time(since))
    paired = with_previous(bars, ["sector"], "datetime", "high", "prev_high")
    return paired.where(F.col("prev_high").isNotNull()).select(
        "datetime",
        "sector",
        "high",
        "prev_high",
        times.relative_change(F.col("high"), F.col("prev_high")).alias("diff_percent"),
    )


def stock_top_sector(
    stock_sector: DataFrame,
    direction: Literal["signed", "abs"] = "signed",
    null_first: bool = False,
) -> DataFrame:
    """The sector with the largest rise at the newest time: one row.

    Only sectors with a bar at that time compete; equal changes go to the lower
    sector key. ``direction="abs"`` also lets the largest fall win.
    """
    change = F.col("diff_percent") if direction == "signed" else F.abs("diff_percent")
    largest = change.desc_nulls_first() if null_first else change.desc_nulls_last()
    moved = sector_change(stock_sector)
    return moved.orderBy(F.col("datetime").desc_nulls_last(), largest, "sector").limit(1)


def settled_top_sector(
    stock_sector: DataFrame, days: Sequence[int] = (1, 7, 60), **options
) -> DataFrame:
    """The row of :func:`stock_top_sector`, pinned, from as few of the newest bars as settle it.

    The last day is tried first, then longer spans, then all bars. A span settles the
    answer if each sector with a bar at the newest time has an earlier one within the
    span, since no older bar can then be its predecessor, and one of them competes. So
    the answer never depends on ``days``, only the number of bars read does.
    """
    micros = F.unix_micros("datetime")
    newest = stock_sector.agg(F.max(micros)).first()[0]
    if newest is not None:
        for n in days:
            start = F.timestamp_micros(F.lit(newest - n * 86_400_000_000).cast("long"))
            recent = _from(stock_sector, start)
            spans = recent.groupBy("sector").agg(
                F.min(micros).alias("first"), F.max(micros).alias("last")
            )
            latest_first = spans.where(F.col("last") == newest).agg(F.max("first")).first()[0]
            if latest_first == newest:
                continue
            top = session.pinned(stock_top_sector(recent, **options))
            if not top.where(micros == newest).isEmpty():
                return top
    return session.pinned(stock_top_sector(stock_sector, **options))


def top_sector_companies(
    companies: DataFrame, industries: DataFrame, top: DataFrame
) -> DataFrame:
    """Companies of the top sector."""
    parents = industries.select("industry_key", F.col("sector_key").alias("sector"))
    in_top = parents.join(F.broadcast(top.select("sector")), "sector")
    return companies.join(in_top, "industry_key").select(
        "company_symbol", "company_name", "industry_key", "sector"
    )


def top_sector(industries: DataFrame, top: DataFrame) -> DataFrame:
    """Industries of the top sector with their weight."""
    return (
        industries.withColumnRenamed("sector_key", "sector")
        .join(F.broadcast(top.select("sector")), "sector")
        .select("sector", "industry_key", "industry_name", "market_weight")
    )


def _member_news(
    news: DataFrame,
    companies: DataFrame,
    industries: DataFrame,
    top: DataFrame,
    k: int,
    null_first: bool,
    limit: int,
    cut: bool = True,
) -> DataFrame:
    """News of the top sector's companies, at least the ``k`` newest of each (all without ``cut``).

    The companies of all sectors are measured, which bounds those of the top one
    without finding it first. If they are too many, those of the top sector are measured, and news of other
    sectors is neither ranked nor moved if they fit. Otherwise news is first cut to ``k`` rows per company;
    no later ranking can need more, and no company's news is moved as a whole.
    """
    columns = [*schemas.NEWS_KEYS, "title", "summary", "pubdate"]
    members = top_sector_companies(companies, industries, top).withColumnRenamed(
        "company_symbol", "company_key"
    )
    articles = news.select(*columns)
    everyone = companies.join(industries.select("industry_key", "sector_key"), "industry_key")
    if lookup.fits_broadcast(everyone, limit) or lookup.fits_broadcast(members, limit):
        return articles.join(F.broadcast(members), "company_key")
    if not cut:
        return articles.join(members, "company_key")
    newest = topk.newest_per(
        articles, ["company_key"], k, ties=NEWS_TIES, null_first=null_first
    )
    return newest.drop("rn").join(members, "company_key")


def top_sector_news(
    news: DataFrame,
    companies: DataFrame,
    industries: DataFrame,
    top: DataFrame,
    k: int = NEWS_LIMIT,
    null_first: bool = False,
    distinct_articles: bool = False,
    limit: int = lookup.BROADCAST_BYTES,
) -> DataFrame:
    """The ``k`` newest news rows of the top sector.

    An article about three of its companies takes three places, unless
    ``distinct_articles`` keeps only its first company. Articles without an id are
    never taken for one another.
    """
    if distinct_articles:
        # one row per article and company, so that copies take no place either
        keep = F.max(F.struct("pubdate", "title", "summary")).alias("row")
        plain = [*schemas.NEWS_KEYS, "pubdate", "title", "summary"]
        known = news.where(F.col("content_id").isNotNull()).groupBy(*schemas.NEWS_KEYS).agg(keep)
        nameless = news.where(F.col("content_id").isNull()).select(*plain)
        news = known.select(*schemas.NEWS_KEYS, "row.*").select(*plain).unionByName(nameless)
    # which company an article counts for is settled before any cut, whatever the plan
    found = _member_news(
        news, companies, industries, top, k, null_first, limit, cut=not distinct_articles
    )
    if distinct_articles:
        rest = [c for c in found.columns if c not in ("content_id", "company_key")]
        one = F.min(F.struct("company_key", *rest)).alias("row")
        named = found.where(F.col("content_id").isNotNull()).groupBy("content_id").agg(one)
        nameless = found.where(F.col("content_id").isNull())
        found = named.select("content_id", "row.*").unionByName(nameless)
    ranked = topk.newest_per(found, ["sector"], k, ties=NEWS_TIES, null_first=null_first)
    return ranked.select("pubdate", "title", "summary", "company_name", "sector")


def top_sector_company_news(
    news: DataFrame,
    companies: DataFrame,
    industries: DataFrame,
    top: DataFrame,
    k: int = NEWS_LIMIT,
    null_first: bool = False,
    limit: int = lookup.BROADCAST_BYTES,
) -> DataFrame:
    """The ``k`` newest news rows of each company of the top sector."""
    found = _member_news(news, companies, industries, top, k, null_first, limit)
    ranked = topk.newest_per(found, ["company_key"], k, ties=NEWS_TIES, null_first=null_first)
    return ranked.select(
        "pubdate", "company_name", "sector", "industry_key", "title", "summary"
    )


def newest_company_news(
    spark: SparkSession, folder: str, k: int = NEWS_LIMIT, buckets: int = BUCKETS
) -> TopList:
    """The ``k`` newest news rows of each company, kept up to date by loads.

    Its rows stand for all news in :func:`top_sector_news` (without ``distinct_articles``),
    :func:`top_sector_company_news` and :func:`refresh`: no ranking needs more than ``k`` rows of a
    company, whichever sector it belongs to by then.
    """
    columns = [*schemas.NEWS_KEYS, "title", "summary", "pubdate"]
    schema = T.StructType([f for f in schemas.NEWS if f.name in columns])
    return TopList(spark, folder, schema, ["company_key"], k, ties=NEWS_TIES, buckets=buckets)


def stock_with_industry(
    stock_company: DataFrame,
    companies: DataFrame,
    industries: DataFrame,
    sectors: DataFrame,
    limit: int = lookup.BROADCAST_BYTES,
) -> DataFrame:
    """Company bars with company, industry and sector; unknown symbols drop out.

    One broadcast lookup when the company details measure small. Otherwise bars and
    companies are shuffled on the symbol, where adaptive execution splits a hot
    symbol, and the few industries and sectors are joined to the result.
    """
    detail = company_detail(companies, industries, sectors)
    if lookup.fits_broadcast(detail, limit):
        named = stock_company.join(F.broadcast(detail), "company_symbol")
    else:
        known = stock_company.join(companies, "company_symbol")
        named = with_industry(known, industries, sectors)
    return named.select(
        "datetime",
        "open",
        "high",
        "low",
        "close",
        "volume",
        "company_name",
        "industry_name",
        F.col("sector_key").alias("sector"),
    )


def in_read_order(df: DataFrame, model: str) -> DataFrame:
    """Sort a stored model for display; the tables themselves are not sorted."""
    order = {
        "top_sector": [F.desc_nulls_last("market_weight")],
        "top_sector_news": [F.desc_nulls_last("pubdate")],
        "top_sector_company_news": [
            F.asc_nulls_last("company_name"),
            F.desc_nulls_last("pubdate"),
        ],
    }
    return df.orderBy(*order[model])


def refresh(
    raw: Mapping[str, DataFrame],
    database: str,
    folder: str,
    days: Sequence[str | None] | None = None,
) -> dict[str, DataFrame]:
    """Rebuild the four stored models from the raw tables; returns what was stored.

    The top sector is determined once and pinned, so that all tables agree on it
    even if bars are loaded meanwhile. ``stock_with_industry`` is kept by UTC day. A run that
    knows on which ``days`` bars were loaded since the last one rebuilds these days only;
    after a change of the master data, run without ``days``. ``raw["news"]`` may be all news or the rows of
    :func:`newest_company_news`.
    """
    companies, industries = raw["company_info"], raw["industry_info"]
    top = settled_top_sector(raw["stock_sector"])
    models = {
        "top_sector": top_sector(industries, top),
        "top_sector_news": top_sector_news(raw["news"], companies, industries, top),
        "top_sector_company_news": top_sector_company_news(
            raw["news"], companies, industries, top
        ),
    }
    spark = top.sparkSession
    for name, model in models.items():
        sinks.materialize(model, database, name, folder)
    bars = stock_with_industry(
        raw["stock_company"], companies, industries, raw["sector_info"]
    )
    sinks.materialize(bars, database, "stock_with_industry", folder, True, days)
    stored = {name: spark.table(f"{database}.{name}") for name in (*models, "stock_with_industry")}
    return stored | {"stock_with_industry": stored["stock_with_industry"].drop("date")}

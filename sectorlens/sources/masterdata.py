"""Sector, industry and company records as the vendor nests them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sectorlens import schemas
from sectorlens.operators import dedupe, topk

# The sectors that are followed.
SECTOR_KEYS = [
    "basic-materials",
    "communication-services",
    "consumer-cyclical",
    "consumer-defensive",
    "energy",
    "financial-services",
    "healthcare",
    "industrials",
    "real-estate",
    "technology",
    "utilities",
]
COMPANIES_PER_INDUSTRY = 5

SECTOR_RECORDS = (
    "sector_pos int, sector_key string, sector_name string, sector_symbol string,"
    " industries array<struct<industry_key: string, industry_name: string,"
    " industry_symbol: string, market_weight: double>>"
)
INDUSTRY_RECORDS = (
    "industry_pos int, industry_key string,"
    " companies array<struct<company_symbol: string, company_name: string>>"
)


def sector_keys(spark: SparkSession) -> DataFrame:
    """The followed sectors with their position, to join vendor records to."""
    return spark.createDataFrame(
        list(enumerate(SECTOR_KEYS)), "sector_pos int, sector_key string"
    )


def company_symbols(company_info: DataFrame) -> DataFrame:
    """Symbols to fetch for: a join side, not a list on the driver."""
    return company_info.select("company_symbol").where(F.col("company_symbol").isNotNull())


def sectors(records: DataFrame) -> DataFrame:
    """One row per sector; of repeats the first in record order stays."""
    rows = records.select("sector_pos", *schemas.SECTOR_INFO.names)
    return dedupe.keep_first(rows, ["sector_key"], ["sector_pos"]).drop("sector_pos")


def industry_rows(records: DataFrame) -> DataFrame:
    """One row per sector and listed industry, with both positions."""
    listed = records.select(
        "sector_pos", "sector_key", F.posexplode("industries").alias("pos", "industry")
    )
    return listed.select("sector_pos", "pos", "industry.*", "sector_key")


def industries(rows: DataFrame) -> DataFrame:
    """One row per industry; an industry listed by two sectors stays with the earlier."""
    firsts = dedupe.keep_first(rows, ["industry_key"], ["sector_pos", "pos"])
    return firsts.select(*schemas.INDUSTRY_INFO.names)


def company_rows(records: DataFrame, k: int = COMPANIES_PER_INDUSTRY) -> DataFrame:
    """One row per industry and company among the first ``k`` of its list.

    Industries without a list give none.
    """
    head = F.posexplode(F.slice("companies", 1, k)).alias("pos", "company")
    listed = records.select("industry_pos", "industry_key", head)
    return listed.select("industry_pos", "pos", "company.*", "industry_key")


def companies(rows: DataFrame, k: int = COMPANIES_PER_INDUSTRY) -> DataFrame:
    """The first ``k`` listed companies of each industry, one row per symbol.

    The cut comes before the blank-symbol filter and the filter before the
    removal of repeats, so an industry may end up with fewer than ``k``.
    """
    head = rows.where(F.col("pos") < k)
    named = head.where(F.col("company_symbol").isNotNull() & (F.col("company_symbol") != ""))
    firsts = dedupe.keep_first(named, ["company_symbol"], ["industry_pos", "pos"])
    return firsts.select(*schemas.COMPANY_INFO.names)


def with_positions(rows: DataFrame, parent: str, order: list, k: int) -> DataFrame:
    """Number flat vendor rows per ``parent`` from 0, keeping the first ``k``."""
    ranked = topk.first_per(rows, [parent], k, order)
    return ranked.withColumn("pos", F.col("rn") - 1).drop("rn")

"""The model tables, taken from the synthetic test tables.

region -> sectors, nation -> industries, customer -> companies, events -> price
ticks, events with a document -> news.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sectorlens.functions import times
from sectorlens.operators import bars


_known_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table; its schema is read from the files only the first time.

    The files hold UTC times without a zone. They are read as instants, which
    needs no conversion per row.
    """
    path = f"{folder}/{name}.parquet"
    if path not in _known_schemas:
        found = spark.read.parquet(path).schema
        instants = [
            T.StructField(f.name, T.TimestampType() if f.dataType == T.TimestampNTZType() else f.dataType)
            for f in found
        ]
        _known_schemas[path] = T.StructType(instants)
    return spark.read.schema(_known_schemas[path]).parquet(path)


def sector_info(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("r_regionkey").cast("string")
    return table(spark, folder, "region").select(
        key.alias("sector_key"),
        F.col("r_name").alias("sector_name"),
        F.concat(F.lit("^S"), key).alias("sector_symbol"),
    )


def industry_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Industries without their weight, which costs a pass over the companies."""
    key = F.col("n_nationkey").cast("string")
    return table(spark, folder, "nation").select(
        key.alias("industry_key"),
        F.col("n_name").alias("industry_name"),
        F.concat(F.lit("^I"), key).alias("industry_symbol"),
        F.col("n_regionkey").cast("string").alias("sector_key"),
    )


def industry_info(spark: SparkSession, folder: str) -> DataFrame:
    """Weight = the industry's share of its sector's companies."""
    per_industry = (
        company_info(spark, folder).groupBy("industry_key").agg(F.count(F.lit(1)).alias("n"))
    )
    counted = industry_keys(spark, folder).join(per_industry, "industry_key", "left")
    of_sector = F.sum("n").over(Window.partitionBy("sector_key"))
    return counted.select(
        "industry_key",
        "industry_name",
        "industry_symbol",
        (F.coalesce("n", F.lit(0)) / of_sector).alias("market_weight"),
        "sector_key",
    )


def company_info(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("company_symbol"),
        F.col("c_name").alias("company_name"),
        F.col("c_nationkey").cast("string").alias("industry_key"),
    )


def ticks(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("company_symbol"),
        "ts",
        F.col("value").alias("price"),
        F.col("event_id").alias("seq"),
    )


def stock_company(
    spark: SparkSession, folder: str, width: str = times.BAR_WIDTH
) -> DataFrame:
    return bars.ohlcv(ticks(spark, folder), ["company_symbol"], width)


def stock_sector(spark: SparkSession, folder: str, width: str = times.BAR_WIDTH) -> DataFrame:
    return bars.sector_bars(
        ticks(spark, folder), company_info(spark, folder), industry_keys(spark, folder), width
    ).drop("volume")


def news(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        F.col("event_id").alias("doc_id"),
        F.col("user_id").cast("string").alias("company_key"),
        F.col("ts").alias("pubdate"),
    )
    documents = table(spark, folder, "documents")
    return documents.join(events, "doc_id").select(
        F.col("doc_id").cast("string").alias("content_id"),
        F.concat_ws(" ", "lang", "source", "doc_id").alias("title"),
        F.col("text").alias("summary"),
        F.concat(F.lit("https://news.example/"), F.col("doc_id")).alias("url"),
        "company_key",
        "pubdate",
    )

"""News payloads: JSON objects that map a ticker to its list of items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sectorlens import schemas


def read_payloads(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Landed JSON text, one object per line or per file, in column ``payload``."""
    reader = spark.read.option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true")
    return reader.text(path, wholetext=whole_file).withColumnRenamed("value", "payload")


def _by_ticker() -> Column:
    return F.from_json("payload", schemas.NEWS_PAYLOAD)


def unreadable_payloads(payloads: DataFrame) -> DataFrame:
    """The lines that are no JSON object of items by ticker. Blank lines are no payloads."""
    return payloads.select("payload").where(is_unreadable())


def is_unreadable() -> Column:
    return (F.trim("payload") != "") & _by_ticker().isNull()


def news_items(payloads: DataFrame) -> DataFrame:
    """One row per ticker and item, the ticker in ``company_key``.

    The ticker of the map is the key, whatever the item itself may say. Tickers
    without items give no rows, and neither do the lines of :func:`unreadable_payloads`.
    """
    parsed = payloads.select(_by_ticker().alias("by_ticker"))
    per_ticker = parsed.select(F.explode("by_ticker").alias("company_key", "items"))
    return per_ticker.select("company_key", F.inline("items"))

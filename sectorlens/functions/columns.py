"""Column-list steps, each meant for ``DataFrame.transform``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sectorlens import schemas
from sectorlens.functions import times


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by map; names the frame does not have are ignored."""
    return df.withColumnsRenamed(dict(names))


def select_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df if columns is None else df.select(*columns)


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.upper() for name in df.columns])


def tag(df: DataFrame, column: str, value: str) -> DataFrame:
    """Mark every row with the key it was fetched for."""
    return df.withColumn(column, F.lit(value))


def set_date(df: DataFrame, column: str, pattern: str = "yyyy-MM-dd") -> DataFrame:
    """Add ``date``, the UTC day of ``column`` as text; null where it has no time."""
    return df.withColumn("date", times.day_text(times.parse_instant(F.col(column)), pattern))


def news_columns(items: DataFrame) -> DataFrame:
    """Flatten ``content.*`` of news items to the landing columns."""
    return items.select(
        F.col("content.id").alias("content_id"),
        F.col("content.title").alias("title"),
        F.col("content.summary").alias("summary"),
        F.col("content.canonicalUrl.url").alias("url"),
        F.col("company_key"),
        F.col("content.pubDate").alias("pubdate"),
    )


def clean_bars(landed: DataFrame, kind: str) -> DataFrame:
    """Landed bars to the warehouse columns of their kind.

    A time that cannot be read becomes null and the row is kept; the not-null
    check counts such rows. Volume that arrived as a float is cast back.
    """
    table = schemas.BAR_TABLE[schemas.bar_kind(kind)]
    named = rename_columns(landed, schemas.LANDING_FIELDS)
    return named.withColumn("datetime", times.parse_instant(F.col("datetime"))).select(
        *[F.col(field.name).cast(field.dataType) for field in table.fields]
    )

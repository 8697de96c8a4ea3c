"""Landed Parquet files."""

from __future__ import annotations

import operator
from collections.abc import Iterator
from datetime import date, datetime
from functools import reduce
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sectorlens import schemas
from sectorlens.functions import times
from sectorlens.functions.columns import clean_bars
from sectorlens.schemas import landing_schema

PARQUET_FILES = "*.parquet"


def read_or_empty(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    nested: bool = False,
    files: Column | None = None,
) -> DataFrame:
    """Read a Parquet dataset; one that does not exist yet has no rows.

    Only a missing path counts as empty. Any other error is raised. ``nested``
    reads all folders below ``path`` without taking their names for partitions.
    ``files`` is a condition on ``_metadata.file_path``; other files are not opened.
    """
    reader = spark.read.schema(schema).option("pathGlobFilter", PARQUET_FILES)
    if nested:
        reader = reader.option("recursiveFileLookup", "true")
    try:
        found = reader.parquet(path)
        return found if files is None else found.where(files)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def in_kind_folder(path: str, kind: str) -> Column:
    """Condition on files: the last folder below ``path`` that is named for a kind of bars names ``kind``.

    ``Sector``, ``Company`` and ``kind=Sector`` in any case are such names. Files below
    none of them belong to whoever reads ``path``.
    """
    root = quote(path.split("://", 1)[-1].rstrip("/") + "/", safe="/=:,@+-_.~!*'()&$;")
    # asked of each file when files are listed, and of each row again; most paths need no pattern for that
    whole = F.lower(F.col("_metadata.file_path"))
    mentioned = reduce(operator.or_, [whole.contains(f"{name}/") for name in schemas.BAR_KEY])
    below = F.lower(F.substring_index(F.col("_metadata.file_path"), root, -1))
    names = "|".join(schemas.BAR_KEY)
    named = F.regexp_extract(F.concat(F.lit("/"), below), rf".*/(?:\w+=)?({names})/", 1)
    return F.when(mentioned, named.isin("", schemas.bar_kind(kind))).otherwise(F.lit(True))


def read_landed_bars(
    spark: SparkSession, path: str, kind: str, day: str | None = None, slot: str | None = None
) -> DataFrame:
    """All landed bars of a kind below ``path``, with the vendor's column names.

    Both kinds may lie below one ``path``, see :func:`in_kind_folder`. With ``day``, and
    ``slot`` if given, only the folder ``path/day/slot`` of one run is listed and read.
    Where nothing was landed there are no rows, and loading them does nothing.
    """
    folder = "/".join([path.rstrip("/"), *[part for part in (day, slot) if part]])
    mine = in_kind_folder(folder, kind)
    return read_or_empty(spark, folder, landing_schema(kind), nested=True, files=mine)


def newest_day(landed: DataFrame) -> DataFrame:
    """Rows of the newest ``date`` folder; everything where there are no such folders.

    The day is found from folder names; no column of the files is read for it.
    """
    if "date" not in landed.columns:
        return landed
    day = landed.agg(F.max("date")).first()[0]
    return landed if day is None else landed.where(F.col("date") == F.lit(day))


def read_news(spark: SparkSession, path: str, since: date | str | None = None) -> DataFrame:
    """Stored news, typed. ``since`` keeps that day and later and prunes folders."""
    landed = read_or_empty(spark, path, schemas.NEWS_LANDING)
    if since is not None:
        landed = landed.where(F.col("date") >= F.lit(since).cast("date"))
    return landed.select(
        *[c for c in schemas.NEWS.names if c != "pubdate"],
        times.parse_instant(F.col("pubdate")).alias("pubdate"),
        "date",
    )


def raw_columns(table: DataFrame, name: str) -> DataFrame:
    """The declared columns of a raw table, in order."""
    return table.select(*schemas.RAW_TABLES[name].names)


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """Path of every file below ``path``; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path")
    )


def folder_prefixes(files: DataFrame, folder: str) -> DataFrame:
    """Distinct paths up to and including ``folder/``, for files that lie in one."""
    mark = f"{folder}/"
    at = F.instr(F.col("path"), mark)
    return (
        files.where(at > 0)
        .select(F.substring(F.col("path"), F.lit(1), at + len(mark) - 1).alias("prefix"))
        .distinct()
    )


def fetch_window(landed: DataFrame, now: datetime | str | Column) -> DataFrame:
    """What to fetch next: one row of ``mode, since``.

    A target without bars is bootstrapped with one month, otherwise fetching
    continues after the newest landed bar.
    """
    newest = landed.agg(F.max("datetime").alias("newest"))
    return newest.select(
        F.when(F.col("newest").isNull(), "bootstrap").otherwise("incremental").alias("mode"),
        F.coalesce("newest", bootstrap_start(now)).alias("since"),
    )


def bootstrap_start(now: datetime | str | Column) -> Column:
    """Where the history of a first load begins."""
    # months are counted in UTC, not in the session's zone
    return times.from_utc_clock(times.utc_clock(times.run_time(now)) - F.expr("INTERVAL 1 MONTH"))


#: Parquet types by their Arrow names, as Spark reads them.
_KINDS = {
    "double": "double",
    "float": "float",
    "int64": "bigint",
    "int32": "int",
    "int16": "smallint",
    "string": "string",
    "large_string": "string",
}


def _kind(kind: pa.DataType) -> str | None:
    """How Spark reads a column of this type; None for one that holds nulls only."""
    if pa.types.is_null(kind):
        return None
    if pa.types.is_timestamp(kind):
        if kind.unit == "ns":
            return "bigint /* ns */"
        return "timestamp" if kind.tz else "timestamp_ntz"
    return _KINDS.get(str(kind), str(kind))


def _footers(wanted: list[str]):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kinds = []
            for path in batch["path"]:
                filesystem, place = pafs.FileSystem.from_uri(path)
                there = pq.read_schema(place, filesystem=filesystem)
                found = {name: _kind(there.field(name).type) for name in wanted if name in there.names}
                kinds.append(", ".join(f"`{name}` {kind}" for name, kind in found.items() if kind))
            yield pd.DataFrame({"kinds": kinds, "path": batch["path"]})

    return read


def _one_kind(
    spark: SparkSession, schema: T.StructType, kinds: str, paths: list[str], since: Column | None
) -> DataFrame:
    """The files of one set of column types, read by Spark and cast to ``schema``."""
    if " /* ns */" in kinds:
        # Spark reads nanoseconds as plain numbers if its session says so; this one is for these scans only
        spark = spark.newSession()
        spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    typed = {part.split("` ")[0][1:]: part.split("` ")[1] for part in kinds.split(", ") if part}
    plain = ", ".join(f"`{name}` {kind.split()[0]}" for name, kind in typed.items())
    rows = spark.read.schema(plain).option("pathGlobFilter", PARQUET_FILES).option("recursiveFileLookup", "true").parquet(*paths)

    def cast(field: T.StructField) -> Column:
        kind, column = typed.get(field.name), F.col(f"`{field.name}`")
        if kind is None:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if kind == "bigint /* ns */":
            whole = F.expr(f"(`{field.name}` - pmod(`{field.name}`, 1000L)) div 1000")
            column = F.timestamp_micros(whole)
        elif kind == "timestamp_ntz":
            column = times.from_utc_clock(column)
        elif kind in ("double", "float") and field.dataType == T.LongType():
            column = F.when(~F.isnan(column), column)
        elif field.dataType == T.TimestampType():
            column = times.parse_instant(column)
        return column.cast(field.dataType).alias(field.name)

    if since is not None and (kind := typed.get("Datetime")):
        # on the stored type, so that it reaches the scan
        bound = {"bigint /* ns */": F.unix_micros(since) * 1000, "timestamp_ntz": times.utc_clock(since), "timestamp": since}
        if kind in bound:
            rows = rows.where(F.col("Datetime") >= bound[kind])
    return rows.select(*[cast(field) for field in schema])


def read_foreign_bars(
    spark: SparkSession, path: str, kind: str, since: datetime | str | None = None
) -> DataFrame:
    """Landed bars written by other tools, cleaned to one typed frame.

    Such files may hold nanosecond times, which Spark's reader refuses unless it is told to take them for
    numbers, a batch with a gap has its volume as a float, which cannot be merged with whole numbers, and columns may be
    absent. So footers are read first, one per file and inside tasks; the files of each set of column types are one scan of
    Spark's own reader (column pruning, split files), cast to the schema and united by name. Nanoseconds are cut to
    microseconds, and a time without a zone is UTC. ``since`` leaves older bars out and is pushed into
    each scan whose times are not text. The driver holds the paths, as it does for any listing.
    """
    schema = landing_schema(kind)
    files = landed_files(spark, path).where(F.col("path").endswith(".parquet"))
    spread = files.repartition(spark.sparkContext.defaultParallelism, "path")
    found = spread.mapInPandas(_footers(schema.names), "kinds string, path string")
    groups = found.groupBy("kinds").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("kinds").collect()
    bound = None if since is None else times.run_time(since)
    # no rows, and no part of the plan either; makes this session the one that runs it
    nulls = [f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema]
    rows = spark.sql(f"SELECT {', '.join(nulls)} WHERE false")
    for group in groups:
        paths = [path] if len(groups) == 1 else group["paths"]
        rows = rows.unionByName(_one_kind(spark, schema, group["kinds"], paths, bound))
    return clean_bars(rows if since is None else rows.where(F.col("Datetime") >= bound), kind)

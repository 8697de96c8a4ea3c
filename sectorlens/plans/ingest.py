"""Jobs that fill the raw tables: bars, news and master data."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sectorlens import schemas, session
from sectorlens.functions import columns, times
from sectorlens.operators import bars as bar_ops
from sectorlens.operators import dedupe, lookup, sinks
from sectorlens.operators.ledger import KeyLedger
from sectorlens.sources import landing, masterdata
from sectorlens.sources import news as news_source


def news_rows(payloads: DataFrame) -> DataFrame:
    """News payloads to landing rows, with the UTC day of publication."""
    return _dated(columns.news_columns(news_source.news_items(payloads)))


def _dated(rows: DataFrame) -> DataFrame:
    return columns.set_date(rows, "pubdate").withColumn("date", F.col("date").cast("date"))


def _on_days_of(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of the days that ``kept`` has rows of, found without moving any."""
    days = _dated(kept).select(F.col("date").alias("__day")).distinct()
    if not lookup.fits_broadcast(days):
        return rows
    return rows.join(F.broadcast(days), F.col("date").eqNullSafe(F.col("__day")), "left_semi")


def ingest_news(
    payloads: DataFrame,
    path: str,
    since: date | str | None = None,
    quarantine: str | None = None,
    ledger: KeyLedger | None = None,
) -> int:
    """Append news that the store does not have yet, in folders by day.

    Returns the number of new rows. Seen keys are taken from the store itself, not
    from a separate list that a failed run could leave ahead of the data. News
    without a readable time lands in the default partition. ``since`` compares
    with the stored days from then on only; use it if the vendor repeats nothing older.
    With a ``ledger`` the store is not read: the ledger enters the files added since its last
    run, and is asked for the batch's keys alone, however old they are.

    The payloads are read twice: for the keys, which tell what is new, and for the texts of the days that have
    something new. Payloads that cost more than a scan should be stored first.

    Payload lines that cannot be read are kept below ``quarantine``, each once. Without
    such a folder they are an error, and nothing is stored.
    """
    spark = payloads.sparkSession
    if quarantine is not None:
        unreadable = news_source.unreadable_payloads(payloads)
        kept = landing.read_or_empty(spark, quarantine, unreadable.schema)
        new_lines = dedupe.drop_seen(unreadable.distinct(), kept, ["payload"])
        sinks.write_dataset(new_lines, quarantine, "append")
    checked = Observation()
    read = payloads.observe(checked, F.count_if(news_source.is_unreadable()).alias("n_unreadable"))
    heads = session.pinned(dedupe.heads(news_rows(read), schemas.NEWS_KEYS, "pubdate"))
    if quarantine is None and checked.get["n_unreadable"]:
        raise ValueError("there are payloads that cannot be read, and no folder to keep them in")
    if ledger is not None:
        ledger.follow(path, schemas.NEWS_LANDING)
        seen = ledger.seen(heads)
    else:
        seen = landing.read_or_empty(spark, path, schemas.NEWS_LANDING)
        if since is not None:
            recent = F.col("date") >= F.lit(since).cast("date")
            seen = seen.where(recent | F.col("date").isNull())
    new = session.pinned(dedupe.drop_seen(heads, seen.select(*schemas.NEWS_KEYS), schemas.NEWS_KEYS))
    fresh = dedupe.rows_of(_on_days_of(news_rows(payloads), new), new, schemas.NEWS_KEYS, "pubdate")
    return sinks.write_dataset(fresh, path, "append", ["date"])


def next_ledger(ledger: DataFrame | None, written: DataFrame) -> DataFrame:
    """Keys seen so far and keys just written, each once."""
    keys = written.select(*schemas.NEWS_KEYS)
    if ledger is not None:
        keys = keys.unionByName(ledger.select(*schemas.NEWS_KEYS))
    return keys.distinct()


def fetch_bars(
    bars: DataFrame,
    landed: DataFrame,
    keys: DataFrame,
    kind: str,
    now: datetime | str | Column,
    strict: bool = True,
) -> DataFrame:
    """The bars a run at ``now`` has to land.

    With nothing landed yet that is one month of history, otherwise the bars after
    the newest landed one up to the target slot, so that runs which did not take
    place leave no gap, and that slot itself. ``strict`` raises if a key has no bar
    in that slot, or in the month of a first load. If ``landed`` is kept by ``date``,
    only its newest folder is read.
    """
    key = schemas.BAR_KEY[schemas.bar_kind(kind)]
    time = F.col("datetime")
    window = landing.fetch_window(landing.newest_day(landed), now)
    mode, since = window.select("mode", F.unix_micros("since")).first()
    if mode == "bootstrap":
        fetched = bars.where(time >= landing.bootstrap_start(now))
        if strict:
            arrived = fetched.select(key, "datetime")
            absent = bar_ops.stale_keys(keys, arrived, key, now).where("status = 'missing'")
            bar_ops.require_fresh(absent, key)
            if fetched.isEmpty():
                raise bar_ops.DataNotFound(f"no {kind} bars in the month before {now}")
        return fetched
    newer = time > F.timestamp_micros(F.lit(since).cast("long"))
    slot = times.in_slot(time, now)
    before_end = time < times.target_slot(now) + F.expr("INTERVAL 1 MINUTE")
    fetched = bars.where(slot | (newer & before_end))
    if strict:
        bar_ops.require_fresh(bar_ops.stale_keys(keys, fetched, key, now), key)
    return fetched


def load_bars(landed: DataFrame, kind: str, table: str, location: str | None = None) -> None:
    """Clean landed bars and append those the table does not have yet."""
    kind = schemas.bar_kind(kind)
    sinks.ensure_table(landed.sparkSession, table, schemas.BAR_TABLE[kind], location)
    cleaned = columns.clean_bars(landed, kind)
    sinks.append_new(cleaned, table, ["datetime", schemas.BAR_KEY[kind]])


def refresh_master(
    spark: SparkSession,
    sector_records: DataFrame,
    industry_records: DataFrame,
    database: str,
    folder: str,
) -> dict[str, int]:
    """Replace the three master tables from nested vendor records; returns their sizes."""
    tables = {
        "sector_info": masterdata.sectors(sector_records),
        "industry_info": masterdata.industries(masterdata.industry_rows(sector_records)),
        "company_info": masterdata.companies(masterdata.company_rows(industry_records)),
    }
    return {
        name: sinks.materialize(df, database, name, folder) for name, df in tables.items()
    }


def followed(keys: Sequence[str], records: DataFrame, column: str) -> DataFrame:
    """Vendor records of the given keys only."""
    return records.where(F.col(column).isin(*keys))

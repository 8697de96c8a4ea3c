"""Every query by name, each with the SQL that must give the same rows.

A query takes the session and the folder of the test tables and runs over whole
tables. The SQL is written independently, for another engine, over the same files.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sectorlens import schemas, session
from sectorlens.functions import columns, times
from sectorlens.operators import bars as bar_ops
from sectorlens.operators import dedupe, lookup, quality, sinks
from sectorlens.operators.checkstate import CheckState
from sectorlens.operators.ledger import KeyLedger
from sectorlens.plans import ingest, leader, marts, propagate
from sectorlens.sources import landing, masterdata, panels
from sectorlens.sources import testtables as tables
from sectorlens.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# A run shortly after the newest bar of the test tables is complete.
NOW = "2024-01-31 00:04:00"
KEPT_UNTIL = "2024-01-16"
# From this day on, slots that are cleaned again have their own close.
SLOTS_AGAIN_FROM = "2024-01-30"
# Within the few days that the news of the test tables covers, so that a ledger holds some and lacks some.
NEWS_KEPT_UNTIL = "2024-01-02 12:00:00"


def _register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return _zoneless(query(session.configure(spark), folder))

        run.__name__, run.__doc__ = name, query.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return query

    return add


def _zoneless(df: DataFrame) -> DataFrame:
    """UTC instants as plain timestamps, the type the other engine returns."""
    return df.select(
        *[
            F.col(f"`{name}`").cast("timestamp_ntz").alias(name) if kind == "timestamp" else f"`{name}`"
            for name, kind in df.dtypes
        ]
    )


# ---------------------------------------------------------------- SQL building blocks

_OHLC = """
    first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
    last(value ORDER BY ts, event_id) AS close, count(*) AS volume"""


def _company_bars(width: str = "15 minutes") -> str:
    return f"""SELECT time_bucket(INTERVAL '{width}', ts) AS datetime,
    CAST(user_id AS VARCHAR) AS company_symbol, {_OHLC}
  FROM events WHERE ts IS NOT NULL AND value IS NOT NULL GROUP BY 1, 2"""


def _sector_bars(width: str = "15 minutes") -> str:
    return f"""SELECT time_bucket(INTERVAL '{width}', ts) AS datetime,
    CAST(n_regionkey AS VARCHAR) AS sector, {_OHLC}
  FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE ts IS NOT NULL AND value IS NOT NULL AND n_regionkey IS NOT NULL GROUP BY 1, 2"""


_INDUSTRY = """SELECT CAST(n_nationkey AS VARCHAR) AS industry_key, n_name AS industry_name,
    '^I' || n_nationkey AS industry_symbol,
    coalesce(n, 0) / CAST(sum(coalesce(n, 0)) OVER (PARTITION BY n_regionkey) AS DOUBLE)
      AS market_weight,
    CAST(n_regionkey AS VARCHAR) AS sector_key
  FROM nation LEFT JOIN
    (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) ON n_nationkey = c_nationkey"""

_DETAIL = """SELECT CAST(c_custkey AS VARCHAR) AS company_symbol, c_name AS company_name,
    CAST(c_nationkey AS VARCHAR) AS industry_key, n_name AS industry_name,
    CAST(r_regionkey AS VARCHAR) AS sector_key, r_name AS sector_name
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey"""

_NEWS = """SELECT CAST(doc_id AS VARCHAR) AS content_id,
    lang || ' ' || source || ' ' || doc_id AS title, text AS summary,
    'https://news.example/' || doc_id AS url, CAST(user_id AS VARCHAR) AS company_key,
    ts AS pubdate
  FROM documents JOIN events ON doc_id = event_id"""

_CHANGE = f"""SELECT datetime, sector, high, prev_high,
    (high - prev_high) / nullif(prev_high, 0) AS diff_percent
  FROM (SELECT datetime, sector, high,
      lag(high) OVER (PARTITION BY sector ORDER BY datetime) AS prev_high
    FROM ({_sector_bars()}))
  WHERE prev_high IS NOT NULL"""


def _top(change: str = "diff_percent") -> str:
    return f"""SELECT * FROM ({_CHANGE})
  ORDER BY datetime DESC NULLS LAST, {change} DESC NULLS LAST, sector LIMIT 1"""


_MEMBERS = f"""SELECT company_symbol, company_name, industry_key, sector
  FROM ({_DETAIL}) JOIN ({_top()}) ON sector_key = sector"""

_NEWEST = "pubdate DESC NULLS LAST, content_id, company_key, title"


# ---------------------------------------------------------------- bars


@_register("bars_15m_company", _company_bars())
def _(spark, folder):
    return tables.stock_company(spark, folder)


@_register("bars_1d_company", _company_bars("1 day"))
def _(spark, folder):
    return tables.stock_company(spark, folder, "1 day")


@_register("bars_15m_sector", f"SELECT * EXCLUDE (volume) FROM ({_sector_bars()})")
def _(spark, folder):
    return tables.stock_sector(spark, folder)


@_register("bars_1h_sector_preaggregated", _sector_bars("1 hour"))
def _(spark, folder):
    """The plan for companies too many to broadcast: company bars first."""
    return bar_ops.sector_bars(
        tables.ticks(spark, folder),
        tables.company_info(spark, folder),
        tables.industry_keys(spark, folder),
        "1 hour",
        limit=0,
    )


@_register(
    "last_bar_per_company",
    f"""SELECT company_symbol, datetime, open, high, low, close, volume
  FROM ({_company_bars()})
  QUALIFY row_number() OVER (PARTITION BY company_symbol ORDER BY datetime DESC) = 1""",
)
def _(spark, folder):
    return bar_ops.last_bar(tables.stock_company(spark, folder), "company_symbol")


@_register(
    "slot_filter",
    f"SELECT * FROM ({_company_bars()}) WHERE datetime = TIMESTAMP '2024-01-30 23:45:00'",
)
def _(spark, folder):
    return bar_ops.slot_bars(tables.ticks(spark, folder), ["company_symbol"], NOW)


@_register(
    "bars_to_land",
    f"""SELECT 'bootstrap' AS mode, * FROM ({_company_bars()})
    WHERE datetime >= TIMESTAMP '2023-12-31 00:04:00'
  UNION ALL SELECT 'incremental', * FROM ({_company_bars()})
    WHERE datetime = TIMESTAMP '2024-01-30 23:45:00'""",
)
def _(spark, folder):
    """A first run lands a month, the next one only the slot it was started for."""
    bars = tables.stock_company(spark, folder)
    keys = masterdata.company_symbols(tables.company_info(spark, folder))
    nothing = spark.createDataFrame([], schemas.STOCK_COMPANY)
    first = ingest.fetch_bars(bars, nothing, keys, "company", NOW, strict=False)
    second = ingest.fetch_bars(bars, bars, keys, "company", NOW, strict=False)
    return first.select(F.lit("bootstrap").alias("mode"), "*").unionByName(
        second.select(F.lit("incremental").alias("mode"), "*")
    )


@_register(
    "bars_after_outage",
    f"""SELECT * FROM ({_company_bars()}) WHERE datetime > TIMESTAMP '{KEPT_UNTIL}'
    AND datetime <= TIMESTAMP '2024-01-30 23:45:00'""",
)
def _(spark, folder):
    """Runs between the newest landed bar and this one did not take place; their bars are fetched now."""
    bars = tables.stock_company(spark, folder)
    keys = masterdata.company_symbols(tables.company_info(spark, folder))
    landed = bars.where(F.col("datetime") <= times.run_time(KEPT_UNTIL))
    upto = landed.unionByName(bars.limit(1).withColumn("datetime", times.run_time(KEPT_UNTIL)))
    return ingest.fetch_bars(bars, upto, keys, "company", NOW, strict=False)


@_register(
    "bars_missing_at_slot",
    f"""SELECT company_symbol, max(datetime) AS last_datetime,
    CASE WHEN max(datetime) IS NULL THEN 'missing' ELSE 'stale' END AS status
  FROM (SELECT CAST(c_custkey AS VARCHAR) AS company_symbol FROM customer)
    LEFT JOIN ({_company_bars()}) USING (company_symbol)
  GROUP BY 1 HAVING max(datetime) IS NULL
    OR date_trunc('minute', max(datetime)) <> TIMESTAMP '2024-01-30 23:45:00'""",
)
def _(spark, folder):
    """The keys a strict run names in its error; the error itself is raised and caught here."""
    bars = tables.stock_company(spark, folder)
    keys = masterdata.company_symbols(tables.company_info(spark, folder))
    stale = bar_ops.stale_keys(keys, bars, "company_symbol", NOW)
    try:
        bar_ops.require_fresh(stale, "company_symbol")
    except bar_ops.DataNotFound:
        return stale
    return stale.where("false")


@_register(
    "bootstrap_or_incremental",
    f"""SELECT 'stock_company' AS target, 'incremental' AS mode, max(datetime) AS since
    FROM ({_company_bars()})
  UNION ALL SELECT 'stock_sector', 'bootstrap', TIMESTAMP '2023-12-31 00:04:00'""",
)
def _(spark, folder):
    """Company bars have been landed, sector bars have not."""
    landed = {
        "stock_company": tables.stock_company(spark, folder),
        "stock_sector": spark.createDataFrame([], schemas.STOCK_SECTOR),
    }
    company, sector = [
        landing.fetch_window(df, NOW).select(F.lit(name).alias("target"), "mode", "since")
        for name, df in landed.items()
    ]
    return company.unionByName(sector)


@_register(
    "price_panel_to_long",
    f"""SELECT t.datetime, s.sector, b.open, b.high, b.low, b.close
  FROM (SELECT DISTINCT datetime FROM ({_sector_bars()})) t
    CROSS JOIN (SELECT CAST(r_regionkey AS VARCHAR) AS sector FROM region) s
    LEFT JOIN ({_sector_bars()}) b ON b.datetime = t.datetime AND b.sector = s.sector""",
)
def _(spark, folder):
    """Sector bars as a wide panel, and back: gaps come back as null rows."""
    fields = ["open", "high", "low", "close"]
    # one row per sector, a handful by definition
    tickers = [r[0] for r in tables.sector_info(spark, folder).select("sector_key").collect()]
    panel = panels.long_to_panel(
        tables.stock_sector(spark, folder), fields, "sector", sorted(tickers)
    )
    return panels.panel_to_long(panel, fields, "sector")


_PANEL_FIELDS = ("open", "high", "low", "close", "volume", "dividends", "stock_splits")


@_register(
    "seven_field_panel_to_long",
    f"""WITH bars AS (SELECT time_bucket(INTERVAL '15 minutes', ts) AS datetime,
      CAST(c_nationkey AS VARCHAR) AS industry_key, {_OHLC}
    FROM events JOIN customer ON user_id = c_custkey
    WHERE ts IS NOT NULL AND value IS NOT NULL GROUP BY 1, 2)
  SELECT t.datetime, s.industry_key, open, high, low, close, volume,
    close / 100 AS dividends, CASE WHEN close IS NOT NULL THEN 0.0::DOUBLE END AS stock_splits
  FROM (SELECT DISTINCT datetime FROM bars) t
    CROSS JOIN (SELECT CAST(n_nationkey AS VARCHAR) AS industry_key FROM nation) s
    LEFT JOIN bars b ON b.datetime = t.datetime AND b.industry_key = s.industry_key""",
)
def _(spark, folder):
    """All seven fields of the vendor's panel, one column per field and industry, and back."""
    companies = tables.company_info(spark, folder).select("company_symbol", "industry_key")
    ticks = tables.ticks(spark, folder).join(companies, "company_symbol")
    bars = bar_ops.ohlcv(ticks, ["industry_key"]).withColumns(
        {"dividends": F.col("close") / 100, "stock_splits": F.lit(0.0)}
    )
    # a panel has one column per ticker, so their list is short by definition
    industries = tables.industry_keys(spark, folder).select("industry_key")
    tickers = sorted(r[0] for r in industries.collect())
    panel = panels.long_to_panel(bars, _PANEL_FIELDS, "industry_key", tickers)
    return panels.panel_to_long(panel, _PANEL_FIELDS, "industry_key")


@_register(
    "tagged_vendor_bars",
    f"""SELECT strftime(datetime, '%Y-%m-%dT%H:%M:%S+00:00') AS "Datetime", close AS "Close", 'R' || sector AS sector_key
  FROM ({_sector_bars()}) WHERE sector IN ('0', '3') AND NOT open < 1""",
)
def _(spark, folder):
    """Bars of two sectors as fetched: wanted columns only, and each row marked with the key it was fetched for."""
    landed = _landed(spark, folder, "sector")
    fetched = [
        landed.where(F.col("Sector") == key)
        .transform(columns.select_columns, ["Datetime", "Close", "Volume", "Sector"])
        .transform(columns.drop_columns, ["Volume", "Sector", "Dividends"])
        .transform(columns.tag, "sector_key", f"R{key}")
        for key in ("0", "3")
    ]
    readable = fetched[0].unionByName(fetched[1])
    clock = times.iso_offset(times.parse_instant(F.col("Datetime")))
    return readable.where(clock.isNotNull()).withColumn("Datetime", clock)


# ---------------------------------------------------------------- models


@_register("company_detail", _DETAIL)
def _(spark, folder):
    return marts.company_detail(
        tables.company_info(spark, folder),
        tables.industry_keys(spark, folder),
        tables.sector_info(spark, folder),
    )


@_register("sector_change", _CHANGE)
def _(spark, folder):
    return marts.sector_change(tables.stock_sector(spark, folder))


def _top_of(spark, folder, **options):
    return marts.stock_top_sector(tables.stock_sector(spark, folder), **options)


@_register("top_sector_now", _top())
def _(spark, folder):
    return _top_of(spark, folder)


@_register("top_sector_now_settled", _top())
def _(spark, folder):
    """The same row, from no more of the newest bars than settle it."""
    return marts.settled_top_sector(tables.stock_sector(spark, folder))


@_register("top_sector_now_from_days", _top())
def _(spark, folder):
    """From one row a sector and day: first the early days with a third of their bars missing, then half of all days again, then the rest."""
    path = session.scratch_dir(spark, "leads")
    bars = session.pinned(tables.stock_sector(spark, folder))
    day = times.utc_day(F.col("datetime"))
    early = bars.where((F.col("datetime") < KEPT_UNTIL) & (F.pmod(F.hash("sector", "datetime"), F.lit(3)) > 0))
    leader.refresh_day_leads(early, path)
    # late bars of the earlier days, and the days that were not there yet
    days = sorted(r[0] for r in bars.select(day.cast("string")).distinct().collect())
    for touched in (days[: len(days) // 2], days[len(days) // 2 :]):
        leader.refresh_day_leads(bars, path, touched)
    return leader.top_sector_of(leader.read_day_leads(spark, path))


@_register("top_sector_now_either_direction", _top("abs(diff_percent)"))
def _(spark, folder):
    return _top_of(spark, folder, direction="abs")


@_register("top_sector_companies", _MEMBERS)
def _(spark, folder):
    return marts.top_sector_companies(
        tables.company_info(spark, folder),
        tables.industry_keys(spark, folder),
        _top_of(spark, folder),
    )


@_register(
    "top_sector",
    f"""SELECT sector, industry_key, industry_name, market_weight
  FROM ({_top()}) JOIN ({_INDUSTRY}) ON sector = sector_key""",
)
def top_sector(spark, folder):
    return marts.top_sector(tables.industry_info(spark, folder), _top_of(spark, folder))


@_register(
    "top_sector_in_order",
    f"""SELECT industry_key, market_weight, rank() OVER (ORDER BY market_weight DESC NULLS LAST) AS place
  FROM ({SQL["top_sector"]})""",
)
def _(spark, folder):
    """The stored model as it is read: heaviest industry first; equal weights share the first of their places."""
    industries = marts.top_sector(tables.industry_info(spark, folder), _top_of(spark, folder))
    read = marts.in_read_order(industries, "top_sector").select("industry_key", "market_weight")
    # one sector's industries, a short list that stays in its order
    listed = read.agg(F.collect_list(F.struct("industry_key", "market_weight")).alias("rows"))
    numbered = listed.select(F.posexplode("rows").alias("at", "row")).select("row.*", "at")
    first = F.min("at").over(Window.partitionBy("market_weight"))
    return numbered.select("industry_key", "market_weight", (first + 1).cast("long").alias("place"))


_TOP_NEWS = f"""SELECT pubdate, title, summary, company_name, sector
  FROM (SELECT *, row_number() OVER (PARTITION BY sector ORDER BY {_NEWEST}) AS rn
    FROM ({_NEWS}) JOIN ({_MEMBERS}) ON company_key = company_symbol)
  WHERE rn <= 5"""


def _news_inputs(spark, folder):
    return (
        tables.news(spark, folder),
        tables.company_info(spark, folder),
        tables.industry_keys(spark, folder),
        _top_of(spark, folder),
    )


@_register("top_sector_news", _TOP_NEWS)
def _(spark, folder):
    return marts.top_sector_news(*_news_inputs(spark, folder))


@_register("top_sector_news_preranked", _TOP_NEWS)
def _(spark, folder):
    """The plan for companies too many to broadcast: rank per company first."""
    return marts.top_sector_news(*_news_inputs(spark, folder), limit=0)


@_register(
    "top_sector_news_distinct",
    f"""WITH found AS (SELECT * FROM ({_NEWS}) JOIN ({_MEMBERS}) ON company_key = company_symbol),
  one AS (SELECT * FROM found
    QUALIFY row_number() OVER (PARTITION BY content_id ORDER BY company_key) = 1)
  SELECT pubdate, title, summary, company_name, sector FROM one
  QUALIFY row_number() OVER (PARTITION BY sector ORDER BY {_NEWEST}) <= 5""",
)
def _(spark, folder):
    return marts.top_sector_news(*_news_inputs(spark, folder), distinct_articles=True)


@_register(
    "top_sector_news_distinct_copies",
    f"""WITH copies AS (
    SELECT doc_id, CAST(user_id AS VARCHAR) AS company_key, ts AS pubdate
      FROM documents JOIN events ON doc_id // 3 = event_id),
  found AS (SELECT CAST(doc_id // 3 AS VARCHAR) AS content_id, CAST(doc_id AS VARCHAR) AS title,
      doc_id, pubdate + INTERVAL 1 MINUTE * (doc_id % 3) AS pubdate, m.company_name, m.sector, m.company_symbol
    FROM copies JOIN ({_MEMBERS}) m
      ON m.company_symbol = CAST(CAST(company_key AS BIGINT) + doc_id % 3 AS VARCHAR)),
  one AS (SELECT * FROM found
    QUALIFY row_number() OVER (PARTITION BY content_id ORDER BY company_symbol, pubdate, title) = 1)
  SELECT pubdate, title, title AS summary, company_name, sector FROM one
  QUALIFY row_number() OVER (PARTITION BY sector
    ORDER BY pubdate DESC NULLS LAST, content_id, company_symbol, title) <= 5""",
)
def _(spark, folder):
    """Articles under several companies at different times, by the plan for many companies."""
    events = tables.table(spark, folder, "events").select(
        F.col("event_id").alias("article"), F.col("user_id"), "ts"
    )
    third = F.col("doc_id") % 3
    copies = (
        tables.table(spark, folder, "documents")
        .select("doc_id", F.floor(F.col("doc_id") / 3).alias("article"))
        .join(events, "article")
        .select(
            F.col("article").cast("string").alias("content_id"),
            (F.col("user_id") + third).cast("string").alias("company_key"),
            F.col("doc_id").cast("string").alias("title"),
            F.col("doc_id").cast("string").alias("summary"),
            F.timestamp_add("MINUTE", third, F.col("ts")).alias("pubdate"),
        )
    )
    _, companies, industries, top = _news_inputs(spark, folder)
    return marts.top_sector_news(
        copies, companies, industries, top, distinct_articles=True, limit=0
    )


_COMPANY_NEWS = f"""SELECT pubdate, company_name, sector, industry_key, title, summary
  FROM ({_MEMBERS}) JOIN
    (SELECT *, row_number() OVER (PARTITION BY company_key ORDER BY {_NEWEST}) AS rn
      FROM ({_NEWS})) ON company_symbol = company_key
  WHERE rn <= 5"""


@_register("top_sector_company_news", _COMPANY_NEWS)
def _(spark, folder):
    return marts.top_sector_company_news(*_news_inputs(spark, folder))


@_register("top_sector_company_news_preranked", _COMPANY_NEWS)
def _(spark, folder):
    return marts.top_sector_company_news(*_news_inputs(spark, folder), limit=0)


# Every tenth company moves to the next industry after two loads of news.
_MOVED_MEMBERS = f"""SELECT CAST(c_custkey AS VARCHAR) AS company_symbol, c_name AS company_name,
    CAST(n_nationkey AS VARCHAR) AS industry_key, sector
  FROM customer JOIN nation
      ON n_nationkey = CASE WHEN c_custkey % 10 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END
    JOIN ({_top()}) ON CAST(n_regionkey AS VARCHAR) = sector"""


def _merged_news(spark, folder):
    """News in four loads, one of them run twice, and the master data after companies have moved."""
    store = marts.newest_company_news(spark, session.scratch_dir(spark, "newest"), buckets=8)
    news = tables.news(spark, folder)
    part = F.pmod(F.hash("content_id"), F.lit(4))
    for load, number in ((0, 0), (1, 1), (1, 1), (2, 2), (3, 3)):
        store.load(news.where(part == number), load)
    moved = (F.col("industry_key").cast("int") + 1) % 25
    companies = tables.company_info(spark, folder).withColumn(
        "industry_key",
        F.when(F.col("company_symbol").cast("long") % 10 == 0, moved.cast("string")).otherwise(
            F.col("industry_key")
        ),
    )
    return store.read(), companies, tables.industry_keys(spark, folder), _top_of(spark, folder)


@_register("top_sector_company_news_merged", _COMPANY_NEWS.replace(_MEMBERS, _MOVED_MEMBERS))
def _(spark, folder):
    """From the five newest rows kept per company; companies count in the sector they are in now."""
    return marts.top_sector_company_news(*_merged_news(spark, folder))


@_register("top_sector_news_merged", _TOP_NEWS.replace(_MEMBERS, _MOVED_MEMBERS))
def _(spark, folder):
    return marts.top_sector_news(*_merged_news(spark, folder))


@_register(
    "stock_with_industry",
    f"""SELECT datetime, open, high, low, close, volume, company_name, industry_name,
    sector_key AS sector
  FROM ({_company_bars()}) JOIN ({_DETAIL}) USING (company_symbol)""",
)
def _(spark, folder):
    return marts.stock_with_industry(
        tables.stock_company(spark, folder),
        tables.company_info(spark, folder),
        tables.industry_keys(spark, folder),
        tables.sector_info(spark, folder),
    )


# ---------------------------------------------------------------- raw tables


_RAW = {
    "sector_info": (
        tables.sector_info,
        "SELECT CAST(r_regionkey AS VARCHAR) AS sector_key, r_name AS sector_name,"
        " '^S' || r_regionkey AS sector_symbol FROM region",
    ),
    "industry_info": (tables.industry_info, _INDUSTRY),
    "company_info": (
        tables.company_info,
        "SELECT CAST(c_custkey AS VARCHAR) AS company_symbol, c_name AS company_name,"
        " CAST(c_nationkey AS VARCHAR) AS industry_key FROM customer",
    ),
    "stock_sector": (
        tables.stock_sector,
        f"SELECT * EXCLUDE (volume) FROM ({_sector_bars()})",
    ),
    "stock_company": (tables.stock_company, _company_bars()),
    "news": (tables.news, _NEWS),
}

for _name, (_source, _sql) in _RAW.items():

    @_register(f"raw_projection_{_name}", _sql)
    def _(spark, folder, name=_name, source=_source):
        return landing.raw_columns(source(spark, folder), name)


@_register(
    "company_keys",
    "SELECT CAST(c_custkey AS VARCHAR) AS company_symbol FROM customer WHERE c_custkey IS NOT NULL",
)
def _(spark, folder):
    return masterdata.company_symbols(tables.company_info(spark, folder))


# ---------------------------------------------------------------- cleaning and scalars


def _payloads(news):
    """News as the vendor sends it: JSON, ticker -> items; there is none without a ticker."""
    news = news.where(F.col("company_key").isNotNull())
    content = F.struct(
        F.col("content_id").alias("id"),
        "title",
        "summary",
        F.date_format("pubdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("pubDate"),
        F.struct("url").alias("canonicalUrl"),
    )
    items = F.array(F.struct(content.alias("content")))
    # over a plain scan Spark may build the map before it has left out rows without a ticker
    ticker = F.coalesce("company_key", F.lit(""))
    return news.select(F.to_json(F.create_map(ticker, items)).alias("payload"))


@_register(
    "news_flatten",
    f"""SELECT content_id, title, summary, url, company_key,
    strftime(pubdate, '%Y-%m-%dT%H:%M:%SZ') AS pubdate, CAST(pubdate AS DATE) AS date
  FROM ({_NEWS}) WHERE company_key IS NOT NULL""",
)
def _(spark, folder):
    return ingest.news_rows(_payloads(tables.news(spark, folder)))


@_register(
    "news_with_date",
    """SELECT event_id, instant, strftime(instant, '%Y-%m-%d') AS date,
    strftime(instant, '%Y/%m') AS month, strftime(instant, '%Y-%m-%dT%H:%M:%S+00:00') AS iso
  FROM (SELECT event_id, CASE event_type WHEN 'error' THEN NULL
      WHEN 'click' THEN date_trunc('second', ts) + INTERVAL 5 HOURS
      ELSE date_trunc('second', ts) END AS instant FROM events)""",
)
def _(spark, folder):
    """Publication times as text: without zone, with an offset, and unreadable."""
    clock = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("no time "), F.col("props")))
        .when(F.col("event_type") == "click", F.concat(clock, F.lit("-05:00")))
        .otherwise(clock)
    )
    events = tables.table(spark, folder, "events").select("event_id", text.alias("pubdate"))
    dated = columns.set_date(events, "pubdate")
    at = times.parse_instant(F.col("pubdate"))
    return dated.select(
        "event_id",
        at.alias("instant"),
        "date",
        times.day_text(at, "yyyy/MM").alias("month"),
        times.iso_offset(at).alias("iso"),
    )


@_register(
    "iso_offset_text",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS iso,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE event_type WHEN 'click' THEN '-05:00'
      WHEN 'view' THEN 'Z' ELSE '+00:00' END AS colon
  FROM events""",
)
def _(spark, folder):
    clock = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    offset = (
        F.when(F.col("event_type") == "click", "-0500")
        .when(F.col("event_type") == "view", "Z")
        .otherwise("+0000")
    )
    return tables.table(spark, folder, "events").select(
        "event_id",
        times.iso_offset(F.col("ts")).alias("iso"),
        times.colon_offset(F.concat(clock, offset)).alias("colon"),
    )


@_register(
    "run_keys",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H%M') AS hhmm,
    ts - INTERVAL 5 HOURS AS exchange_clock,
    date_trunc('minute', ts - INTERVAL 19 MINUTES) AS slot,
    date_diff('minute', TIMESTAMP '2024-01-01 00:00:30', ts) AS minutes
  FROM events""",
)
def _(spark, folder):
    """Folder keys, exchange time, target slot and minute distance of every tick."""
    ts = F.col("ts")
    return tables.table(spark, folder, "events").select(
        "event_id",
        times.day_text(ts).alias("day"),
        times.hhmm_text(ts).alias("hhmm"),
        times.exchange_clock(ts).alias("exchange_clock"),
        times.target_slot(ts).alias("slot"),
        times.minute_gap(times.run_time("2024-01-01 00:00:30"), ts).alias("minutes"),
    )


def _landed(spark, folder, kind):
    """Bars under the vendor's column names, the time as text, some of it unreadable."""
    source = tables.stock_sector if kind == "sector" else tables.stock_company
    bars = source(spark, folder)
    if kind == "sector":
        bars = bars.withColumn("volume", F.lit(0).cast("double"))
    text = F.when(F.col("open") < 1, F.lit("not a time")).otherwise(
        times.iso_offset(F.col("datetime"))
    )
    extra = {"dividends": F.lit(0.0), "stock_splits": F.lit(0.0), "datetime": text}
    vendor = {ours: theirs for theirs, ours in schemas.LANDING_FIELDS.items()}
    return columns.rename_columns(bars.withColumns(extra), vendor)


_UNREADABLE = "CASE WHEN open < 1 THEN NULL ELSE datetime END AS datetime"


@_register(
    "clean_bars_sector",
    f"SELECT {_UNREADABLE}, sector, open, high, low, close FROM ({_sector_bars()})",
)
def _(spark, folder):
    return columns.clean_bars(_landed(spark, folder, "sector"), "Sector")


@_register(
    "clean_bars_company",
    f"SELECT {_UNREADABLE}, company_symbol, open, high, low, close, volume"
    f" FROM ({_company_bars()})",
)
def _(spark, folder):
    return columns.clean_bars(_landed(spark, folder, "company"), "company")


# ---------------------------------------------------------------- seen and repeated rows

# French articles carry no id, to have null keys on both sides.
_KEYED = f"""SELECT CASE WHEN title LIKE 'fr %' THEN NULL ELSE content_id END AS content_id,
    title, company_key, pubdate, url FROM ({_NEWS})"""
_SEEN = f"""SELECT DISTINCT content_id, company_key FROM ({_KEYED})
  WHERE pubdate < TIMESTAMP '{NEWS_KEPT_UNTIL}'"""


def _keyed_news(spark, folder):
    no_id = F.when(~F.col("title").startswith("fr "), F.col("content_id"))
    return (
        tables.news(spark, folder)
        .withColumn("content_id", no_id)
        .select("content_id", "title", "company_key", "pubdate", "url")
    )


@_register(
    "news_drop_seen",
    f"""SELECT * FROM ({_KEYED}) a WHERE NOT EXISTS (SELECT 1 FROM ({_SEEN}) s
    WHERE a.content_id IS NOT DISTINCT FROM s.content_id
      AND a.company_key IS NOT DISTINCT FROM s.company_key)""",
)
def _(spark, folder):
    news = _keyed_news(spark, folder)
    ledger = news.where(F.col("pubdate") < NEWS_KEPT_UNTIL)
    return dedupe.drop_seen(news, ledger, schemas.NEWS_KEYS)


@_register(
    "news_new_only",
    f"""SELECT * FROM ({_KEYED}) a WHERE NOT EXISTS (SELECT 1 FROM ({_SEEN}) s
    WHERE a.content_id IS NOT DISTINCT FROM s.content_id
      AND a.company_key IS NOT DISTINCT FROM s.company_key)
  QUALIFY row_number() OVER (PARTITION BY content_id, company_key,
    CASE WHEN content_id IS NULL OR company_key IS NULL THEN concat_ws('|', pubdate, title, url) END
    ORDER BY pubdate DESC, title DESC, url DESC) = 1""",
)
def _(spark, folder):
    """Every article fetched twice, half of them known already; different ones without an id all stay."""
    news = _keyed_news(spark, folder)
    ledger = news.where(F.col("pubdate") < NEWS_KEPT_UNTIL)
    return dedupe.new_unique(news.unionByName(news), ledger, schemas.NEWS_KEYS, "pubdate")


@_register(
    "news_ledger",
    f"SELECT DISTINCT content_id, company_key FROM ({_KEYED})",
)
def _(spark, folder):
    news = _keyed_news(spark, folder)
    known = F.coalesce(F.col("pubdate") < NEWS_KEPT_UNTIL, F.lit(False))
    return ingest.next_ledger(news.where(known), news.where(~known))


@_register(
    "keep_first_by_key",
    """SELECT c_nationkey, c_mktsegment, c_custkey, c_name FROM customer
  QUALIFY row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) = 1""",
)
def _(spark, folder):
    rows = tables.table(spark, folder, "customer").select(
        "c_nationkey", "c_mktsegment", "c_custkey", "c_name"
    )
    return dedupe.keep_first(rows, ["c_nationkey", "c_mktsegment"], ["c_custkey"])


@_register(
    "top5_per_industry",
    """SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE CAST(c_custkey AS VARCHAR) END
      AS company_symbol, c_name AS company_name, CAST(c_nationkey AS VARCHAR) AS industry_key
  FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey
      ORDER BY c_acctbal DESC NULLS LAST, c_custkey) AS rn FROM customer)
  WHERE rn <= 5 AND c_mktsegment <> 'BUILDING'""",
)
def _(spark, folder):
    """Companies by balance; those of one segment come without a symbol."""
    symbol = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(
        F.col("c_custkey").cast("string")
    )
    rows = tables.table(spark, folder, "customer").select(
        F.col("c_nationkey").alias("industry_pos"),
        symbol.alias("company_symbol"),
        F.col("c_name").alias("company_name"),
        F.col("c_nationkey").cast("string").alias("industry_key"),
        "c_acctbal",
        "c_custkey",
    )
    order = [F.desc_nulls_last("c_acctbal"), F.asc("c_custkey")]
    listed = masterdata.with_positions(
        rows, "industry_key", order, masterdata.COMPANIES_PER_INDUSTRY
    )
    return masterdata.companies(listed.drop("c_acctbal", "c_custkey"))


def _sector_records(spark, folder):
    """Each sector lists its industries, and the next sector's as well."""
    industry = tables.industry_info(spark, folder)
    listed = industry.select(
        F.explode(
            F.array(
                F.col("sector_key").cast("int"), F.pmod(F.col("sector_key").cast("int") + 1, F.lit(5))
            )
        ).alias("sector_pos"),
        F.struct(
            "industry_key", "industry_name", "industry_symbol", "market_weight"
        ).alias("industry"),
    )
    # a sector's list of industries is short by definition
    lists = listed.groupBy("sector_pos").agg(F.sort_array(F.collect_list("industry")).alias("industries"))
    sectors = tables.sector_info(spark, folder).withColumn(
        "sector_pos", F.col("sector_key").cast("int")
    )
    return sectors.join(lists, "sector_pos", "left")


@_register("master_sectors", _RAW["sector_info"][1])
def _(spark, folder):
    records = _sector_records(spark, folder)
    return masterdata.sectors(records.unionByName(records))


@_register(
    "master_industries",
    f"""SELECT industry_key, industry_name, industry_symbol, market_weight,
    CAST(least(CAST(sector_key AS INT), (CAST(sector_key AS INT) + 1) % 5) AS VARCHAR) AS sector_key
  FROM ({_INDUSTRY})""",
)
def _(spark, folder):
    """An industry listed by two sectors stays with the earlier one."""
    return masterdata.industries(masterdata.industry_rows(_sector_records(spark, folder)))


def _industry_records(spark, folder):
    """Each industry lists its companies, one more than is taken."""
    symbol = F.when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("M"), "c_custkey"))
    rows = tables.table(spark, folder, "customer").select(
        F.col("c_nationkey").alias("industry_pos"),
        F.col("c_nationkey").cast("string").alias("industry_key"),
        F.coalesce(symbol, F.col("c_custkey").cast("string")).alias("company_symbol"),
        F.col("c_name").alias("company_name"),
        "c_acctbal",
        "c_custkey",
    )
    listed = masterdata.with_positions(
        rows,
        "industry_key",
        [F.asc_nulls_first("c_acctbal"), F.asc("c_custkey")],
        masterdata.COMPANIES_PER_INDUSTRY + 1,
    )
    # at most six entries per list
    entries = F.sort_array(F.collect_list(F.struct("pos", "company_symbol", "company_name")))
    records = listed.groupBy("industry_pos", "industry_key").agg(
        F.transform(entries, lambda e: F.struct(e["company_symbol"], e["company_name"])).alias(
            "companies"
        )
    )
    return records


@_register(
    "master_companies",
    """SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN 'M' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END
      AS company_symbol, c_name AS company_name, CAST(c_nationkey AS VARCHAR) AS industry_key
  FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey
      ORDER BY c_acctbal NULLS FIRST, c_custkey) AS rn FROM customer)
  WHERE rn <= 5""",
)
def _(spark, folder):
    """Industry records that list one company more than is taken."""
    return masterdata.companies(masterdata.company_rows(_industry_records(spark, folder)))


_MASTER = {
    "sector_info": ("sector_key", "sector_name", "NULL", _RAW["sector_info"][1]),
    "industry_info": ("industry_key", "industry_name", "sector_key", SQL["master_industries"]),
    "company_info": ("company_symbol", "company_name", "industry_key", SQL["master_companies"]),
}


@_register(
    "master_refresh_roundtrip",
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", {key} AS key, {title} AS title, CAST({parent} AS VARCHAR) AS parent,"
        f" (SELECT count(*) FROM ({sql})) AS loaded FROM ({sql})"
        for name, (key, title, parent, sql) in _MASTER.items()
    ),
)
def _(spark, folder):
    """All three master tables replaced from nested records, twice, the first time with other ones."""
    place = session.scratch_dir(spark, "master")
    database = f"master_{place[-32:]}"
    sectors, industries = _sector_records(spark, folder), _industry_records(spark, folder)
    ingest.refresh_master(spark, sectors.limit(2), industries.limit(3), database, place)
    sizes = ingest.refresh_master(spark, sectors.unionByName(sectors), industries, database, place)
    stored = [
        spark.table(f"{database}.{name}").select(
            F.lit(name).alias("table"),
            F.col(key).alias("key"),
            F.col(title).alias("title"),
            (F.lit(None) if parent == "NULL" else F.col(parent)).cast("string").alias("parent"),
            F.lit(sizes[name]).cast("long").alias("loaded"),
        )
        for name, (key, title, parent, _) in _MASTER.items()
    ]
    return reduce(DataFrame.unionByName, stored)


# ---------------------------------------------------------------- data checks


def _checked_tables(spark, folder):
    companies = tables.company_info(spark, folder)
    industries = tables.industry_info(spark, folder)
    sectors = tables.sector_info(spark, folder)
    news = tables.news(spark, folder)
    top = session.pinned(_top_of(spark, folder))
    return {
        "company_info": companies,
        "industry_info": industries,
        "sector_info": sectors,
        "news": news,
        "stg_company_detail": marts.company_detail(companies, industries, sectors),
        "stg_stock_top_sector": top,
        "stg_company_sector_con": marts.top_sector_companies(companies, industries, top),
        "top_sector": marts.top_sector(industries, top),
        "top_sector_company_news": marts.top_sector_company_news(
            news, companies, industries, top
        ),
        "top_sector_news": marts.top_sector_news(news, companies, industries, top),
    }


def _declared_sql() -> str:
    models = {
        "company_info": _RAW["company_info"][1],
        "industry_info": _INDUSTRY,
        "sector_info": _RAW["sector_info"][1],
        "news": _NEWS,
        "stg_company_detail": _DETAIL,
        "stg_stock_top_sector": _top(),
        "stg_company_sector_con": _MEMBERS,
        "top_sector": SQL["top_sector"],
        "top_sector_company_news": _COMPANY_NEWS,
        "top_sector_news": _TOP_NEWS,
    }
    parts = []
    for table, sql in models.items():
        not_null, unique = quality.DECLARED[table]
        parts += [
            f"""SELECT '{table}' AS "table", '{c}' AS "column", 'not_null' AS test,
    count(*) - count({c}) AS failures FROM ({sql})"""
            for c in not_null
        ]
        parts += [
            f"""SELECT '{table}', '{c}', 'unique', count(*)
    FROM (SELECT {c} FROM ({sql}) WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"""
            for c in unique
        ]
    return "\n  UNION ALL ".join(parts)


@_register("dq_declared", _declared_sql())
def _(spark, folder):
    """All declared checks; none of them fails on the test tables."""
    return quality.check_tables(_checked_tables(spark, folder))


@_register(
    "dq_declared_failing",
    """SELECT 'company_info' AS "table", 'company_symbol' AS "column", 'not_null' AS test,
    count(*) - count(symbol) AS failures FROM (%s)
  UNION ALL SELECT 'company_info', 'company_symbol', 'unique', count(*)
    FROM (SELECT symbol FROM (%s) WHERE symbol IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"""
    % (("SELECT CASE WHEN c_custkey % 10 > 0 THEN CAST(c_custkey // 2 AS VARCHAR) END AS symbol FROM customer",) * 2),
)
def _(spark, folder):
    """The checks of a table with missing and repeated keys."""
    customer = tables.table(spark, folder, "customer")
    symbol = F.when(F.col("c_custkey") % 10 > 0, F.floor(F.col("c_custkey") / 2).cast("string"))
    return quality.check_tables({"company_info": customer.select(symbol.alias("company_symbol"))})


# Mentions of which every seventh id is missing.
_MENTIONS_KEYED = """SELECT CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 7 > 0
    THEN json_extract_string(props, '$.k') END AS content_id, CAST(user_id AS VARCHAR) AS company_key FROM events"""


@_register(
    "dq_merged",
    f"""{SQL["dq_declared_failing"]}
  UNION ALL SELECT 'news', 'content_id', 'not_null', count(*) - count(content_id) FROM ({_MENTIONS_KEYED})
  UNION ALL SELECT 'news', 'company_key', 'not_null', count(*) - count(company_key) FROM ({_MENTIONS_KEYED})
  UNION ALL SELECT 'news', 'company_key, content_id', 'unique', count(*) FROM (
    SELECT 1 FROM ({_MENTIONS_KEYED}) WHERE content_id IS NOT NULL AND company_key IS NOT NULL
    GROUP BY company_key, content_id HAVING count(*) > 1)""",
)
def _(spark, folder):
    """Checks after three loads, one of them run twice: partial results by load (customers) and by day (mentions) that merge."""
    path = session.scratch_dir(spark, "checks")
    customer = tables.table(spark, folder, "customer")
    symbol = F.when(F.col("c_custkey") % 10 > 0, F.floor(F.col("c_custkey") / 2).cast("string"))
    rows = customer.select(symbol.alias("company_symbol"), F.pmod(F.hash("c_custkey"), F.lit(3)).alias("load"))
    companies = CheckState(spark, f"{path}/company_info", *quality.DECLARED["company_info"])
    for load in (0, 1, 1, 2):
        companies.update(rows.where(F.col("load") == load), "load")
    mentions = _mentions(tables.table(spark, folder, "events"))
    keyless = F.when(F.col("content_id").cast("long") % 7 > 0, F.col("content_id"))
    mentions = mentions.withColumn("content_id", keyless).withColumn("date", times.utc_day(F.col("pubdate")))
    news = CheckState(spark, f"{path}/news", quality.DECLARED["news"][0], [("company_key", "content_id")])
    for days in (F.col("date") < KEPT_UNTIL, F.col("date") >= KEPT_UNTIL, F.col("date") < "2024-01-05"):
        news.update(mentions.where(days | F.col("date").isNull()), "date")
    return reduce(
        DataFrame.unionByName,
        [state.result().select(F.lit(name).alias("table"), "*") for name, state in (("company_info", companies), ("news", news))],
    )


@_register(
    "dq_not_null",
    """SELECT 'content_id' AS "column", count(*) - count(content_id) AS failures FROM (%s)
  UNION ALL SELECT 'company_key', count(*) - count(company_key) FROM (%s)"""
    % (_KEYED, _KEYED),
)
def _(spark, folder):
    return quality.null_counts(_keyed_news(spark, folder), schemas.NEWS_KEYS)


@_register(
    "dq_unique",
    "SELECT industry_key, count(*) AS n_rows FROM (%s) WHERE industry_key IS NOT NULL"
    " GROUP BY 1 HAVING count(*) > 1" % _RAW["company_info"][1],
)
def _(spark, folder):
    return quality.repeated_values(tables.company_info(spark, folder), "industry_key")


_MENTIONS = """SELECT json_extract_string(props, '$.k') AS content_id,
    CAST(user_id AS VARCHAR) AS company_key, ts AS pubdate FROM events"""


def _mentions(events):
    """Ticks read as articles: the id is in a JSON text and repeats per company."""
    return events.select(
        F.get_json_object("props", "$.k").alias("content_id"),
        F.col("user_id").cast("string").alias("company_key"),
        F.col("ts").alias("pubdate"),
    )


@_register(
    "dq_news_key_dups",
    f"""SELECT company_key, content_id, count(*) AS cnt FROM ({_MENTIONS})
  WHERE content_id IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1""",
)
def _(spark, folder):
    return quality.news_key_repeats(_mentions(tables.table(spark, folder, "events")))


def _gaps(sql: str, time: str) -> str:
    return f"""SELECT sector, prev, curr, diff, count(*) AS n_rows
  FROM (SELECT sector, prev, curr, date_diff('minute', prev, curr) AS diff
    FROM (SELECT sector, {time} AS curr,
        lag({time}) OVER (PARTITION BY sector ORDER BY {time}) AS prev FROM ({sql})))
  WHERE diff < 15 GROUP BY 1, 2, 3, 4"""


@_register("dq_bar_interval", _gaps(_sector_bars(), "datetime"))
def _(spark, folder):
    return quality.short_gaps(tables.stock_sector(spark, folder))


@_register(
    "dq_tick_interval",
    _gaps(
        "SELECT CAST(n_regionkey AS VARCHAR) AS sector, ts FROM events"
        " JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey"
        " WHERE n_regionkey IS NOT NULL AND ts IS NOT NULL",
        "ts",
    ),
)
def _(spark, folder):
    """The same check on raw ticks, which are far closer together than bars."""
    detail = marts.company_detail(
        tables.company_info(spark, folder),
        tables.industry_keys(spark, folder),
        tables.sector_info(spark, folder),
    )
    sector_of = detail.select("company_symbol", F.col("sector_key").alias("sector")).dropna()
    ticks = tables.ticks(spark, folder)
    series = lookup.lookup_join(ticks, sector_of, "company_symbol").select("sector", "ts")
    return quality.short_gaps(series, "sector", "ts")


@_register(
    "dq_freshness",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS company_symbol, last_datetime,
    CASE WHEN last_datetime IS NULL THEN 'missing' ELSE 'stale' END AS status
  FROM customer LEFT JOIN (SELECT company_symbol, max(datetime) AS last_datetime
    FROM ({_company_bars()}) GROUP BY 1) ON company_symbol = CAST(c_custkey AS VARCHAR)
  WHERE last_datetime IS DISTINCT FROM TIMESTAMP '2024-01-30 23:45:00'""",
)
def _(spark, folder):
    return bar_ops.stale_keys(
        tables.company_info(spark, folder),
        tables.stock_company(spark, folder),
        "company_symbol",
        NOW,
    )


# ---------------------------------------------------------------- writes, read back


def _stored_news(spark, folder):
    """The news that several loads read, joined once: each further join would move all texts again."""
    path = session.scratch_dir(spark, "vendor")
    news = tables.news(spark, folder)
    sinks.write_dataset(news, path)
    return landing.read_or_empty(spark, path, news.schema)


@_register(
    "partitioned_roundtrip",
    f"""SELECT * REPLACE (date_trunc('second', pubdate) AS pubdate),
    CAST(pubdate AS DATE) AS date FROM ({_NEWS}) WHERE company_key IS NOT NULL""",
)
def _(spark, folder):
    """News stored by day; half of it was stored before, so only the rest is added."""
    path = session.scratch_dir(spark, "news")
    news = _stored_news(spark, folder)
    ingest.ingest_news(_payloads(news.where(F.col("pubdate") < NEWS_KEPT_UNTIL)), path)
    ingest.ingest_news(_payloads(news), path)
    return landing.read_news(spark, path)


@_register(
    "partitioned_roundtrip_ledger",
    f"""SELECT * REPLACE (date_trunc('second', pubdate) AS pubdate),
    CAST(pubdate AS DATE) AS date FROM ({_NEWS}) WHERE company_key IS NOT NULL""",
)
def _(spark, folder):
    """Three loads that overlap; stored keys come from a bucketed ledger that follows the store's files."""
    path = session.scratch_dir(spark, "news")
    news = _stored_news(spark, folder)
    table = f"news_keys_{path[-32:]}"
    ledger = KeyLedger(spark, table, f"{path}-keys", schemas.NEWS_KEYS, 16)
    try:
        for part in (news.where(F.col("pubdate") < NEWS_KEPT_UNTIL), news, news):
            ingest.ingest_news(_payloads(part), path, ledger=ledger)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return landing.read_news(spark, path)


@_register(
    "overwrite_partitions_roundtrip",
    f"""SELECT datetime, company_symbol, open, high, low,
    CASE WHEN datetime >= TIMESTAMP '{KEPT_UNTIL}' THEN close ELSE open END AS close,
    volume, CAST(datetime AS DATE) AS date
  FROM ({_company_bars()})""",
)
def _(spark, folder):
    """Provisional closes of all days, then the final ones of the later days."""
    path = session.scratch_dir(spark, "bars")
    bars = tables.stock_company(spark, folder).withColumn("date", F.to_date("datetime"))
    sinks.write_dataset(bars.withColumn("close", F.col("open")), path, "overwrite", ["date"])
    final = bars.where(F.col("date") >= KEPT_UNTIL)
    sinks.write_dataset(final, path, "overwrite_partitions", ["date"])
    return spark.read.parquet(path)


@_register(
    "land_bars_roundtrip",
    f"SELECT *, CAST(datetime AS DATE) AS date FROM ({_company_bars()})",
)
def _(spark, folder):
    """A first run lands a month of bars, the next run's slot is there already, and a retry adds nothing."""
    path = session.scratch_dir(spark, "stock")
    bars = tables.stock_company(spark, folder)
    keys = masterdata.company_symbols(tables.company_info(spark, folder))
    for _ in range(2):
        landed = landing.read_or_empty(spark, path, schemas.STOCK_COMPANY)
        sinks.land_bars(
            ingest.fetch_bars(bars, landed, keys, "company", NOW, strict=False), path
        )
    return spark.read.parquet(path)


@_register(
    "cleaned_slots_roundtrip",
    f"""SELECT datetime, sector, open, high, low,
    CASE WHEN datetime >= TIMESTAMP '{SLOTS_AGAIN_FROM}' THEN close ELSE open END AS close,
    CAST(datetime AS DATE) AS date, strftime(datetime, '%H%M') AS slot
  FROM ({_sector_bars()})""",
)
def _(spark, folder):
    """Cleaned sector bars by day and slot; slots that come again are replaced."""
    path = session.scratch_dir(spark, "cleaned")
    bars = tables.stock_sector(spark, folder)
    opened, newest = F.col("open"), F.col("datetime") >= SLOTS_AGAIN_FROM
    again = F.col("datetime") >= KEPT_UNTIL
    sinks.save_cleaned(bars.withColumn("close", F.when(again, F.col("high") + 1).otherwise(opened)), path)
    # the slots of all days from KEPT_UNTIL on come again; a slot that is not replaced keeps a wrong close
    sinks.save_cleaned(bars.where(again).withColumn("close", F.when(newest, F.col("close")).otherwise(opened)), path)
    stored = sinks.with_slot(bars).schema
    return spark.read.schema(stored).parquet(path)


@_register("cleaned_days_roundtrip", SQL["cleaned_slots_roundtrip"])
def _(spark, folder):
    """The same with one folder a day: in three loads, the slots of the early days, a third of the later ones' with wrong closes, and all of these."""
    path = session.scratch_dir(spark, "cleaned-days")
    bars = tables.stock_sector(spark, folder)
    newest, again = F.col("datetime") >= SLOTS_AGAIN_FROM, F.col("datetime") >= KEPT_UNTIL
    final = bars.withColumn("close", F.when(newest, F.col("close")).otherwise(F.col("open")))
    third = F.pmod(F.hash("datetime"), F.lit(3)) == 0
    sinks.save_cleaned_days(final.where(~again), path)
    sinks.save_cleaned_days(bars.where(again & third).withColumn("close", F.col("high") + 1), path)
    sinks.save_cleaned_days(final.where(again & ~third), path)
    sinks.save_cleaned_days(final.where(again & third), path)
    return spark.read.schema(sinks.with_slot(bars).schema).parquet(path)


@_register("load_bars_roundtrip", _company_bars())
def _(spark, folder):
    """Landed bars appended by name, twice; the second load finds nothing new."""
    landed_at, location = session.scratch_dir(spark, "landed"), session.scratch_dir(spark, "table")
    bars = tables.stock_company(spark, folder)
    vendor = {ours: theirs for theirs, ours in schemas.LANDING_FIELDS.items()}
    extra = {"dividends": F.lit(0.0), "stock_splits": F.lit(0.0)}
    sinks.write_dataset(columns.rename_columns(bars.withColumns(extra), vendor), landed_at)
    landed = landing.read_landed_bars(spark, landed_at, "company")
    table = f"stock_company_{location[-32:]}"
    try:
        ingest.load_bars(landed, "company", table, location)
        ingest.load_bars(landed, "company", table, location)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return spark.read.schema(schemas.STOCK_COMPANY).parquet(location)


@_register("load_one_kind_roundtrip", f"SELECT * EXCLUDE (volume) FROM ({_sector_bars()})")
def _(spark, folder):
    """Both kinds of bars are landed under one root, and one of them is loaded."""
    root, location = session.scratch_dir(spark, "landed"), session.scratch_dir(spark, "table")
    vendor = {ours: theirs for theirs, ours in schemas.LANDING_FIELDS.items()}
    extra = {"dividends": F.lit(0.0), "stock_splits": F.lit(0.0)}
    for kind, bars in [
        ("Company", tables.stock_company(spark, folder)),
        ("Sector", tables.stock_sector(spark, folder).withColumn("volume", F.lit(0).cast("long"))),
    ]:
        dated = columns.rename_columns(bars.withColumns(extra), vendor)
        sinks.write_dataset(dated, f"{root}/2024-01-31/0004/{kind}")
    table = f"stock_sector_{location[-32:]}"
    landed = landing.read_landed_bars(spark, root, "sector", "2024-01-31", "0004")
    try:
        ingest.load_bars(landed, "sector", table, location)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return spark.read.schema(schemas.STOCK_SECTOR).parquet(location)


def _foreign_files(path):
    """Writes bars as another tool would: a batch with gaps has its volume as a float, times are nanoseconds or not."""

    def write(batches):
        for n, rows in enumerate(batches):
            part = TaskContext.get().partitionId()
            none = rows["Company_symbol"].astype("int64") % 5 == 0
            kinds = [("gaps", rows[none].assign(Volume=float("nan")), "ns"), ("whole", rows[~none], ("ns", "us")[(n + part) % 2])]
            for name, some, unit in kinds:
                table = pa.Table.from_pandas(some, preserve_index=False)
                at = table.schema.get_field_index("Datetime")
                table = table.set_column(at, "Datetime", table["Datetime"].cast(pa.timestamp(unit, "UTC")))
                filesystem, place = pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
                filesystem.create_dir(place, recursive=True)
                pq.write_table(table, f"{place}/{part}-{n}-{name}.parquet", filesystem=filesystem, version="2.6")
            yield pd.DataFrame({"files": [len(kinds)]})

    return write


@_register(
    "foreign_bars_roundtrip",
    f"""SELECT datetime, company_symbol, open, high, low, close,
    CASE WHEN CAST(company_symbol AS BIGINT) % 5 > 0 THEN volume END AS volume
  FROM ({_company_bars()})""",
)
def _(spark, folder):
    """Files of another tool: nanosecond or microsecond times, volume whole or a number that may be none, columns absent."""
    path = session.scratch_dir(spark, "foreign")
    vendor = {ours: theirs for theirs, ours in schemas.LANDING_FIELDS.items()}
    bars = columns.rename_columns(tables.stock_company(spark, folder), vendor)
    # every task writes its own files, under names that a repeated task uses again
    bars.mapInPandas(_foreign_files(path), "files int").agg(F.sum("files")).first()
    return landing.read_foreign_bars(spark, path, "company")


@_register(
    "unreadable_payloads_kept",
    """SELECT payload, news FROM (SELECT '{"' || user_id || '": [' || event_id AS payload
    FROM events WHERE event_type = 'error'), (SELECT count(*) AS news
      FROM (SELECT DISTINCT event_id, user_id FROM events WHERE event_type <> 'error'))""",
)
def _(spark, folder):
    """Cut lines go to the quarantine folder, once in two runs; the other payloads are stored."""
    path = session.scratch_dir(spark, "payloads")
    events = tables.table(spark, folder, "events")
    item = F.struct(F.struct(F.col("event_id").cast("string").alias("id")).alias("content"))
    good = F.to_json(F.create_map(F.col("user_id").cast("string"), F.array(item)))
    cut = F.concat(F.lit('{"'), "user_id", F.lit('": ['), "event_id")
    payloads = events.select(
        F.when(F.col("event_type") == "error", cut).otherwise(good).alias("payload")
    )
    for _ in range(2):
        ingest.ingest_news(payloads, f"{path}/news", quarantine=f"{path}/unreadable")
    stored = landing.read_news(spark, f"{path}/news").agg(F.count(F.lit(1)).alias("news"))
    return spark.read.parquet(f"{path}/unreadable").join(F.broadcast(stored))


@_register(
    "append_by_name_roundtrip",
    f"""SELECT datetime, sector AS company_symbol, NULL::DOUBLE AS open, high, low, close,
    NULL::BIGINT AS volume FROM ({_sector_bars("1 hour")})
  UNION ALL SELECT datetime, company_symbol, open, high, low, close, volume
    FROM ({_company_bars("1 day")})""",
)
def _(spark, folder):
    """Two loads of one table: other order, case and columns, then the exact ones."""
    location = session.scratch_dir(spark, "table")
    table = f"by_name_{location[-32:]}"
    odd = tables.stock_sector(spark, folder, "1 hour").select(
        F.col("close").alias("CLOSE"),
        F.col("sector").alias("Company_Symbol"),
        F.lit("not in the table").alias("comment"),
        F.col("low").alias("Low"),
        "high",
        F.col("datetime").alias("DateTime"),
    )
    sinks.ensure_table(spark, table, schemas.STOCK_COMPANY, location)
    try:
        sinks.append_by_name(odd, table)
        sinks.append_by_name(tables.stock_company(spark, folder, "1 day"), table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return spark.read.schema(schemas.STOCK_COMPANY).parquet(location)


@_register(
    "full_refresh_roundtrip",
    "SELECT CAST(c_custkey AS VARCHAR) AS company_symbol, upper(c_name) AS company_name,"
    " CAST(c_nationkey AS VARCHAR) AS industry_key FROM customer",
)
def _(spark, folder):
    """A table replaced by rows made from itself."""
    place = session.scratch_dir(spark, "refresh")
    table = f"company_info_{place[-32:]}"
    sinks.full_refresh(tables.company_info(spark, folder), table, place)
    changed = spark.table(table).withColumn("company_name", F.upper("company_name"))
    sinks.full_refresh(changed, table, place)
    return spark.table(table)


@_register(
    "landed_folders",
    f"""SELECT DISTINCT 'date=' || strftime(datetime, '%Y-%m-%d') || '/kind=Company/' AS prefix
  FROM ({_company_bars("1 day")})""",
)
def _(spark, folder):
    """Folders that hold company bars, found from file names alone."""
    path = session.scratch_dir(spark, "stock")
    both = [
        df.select(F.to_date("datetime").alias("date"), F.lit(kind).alias("kind"), "open", "close")
        for kind, df in [
            ("Company", tables.stock_company(spark, folder, "1 day")),
            ("Sector", tables.stock_sector(spark, folder, "1 day")),
        ]
    ]
    sinks.write_dataset(both[0].unionByName(both[1]), path, "overwrite", ["date", "kind"])
    found = landing.folder_prefixes(landing.landed_files(spark, path), "kind=Company")
    return found.select(F.substring_index("prefix", f"{path.rsplit('/', 1)[-1]}/", -1).alias("prefix"))


@_register(
    "landed_folders_followed",
    f"""SELECT 'date=' || strftime(datetime, '%Y-%m-%d') || '/' AS prefix, min(CASE
      WHEN datetime >= TIMESTAMP '{KEPT_UNTIL}' OR date_part('day', datetime) % 5 = 0 THEN 1 ELSE 0 END) AS run
  FROM ({_company_bars("1 day")}) GROUP BY 1""",
)
def _(spark, folder):
    """Day folders and the run that found them: late days among the earlier ones are found by the second run alone."""
    path, inventory = session.scratch_dir(spark, "stock"), session.scratch_dir(spark, "inventory")
    bars = tables.stock_company(spark, folder, "1 day").withColumn("date", times.utc_day(F.col("datetime")))
    late = (F.col("datetime") >= KEPT_UNTIL) | (F.dayofmonth("date") % 5 == 0)
    for part in (~late, late):
        sinks.write_dataset(bars.where(part), path, "append", ["date"])
        found = jobs.follow_files(spark, path, inventory)
    found = jobs.follow_files(spark, path, inventory)
    prefix = F.concat(F.regexp_extract("path", r"(date=[^/]*)/[^/]*$", 1), F.lit("/"))
    return found.groupBy(prefix.alias("prefix")).agg(F.min("batch").cast("int").alias("run"))


@_register(
    "stock_with_industry_after_move",
    f"""SELECT datetime, open, high, low, close, volume, c_name AS company_name, n_name AS industry_name,
    CAST(n_regionkey AS VARCHAR) AS sector
  FROM ({_company_bars()}) JOIN customer ON company_symbol = CAST(c_custkey AS VARCHAR)
    LEFT JOIN nation ON n_nationkey = CASE WHEN c_custkey % 10 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END""",
)
def _(spark, folder):
    """Stored by day, then companies move to other industries: the days they have bars on are rebuilt, no day is named."""
    place = session.scratch_dir(spark, "moved")
    database = f"moved_{place[-32:]}"
    raw = {
        "stock_company": tables.stock_company(spark, folder),
        "company_info": tables.company_info(spark, folder),
        "industry_info": tables.industry_keys(spark, folder),
        "sector_info": tables.sector_info(spark, folder),
    }
    propagate.refresh_stock_with_industry(raw, database, place)
    moved = (F.col("industry_key").cast("int") + 1) % 25
    of_ten = F.col("company_symbol").cast("long") % 10 == 0
    companies = raw["company_info"].withColumn("industry_key", F.when(of_ten, moved.cast("string")).otherwise(F.col("industry_key")))
    propagate.refresh_stock_with_industry(raw | {"company_info": companies}, database, place)
    return spark.table(f"{database}.stock_with_industry").drop("date")


@_register("stored_top_sector_news", _TOP_NEWS)
def _(spark, folder):
    """All four models rebuilt and stored, and one of them read from its table."""
    place = session.scratch_dir(spark, "models")
    raw = {name: source(spark, folder) for name, (source, _) in _RAW.items()}
    stored = marts.refresh(raw, f"analytics_{place[-32:]}", place)
    return stored["top_sector_news"]


@_register(
    "stored_days_roundtrip",
    f"""WITH bars AS ({_company_bars()}), newest AS (SELECT max(datetime::DATE) AS d FROM bars)
  SELECT datetime, open, high, low, close,
    CASE WHEN datetime::DATE = d THEN 2 * volume ELSE volume END AS volume,
    company_name, industry_name, sector_key AS sector
  FROM bars JOIN ({_DETAIL}) USING (company_symbol) CROSS JOIN newest""",
)
def _(spark, folder):
    """Bars by industry stored for all days, then the newest day's rebuilt from changed bars."""
    place = session.scratch_dir(spark, "by-day")
    table = f"by_day_{place[-32:]}"
    lookups = (
        tables.company_info(spark, folder),
        tables.industry_keys(spark, folder),
        tables.sector_info(spark, folder),
    )
    bars = tables.stock_company(spark, folder)
    twice = bars.withColumn("volume", 2 * F.col("volume"))
    newest = bars.agg(F.max(times.utc_day(F.col("datetime"))).cast("string")).first()[0]
    try:
        for source, days in ((bars, None), (twice, [newest])):
            model = marts.stock_with_industry(source, *lookups)
            sinks.refresh_days(model, table, place, days)
        stored = spark.table(table).inputFiles()
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return spark.read.option("basePath", stored[0].split("/date=")[0]).parquet(*stored).drop("date")


# ---------------------------------------------------------------- streams


def _event_stream(spark, folder):
    events = tables.table(spark, folder, "events")
    # written as a pattern, so that the table may be one file as well as a folder
    return spark.readStream.schema(events.schema).parquet(f"{folder}/events.parque[t]")


@_register(
    "stream_clean_append",
    f"SELECT {_UNREADABLE}, sector, open, high, low, close FROM ({_sector_bars()})",
)
def _(spark, folder):
    """Landed sector bars cleaned and appended; a second run adds nothing."""
    path = session.scratch_dir(spark, "stream")
    _landed(spark, folder, "sector").write.parquet(f"{path}/landed")
    schema = spark.read.parquet(f"{path}/landed").schema
    for _ in range(2):
        landed = jobs.file_stream(spark, f"{path}/landed", schema)
        jobs.clean_and_append(landed, "sector", f"{path}/clean", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/clean").drop("date")


@_register(
    "stream_news_dedupe",
    f"SELECT DISTINCT content_id, company_key FROM ({_MENTIONS}) WHERE pubdate IS NOT NULL",
)
def _(spark, folder):
    path = session.scratch_dir(spark, "stream")
    mentions = _mentions(_event_stream(spark, folder))
    jobs.append_new_news(mentions, f"{path}/news", f"{path}/checkpoint", "60 days")
    return spark.read.parquet(f"{path}/news").select(*schemas.NEWS_KEYS)


@_register(
    "stream_news_ingest",
    f"""SELECT * FROM ({_MENTIONS}) QUALIFY row_number() OVER (
    PARTITION BY content_id, company_key ORDER BY pubdate DESC) = 1""",
)
def _(spark, folder):
    """The newest mention per key, without a limit on how late copies come."""
    path = session.scratch_dir(spark, "stream")
    for _ in range(2):
        mentions = _mentions(_event_stream(spark, folder))
        jobs.ingest_new_news(mentions, f"{path}/news", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/news").drop("batch")


@_register("stream_news_ledger", f"SELECT DISTINCT content_id, company_key FROM ({_MENTIONS})")
def _(spark, folder):
    """Mentions in four batches, started twice; each batch asks a bucketed ledger for its own keys only."""
    path = session.scratch_dir(spark, "stream")
    mentions = _mentions(tables.table(spark, folder, "events"))
    mentions.repartition(4).write.parquet(f"{path}/landed")
    table = f"mention_keys_{path[-32:]}"
    ledger = KeyLedger(spark, table, f"{path}/keys", schemas.NEWS_KEYS, 16)
    try:
        for _ in range(2):
            landed = jobs.file_stream(spark, f"{path}/landed", mentions.schema, files_per_batch=1)
            jobs.ingest_new_news(landed, f"{path}/news", f"{path}/checkpoint", ledger)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return spark.read.parquet(f"{path}/news").select(*schemas.NEWS_KEYS)


@_register("stream_bars_15m", _company_bars())
def _(spark, folder):
    path = session.scratch_dir(spark, "stream")
    ticks = _event_stream(spark, folder).select(
        F.col("user_id").cast("string").alias("company_symbol"),
        "ts",
        F.col("value").alias("price"),
        F.col("event_id").alias("seq"),
    )
    jobs.tick_bars(ticks, "company_symbol", f"{path}/bars", f"{path}/checkpoint")
    return jobs.read_tick_bars(spark, f"{path}/bars", "company_symbol")


@_register("stream_bars_15m_late", _company_bars())
def _(spark, folder):
    """Ticks in four batches, each with ticks of all times, and the job started twice."""
    path = session.scratch_dir(spark, "stream")
    ticks = tables.ticks(spark, folder)
    ticks.repartition(4, "seq").write.parquet(f"{path}/ticks")
    for _ in range(2):
        landed = jobs.file_stream(spark, f"{path}/ticks", ticks.schema, files_per_batch=1)
        jobs.tick_bars(landed, "company_symbol", f"{path}/bars", f"{path}/checkpoint")
    return jobs.read_tick_bars(spark, f"{path}/bars", "company_symbol")


@_register("stream_top_sector", _top())
def _(spark, folder):
    """Sector bars in two batches, each with bars of all times; the answer after the last of them."""
    path = session.scratch_dir(spark, "stream")
    tables.stock_sector(spark, folder).repartition(4).write.parquet(f"{path}/landed")
    landed = jobs.file_stream(spark, f"{path}/landed", schemas.STOCK_SECTOR, files_per_batch=2)
    jobs.follow_top_sector(landed, f"{path}/lead", f"{path}/checkpoint")
    return jobs.read_top_sector(spark, f"{path}/lead")


@_register("stream_sector_change", _CHANGE)
def _(spark, folder):
    """Sector bars in four batches, each with bars of all times, and the job started twice; the last correction of each bar."""
    path = session.scratch_dir(spark, "stream")
    tables.stock_sector(spark, folder).repartition(4).write.parquet(f"{path}/landed")
    for _ in range(2):
        landed = jobs.file_stream(spark, f"{path}/landed", schemas.STOCK_SECTOR, files_per_batch=1)
        jobs.follow_sector_changes(landed, f"{path}/changes", f"{path}/checkpoint")
    return jobs.read_sector_changes(spark, f"{path}/changes")

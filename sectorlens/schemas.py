"""Table contracts: column names, types, key columns and layer databases."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_S, _D, _L, _TS = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType()
_OHLC = {"open": _D, "high": _D, "low": _D, "close": _D}

SECTOR_INFO = _struct(sector_key=_S, sector_name=_S, sector_symbol=_S)
INDUSTRY_INFO = _struct(
    industry_key=_S, industry_name=_S, industry_symbol=_S, market_weight=_D, sector_key=_S
)
COMPANY_INFO = _struct(company_symbol=_S, company_name=_S, industry_key=_S)
STOCK_SECTOR = _struct(datetime=_TS, sector=_S, **_OHLC)
STOCK_COMPANY = _struct(datetime=_TS, company_symbol=_S, **_OHLC, volume=_L)
NEWS = _struct(content_id=_S, title=_S, summary=_S, url=_S, company_key=_S, pubdate=_TS)
NEWS_LANDING = _struct(
    content_id=_S, title=_S, summary=_S, url=_S, company_key=_S, pubdate=_S, date=T.DateType()
)

RAW_TABLES = {
    "sector_info": SECTOR_INFO,
    "industry_info": INDUSTRY_INFO,
    "company_info": COMPANY_INFO,
    "stock_sector": STOCK_SECTOR,
    "stock_company": STOCK_COMPANY,
    "news": NEWS,
}

# The names the vendor uses in landed bar files.
LANDING_FIELDS = {
    "Datetime": "datetime",
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Volume": "volume",
    "Dividends": "dividends",
    "Stock Splits": "stock_splits",
    "Sector": "sector",
    "Company_symbol": "company_symbol",
}
BAR_KEY = {"sector": "sector", "company": "company_symbol"}
BAR_TABLE = {"sector": STOCK_SECTOR, "company": STOCK_COMPANY}

NEWS_KEYS = ("content_id", "company_key")

# One JSON object per line: ticker -> list of news items.
NEWS_PAYLOAD = (
    "map<string, array<struct<content: struct<id: string, title: string, summary: string,"
    " pubDate: string, canonicalUrl: struct<url: string>>>>>"
)

_LAYERS = {"raw": "raw_data", "staging": "staging_data", "analytics": "analytics_data"}


def bar_kind(kind: str) -> str:
    """``sector`` or ``company`` in any case; anything else is a ``KeyError``."""
    kind = kind.lower()
    if kind not in BAR_KEY:
        raise KeyError(f"bars are kept per sector or per company, not per {kind!r}")
    return kind


def database_for(layer: str | None, default: str = "default") -> str:
    """Database of a layer. A custom name is used as given, blank means the default."""
    name = (layer or "").strip()
    return _LAYERS.get(name, name) or default


def landing_schema(kind: str) -> T.StructType:
    """Columns of a landed bar file, with the vendor's names."""
    key = BAR_KEY[bar_kind(kind)]
    types = {"datetime": _TS, "volume": _L, "sector": _S, "company_symbol": _S}
    unwanted = set(BAR_KEY.values()) - {key}
    return T.StructType(
        [
            T.StructField(landed, types.get(name, _D))
            for landed, name in LANDING_FIELDS.items()
            if name not in unwanted
        ]
    )

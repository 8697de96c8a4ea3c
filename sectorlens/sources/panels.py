"""Wide price panels: one row per time, one column per ticker and price field."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEPARATOR = "|"


def panel_tickers(panel: DataFrame) -> list[str]:
    """Tickers of a panel, read from its column names only."""
    names = [c.split(SEPARATOR, 1)[1] for c in panel.columns if SEPARATOR in c]
    return list(dict.fromkeys(names))


def panel_to_long(
    panel: DataFrame, fields: Sequence[str], key: str, time: str = "datetime"
) -> DataFrame:
    """One row per time and ticker from columns named ``field|ticker``.

    Each wide row is turned into its long rows where it is, without a shuffle.
    A ticker without a bar at a time keeps its row, with null prices.
    """
    bars = [
        F.struct(
            F.lit(ticker).alias(key),
            *[F.col(f"`{field}{SEPARATOR}{ticker}`").alias(field) for field in fields],
        )
        for ticker in panel_tickers(panel)
    ]
    return panel.select(time, F.inline(F.array(*bars)))


def long_to_panel(
    bars: DataFrame, fields: Sequence[str], key: str, tickers: Sequence[str], time: str = "datetime"
) -> DataFrame:
    """The panel of the given tickers; the inverse of :func:`panel_to_long`."""
    cells = [
        F.max(F.when(F.col(key) == ticker, F.col(field))).alias(f"{field}{SEPARATOR}{ticker}")
        for ticker in tickers
        for field in fields
    ]
    return bars.groupBy(time).agg(*cells)

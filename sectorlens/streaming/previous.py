"""Previous bar per key as stream state, with corrections for late bars.

The state of a key is its bars by UTC day (a map from day to times and values) and the ordered list
of its days, so a late bar touches its own day and at most the neighbouring days that hold its
predecessor or successor; the history is never read again. A new or changed
bar gives a row for itself and one for its successor. Rows carry a version that grows per key:
the row of a bar with the greatest version is the valid one (:func:`latest_rows`).

Equal times of a key count as one bar with the greatest value, as in
:func:`sectorlens.operators.previous.with_previous`; rows without a time are left out.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from math import isnan

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

DAY = 86_400_000_000
#: Columns of the rows that the processor returns, besides the key. Pandas has one mark for null and NaN, so NaN has flags.
ROWS = "time long, value double, value_nan boolean, previous double, previous_nan boolean, version long"
_COLUMNS = ["key", "time", "value", "value_nan", "previous", "previous_nan", "version"]


def _greatest(a: float | None, b: float | None) -> float | None:
    """As ``max`` in SQL: null is least, NaN greatest."""
    known = [x for x in (a, b) if x is not None]
    if not known:
        return None
    return next((x for x in known if isnan(x)), max(known))


class _Bars:
    """The days of one key that this batch has touched, read from the state once and written back once."""

    def __init__(self, state, days: list[int]):
        self.state, self.days, self.read, self.changed = state, days, {}, set()

    def day(self, day: int) -> tuple[list[int], list[float | None]]:
        if day not in self.read:
            found = self.state.getValue((day,)) if day in self.days else None
            self.read[day] = ([int(t) for t in found[0]], [_plain(v) for v in found[1]]) if found else ([], [])
        return self.read[day]

    def put(self, time: int, value: float | None) -> bool:
        """Whether this is a new bar or changes one."""
        day = time // DAY
        times, values = self.day(day)
        at = bisect_left(times, time)
        if at < len(times) and times[at] == time:
            greatest = _greatest(values[at], value)
            if greatest == values[at] or (_is_nan(greatest) and _is_nan(values[at])):
                return False
            values[at] = greatest
        else:
            times.insert(at, time)
            values.insert(at, value)
            if day not in self.days:
                insort(self.days, day)
        self.changed.add(day)
        return True

    def value(self, time: int) -> float | None:
        times, values = self.day(time // DAY)
        return values[bisect_left(times, time)]

    def before(self, time: int) -> float | None:
        """Value of the bar before ``time``, None if there is none."""
        times, values = self.day(time // DAY)
        at = bisect_left(times, time)
        if at:
            return values[at - 1]
        place = bisect_left(self.days, time // DAY)
        return self.day(self.days[place - 1])[1][-1] if place else None

    def after(self, time: int) -> int | None:
        """Time of the bar after ``time``."""
        times, _ = self.day(time // DAY)
        at = bisect_right(times, time)
        if at < len(times):
            return times[at]
        place = bisect_right(self.days, time // DAY)
        return self.day(self.days[place])[0][0] if place < len(self.days) else None

    def store(self) -> None:
        for day in self.changed:
            self.state.updateValue((day,), (*self.read[day],))


def _plain(value) -> float | None:
    return None if value is None else float(value)


def _is_nan(value: float | None) -> bool:
    return value is not None and isnan(value)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    kinds = {"key": object, "time": "int64", "value": "float64", "value_nan": bool, "previous": "float64", "previous_nan": bool, "version": "int64"}
    return pd.DataFrame(rows, columns=_COLUMNS).astype(kinds)


class PreviousBar(StatefulProcessor):
    """See the module. With ``expire``, a day that the watermark has passed keeps its last bar only, and only if none is newer."""

    def __init__(self, expire: bool = False):
        self.expire = expire

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bars = handle.getMapState("bars", "day int", "times array<long>, values array<double>")
        self.known = handle.getValueState("known", "days array<int>, version long")

    def _known(self) -> tuple[list[int], int]:
        found = self.known.get() if self.known.exists() else None
        return ([int(d) for d in found[0]], int(found[1])) if found else ([], 0)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        days, version = self._known()
        had = set(days)
        bars = _Bars(self.bars, days)
        touched: set[int] = set()
        for chunk in rows:
            empty = chunk["value"].isna() & ~chunk["value_nan"]
            for time, value, none in zip(chunk["time"].tolist(), chunk["value"].tolist(), empty.tolist()):
                if bars.put(time, None if none else value):
                    touched.add(time)
        touched |= {t for t in map(bars.after, list(touched)) if t is not None}
        out = []
        for time in sorted(touched):
            version += 1
            value, before = bars.value(time), bars.before(time)
            out.append((key[0], time, value, _is_nan(value), before, _is_nan(before), version))
        bars.store()
        self.known.update((days, version))
        if self.expire:
            for day in set(days) - had:
                self.handle.registerTimer((day + 1) * DAY // 1000)
        yield _frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        days, version = self._known()
        passed = expiredTimerInfo.getExpiryTimeInMs() * 1000 // DAY  # days before this one
        old = [d for d in days if d < passed]
        for day in old[:-1]:
            self.bars.removeKey((day,))
        if old:
            # the newest of the passed days still holds the predecessor of what comes next
            times, values = self.bars.getValue((old[-1],))
            self.bars.updateValue((old[-1],), ([int(times[-1])], [_plain(values[-1])]))
            self.known.update((days[len(old) - 1 :], version))
        yield _frame([])

    def close(self) -> None:
        pass


def stream_previous(rows: DataFrame, key: str, time: str, value: str, out: str, keep: str | None = None) -> DataFrame:
    """``key, time, value, out, version`` of every new or corrected bar of a stream.

    Needs the RocksDB state store. With ``keep`` (an interval), bars that come later than that behind the newest
    one are dropped, and the state holds no more than that span and one bar before it.
    """
    kind = dict(rows.dtypes)[key]
    timed = rows.where(F.col(time).isNotNull())
    if keep is not None:
        timed = timed.withWatermark(time, keep)
    given = timed.select(
        F.col(key).alias("key"), F.unix_micros(time).alias("time"), F.col(value).cast("double").alias("value"),
        F.coalesce(F.isnan(F.col(value).cast("double")), F.lit(False)).alias("value_nan"), *([time] if keep is not None else []),
    )
    found = given.groupBy("key").transformWithStateInPandas(
        PreviousBar(keep is not None), f"key {kind}, {ROWS}", "Update" if keep is None else "Append", "None" if keep is None else "EventTime"
    )
    number = lambda name: F.when(F.col(f"{name}_nan"), F.lit(float("nan"))).otherwise(F.col(name))
    return found.select(
        F.col("key").alias(key), F.timestamp_micros("time").alias(time), number("value").alias(value), number("previous").alias(out), "version"
    )


def latest_rows(rows: DataFrame, key: str, time: str, value: str, out: str) -> DataFrame:
    """The valid row of each bar; fixed-width columns, so they are hash-aggregated."""
    return rows.groupBy(key, time).agg(
        F.max_by(value, "version").alias(value), F.max_by(out, "version").alias(out), F.max("version").alias("version")
    )

"""Time expressions. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The exchange's zone and how far behind the clock a bar is complete.
EXCHANGE_ZONE = "America/New_York"
BAR_LAG_MINUTES = 19
BAR_WIDTH = "15 minutes"
BAR_GAP_MINUTES = 15


_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def utc_clock(ts: Column) -> Column:
    """The UTC wall clock of an instant as a zoneless timestamp, whatever the session's zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.expr(_EPOCH))


def from_utc_clock(clock: Column) -> Column:
    """The instant at which clocks in UTC show ``clock``."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), clock))


def _parse_any(text: Column) -> Column:
    # a bare time of day would be read as today's
    plain = F.when(text.rlike(r"^\s*[+-]?\d{4}"), text)
    return F.coalesce(
        F.concat(plain, F.lit("Z")).try_cast("timestamp"),
        F.concat(plain, F.lit("T00:00:00Z")).try_cast("timestamp"),
        plain.try_cast("timestamp"),
    )


def parse_instant(text: Column) -> Column:
    """Text or timestamp to an instant; what cannot be parsed becomes null.

    Text without a zone means UTC, whatever the session's zone. Text with a date and a time is parsed
    once: anything but digits, colons and a point behind the first colon is a zone of its
    own, otherwise a ``Z`` is put behind it. Only text of another form, or without a meaning, is tried in several ways.
    """
    plain = text.cast("string")
    colon = F.instr(plain, ":")
    rest = F.translate(F.substring(plain, colon, F.length(plain)), "0123456789:. \t\r\n", "")
    # a date of eight characters at least and an hour stand before the colon
    dated = (colon >= 11) & F.substring(plain, 1, 1).between("0", "9")
    once = F.when(rest == "", F.concat(plain, F.lit("Z"))).otherwise(plain).try_cast("timestamp")
    read = F.coalesce(F.when(dated, once), _parse_any(plain))
    return F.when(F.typeof(text) == "timestamp", text.try_cast("timestamp")).otherwise(read)


def utc_day(ts: Column) -> Column:
    return utc_clock(ts).cast("date")


def iso_offset(ts: Column) -> Column:
    """``2025-11-01T14:30:00+00:00``: UTC, seconds precision, offset with a colon."""
    seconds = F.timestamp_add("SECOND", F.unix_seconds(ts), F.expr(_EPOCH)).cast("string")
    return F.concat(F.translate(seconds, " ", "T"), F.lit("+00:00"))


def colon_offset(text: Column) -> Column:
    """Put the colon into a trailing ``+hhmm`` offset of raw text."""
    return F.regexp_replace(text, r"([+-]\d{2})(\d{2})$", "$1:$2")


def day_text(ts: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """The UTC day as text; the pattern may use fields of the date only."""
    return F.date_format(utc_day(ts), pattern)


def hhmm_text(ts: Column) -> Column:
    """Hour and minute in UTC."""
    clock = utc_clock(ts)
    return F.concat(*[F.lpad(part(clock).cast("string"), 2, "0") for part in (F.hour, F.minute)])


def exchange_clock(ts: Column, zone: str = EXCHANGE_ZONE) -> Column:
    """Wall-clock reading at the exchange, for display: a timestamp without a zone."""
    return utc_clock(F.from_utc_timestamp(ts, zone))


def run_time(now: datetime | str | Column) -> Column:
    """The run's time as a timestamp literal, from a datetime or ISO text.

    Without a zone it is UTC, whatever zone the session or the driver's machine is in.
    """
    if isinstance(now, Column):
        return now
    text = now.isoformat(sep=" ") if isinstance(now, datetime) else now
    return parse_instant(F.lit(text))


def target_slot(now: datetime | str | Column, lag_minutes: int = BAR_LAG_MINUTES) -> Column:
    """Start of the minute whose bar a run at ``now`` is expected to fetch."""
    return F.date_trunc("minute", run_time(now) - F.expr(f"INTERVAL {lag_minutes} MINUTES"))


def in_slot(ts: Column, now: datetime | str | Column, lag_minutes: int = BAR_LAG_MINUTES) -> Column:
    """``ts`` lies in the target minute.

    Written as a range on the bare column, so that the folded bounds reach the
    Parquet scan as pushed filters.
    """
    slot = target_slot(now, lag_minutes)
    return (ts >= slot) & (ts < slot + F.expr("INTERVAL 1 MINUTE"))


def minute_gap(earlier: Column, later: Column) -> Column:
    """Number of minute boundaries between two times (seconds are ignored)."""
    return F.timestamp_diff(
        "MINUTE", F.date_trunc("minute", earlier), F.date_trunc("minute", later)
    )


def relative_change(new: Column, old: Column) -> Column:
    """``(new - old) / old`` as a fraction; null where ``old`` is zero."""
    return (new - old) / F.nullif(old, F.lit(0.0))

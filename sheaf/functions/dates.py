"""Date and time helpers.

Scalar arguments of a request are parsed on the driver (one value, exactly as
the reference does); the column forms serve request *tables* and return NULL
for input that the scalar form rejects, so such rows go to quarantine.
"""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

PERIOD = re.compile(r"([0-9]+)h|([0-9]{4}-[0-9]{2}-[0-9]{2})")

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def period_threshold(period: str | None, as_of: datetime | None = None) -> datetime:
    """F5 for one request: the moment from which its period counts.

    ``Nh`` reaches back N hours from ``as_of`` (default: now), a day starts at
    its midnight UTC, and no period at all means one hour. The column form
    (:func:`period_threshold_col`) gives NULL where this one raises.
    """
    end = (as_of or datetime.now(tz=timezone.utc))
    end = end if end.tzinfo else end.replace(tzinfo=timezone.utc)
    known = PERIOD.fullmatch(period or "1h")
    if known is None:
        raise ValueError(f"not a period (hours such as 4h, or a day such as 2024-01-31): {period!r}")
    if known[1]:
        return end - timedelta(hours=int(known[1]))
    return datetime.combine(date.fromisoformat(known[2]), datetime.min.time(), timezone.utc)


def epoch_seconds(moment: datetime) -> float:
    """F8 on the driver: seconds since the epoch, fraction kept."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return moment.timestamp()


def epoch_seconds_col(ts: Column | str) -> Column:
    """F8 as a column: epoch seconds (double, microsecond fraction) of a
    timestamp; independent of the session time zone for TIMESTAMP_NTZ input."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), ts.cast("timestamp_ntz")) / F.lit(1e6)


def parse_range_date(value: str) -> date:
    """``%Y-%m-%d`` as ``strptime`` reads it (``2023-5-1`` is accepted)."""
    return datetime.strptime(value, "%Y-%m-%d").date()


def check_range(start: str, end: str) -> tuple[date, date]:
    """Both dates parse and ``end >= start``."""
    s, e = parse_range_date(start), parse_range_date(end)
    if e < s:
        raise ValueError(f"the range ends ({end}) before it starts ({start})")
    return s, e


def range_date_col(value: Column | str) -> Column:
    """F6 as a column: unpadded month/day accepted, impossible dates → NULL."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(value.rlike(r"\A\d{4}-\d{1,2}-\d{1,2}\z"), value.try_cast("date"))


def day_string(d: Column | str) -> Column:
    """``YYYY-MM-DD``."""
    d = F.col(d) if isinstance(d, str) else d
    return F.date_format(d, "yyyy-MM-dd")


def day_spine(start: Column, end: Column) -> Column:
    """J2 spine: every day from ``start`` to ``end`` inclusive, as an array.

    Guarded: ``sequence`` would count *down* when end < start (W16), so such a
    range yields NULL instead.
    """
    return F.when(end >= start, F.sequence(start, end, F.expr("INTERVAL 1 DAY")))


def period_threshold_col(period: Column | str, as_of: datetime) -> Column:
    """F5 as a column (epoch seconds): ``Nh`` → as_of − N hours;
    ``YYYY-MM-DD`` → that midnight UTC; NULL or ``""`` → the last hour.
    Anything else, or an impossible date such as ``2024-13-45``, gives NULL,
    so that a request table can quarantine the row instead of failing."""
    p = F.col(period) if isinstance(period, str) else period
    base = epoch_seconds(as_of)
    hours = F.regexp_extract(p, r"\A([0-9]+)h\z", 1).try_cast("double")
    day = F.try_to_date(p, "yyyy-MM-dd")
    return (F.when(p.isNull() | (p == ""), F.lit(base - 3600.0))
            .when(p.rlike(r"\A[0-9]+h\z"), F.lit(base) - hours * 3600.0)
            .when(p.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), epoch_seconds_col(day.cast("timestamp_ntz"))))

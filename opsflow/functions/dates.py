"""Date/time semantics (S8-S18) as Spark column functions.

``as_of`` always stays a TIMESTAMP_NTZ so ``x BETWEEN as_of ...`` against
DATE columns excludes the whole last day after midnight, exactly like the
source (§1.3). Never truncate it to a date before comparing.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "America/Denver"  # 'Mountain Standard Time' observes DST


def ts_lit(value: datetime | str) -> Column:
    s = value.isoformat(sep=" ") if isinstance(value, datetime) else str(value)
    return F.lit(s).cast("timestamp_ntz")


def date_lit(value: date | datetime | str) -> Column:
    if isinstance(value, datetime):
        value = value.date()
    return F.lit(str(value)).cast("date")


def add_days(ts: Column, n: int | Column) -> Column:
    """DATEADD(day, n, ts) keeping the time part."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.timestamp_add("DAY", n, ts)


def add_months(ts: Column, n: int | Column) -> Column:
    """DATEADD(month, n, ts): clamps to month end, keeps the time."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.timestamp_add("MONTH", n, ts)


def month_start(ts: Column) -> Column:
    """DATEADD(month, DATEDIFF(month, 0, x), 0) (S10) as TIMESTAMP_NTZ."""
    return F.date_trunc("MONTH", ts).cast("timestamp_ntz")


def month_start_date(d: Column) -> Column:
    """``left(date, 7) + '-01'``."""
    return F.trunc(d, "MM")


def week_start(d: Column) -> Column:
    """Monday of the week of ``d`` (``DATEFIRST 1``) as DATE."""
    return F.date_trunc("WEEK", d.cast("date")).cast("date")


def year_month(ts: Column) -> Column:
    """``left(cast(x as date), 7)`` -> 'yyyy-MM' text."""
    return F.date_format(ts, "yyyy-MM")


def day_diff(start: Column, end: Column) -> Column:
    """DATEDIFF(DAY, start, end): midnights crossed (S9); BIGINT."""
    return F.datediff(end.cast("date"), start.cast("date")).cast("bigint")


def weekday_name(ts: Column) -> Column:
    return F.upper(F.date_format(ts, "EEEE"))


def local_to_utc(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    """``x AT TIME ZONE zone AT TIME ZONE 'UTC'`` on a wall-clock time."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), ts)


def utc_to_local(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def hhmm_ampm(ts: Column) -> Column:
    """``left(cast(t as time),5)`` + ' AM'/' PM' by hour < 12."""
    return F.concat(F.date_format(ts, "HH:mm"),
                    F.when(F.hour(ts) < 12, F.lit(" AM")).otherwise(F.lit(" PM")))

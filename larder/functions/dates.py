"""Date expressions: ISO weeks, year-week keys, financial weeks, time zones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the finance calendar and of open-ended validity.
SHIFTED_MONDAY = "2024-09-30"
FUTURE_DATE = "9999-12-31"

ColumnLike = Column | str


def _c(x: ColumnLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def future() -> Column:
    """Open end of a validity interval."""
    return F.to_timestamp_ntz(F.lit(f"{FUTURE_DATE} 00:00:00"))


def monday_of(d: ColumnLike) -> Column:
    """Monday of the week of a date."""
    day = F.to_date(_c(d))
    return F.date_sub(day, F.weekday(day))


def iso_week_start(year: ColumnLike, week: ColumnLike) -> Column:
    """Monday of an ISO week: week 1 is the week of January 4th."""
    return F.date_add(monday_of(F.make_date(_c(year), F.lit(1), F.lit(4))), ((_c(week) - 1) * 7).cast("int"))


def iso_year(d: ColumnLike) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), F.to_date(_c(d)))


def year_week(d: ColumnLike) -> Column:
    """``yyyyww`` key of a date."""
    return (iso_year(d) * 100 + F.weekofyear(F.to_date(_c(d)))).cast("int")


def year_week_start(key: ColumnLike) -> Column:
    """Monday of a ``yyyyww`` key."""
    k = _c(key).cast("int")
    return iso_week_start(F.floor(k / 100).cast("int"), (k % 100).cast("int"))


def weeks_between(later: ColumnLike, earlier: ColumnLike) -> Column:
    """Complete weeks between two dates."""
    return (F.datediff(_c(later), _c(earlier)) / 7).cast("int")


def year_week_diff(later: ColumnLike, earlier: ColumnLike) -> Column:
    """Weeks between two ``yyyyww`` keys."""
    return (F.datediff(year_week_start(later), year_week_start(earlier)) / 7).cast("int")


def recency_score(weeks_ago: ColumnLike, horizon: int) -> Column:
    """1 for an item just used, falling with the logarithm to 0 at the horizon."""
    left = F.greatest(F.lit(horizon) - _c(weeks_ago), F.lit(1))
    return F.log2(left) / F.log2(F.lit(horizon))


def has_week_53(year: ColumnLike) -> Column:
    """Whether an ISO year has 53 weeks: December 28th is always in the last one."""
    return F.weekofyear(F.make_date(_c(year), F.lit(12), F.lit(28))) == 53


def forecast_start(d: ColumnLike, cutoff_weekday: int) -> Column:
    """Monday of the first week to forecast: next week up to the cutoff day, else the week after."""
    day = F.to_date(_c(d))
    ahead = F.when(F.weekday(day) + 1 <= cutoff_weekday, 7).otherwise(14)
    return F.date_add(monday_of(day), ahead)


def forecast_weeks(d: ColumnLike, cutoff_weekday: int, weeks: int) -> Column:
    """Array of the Mondays of a forecast horizon."""
    start = forecast_start(d, cutoff_weekday)
    return F.transform(F.sequence(F.lit(0), F.lit(weeks - 1)), lambda i: F.date_add(start, (i * 7).cast("int")))


def default_cutoff(year: ColumnLike, week: ColumnLike, cutoff_weekday: int) -> Column:
    """Cutoff date of a menu week: the cutoff weekday of the week before."""
    return F.date_add(iso_week_start(year, week), cutoff_weekday - 1 - 7)


def financial_date(monday: ColumnLike) -> Column:
    """The Monday itself, moved one day for the one week that finance books in the next quarter."""
    m = F.to_date(_c(monday))
    return F.when(m == F.lit(SHIFTED_MONDAY).cast("date"), F.date_add(m, 1)).otherwise(m)


def date_key(d: ColumnLike) -> Column:
    """``yyyyMMdd`` integer key."""
    return F.date_format(_c(d), "yyyyMMdd").cast("int")


def time_key(ts: ColumnLike) -> Column:
    """``HHmm`` string key."""
    return F.date_format(_c(ts), "HHmm")


def epoch_seconds(ts: ColumnLike) -> Column:
    """Whole seconds since 1970 of a zone-less timestamp, read as UTC."""
    return F.timestamp_diff("SECOND", F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")), _c(ts))


def local_to_utc(ts: ColumnLike, tz: str) -> Column:
    """Zone-less local time to zone-less UTC time."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), _c(ts))


def repair_timezone(
    ts: ColumnLike, tz: str, until: str | None, keep_midnight: bool = True, already_utc: Column | None = None
) -> Column:
    """Local -> UTC before a switchover instant.

    Times of exactly midnight carry no time of day and stay as they are unless
    ``keep_midnight`` is off.  ``already_utc`` marks rows by writers that wrote UTC.
    """
    c = _c(ts)
    keep = F.lit(False)
    if already_utc is not None:
        keep = keep | F.coalesce(already_utc, F.lit(False))
    if keep_midnight:
        keep = keep | (F.date_format(c, "HH:mm:ss") == "00:00:00")
    if until is not None:
        keep = keep | (c >= F.to_timestamp_ntz(F.lit(until)))
    return F.when(keep, c).otherwise(local_to_utc(c, tz))

"""Calendar, opening-hour and holiday expressions.

All functions take and return ``Column`` objects so that they compose inside a
single projection; nothing here triggers a shuffle.  Holiday calendars are
parameters: small literal lists folded into the expression, never joined.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# Opening hours [open, close) per day type.
WEEKDAY_OPEN_HOUR = 7
WEEKDAY_CLOSE_HOUR = 22
WEEKEND_OPEN_HOUR = 9
WEEKEND_CLOSE_HOUR = 18

# Holiday effect multipliers, first matching rule wins
# (closed day, special low-traffic day, public holiday, major-holiday window, default).
MULT_CLOSED = 0.0
MULT_SPECIAL = 0.68
MULT_PUBLIC = 0.78
MULT_WINDOW = 0.86
MULT_DEFAULT = 1.0
DEFAULT_HOLIDAY_DISTANCE = 365
MAJOR_WINDOW_DAYS = 2

# Seasonal factors by month (June-August, October-November).
SUMMER_MONTHS = (6, 7, 8)
AUTUMN_LABEL_MONTHS = (9, 10, 11)
AUTUMN_FACTOR_MONTHS = (10, 11)
SUMMER_FACTOR = 0.92
AUTUMN_FACTOR = 1.05

# Weekday names indexed Monday=0.
WEEKDAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


_EXPR_CACHE: dict = {}


def _cached(fn):
    """Memoise expression builders called with a column *name*: a Column is an unresolved
    expression and can be reused across DataFrames; this saves the driver hundreds of
    JVM round trips per query plan."""
    def wrapper(*args):
        if args and isinstance(args[0], str):
            key = (fn.__name__, args)
            try:
                return _EXPR_CACHE[key]
            except KeyError:
                _EXPR_CACHE[key] = out = fn(*args)
                return out
            except TypeError:  # unhashable parameters
                return fn(*args)
        return fn(*args)
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


@dataclass(frozen=True)
class HolidayCalendar:
    """Holiday dates as parameters.  ``special`` carries the 0.68 multiplier."""

    public: tuple = ()
    major: tuple = ()
    closed: tuple = ()
    special: tuple = field(default_factory=tuple)

    @staticmethod
    def _dates(values):
        return tuple(v if isinstance(v, _dt.date) else _dt.date.fromisoformat(str(v)) for v in values)

    @classmethod
    def of(cls, public=(), major=(), closed=(), special=()):
        return cls(cls._dates(public), cls._dates(major), cls._dates(closed), cls._dates(special))


# Calendar used by the registered queries: the driver events cover January 2024.
# The forecast horizon (early February) gets a closed day and a major window too.
DEMO_HOLIDAYS = HolidayCalendar.of(
    public=("2024-01-01", "2024-01-07", "2024-01-15", "2024-01-22", "2024-02-02", "2024-02-04"),
    major=("2024-01-01", "2024-01-07", "2024-01-22", "2024-02-04"),
    closed=("2024-01-01", "2024-01-07", "2024-02-04"),
    special=("2024-01-22",),
)


def weekday(ts) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(_col(ts))


def is_weekend(ts) -> Column:
    return weekday(ts) >= 5


def open_hour(ts) -> Column:
    return F.when(is_weekend(ts), F.lit(WEEKEND_OPEN_HOUR)).otherwise(F.lit(WEEKDAY_OPEN_HOUR))


def close_hour(ts) -> Column:
    return F.when(is_weekend(ts), F.lit(WEEKEND_CLOSE_HOUR)).otherwise(F.lit(WEEKDAY_CLOSE_HOUR))


@_cached
def business_open(ts) -> Column:
    """1 when ``open <= hour < close`` for the day type, else 0."""
    h = F.hour(_col(ts))
    return ((h >= open_hour(ts)) & (h < close_hour(ts))).cast("int")


@_cached
def business_label(ts) -> Column:
    return F.format_string("%02d:00-%02d:00", open_hour(ts), close_hour(ts))


@_cached
def calendar_columns(ts) -> dict[str, Column]:
    t = _col(ts)
    return {
        "hour": F.hour(t),
        "day_of_week": weekday(t),
        "is_weekend": is_weekend(t).cast("int"),
        "month": F.month(t),
        "day_of_month": F.dayofmonth(t),
        "week_of_year": F.weekofyear(t),
    }


def _date_lits(dates) -> list[Column]:
    return [F.lit(d) for d in dates]


@_cached
def in_dates(ts, dates) -> Column:
    if not dates:
        return F.lit(0)
    return F.to_date(_col(ts)).isin(*_date_lits(dates)).cast("int")


@_cached
def holiday_distance(ts, dates) -> Column:
    """min |days| to any date of ``dates``; 365 when the list is empty."""
    if not dates:
        return F.lit(DEFAULT_HOLIDAY_DISTANCE)
    d = F.to_date(_col(ts))
    each = [F.abs(F.datediff(h, d)) for h in _date_lits(dates)]  # no lambda: it would hide the column it reads from the optimizer
    return F.least(*each) if len(each) > 1 else each[0]


def holiday_window(ts, dates, window_days: int = MAJOR_WINDOW_DAYS) -> Column:
    return (holiday_distance(ts, dates) <= window_days).cast("int")


@_cached
def holiday_multiplier(ts, cal: HolidayCalendar) -> Column:
    return (F.when(in_dates(ts, cal.closed) == 1, F.lit(MULT_CLOSED))
             .when(in_dates(ts, cal.special) == 1, F.lit(MULT_SPECIAL))
             .when(in_dates(ts, cal.public) == 1, F.lit(MULT_PUBLIC))
             .when(holiday_window(ts, cal.major) == 1, F.lit(MULT_WINDOW))
             .otherwise(F.lit(MULT_DEFAULT)))


@_cached
def holiday_columns(ts, cal: HolidayCalendar) -> dict[str, Column]:
    return {
        "is_public_holiday": in_dates(ts, cal.public),
        "is_gym_closed_holiday": in_dates(ts, cal.closed),
        "is_major_low_traffic_holiday": in_dates(ts, cal.major),
        "is_major_holiday_window": holiday_window(ts, cal.major),
        "days_to_nearest_major_holiday": holiday_distance(ts, cal.major),
        "holiday_effect_multiplier": holiday_multiplier(ts, cal),
    }


def season_label(ts) -> Column:
    m = F.month(_col(ts))
    return (F.when(m.isin(*SUMMER_MONTHS), F.lit("summer"))
             .when(m.isin(*AUTUMN_LABEL_MONTHS), F.lit("autumn"))
             .otherwise(F.lit("spring")))


def season_factor(ts) -> Column:
    m = F.month(_col(ts))
    return (F.when(m.isin(*SUMMER_MONTHS), F.lit(SUMMER_FACTOR))
             .when(m.isin(*AUTUMN_FACTOR_MONTHS), F.lit(AUTUMN_FACTOR))
             .otherwise(F.lit(1.0)))


def hour_floor(ts) -> Column:
    """Truncate to the hour, keeping TIMESTAMP_NTZ."""
    return F.date_trunc("hour", _col(ts)).cast("timestamp_ntz")


def fractional_hour(ts) -> Column:
    t = _col(ts)
    return F.hour(t) + F.minute(t) / 60.0


def weekday_name(ts) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in WEEKDAY_NAMES]), weekday(ts) + 1)


def training_window_start(ts, strict: bool = False) -> Column:
    """Round to the half hour: minute <=15 -> :00, <=45 -> :30, else next hour.

    ``strict`` uses ``<15`` / ``<45`` (client variant).
    """
    t = _col(ts)
    base = F.date_trunc("hour", t).cast("timestamp_ntz")
    m = F.minute(t)
    lo, hi = (m < 15, m < 45) if strict else (m <= 15, m <= 45)
    return (F.when(lo, base)
             .when(hi, base + F.expr("INTERVAL 30 MINUTES"))
             .otherwise(base + F.expr("INTERVAL 1 HOUR")))


def training_window_label(ts, minutes: int = 90, strict: bool = False) -> Column:
    start = training_window_start(ts, strict)
    end = start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    return F.concat(weekday_name(start), F.lit(" "), F.date_format(start, "HH:mm"),
                    F.lit("-"), F.date_format(end, "HH:mm"))


def load_band(value, is_open) -> Column:
    """Crowd band of a forecast point: closed / >=85 peak / >=65 busy / >=45 moderate / low."""
    v = _col(value)
    return (F.when(~_col(is_open), F.lit("closed")).when(v >= 85, F.lit("peak")).when(v >= 65, F.lit("busy"))
             .when(v >= 45, F.lit("moderate")).otherwise(F.lit("low")))

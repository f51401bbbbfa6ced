"""Date and time functions on columns (C106-C111). Weeks start on Monday, which is 0."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _day(c: Column) -> Column:
    return c.cast("date")


PARTS = {
    "year": F.year,
    "quarter": F.quarter,
    "month": F.month,
    "day": F.day,
    "hour": F.hour,
    "minute": F.minute,
    "second": F.second,
    "microsecond": lambda c: (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("int") % 1_000_000,
    "week": F.weekofyear,
    "iso_year": lambda c: F.extract(F.lit("YEAROFWEEK"), c),
    "dayofweek": F.weekday,
    "dayofyear": F.dayofyear,
    "days_in_month": lambda c: F.day(F.last_day(_day(c))),
    "is_leap_year": lambda c: F.dayofyear(F.make_date(F.year(c), F.lit(12), F.lit(31))) == 366,
    "is_month_start": lambda c: F.day(c) == 1,
    "is_month_end": lambda c: _day(c) == F.last_day(_day(c)),
    "is_quarter_start": lambda c: _day(c) == _day(F.trunc(_day(c), "quarter")),
    "is_quarter_end": lambda c: _day(c) == quarter_last(_day(c)),
    "is_year_start": lambda c: F.dayofyear(c) == 1,
    "is_year_end": lambda c: (F.month(c) == 12) & (F.day(c) == 31),
    "day_name": lambda c: F.date_format(c, "EEEE"),
    "month_name": lambda c: F.date_format(c, "MMMM"),
}


def part(c: Column | str, name: str) -> Column:
    """A field of a date or time (C106)."""
    return PARTS[name](_c(c))


def quarter_last(day: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(day, "quarter"), 2))


# -- rounding (C107) -------------------------------------------------------------------------------


def _stepped(c: Column, every: str, how: str) -> Column:
    width = int(pd.Timedelta(every).total_seconds() * 1_000_000)
    at = F.unix_micros(c.cast("timestamp"))
    rest = F.pmod(at, F.lit(width))
    low = at - rest
    if how == "ceil":
        low = F.when(rest > 0, low + width).otherwise(low)
    elif how == "round":
        # Half-way goes to the even step.
        odd = F.pmod(F.floor(at / width), F.lit(2)) == 1
        low = F.when((rest * 2 > width) | ((rest * 2 == width) & odd), low + width).otherwise(low)
    return F.timestamp_micros(low)


def floor(c: Column | str, every: str, ntz: bool = True) -> Column:
    """Down to a whole step, steps counted from 1970 (C107)."""
    return _stepped(_c(c), every, "floor").cast("timestamp_ntz" if ntz else "timestamp")


def ceil(c: Column | str, every: str, ntz: bool = True) -> Column:
    return _stepped(_c(c), every, "ceil").cast("timestamp_ntz" if ntz else "timestamp")


def round(c: Column | str, every: str, ntz: bool = True) -> Column:
    return _stepped(_c(c), every, "round").cast("timestamp_ntz" if ntz else "timestamp")


def normalize(c: Column | str) -> Column:
    """Midnight of the day."""
    return _day(_c(c)).cast("timestamp_ntz")


# -- text (C108) -----------------------------------------------------------------------------------

# Percent directives and Spark's letters for them.
DIRECTIVES = {
    "%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%H": "HH", "%I": "hh", "%M": "mm", "%S": "ss",
    "%f": "SSSSSS", "%p": "a", "%j": "DDD", "%A": "EEEE", "%a": "EEE", "%B": "MMMM", "%b": "MMM", "%%": "%",
}


def pattern(fmt: str) -> str:
    """A percent format in Spark's letters, other letters quoted."""
    out = ""
    for token in re.findall(r"%.|[^%]+", fmt, re.S):
        if token[0] != "%":
            out += re.sub(r"([A-Za-z]+)", r"'\1'", token)
        elif token in DIRECTIVES:
            out += DIRECTIVES[token]
        else:
            raise ValueError(f"directive {token!r} is not supported")
    return out


def strftime(c: Column | str, fmt: str) -> Column:
    return F.date_format(_c(c), pattern(fmt))


def strptime(c: Column | str, fmt: str, errors: str = "raise") -> Column:
    """Text to time; text that does not fit raises, or with ``coerce`` is NULL."""
    parse = F.to_timestamp if errors == "raise" else lambda x, f: F.try_to_timestamp(x, F.lit(f))
    return parse(_c(c), pattern(fmt)).cast("timestamp_ntz")


# -- zones (C109) ----------------------------------------------------------------------------------


def localize(c: Column | str, zone: str) -> Column:
    """The instant at which a clock in ``zone`` shows this time."""
    return F.to_utc_timestamp(_c(c).cast("timestamp"), zone)


def convert(c: Column | str, zone: str) -> Column:
    """What a clock in ``zone`` shows at this instant (instants kept in UTC)."""
    return F.from_utc_timestamp(_c(c).cast("timestamp"), zone).cast("timestamp_ntz")


# -- durations and time of day (C110) --------------------------------------------------------------

# Seconds in each unit.
UNITS = {"us": 1e-6, "ms": 1e-3, "s": 1, "m": 60, "h": 3600, "D": 86_400, "W": 604_800}


def duration(c: Column | str, unit: str) -> Column:
    """A number of units as an interval."""
    micros = (_c(c) * F.lit(UNITS[unit] * 1_000_000)).cast("long")
    return F.make_dt_interval(secs=(micros / F.lit(1_000_000)).cast("decimal(18,6)"))


def seconds_between(a: Column | str, b: Column | str) -> Column:
    """Seconds from ``a`` to ``b``, with microseconds."""
    return (F.unix_micros(_c(b).cast("timestamp")) - F.unix_micros(_c(a).cast("timestamp"))) / 1_000_000


def time_of_day(c: Column | str) -> Column:
    """Time of day as ``HH:mm:ss.SSSSSS``."""
    return F.date_format(_c(c), "HH:mm:ss.SSSSSS")


# The forms of a time of day that are accepted.
TIME_FORMS = ["%H:%M", "%H%M", "%I:%M%p", "%I%M%p", "%H:%M:%S", "%H%M%S", "%I:%M:%S%p", "%I%M%S%p", "%I:%M %p", "%I:%M:%S %p"]


def parse_time(c: Column | str) -> Column:
    """Seconds after midnight from text such as ``14:30``, ``14:30:15`` or ``2:30 PM``; else NULL."""
    c = F.upper(F.trim(_c(c)))
    forms = [pattern(f).replace("HH", "H").replace("hh", "h") if ":" in f else pattern(f) for f in TIME_FORMS]
    at = F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in forms])
    return F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)


# -- calendar steps (C111) -------------------------------------------------------------------------


def _with_time(ts: Column, day: Column) -> Column:
    """The same time of day on another day."""
    return ts.cast("timestamp_ntz") + F.make_dt_interval(days=F.date_diff(day, _day(ts)))


def month_begin(c: Column | str, n: int = 1) -> Column:
    """The ``n``-th first of a month after this time."""
    c = _c(c)
    return _with_time(c, F.add_months(F.trunc(_day(c), "month"), n))


def month_end(c: Column | str, n: int = 1) -> Column:
    """The ``n``-th last day of a month after this time."""
    c = _c(c)
    here = _day(c)
    on_end = F.when(here == F.last_day(here), n).otherwise(n - 1)
    return _with_time(c, F.last_day(F.add_months(F.trunc(here, "month"), on_end)))


def quarter_begin(c: Column | str, n: int = 1) -> Column:
    """The ``n``-th start of a quarter (January, April, ...) after this time."""
    c = _c(c)
    return _with_time(c, F.add_months(F.trunc(_day(c), "quarter"), 3 * n))


def quarter_end(c: Column | str, n: int = 1) -> Column:
    c = _c(c)
    here = _day(c)
    on_end = F.when(here == quarter_last(here), 3 * n).otherwise(3 * (n - 1))
    return _with_time(c, quarter_last(F.add_months(F.trunc(here, "quarter"), on_end)))


def year_begin(c: Column | str, n: int = 1) -> Column:
    c = _c(c)
    return _with_time(c, F.make_date(F.year(c) + n, F.lit(1), F.lit(1)))


def year_end(c: Column | str, n: int = 1) -> Column:
    c = _c(c)
    on_end = (F.month(c) == 12) & (F.day(c) == 31)
    return _with_time(c, F.make_date(F.year(c) + F.when(on_end, n).otherwise(n - 1), F.lit(12), F.lit(31)))


# Days of the week as Spark names them, Monday first.
WEEKDAYS = ("MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN")


def next_weekday(c: Column | str, weekday: int) -> Column:
    """The next such day after this one."""
    c = _c(c)
    return _with_time(c, F.next_day(_day(c), WEEKDAYS[weekday]))


def business_days(c: Column | str, n: int) -> Column:
    """``n`` working days on (or back). A weekend counts from the working day on its near side."""
    c = _c(c)
    wd = F.weekday(c)
    weeks, rest = divmod(abs(n), 5)
    if n >= 0:
        from_day = F.when(wd > 4, F.lit(4)).otherwise(wd)
        days = F.lit(7 * weeks + rest) + F.when(from_day + rest > 4, 2).otherwise(0)
        if n == 0:
            return _with_time(c, F.date_add(_day(c), F.when(wd > 4, 7 - wd).otherwise(0)))
        shift = days - (wd - from_day)
    else:
        # Counted from Monday backwards.
        from_day = F.when(wd > 4, F.lit(7)).otherwise(wd)
        inside = F.when(from_day == 7, F.lit(0)).otherwise(from_day)
        days = F.lit(7 * weeks + rest) + F.when(inside - rest < 0, 2).otherwise(0)
        shift = (from_day - wd) - days
    return _with_time(c, F.date_add(_day(c), shift.cast("int")))

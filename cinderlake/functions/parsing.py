"""Parsing of the feed's text fields."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from cinderlake import schema

NUMBER_CHARACTERS = "0123456789+-.eE "
DAY_FIRST = r"^\s*(\d{1,2})[-/](\d{1,2})[-/](\d{4})"
SHORTEST_DATE = 8  # "1-1-2001"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing_to_null(c: Column | str) -> Column:
    """NULL for every token the feed uses for a missing value."""
    c = as_column(c)
    return F.when(~c.isin(schema.NA_TOKENS), c)


def blank_to_null(c: Column | str) -> Column:
    """NULL for missing tokens and for cells of blanks only."""
    c = as_column(c)
    return F.when(~F.trim(c).isin(schema.NA_TOKENS), c)


def num(c: Column | str) -> Column:
    """Number with a decimal comma or point; anything else is NULL.

    The check on characters keeps out what a cast would take beyond plain numbers (`1d`, `0x1p3`,
    `NaN`).
    """
    text = F.translate(as_column(c), ",", ".")
    return F.when(F.translate(text, NUMBER_CHARACTERS, "") == "", text.try_cast("double"))


def flag(c: Column | str) -> Column:
    """`SIM/NAO`, `0/1` and their spellings to a three-valued boolean."""
    text = F.upper(F.trim(as_column(c)))
    return (
        F.when(text.isin(schema.TRUE_FLAGS), F.lit(True))
        .when(text.isin(schema.FALSE_FLAGS), F.lit(False))
    )


def is_false_alarm(c: Column | str) -> Column:
    """True only for the spelled-out positive flags; a missing flag is not a false alarm."""
    return F.coalesce(F.upper(as_column(c)).isin(schema.TRUE_FLAGS), F.lit(False))


def wall_clock(c: Column | str) -> Column:
    """Day-first (or ISO) text to a zone-less timestamp; bad text or an impossible date is NULL.

    The text is rearranged to ISO and cast straight to TIMESTAMP_NTZ, so the session zone's
    daylight-saving gaps never shift a value.
    """
    c = F.trim(as_column(c))
    iso = F.regexp_replace(c, DAY_FIRST, "$3-$2-$1")
    return F.when(F.length(c) >= SHORTEST_DATE, iso.try_cast("timestamp_ntz"))


def day_and_time(day: Column | str, time: Column | str) -> Column:
    """Timestamp from a day-first date and a clock time; NULL when either is missing."""
    return wall_clock(F.concat(as_column(day), F.lit(" "), as_column(time)))


def hour_stamp(year: Column, month: Column, day: Column, hour: Column) -> Column:
    """Hour-precision timestamp from its parts; NULL for missing or impossible parts."""
    return F.try_make_timestamp_ntz(year, month, day, hour, F.lit(0), F.lit(0))


def millis_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed milliseconds between two zone-less timestamps, as a double."""
    return F.timestamp_diff("MICROSECOND", as_column(start), as_column(end)) / F.lit(1000.0)


def drop_sentinel(c: Column | str, sentinel: float = schema.PRECIPITATION_SENTINEL) -> Column:
    """NULL in place of the sentinel value."""
    return F.nullif(as_column(c), F.lit(sentinel))


def joined_list(columns: Iterable[Column | str], sep: str = ",") -> Column:
    """Non-null cells joined by `sep`; NULL when nothing remains."""
    return F.nullif(F.trim(F.concat_ws(sep, *[as_column(c) for c in columns])), F.lit(""))


def snap(c: Column | str, grid: float = 1e-5) -> Column:
    """Coordinate moved to the nearest grid line."""
    return F.rint(as_column(c) / F.lit(grid)) * F.lit(grid)


def file_name(url: Column | str) -> Column:
    """Percent-encoded last part of a URL path."""
    last = F.element_at(F.split(as_column(url), "/"), -1)
    # `url_encode` is for forms; in a path a space is %20, an asterisk %2A, and a tilde stays
    for form, path in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        last = F.replace(F.url_encode(last) if form == "+" else last, F.lit(form), F.lit(path))
    return last


def on_or_after(year: Column, month: Column, day: Column, start) -> Column:
    """True when the date made of its parts is not before `start` (compared as a date)."""
    stamp = F.try_make_timestamp_ntz(year, month, day, F.lit(0), F.lit(0), F.lit(0))
    return stamp >= F.lit(start).cast("timestamp_ntz")

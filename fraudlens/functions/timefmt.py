"""Timestamp parsing and formatting on wall-clock (TIMESTAMP_NTZ) values."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values ----------------------------------------------------------
REPORT_TIME_ZONE = "Asia/Jakarta"     # zone the habit mart formats in
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The grammar of Python's ISO parser (``datetime.fromisoformat``) in one pattern of named
# groups.  A date is a calendar or a week date, extended or compact; any one character may
# separate it from the time, a digit too (a run of digits after a compact week date is then
# told apart by its length, as the parser does).  In front of an offset the parser
# overlooks one odd character, or any after six digits of a fraction.
_ISO_DATE = (
    r"(?!0000)(?<y>[0-9]{4})(?:-(?<moa>[0-9]{2})-(?<da>[0-9]{2})|(?<mob>[0-9]{2})(?<db>[0-9]{2})"
    r"|-W(?<wa>[0-9]{2})(?:-(?<wda>[0-9])(?![0-9])|(?=\z|[^-]|-[0-9]{2}))"
    r"|W(?<wb>[0-9]{2})(?:(?<wdb>[0-9])(?=(?:[0-9](?:[0-9]{2})*+)?(?![0-9]))|(?=(?:[0-9]{3}(?:[0-9]{2})*+)?(?![0-9]))))"
)


def _iso_time(of_offset: bool) -> str:
    """Hours to fraction, with colons or packed; of an offset nothing is captured that
    the result needs, and nothing odd may follow."""
    n = "o" if of_offset else ""
    # the empty groups tell which form was met: \k of a group that took no part fails
    point = rf"(?:[.,]|\k<colon{n}>:|\k<packed{n}>(?=[0-9]{{2}}))"
    if of_offset:
        tail = f"(?:{point}[0-9]+)?"
    else:
        tail = (
            rf"(?:{point}(?:(?<f>[0-9]{{6}})(?:[0-9]*|[^+\-Z]*(?=[+\-Z]))|(?<g>[0-9]{{1,5}}))"
            r"|[\x01-\x7F&&[^+\-Z]](?=[+\-Z]))?"
        )
    return (
        f"(?<h{n}>[0-9]{{2}})(?::(?<ma{n}>[0-9]{{2}})(?::(?<sa{n}>[0-9]{{2}})(?<colon{n}>))?"
        f"|(?<mb{n}>[0-9]{{2}})(?:(?<sb{n}>[0-9]{{2}})(?<packed{n}>))?)?{tail}"
    )


# an offset is shorter than a day; the last alternative is any other text, of empty parts
_ISO_OFFSET = r"(?:Z|[+-](?!2[4-9]|[3-9]|23:?[6-9]|23:?59:?[6-9])" + _iso_time(True) + ")"
ISO_TEXT = "^" + _ISO_DATE + r"(?:[\s\S]" + _iso_time(False) + "(?:" + _ISO_OFFSET + r")?)?\z|^[\s\S]*\z"
ISO_PARTS = "${y}|${moa}${mob}|${da}${db}|${wa}${wb}|${wda}${wdb}|${h}|${ma}${mb}|${sa}${sb}|${f}${g}"


# the usual form, which needs no taking apart
PLAIN_TEXT = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]{6})?\z"


def _iso_parts(text: Column) -> Column:
    """The parts of an ISO text (nine texts, empty where absent), by one pattern; NULL for
    the usual form."""
    parts = F.split(F.regexp_replace(text, F.lit(ISO_TEXT), F.lit(ISO_PARTS)), r"\|", -1)
    return F.when(~text.rlike(PLAIN_TEXT), parts)


def _clock_of_parts(parts: Column) -> Column:
    year, month, day, week, weekday, hour, minute, second, fraction = (F.element_at(parts, i) for i in range(1, 10))
    # week 1 is the one of January 4th; a week belongs to the year its Thursday is in
    first = F.concat(year, F.lit("-01-04")).try_cast("date")
    monday = F.date_add(first, (week.try_cast("int") - 1) * 7 - F.weekday(first))
    of_week = F.date_add(monday, F.coalesce(weekday.try_cast("int"), F.lit(1)) - 1)
    in_year = F.year(F.date_add(monday, 3)) == year.try_cast("int")
    known = in_year & (week >= "01") & (weekday.isin("", *"1234567")) & (of_week <= F.lit(_dt.date.max))
    date = F.when(week == "", F.concat_ws("-", year, month, day)).when(known, of_week.cast("string"))
    time = F.concat_ws(":", *[F.rpad(x, 2, "0") for x in (hour, minute, second)])
    return F.concat(date, F.lit("T"), time, F.lit("."), F.rpad(fraction, 6, "0")).try_cast("timestamp_ntz")


def parse_wall_clock(text) -> Column:
    """ISO-8601 text -> TIMESTAMP_NTZ; NULL when it does not parse.

    Takes what Python's ISO parser takes: calendar dates and week dates, with dashes or
    compact, alone or with a time (``10``, ``10:00``, ``100000``, fractions after a
    point or comma, cut to microseconds) and an offset of less than a day.  The offset is
    ignored, the wall clock is kept (as the rule input ``fromisoformat(...).hour`` would
    see it).  Text with a NUL character is no date.

    The pattern runs once for each evaluation.  Where rows are filtered by the result, use
    :func:`with_wall_clock`: the optimizer would copy this expression into the filter.
    """
    t = _col(text)
    found = F.element_at(F.transform(F.array(_iso_parts(t)), lambda p: F.when(p.isNotNull(), _clock_of_parts(p))), 1)
    return F.coalesce(found, F.when(t.rlike(PLAIN_TEXT), t.try_cast("timestamp_ntz")))


def with_once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` and further columns, each evaluated once for each row.

    A generator of one row holds them: a filter on its output isn't pushed through it, so
    the optimizer copies no expression into a filter.
    """
    made = F.explode(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))).alias("_made")
    return df.select("*", made).select(*df.columns, *[F.col(f"_made.{name}").alias(name) for name in columns])


def with_wall_clock(df: DataFrame, text: str, name: str, **others: Column) -> DataFrame:
    """``df`` and a column ``name``, the parsed ``text``, and ``others``, evaluated once
    for each row (:func:`with_once`)."""
    parts = f"_parts_of_{name}"
    clock = F.when(F.col(parts).isNull(), F.col(text).try_cast("timestamp_ntz")).otherwise(_clock_of_parts(F.col(parts)))
    return with_once(df.withColumn(parts, _iso_parts(F.col(text))), **{name: clock}, **others).drop(parts)


def _ntz_text(ts) -> Column:
    """``yyyy-MM-dd HH:mm:ss[.ffffff]`` of a TIMESTAMP_NTZ value.

    Casting NTZ to STRING never involves a time zone.  ``date_format`` would:
    it takes a session-zoned TIMESTAMP, so a wall clock inside a daylight-
    saving gap of the session zone would come out shifted by an hour.
    """
    return _col(ts).cast("timestamp_ntz").cast("string")


def report_clock(ts) -> Column:
    """Format a stored clock as it is shown in reports: the value is treated
    as UTC and rendered in Asia/Jakarta (a +7 h shift, kept for parity),
    as ``yyyy-MM-dd HH:mm:ss``."""
    shifted = F.convert_timezone(F.lit("UTC"), F.lit(REPORT_TIME_ZONE), _col(ts))
    return F.substring(_ntz_text(shifted), 1, 19)


def iso_text(ts) -> Column:
    """Wall clock -> ISO-8601 text ``yyyy-MM-ddTHH:mm:ss[.ffffff]`` (the wire
    format of the topic), independent of the session time zone."""
    return F.regexp_replace(_ntz_text(ts), " ", "T")


def as_date(value) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value))


def day_window(day) -> tuple[Column, Column]:
    """[start, end) NTZ literals of a calendar day: a range predicate on the raw
    column is pushed to the Parquet reader, ``to_date(col) = d`` is not."""
    d = as_date(day)
    start = _dt.datetime(d.year, d.month, d.day)
    end = start + _dt.timedelta(days=1)
    return (
        F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz"),
        F.lit(end.isoformat(sep=" ")).cast("timestamp_ntz"),
    )


def may_be_on(text, day) -> Column:
    """Whether an ISO text can name a clock on ``day``, by the ways a date is spelled at
    its start: false for no text that :func:`parse_wall_clock` puts on that day.  It is a
    test of prefixes, so it is cheap and can be pushed to where the text is read."""
    d = as_date(day)
    iso_year, week, _ = d.isocalendar()
    starts = [d.isoformat(), d.strftime("%Y%m%d").zfill(8), f"{iso_year:04d}-W{week:02d}", f"{iso_year:04d}W{week:02d}"]
    t = _col(text)
    return t.startswith(starts[0]) | t.startswith(starts[1]) | t.startswith(starts[2]) | t.startswith(starts[3])


def run_clock(as_of=None) -> Column:
    """``updated_at`` of the core tables: the given ``as_of`` or the current
    UTC wall clock."""
    if as_of is None:
        return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())
    text = as_of.isoformat(sep=" ") if isinstance(as_of, _dt.datetime) else str(as_of)
    return F.lit(text).cast("timestamp_ntz")

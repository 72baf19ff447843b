"""Loosely typed time text, day buckets and date arithmetic as plain column expressions.

Everything works in the session time zone. Set ``spark.sql.session.timeZone`` explicitly:
epoch values fall on a day only with respect to a zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_FORMAT = "yyyy-MM-dd"
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
DEFAULT_DAY = "1970-01-01"
DAY_MS = 86_400_000

# Accepted text forms. Epoch text is seconds at length 10 and milliseconds at length 13.
_EPOCH = r"\A[+-]?\d+\z"
_COMPACT = r"\A\d{8}\z"
_DASHED = (
    r"\A\d{4}-\d{2}-\d{2}"
    r"(?: \d{2}(?::\d{2}(?::\d{2}(?:,\d{3})?)?)?|T\d{2}:\d{2}:\d{2}\.\d{3}Z)?\z"
)
_DASHED_WITH_FRACTION = (
    r"\A\d{4}-\d{2}-\d{2}"
    r"(?: \d{2}(?::\d{2}(?::\d{2}(?:,\d{3}|\.\d{1,9})?)?)?|T\d{2}:\d{2}:\d{2}\.\d{3}Z)?\z"
)

# The same dashed and compact forms with every field in range and no leap day: their day is plain to see.
_PLAIN_DAY = (
    r"(?!0000)\d{4}{dash}(?:(?:0[13578]|1[02]){dash}(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[469]|11){dash}(?:0[1-9]|[12]\d|30)|02{dash}(?:0[1-9]|1\d|2[0-8]))"
)
_PLAIN_CLOCK = r"(?:[01]\d|2[0-3])(?::[0-5]\d(?::[0-5]\d{fraction})?)?"
_PLAIN_DASHED = (
    r"\A" + _PLAIN_DAY.replace("{dash}", "-") + r"(?: " + _PLAIN_CLOCK.replace("{fraction}", r"(?:,\d{3})?")
    + r"|T(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d\.\d{3}Z)?\z"
)
_PLAIN_COMPACT = r"\A" + _PLAIN_DAY.replace("{dash}", "") + r"\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _apart(value: Column, rule: Callable[[Column], Column]) -> Column:
    """Evaluate a long rule outside of the generated row loop, with its input computed once.

    Inlined, such a rule makes the loop's method too big for the JIT compiler, and then every row is slow.
    """
    return F.transform(F.array(value), rule)[0]


def _is_epoch(text: Column) -> Column:
    return F.length(text).isin(10, 13) & text.rlike(_EPOCH)


def _epoch_ms(text: Column) -> Column:
    """Epoch milliseconds of epoch text."""
    number = text.try_cast("bigint")
    return F.when(F.length(text) == 10, number * 1000).otherwise(number)


def _field(text: Column, compact_at: int | None, dashed_at: int, size: int = 2) -> Column:
    dashed = F.substring(text, dashed_at, size)
    if compact_at is None:
        return F.coalesce(F.when(F.length(text) > 8, dashed).try_cast("int"), F.lit(0))
    return F.when(F.length(text) == 8, F.substring(text, compact_at, size)).otherwise(dashed).try_cast("int")


def _is_calendar_text(text: Column, extended: bool) -> Column:
    return text.rlike(_COMPACT) | text.rlike(_DASHED_WITH_FRACTION if extended else _DASHED)


def _calendar_day(text: Column) -> Column:
    """The day of calendar text, rolling fields that are out of range into the next unit."""
    first = F.make_date(_field(text, 1, 1, 4), F.lit(1), F.lit(1))
    day = F.date_add(F.add_months(first, _field(text, 5, 6) - 1), _field(text, 7, 9) - 1)
    return F.date_add(day, F.floor(_second_of_day(text) / 86400).cast("int"))


def _second_of_day(text: Column) -> Column:
    return _field(text, None, 12) * 3600 + _field(text, None, 15) * 60 + _field(text, None, 18)


def _day_text(day: Column) -> Column:
    """``yyyy-MM-dd`` with the year of its era, so zero dates print as years before year one."""
    return F.when(
        F.year(day) <= 0,
        F.concat(F.lpad((1 - F.year(day)).cast("string"), 4, "0"), F.date_format(day, "-MM-dd")),
    ).otherwise(day.cast("string"))


def parse_loose(c: Column | str, extended: bool = False) -> Column:
    """S-02: loose time text to TIMESTAMP; NULL when no form fits.

    Calendar fields are lenient (month 13 is January of the next year). A trailing ``Z`` is read as
    local time. ``extended`` also takes a dotted fraction of a second.
    """
    text = _col(c)
    # Completed to a full timestamp text: the tail of a midnight template stands in for what is missing.
    spaced = F.translate(text, "T,Z", " .")
    dashed = F.concat(spaced, F.expr("'0000-00-00 00:00:00'").substr(F.length(spaced) + 1, F.lit(19)))
    return (
        F.when((F.length(text) >= 10) & text.rlike(_PLAIN_DASHED), dashed.try_cast("timestamp"))
        .when(_is_epoch(text), F.timestamp_millis(_epoch_ms(text)))
        .when((F.length(text) == 8) & text.rlike(_PLAIN_COMPACT), _dash(text).try_cast("timestamp"))
        .when(_is_calendar_text(text, extended), _apart(text, _roll_over))
    )


def _dash(compact: Column) -> Column:
    return F.concat_ws("-", F.substring(compact, 1, 4), F.substring(compact, 5, 2), F.substring(compact, 7, 2))


def _roll_over(text: Column) -> Column:
    """A timestamp from calendar text whose fields may be out of range."""
    fraction = F.rpad(F.regexp_extract(text, r"[.,](\d{1,9})Z?\z", 1), 6, "0")
    micros = F.coalesce(fraction.try_cast("bigint"), F.lit(0))
    seconds = F.pmod(_second_of_day(text), F.lit(86400)).cast("bigint")
    clock = ((seconds * 1_000_000 + micros) / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    local = _calendar_day(text).cast("timestamp_ntz") + F.make_dt_interval(secs=clock)
    return local.cast("timestamp")


def can_parse_loose(c: Column | str) -> Column:
    """S-04. NULL text counts as parseable: it parses to NULL."""
    text = _col(c)
    return text.isNull() | _is_epoch(text) | _is_calendar_text(text, False)


def format_loose(c: Column | str, pattern: str) -> Column:
    """S-03: loose time text in any pattern; a back-quoted T stands for a literal T."""
    return F.date_format(parse_loose(c), pattern.replace("`T`", "'T'"))


def day_bucket(c: Column | str, default: str | None = DEFAULT_DAY, extended: bool = False) -> Column:
    """S-01: the day of loose time text, ``default`` for NULL and for text that fits no form.

    Text whose fields are all in range is cut, not parsed; only the rest goes through calendar arithmetic.
    The text is used several times: pass a column, not an expression that is dear to compute.
    """
    text = _col(c)
    size = F.length(text)
    return F.coalesce(
        F.when((size >= 10) & text.rlike(_PLAIN_DASHED), F.substring(text, 1, 10))
        .when(_is_epoch(text), F.timestamp_millis(_epoch_ms(text)).cast("date").cast("string"))
        .when((size == 8) & text.rlike(_PLAIN_COMPACT), _dash(text))
        .when(_is_calendar_text(text, extended), _apart(text, lambda t: _apart(_calendar_day(t), _day_text))),
        F.lit(default),
    )


def reformat(c: Column | str, source: str, target: str) -> Column:
    """S-19: date text from one pattern to another."""
    return F.date_format(F.to_timestamp(_col(c), source), target)


def epoch_ms_text(c: Column | str, pattern: str = SECOND_FORMAT) -> Column:
    """S-20: epoch milliseconds as local text."""
    return F.date_format(F.timestamp_millis(_col(c)), pattern)


def offset_day(c: Column | str, days: Column | int, pattern: str = DAY_FORMAT) -> Column:
    """S-21: shift date text by whole days, at midnight."""
    return F.date_format(F.date_add(F.to_date(_col(c), pattern), days), pattern)


def offset_day_at(
    c: Column | str, days: Column | int, hour: int = 0, minute: int = 0, second: int = 0, pattern: str = SECOND_FORMAT
) -> Column:
    """S-21: shift a date by whole days and set its time of day."""
    moved = F.date_add(_col(c).cast("date"), days).cast("timestamp_ntz")
    clock = F.make_dt_interval(hours=F.lit(hour), mins=F.lit(minute), secs=F.lit(second))
    return F.date_format(moved + clock, pattern)


def diff_ms(a: Column | str, b: Column | str) -> Column:
    """S-22: milliseconds between two ``yyyy-MM-dd`` texts, first minus second."""
    left, right = (F.to_timestamp(_col(x), DAY_FORMAT) for x in (a, b))
    return F.unix_millis(left) - F.unix_millis(right)


def diff_days(a: Column | str, b: Column | str) -> Column:
    """S-22: whole days between two ``yyyy-MM-dd`` texts, cut toward zero."""
    ms = diff_ms(a, b)
    return (F.signum(ms) * F.floor(F.abs(ms) / DAY_MS)).cast("int")


def weekday(c: Column | str) -> Column:
    """S-23: day of the week, 0 for Sunday."""
    return F.dayofweek(_col(c)) - 1


def fits_format(c: Column | str, pattern: str) -> Column:
    """S-24: can the text be read with the pattern? Fields must be in range (Spark's parser is strict)."""
    return F.try_to_timestamp(_col(c), F.lit(pattern)).isNotNull()


def ms_since_midnight(c: Column | str) -> Column:
    """S-25: milliseconds since local midnight."""
    at = _col(c).cast("timestamp")
    return F.unix_millis(at) - F.unix_millis(F.date_trunc("day", at))


def local_to_epoch_ms(c: Column | str, zone: str = "+08:00", plus_ms: int = 0) -> Column:
    """S-26: local date-time, seen in a fixed zone, to epoch milliseconds."""
    local = _col(c).cast("timestamp_ntz")
    return F.unix_millis(F.convert_timezone(F.lit(zone), F.lit("UTC"), local).cast("timestamp")) + plus_ms


def epoch_ms_to_local(c: Column | str) -> Column:
    """S-26: epoch milliseconds to the local date-time of the session zone."""
    return F.timestamp_millis(_col(c)).cast("timestamp_ntz")

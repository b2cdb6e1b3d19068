"""Column functions with the feed dialect's semantics, all inside codegen."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts accepted where no format is named, tried in this order.
AUTO_DATE_PATTERNS = ("yyyy-MM-dd", "MM/dd/yyyy", "dd-MMM-yyyy")
AUTO_TIMESTAMP_PATTERNS = (
    "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS]",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd'T'HH:mm",
    "yyyy-MM-dd",
)
# A zone behind a time of day; the column has no zone, so the clock time counts.
ZONE = r"(:\d{2}(?:\.\d+)?) ?(?:Z|[+-]\d{2}(?::?\d{2})?)$"
NUMBER = "decimal(38,0)"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def null_tokens(value: Column | str, tokens: Iterable[str]) -> Column:
    """NULL for the texts a feed uses in place of no value."""
    value = as_column(value)
    return F.when(value.isin(list(tokens)), None).otherwise(value)


def try_number(value: Column | str) -> Column:
    """Whole number, halves away from zero; NULL where the text is no number."""
    return as_column(value).try_cast(NUMBER)


def try_date(value: Column | str, pattern: str) -> Column:
    return F.try_to_date(as_column(value), pattern)


def try_date_auto(
    value: Column | str, patterns: Sequence[str] = AUTO_DATE_PATTERNS
) -> Column:
    value = as_column(value)
    return F.coalesce(*[F.try_to_date(value, p) for p in patterns])


def _wall_clock(value: Column, pattern: str) -> Column:
    """Parse as UTC, then drop the zone, so the session's zone cannot shift a time
    (a local time in a daylight-saving gap would move by an hour)."""
    value, pattern = F.concat(value, F.lit(" Z")), pattern + " X"
    micros = F.unix_micros(F.try_to_timestamp(value, F.lit(pattern)))
    seconds = (micros / F.lit(1_000_000).cast("decimal(10,0)")).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def try_timestamp_auto(
    value: Column | str, patterns: Sequence[str] = AUTO_TIMESTAMP_PATTERNS
) -> Column:
    value = F.regexp_replace(as_column(value), ZONE, "$1")
    return F.coalesce(*[_wall_clock(value, p) for p in patterns])


def whole_minutes(millis: Column | str) -> Column:
    return F.floor(F.try_divide(as_column(millis), F.lit(60000)))


def leftover_seconds(millis: Column | str) -> Column:
    """Seconds beyond the whole minutes, rounded: 59.5 and above give 60."""
    millis = as_column(millis)
    return F.round(F.try_divide(millis, F.lit(1000)) - whole_minutes(millis) * 60)


def duration_text(minutes: Column | str, seconds: Column | str) -> Column:
    """``m:ss``; NULL if either part is."""
    text = as_column(seconds).cast("bigint").cast("string")
    return F.concat(
        as_column(minutes).cast("bigint").cast("string"), F.lit(":"), F.lpad(text, 2, "0")
    )


def month_start(day: Column | str) -> Column:
    return F.trunc(as_column(day), "month")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Second boundaries crossed, not elapsed whole seconds."""

    def second_of_day(moment: Column) -> Column:
        return F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)

    start, end = as_column(start), as_column(end)
    days = F.date_diff(end, start).cast("bigint")
    return days * 86400 + second_of_day(end) - second_of_day(start)


def ts(moment: datetime | str) -> Column:
    return F.lit(str(moment)).cast("timestamp_ntz")


def day(value: date | str) -> Column:
    return F.lit(str(value)).cast("date")


def run_id(moment: datetime | Column) -> str | Column:
    """Run id from a clock reading, for a driver-side value or a column."""
    if isinstance(moment, datetime):
        return moment.strftime("%Y%m%d%H%M%S")
    return F.date_format(moment, "yyyyMMddHHmmss")


def changed(left: str, right: str, columns: Sequence[str], null_safe: bool = False) -> Column:
    """Whether any column differs between two row aliases.

    A NULL on either side is not a change unless ``null_safe``; the result is
    never NULL.
    """
    result = F.lit(False)
    for c in columns:
        a, b = F.col(f"{left}.{c}"), F.col(f"{right}.{c}")
        differs = ~a.eqNullSafe(b) if null_safe else F.coalesce(a != b, F.lit(False))
        result = result | differs
    return result

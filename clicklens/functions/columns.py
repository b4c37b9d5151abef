"""Scalar helpers as Column expressions.

Every helper returns a JVM-side expression, so it stays inside whole-stage
codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text formats of dates and times in inputs and results.
ACTION_TIME_PATTERN = "yyyy-MM-dd H:mm:ss"  # hour may be unpadded: 3:05:06 and 13:05:06
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
DATE_KEY_FORMAT = "yyyyMMdd"
DATE_HOUR_FORMAT = "yyyy-MM-dd_HH"
TIME_MINUTE_FORMAT = "yyyyMMddHHmm"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_time(c: Column | str, pattern: str = ACTION_TIME_PATTERN) -> Column:
    """Text to timestamp; NULL on text that does not parse."""
    return F.try_to_timestamp(_c(c), F.lit(pattern))


def format_time(c: Column | str) -> Column:
    return F.date_format(_c(c), TIME_FORMAT)


def format_date(c: Column | str) -> Column:
    return F.date_format(_c(c), DATE_FORMAT)


def date_hour(c: Column | str) -> Column:
    """``yyyy-MM-dd_HH`` of a timestamp."""
    return F.date_format(_c(c), DATE_HOUR_FORMAT)


def format_date_key(c: Column | str) -> Column:
    return F.date_format(_c(c), DATE_KEY_FORMAT)


def parse_date_key(c: Column | str) -> Column:
    return F.try_to_timestamp(_c(c), F.lit(DATE_KEY_FORMAT))


def format_time_minute(c: Column | str) -> Column:
    return F.date_format(_c(c), TIME_MINUTE_FORMAT)


def today() -> Column:
    return F.current_date()


def yesterday() -> Column:
    return F.date_sub(F.current_date(), 1)


def before(t1: Column | str, t2: Column | str) -> Column:
    """``t1 < t2``; false when either side is missing."""
    return F.coalesce(_c(t1) < _c(t2), F.lit(False))


def after(t1: Column | str, t2: Column | str) -> Column:
    return F.coalesce(_c(t1) > _c(t2), F.lit(False))


def minus_seconds(t1: Column | str, t2: Column | str) -> Column:
    """Whole seconds ``t1 - t2`` (truncated toward zero); 0 when either side
    is missing."""
    ms = F.unix_millis(_c(t1)) - F.unix_millis(_c(t2))
    secs = F.when(ms >= 0, int_div(ms, F.lit(1000))).otherwise(-int_div(-ms, F.lit(1000)))
    return F.coalesce(secs, F.lit(0).cast("bigint"))


def int_div(num: Column, den: Column) -> Column:
    """Integer division (NULL when ``den`` is 0), exact for all of bigint."""
    return F.call_function("div", num, F.nullif(den, F.lit(0)))


def elapsed_seconds(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from ``start`` to ``end`` (millisecond difference div 1000)."""
    return int_div(F.unix_millis(_c(end)) - F.unix_millis(_c(start)), F.lit(1000))


def half_up_ratio(x: Column | str, n: Column | str, scale: int = 2) -> Column:
    """``x / n`` rounded half-up to ``scale`` decimals, computed exactly on
    integers: ``(2*10^s*x + n) div (2*n) / 10^s``. NULL when ``n`` is 0.

    For non-negative counts this is the decimal half-up rounding of the exact
    fraction; it avoids ``round()`` on a binary double, whose ties differ
    between engines.
    """
    x, n = _c(x).cast("bigint"), _c(n).cast("bigint")
    unit = 10**scale
    return int_div(x * F.lit(2 * unit) + n, n * F.lit(2)) / F.lit(float(unit))


def round_half_up(c: Column | str, scale: int = 2) -> Column:
    """General double rounding (half-up on the decimal form of the double)."""
    return F.round(_c(c), scale)


def is_empty(c: Column | str) -> Column:
    return _c(c).isNull() | (_c(c) == F.lit(""))


def is_not_empty(c: Column | str) -> Column:
    return ~is_empty(c)


def trim_comma(c: Column | str) -> Column:
    """Drop one leading and one trailing comma."""
    return F.regexp_replace(_c(c), r"^,|,$", "")


def fulfill(c: Column | str) -> Column:
    """Two-character text stays; anything else gets one leading "0"."""
    return F.when(F.length(_c(c)) == 2, _c(c)).otherwise(F.concat(F.lit("0"), _c(c)))


def split_ids(c: Column | str) -> Column:
    """Comma list of ids to ``array<bigint>``; blanks and bad items dropped,
    NULL input gives an empty array."""
    items = F.split(F.coalesce(_c(c), F.lit("")), ",")
    ids = F.transform(items, lambda s: F.trim(s).try_cast("bigint"))
    return F.filter(ids, lambda x: x.isNotNull())


def split_words(c: Column | str) -> Column:
    """Comma list of words to ``array<string>``; blanks dropped."""
    items = F.split(F.coalesce(_c(c), F.lit("")), ",")
    return F.filter(items, lambda s: s != F.lit(""))


def sorted_join(arr: Column | str, sep: str = ",") -> Column:
    """Sorted array rendered as a ``sep`` joined text ('' when empty)."""
    return F.array_join(F.array_sort(_c(arr)).cast("array<string>"), sep)


def get_field(record: Column | str, field: str) -> Column:
    """Read ``field`` from a ``k=v|k=v`` record (import path only)."""
    return F.element_at(F.str_to_map(_c(record), F.lit(r"\|"), F.lit("=")), F.lit(field))


def set_field(record: Column | str, field: str, value: Column | str) -> Column:
    """Replace ``field`` in a ``k=v|k=v`` record."""
    val = _c(value) if isinstance(value, Column) else F.lit(value)
    parts = F.split(_c(record), r"\|")
    fixed = F.transform(
        parts,
        lambda kv: F.when(F.split(kv, "=").getItem(0) == F.lit(field), F.concat(F.lit(field + "="), val)).otherwise(kv),
    )
    return F.array_join(fixed, "|")


def json_field(c: Column | str, path: str) -> Column:
    return F.get_json_object(_c(c), path)

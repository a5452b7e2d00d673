"""Column expressions used across the library.

All of these are built from ``pyspark.sql.functions`` so they stay inside the
JVM, take part in whole-stage code generation and are visible to Catalyst.
There is no Python UDF anywhere in the library.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names for weekday numbers 0..6, Monday first.
WEEKDAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Backlog direction thresholds on the windowed net change.
WORSENING_ABOVE = 10
IMPROVING_BELOW = -10


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_timestamp(c: str | Column) -> Column:
    """ISO-8601 text (``Z``, ``+00:00`` or naive, read as UTC) to TIMESTAMP; junk -> NULL."""
    return col_(c).try_cast("timestamp")


def try_long(c: str | Column) -> Column:
    return col_(c).try_cast("bigint")


def try_bool(c: str | Column) -> Column:
    return col_(c).try_cast("boolean")


def canonical_json(c: str | Column) -> Column:
    """JSON text with the keys of every object in order and no white space; text that is not JSON stays as it is.

    A variant keeps an object's fields sorted by name, so two texts of one record that differ in key order become equal.
    """
    return F.coalesce(F.to_json(F.try_parse_json(col_(c))), col_(c))


def json_key_present(json_text: str | Column, key: str) -> Column:
    """True when the top-level object has ``key``, even if its value is JSON null."""
    return F.coalesce(F.array_contains(F.json_object_keys(col_(json_text)), F.lit(key)), F.lit(False))


def json_array_len(json_text: str | Column, path: str) -> Column:
    """Length of the JSON array at ``path``; 0 when missing, null or not an array."""
    return F.coalesce(F.json_array_length(F.get_json_object(col_(json_text), path)), F.lit(0)).cast("bigint")


def calendar_day_diff(start: str | Column, end: str | Column) -> Column:
    """Calendar days crossed from ``start`` to ``end`` (23:55 -> 00:05 counts 1)."""
    return F.datediff(F.to_date(col_(end)), F.to_date(col_(start))).cast("bigint")


def closure_age_days(created_at: str | Column, closed_at: str | Column) -> Column:
    """Day difference, NULL unless the issue has a closing time."""
    return F.when(col_(closed_at).isNotNull(), calendar_day_diff(created_at, closed_at))


def weekday_num(d: str | Column) -> Column:
    """0 = Monday .. 6 = Sunday."""
    return F.weekday(col_(d)).cast("bigint")


def weekday_name(num: str | Column) -> Column:
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    return F.get(names, col_(num).cast("int"))


def month_start(d: str | Column) -> Column:
    return F.trunc(col_(d), "month")


def sorted_list(value: str | Column) -> Column:
    """Aggregate: ascending list (of strings) of values with NULLs kept and placed last.

    ``collect_list`` drops NULLs, so the NULLs are counted and appended.
    """
    v = col_(value)
    nulls = (F.count(F.lit(1)) - F.count(v)).cast("int")
    return F.concat(F.array_sort(F.collect_list(v)), F.array_repeat(F.lit(None).cast("string"), nulls))


def first_element(arr: str | Column) -> Column:
    """First element, NULL for an empty or NULL array (never raises)."""
    return F.get(col_(arr), 0)


def direction_signal(net: str | Column) -> Column:
    net = col_(net)
    return (
        F.when(net > WORSENING_ABOVE, F.lit("Worsening"))
        .when(net < IMPROVING_BELOW, F.lit("Improving"))
        .otherwise(F.lit("Flat"))
    )


def empty_string_array() -> Column:
    return F.array().cast("array<string>")

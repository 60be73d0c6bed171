"""String functions with zero-based positions; comparisons are ordinal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docquery.functions.nulls import _col


def _folded(c, ignore_case: bool) -> Column:
    return F.lower(_col(c)) if ignore_case else _col(c)


def starts_with(c: Column, prefix, ignore_case: bool = False) -> Column:
    return F.startswith(_folded(c, ignore_case), _folded(prefix, ignore_case))


def ends_with(c: Column, suffix, ignore_case: bool = False) -> Column:
    return F.endswith(_folded(c, ignore_case), _folded(suffix, ignore_case))


def contains(c: Column, part, ignore_case: bool = False) -> Column:
    return F.contains(_folded(c, ignore_case), _folded(part, ignore_case))


def compare(a, b) -> Column:
    """-1, 0 or 1; null sorts lowest."""
    a, b = _col(a), _col(b)
    return F.when(a.eqNullSafe(b), 0).when(a.isNull() | (a < b), -1).otherwise(1)


def equals(a, b, ignore_case: bool = False) -> Column:
    return _folded(a, ignore_case).eqNullSafe(_folded(b, ignore_case))


def upper(c: Column) -> Column:
    return F.upper(c)


def lower(c: Column) -> Column:
    return F.lower(c)


def length(c: Column) -> Column:
    return F.length(c)


def index_of(c: Column, part, start: int = 0) -> Column:
    """-1 where absent; an empty part is found at ``start``."""
    part = _col(part)
    return F.when(part == "", F.lit(start)).otherwise(F.expr("1") * F.call_function("locate", part, c, F.lit(start + 1)) - 1)


def replace(c: Column, old, new) -> Column:
    return F.replace(c, _col(old), _col(new))


def substring(c: Column, start, count=None) -> Column:
    start = _col(start)
    return F.substring(c, start + 1, _col(count)) if count is not None else F.substring(c, start + 1, F.length(c))


def is_null_or_empty(c: Column) -> Column:
    return c.isNull() | (c == "")


def is_null_or_white_space(c: Column) -> Column:
    return c.isNull() | c.rlike(r"(?U)^\s*$")


def trim(c: Column, chars: str | None = None) -> Column:
    """All white space of Unicode, or the characters given."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "") if chars is None else F.btrim(c, F.lit(chars))


def trim_start(c: Column, chars: str | None = None) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+", "") if chars is None else F.ltrim(c, F.lit(chars))


def trim_end(c: Column, chars: str | None = None) -> Column:
    return F.regexp_replace(c, r"(?U)\s+$", "") if chars is None else F.rtrim(c, F.lit(chars))


def concat(*parts) -> Column:
    """Null where a part is null; numbers are written in decimal."""
    return F.concat(*[_col(p).cast("string") for p in parts])


def join(separator: str, *parts) -> Column:
    """Nulls are left out."""
    return F.concat_ws(separator, *[_col(p).cast("string") for p in parts])


def matches(c: Column, pattern: str, ignore_case: bool = False) -> Column:
    return c.rlike(f"(?i){pattern}" if ignore_case else pattern)


def like(c: Column, pattern: str) -> Column:
    return c.like(pattern)


def first_char(c: Column) -> Column:
    """Null for an empty string."""
    return F.nullif(F.substring(c, 1, 1), F.lit(""))


def last_char(c: Column) -> Column:
    return F.nullif(F.right(c, F.lit(1)), F.lit(""))


def to_chars(c: Column) -> Column:
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(c, ""))


def to_string(c: Column) -> Column:
    return c.cast("string")

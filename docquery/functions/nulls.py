"""Comparisons as an object language has them: null equals null, and ``!=`` keeps rows whose value is null."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def eq(a, b) -> Column:
    return _col(a).eqNullSafe(_col(b))


def ne(a, b) -> Column:
    return ~_col(a).eqNullSafe(_col(b))


def is_true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def not_true(c: Column) -> Column:
    """Negation that keeps null, as ``!flag`` on a nullable flag does."""
    return ~F.coalesce(c, F.lit(False))


def is_in(c: Column, values) -> Column:
    """A null in ``values`` matches null; an empty list matches nothing."""
    values = list(values)
    known = [v for v in values if v is not None]
    found = F.coalesce(c.isin(known), F.lit(False)) if known else F.lit(False)
    return found | c.isNull() if len(known) < len(values) else found


def not_in(c: Column, values) -> Column:
    return ~is_in(c, values)


def exists(c: Column) -> Column:
    """With a fixed schema a missing field reads as null."""
    return c.isNotNull()


def is_missing(c: Column) -> Column:
    return c.isNull()


def is_null_or_missing(c: Column) -> Column:
    return c.isNull()


def variant_exists(raw: Column, path: str) -> Column:
    """Of a variant column: the path is there, be it null."""
    return F.try_variant_get(raw, path, "variant").isNotNull()


def variant_is_null(raw: Column, path: str) -> Column:
    """Of a variant column: the path is there and null."""
    return F.coalesce(F.is_variant_null(F.try_variant_get(raw, path, "variant")), F.lit(False))


def variant_is_missing(raw: Column, path: str) -> Column:
    return F.try_variant_get(raw, path, "variant").isNull()


def same_fields(entity: Column, values: dict) -> Column:
    """An embedded entity equals a constant when all its fields do; a null entity equals none."""
    return entity.isNotNull() & reduce(lambda a, b: a & b, [eq(entity[k], v) for k, v in values.items()], F.lit(True))


def any_key(keys: list[Column], tuples) -> Column:
    """The key is one of a list: a set lookup for a single key, else a disjunction of field equalities."""
    tuples = [t if isinstance(t, tuple) else (t,) for t in tuples]
    if len(keys) == 1:
        return is_in(keys[0], [t[0] for t in tuples])
    rows = [reduce(lambda a, b: a & b, [eq(k, v) for k, v in zip(keys, t)]) for t in tuples]
    return reduce(lambda a, b: a | b, rows, F.lit(False))

"""Arrays and maps; a null array has no elements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from docquery.functions.nulls import _col


def contains(array: Column, value) -> Column:
    """A null value is looked for as a value."""
    if value is None:
        return F.coalesce(F.exists(array, lambda x: x.isNull()), F.lit(False))
    return F.coalesce(F.array_contains(array, _col(value)), F.lit(False))


def count(array: Column) -> Column:
    return F.coalesce(F.array_size(array), F.lit(0))


def any_(array: Column, predicate: Callable[[Column], Column] | None = None) -> Column:
    if predicate is None:
        return count(array) > 0
    return F.coalesce(F.exists(array, lambda x: F.coalesce(predicate(x), F.lit(False))), F.lit(False))


def all_(array: Column, predicate: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.forall(array, lambda x: F.coalesce(predicate(x), F.lit(False))), F.lit(True))


def where(array: Column, predicate: Callable[[Column], Column]) -> Column:
    return F.filter(array, lambda x: F.coalesce(predicate(x), F.lit(False)))


def select(array: Column, selector: Callable[[Column], Column]) -> Column:
    return F.transform(array, selector)


def element(array: Column, index: int) -> Column:
    """Null beyond the end."""
    return F.get(array, F.lit(index))


def has_key(m: Column, key) -> Column:
    return F.coalesce(F.map_contains_key(m, _col(key)), F.lit(False))


def value(m: Column, key) -> Column:
    """Null where the key is absent."""
    return F.try_element_at(m, _col(key))

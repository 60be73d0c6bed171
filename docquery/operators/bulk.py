"""Bulk delete and update by copy-on-write: the new table is a plan over the old one, swapped in when it is whole.

With filters alone the predicate itself decides, in one pass.  Over an ordered, paged or distinct source the keys of
the source are found first, and rows are matched by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquery.functions.nulls import is_true
from docquery.operators.query import Query, QueryError, Row
from docquery.sources import storage

SOURCES = {"where", "order", "skip", "take", "distinct"}


def _check(query: Query) -> None:
    """Only filters, order, paging and distinct may stand below."""
    bad = set(query._ops) - SOURCES
    if bad:
        raise QueryError(f"a bulk operation cannot go over {', '.join(sorted(bad))}")


def _matched(query: Query, base: DataFrame, keys: list[str]) -> tuple[DataFrame, Column]:
    """``base`` with what marks the rows that the query selects."""
    if not (set(query._ops) - {"where"}):
        return base, is_true(query._predicate) if query._predicate is not None else F.lit(True)
    ids = query.df.select(*keys).distinct().withColumn("_hit", F.lit(True))
    return base.join(ids, keys, "left"), is_true(F.col("_hit"))


def delete_df(query: Query, base: DataFrame, keys: list[str]) -> DataFrame:
    """What is left of ``base``."""
    _check(query)
    if set(query._ops) - {"where"}:
        return base.join(query.df.select(*keys).distinct(), keys, "left_anti")
    rows, hit = _matched(query, base, keys)
    return rows.where(~hit).select(base.columns)


def update_df(query: Query, base: DataFrame, keys: list[str], setters: dict) -> DataFrame:
    """``base`` with new values in the rows that are selected; all setters see the old row."""
    _check(query)
    if not setters:
        raise QueryError("an update sets at least one property")
    row, values = Row(query.entity), {}
    for name, setter in setters.items():
        if name not in base.columns:
            raise QueryError(f"{name} is not a property of the root")
        if query.entity is not None and callable(setter) and query.entity.prop(name).converted:
            raise QueryError(f"{name} is stored converted and cannot be set from itself")
        values[name] = setter(row) if callable(setter) else setter if isinstance(setter, Column) else F.lit(setter)
    version = query.entity.version if query.entity is not None else None
    if version and version.name not in values:
        values[version.name] = F.col(version.name) + 1
    rows, hit = _matched(query, base, keys)
    return rows.select([F.when(hit, values[c]).otherwise(F.col(c)).cast(base.schema[c].dataType).alias(c) if c in values else F.col(c) for c in base.columns])


def _everything(query: Query) -> DataFrame:
    """All rows of the collection as properties, those of other types of a hierarchy included."""
    return query.session.set(query.session.model.root(query.entity.name).name, ignore_filters=True)._df


def _write(query: Query, rows: DataFrame) -> None:
    session, name = query.session, query.entity.name
    root = session.model.root(name).name
    stored, seen = [], set()
    for e in (session.model.full(x.name) for x in session.model.family(root)):
        for c, field in zip(e.stored_columns(), [*({e.composite_element} if len(e.key) > 1 else ()), *[e.element(p.name) for p in e.props if "." not in e.element(p.name)]]):
            if field not in seen:
                seen.add(field)
                stored.append(c)
    if session.model.hierarchy(root):
        stored.append(F.col(session.model.full(root).discriminator))
    storage.replace(rows.select(stored), session.path(session.model.collection(name)))


def _bound(query: Query) -> Query:
    """Within a hierarchy, a query over a derived type selects rows of that type only."""
    session, own = query.session, query.entity
    if own.base and session.model.hierarchy(own.name):
        kind = F.col(own.discriminator).isin(session.model.values(own.name))
        return query._with(predicate=kind if query._predicate is None else kind & query._predicate)
    return query


def execute_delete(query: Query) -> int:
    """Deletes what the query selects; the number of rows."""
    _check(query)
    query, keys = _bound(query), list(query.entity.key)
    count = query.count()
    if count:
        _write(query, delete_df(query, _everything(query), keys))
    return count


def execute_update(query: Query, **setters) -> int:
    """Updates what the query selects; the number of rows matched, changed or not."""
    _check(query)
    query, keys = _bound(query), list(query.entity.key)
    base = _everything(query)
    rows, count = update_df(query, base, keys, setters), query.count()
    if count:
        _write(query, rows)
    return count


__all__ = ["delete_df", "execute_delete", "execute_update", "update_df"]

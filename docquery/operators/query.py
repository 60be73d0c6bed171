"""``Query``: an immutable, lazy chain of operators over a DataFrame.

Rows are given to lambdas as ``Row`` objects whose attributes are columns; a reference navigation is reached through
them too, and joined once when it is first named.  Nothing runs before a terminal (``count``, ``first``, ...), and each
terminal has a lazy form that returns a DataFrame.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquery.functions.nulls import any_key, eq, not_true

log = logging.getLogger("docquery")
Selector = Callable[["Row"], Column] | Column | str


class QueryError(ValueError):
    """A query that has no result of the kind that was asked for."""


class Row:
    """Columns of a row by attribute or by name; navigations that were used are noted."""

    def __init__(self, entity=None, prefix: str = "", model=None, used: list[str] | None = None):
        self.__dict__.update(_entity=entity, _prefix=prefix, _model=model, _used=used if used is not None else [])

    def __getattr__(self, name: str):
        nav = self._entity.nav(name) if self._entity is not None else None
        if nav is not None and not nav.many and self._model is not None:
            path = self._prefix + name
            if path not in self._used:
                self._used.append(path)
            return Row(self._model.full(nav.target), path + ".", self._model, self._used)
        return F.col(self._prefix + name)

    __getitem__ = __getattr__


class Query:
    def __init__(self, df: DataFrame, entity=None, session=None, order: tuple = (), joined: frozenset = frozenset(), ops: tuple = (), predicate: Column | None = None):
        self._df, self.entity, self.session, self._order, self._joined, self._ops, self._predicate = df, entity, session, order, joined, ops, predicate

    # -- plumbing

    def _with(self, df: DataFrame | None = None, op: str | None = None, **changes) -> Query:
        now = {"entity": self.entity, "session": self.session, "order": self._order, "joined": self._joined, "ops": (*self._ops, op) if op else self._ops, "predicate": self._predicate}
        return Query(self._df if df is None else df, **(now | changes))

    @property
    def df(self) -> DataFrame:
        return self._df.orderBy(*[c.desc_nulls_last() if down else c.asc_nulls_first() for c, down in self._order]) if self._order else self._df

    @property
    def model(self):
        return self.session.model if self.session else None

    def _resolve(self, *selectors: Selector) -> tuple[Query, list[Column]]:
        used: list[str] = []
        row = Row(self.entity, "", self.model, used)
        columns = []
        for s in selectors:
            c = s(row) if callable(s) else s
            if isinstance(c, Row):  # an entity stands for its key, all parts of it
                parts = [F.col(c._prefix + k) for k in c._entity.key]
                c = parts[0] if len(parts) == 1 else F.struct(*[x.alias(k) for x, k in zip(parts, c._entity.key)])
            columns.append(F.col(c) if isinstance(c, str) else c)
        query = self
        for path in used:
            query = query._reference(path)
        return query, columns

    def _reference(self, path: str) -> Query:
        """Joins a reference navigation as a struct column: inner where it is required, left where not."""
        if path in self._joined:
            return self
        *outer, name = path.split(".")
        owner = self.entity
        for step in outer:
            owner = self.model.full(owner.nav(step).target)
        nav, prefix = owner.nav(name), "".join(f"{x}." for x in outer)
        target = self.session.set(nav.target)._df
        right = target.select(F.struct("*").alias("_ref"), *[F.col(c).alias(f"_key{k}") for k, c in enumerate(nav.foreign)])
        on = reduce(lambda a, b: a & b, [F.col(prefix + c) == F.col(f"_key{k}") for k, c in enumerate(nav.local)])
        df = self._df.join(right, on, "inner" if nav.required else "left").drop(*[f"_key{k}" for k in range(len(nav.foreign))])
        df = df.withColumn(outer[0], F.col(outer[0]).withField(".".join([*outer[1:], name]), F.col("_ref"))).drop("_ref") if outer else df.withColumnRenamed("_ref", name)
        return self._with(df, joined=self._joined | {path}, op="join")

    # -- filters

    def where(self, predicate: Selector) -> Query:
        query, (p,) = self._resolve(predicate)
        simple = not (set(query._ops) - {"where"})
        merged = (p if query._predicate is None else query._predicate & p) if simple else query._predicate
        return query._with(query._df.where(p), "where", predicate=merged)

    def of_type(self, name: str) -> Query:
        """Entities of a type or of one derived from it."""
        own = self.model.full(name)
        names = dict.fromkeys([*[p.name for p in own.props], own.discriminator])
        df = self._df.where(F.col(own.discriminator).isin(self.model.values(name)))
        return self._with(df.select(*[c for c in self._df.columns if c in names or c in self._joined]), "type", entity=own)

    def is_type(self, name: str) -> Column:
        return F.coalesce(F.col(self.entity.discriminator).isin(self.model.values(name)), F.lit(False))

    def cast(self, name: str) -> Query:
        """A query of entities as entities of a base type."""
        own = self.model.full(name)
        base = self.entity
        while base.name != name:
            if not base.base:
                raise QueryError(f"{self.entity.name} is not a {name}")
            base = self.model[base.base]
        return self._with(self._df.select(*[p.name for p in own.props], *([own.discriminator] if own.discriminator in self._df.columns else [])), "cast", entity=own)

    def find(self, *key) -> Query:
        if len(key) != len(self.entity.key):
            raise QueryError(f"the key of {self.entity.name} has {len(self.entity.key)} parts")
        return self.where(reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in zip(self.entity.key, key)])).take(1)

    def is_entity(self, *key) -> Column:
        return reduce(lambda a, b: a & b, [eq(F.col(k), v) for k, v in zip(self.entity.key, key)])

    def entity_in(self, keys) -> Column:
        return any_key([F.col(k) for k in self.entity.key], keys)

    # -- projection

    def select(self, *selectors: Selector, **named: Selector) -> Query:
        query, columns = self._resolve(*selectors, *named.values())
        columns = columns[: len(selectors)] + [c.alias(n) for n, c in zip(named, columns[len(selectors) :])]
        return Query(query.df.select(*columns), session=self.session, ops=(*query._ops, "select"))

    def select_entity(self, **named: Selector) -> Query:
        """The whole entity as ``entity`` beside computed columns."""
        query, columns = self._resolve(*named.values())
        return Query(query.df.select(F.struct(*self._df.columns).alias("entity"), *[c.alias(n) for n, c in zip(named, columns)]), session=self.session, ops=(*query._ops, "select"))

    def select_many(self, selector: Selector, name: str = "item", position: str | None = None, outer: bool = False) -> Query:
        query, (c,) = self._resolve(selector)
        if position:
            df = query.df.select("*", (F.posexplode_outer if outer else F.posexplode)(c).alias(position, name))
        else:
            df = query.df.withColumn(name, (F.explode_outer if outer else F.explode)(c))
        return query._with(df, "select_many", order=())

    def default_if_empty(self) -> Query:
        """The rows, or one row of nulls where there is none."""
        first = self._df.limit(1).select(F.lit(1).alias("_any"))
        none = self._df.sparkSession.range(1).join(first, F.lit(True), "left_anti")
        return self._with(self.df.unionByName(none.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in self._df.schema.fields])), "default", order=())

    # -- order, paging, distinct

    def _ordered(self, selector: Selector, descending: bool, before: tuple) -> Query:
        query, (c,) = self._resolve(selector)
        return query._with(order=(*before, (c, descending)), op="order")

    def order_by(self, selector: Selector, descending: bool = False) -> Query:
        """A later order_by replaces an earlier one; null is the lowest value."""
        return self._ordered(selector, descending, ())

    def order_by_descending(self, selector: Selector) -> Query:
        return self.order_by(selector, True)

    def then_by(self, selector: Selector, descending: bool = False) -> Query:
        return self._ordered(selector, descending, self._order)

    def then_by_descending(self, selector: Selector) -> Query:
        return self.then_by(selector, True)

    def reverse(self) -> Query:
        if not self._order:
            raise QueryError("only an ordered query can be reversed")
        return self._with(order=tuple((c, not down) for c, down in self._order))

    def skip(self, n: int) -> Query:
        return self._with(self.df.offset(n), "skip")

    def take(self, n: int) -> Query:
        return self._with(self.df.limit(n), "take")

    def distinct(self) -> Query:
        return self._with(self._df.distinct(), "distinct")

    # -- set operations

    def _set(self, df: DataFrame, op: str) -> Query:
        return self._with(df, op, order=())

    def concat(self, other: Query) -> Query:
        return self._set(self.df.unionByName(other.df), "concat")

    def union(self, other: Query) -> Query:
        return self._set(self.df.unionByName(other.df).distinct(), "union")

    def intersect(self, other: Query) -> Query:
        return self._set(self.df.intersect(other.df.select(self._df.columns)), "intersect")

    def except_(self, other: Query) -> Query:
        return self._set(self.df.subtract(other.df.select(self._df.columns)), "except")

    # -- joins

    def join(self, inner: Query, outer_key, inner_key, how: str = "inner", **result) -> Query:
        """Equi-join on one key or several; ``result`` maps names to lambdas of the outer and the inner row."""
        keys = zip(*[x if isinstance(x, (list, tuple)) else [x] for x in (outer_key, inner_key)])
        o, i = Row(self.entity, "o."), Row(inner.entity, "i.")
        on = reduce(lambda a, b: a & b, [_key(a, o) == _key(b, i) for a, b in keys])
        return self._joined_on(inner, on, how, o, i, result)

    def join_on(self, inner: Query, condition, how: str = "inner", **result) -> Query:
        """Join on any condition of both rows; the condition should hold an equality, as all pairs are tried otherwise."""
        o, i = Row(self.entity, "o."), Row(inner.entity, "i.")
        return self._joined_on(inner, condition(o, i), how, o, i, result)

    def _joined_on(self, inner: Query, on: Column, how: str, o: Row, i: Row, result: dict) -> Query:
        df = self.df.alias("o").join(inner.df.alias("i"), on, how)
        if result:
            df = df.select(*[f(o, i).alias(n) for n, f in result.items()])
        return Query(df, session=self.session, ops=(*self._ops, "join"))

    def left_join(self, inner: Query, outer_key, inner_key, **result) -> Query:
        return self.join(inner, outer_key, inner_key, "left", **result)

    def right_join(self, inner: Query, outer_key, inner_key, **result) -> Query:
        return self.join(inner, outer_key, inner_key, "right", **result)

    def cross_join(self, inner: Query, **result) -> Query:
        o, i = Row(self.entity, "o."), Row(inner.entity, "i.")
        df = self.df.alias("o").crossJoin(inner.df.alias("i"))
        return Query(df.select(*[f(o, i).alias(n) for n, f in result.items()]) if result else df, session=self.session, ops=(*self._ops, "join"))

    def semi_join(self, inner: Query, outer_key, inner_key) -> Query:
        """Rows with a match: ``exists``."""
        return self._with(self.join(inner, outer_key, inner_key, "left_semi")._df, "semi")

    def anti_join(self, inner: Query, outer_key, inner_key) -> Query:
        return self._with(self.join(inner, outer_key, inner_key, "left_anti")._df, "anti")

    def group_join(self, inner: Query, outer_key: str, inner_key: str, name: str) -> Query:
        """Each row with the array of its matches, empty where there is none."""
        many = inner._df.groupBy(F.col(inner_key).alias("_key")).agg(F.collect_list(F.struct("*")).alias(name))
        df = self._df.join(many, F.col(outer_key) == F.col("_key"), "left").drop("_key")
        return self._with(df.withColumn(name, F.coalesce(name, F.array().cast(many.schema[name].dataType))), "join")

    # -- navigations

    def include(self, name: str, then: Callable[[Query], Query] | None = None, order_by=(), skip: int = 0, take: int | None = None, where: Selector | None = None) -> Query:
        """Related entities: a struct for a reference, an array of structs for a collection.

        ``then`` goes on from the related query, so includes nest from the inside out.  A collection is aggregated by
        its key before the join: one exchange of the related rows and none of the wide result.  Paging numbers the
        rows of each parent before they are collected.
        """
        nav = self.entity.nav(name)
        if nav is None:
            raise QueryError(f"{self.entity.name} has no navigation {name}")
        related = self.session.set(nav.target)
        related = related.where(where) if where is not None else related
        if then:
            related = then(related)
        if not nav.many:
            if where is None and then is None:
                return self._reference(name)
            right = related._df.select(F.struct("*").alias(name), *[F.col(c).alias(f"_key{k}") for k, c in enumerate(nav.foreign)])
            on = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_key{k}") for k, c in enumerate(nav.local)])
            df = self._df.join(right, on, "inner" if nav.required else "left").drop(*[f"_key{k}" for k in range(len(nav.foreign))])
            return self._with(df, joined=self._joined | {name}, op="join")
        own = related._df
        keys = [F.col(c).alias(f"_key{k}") for k, c in enumerate(nav.foreign)]
        if order_by or skip or take is not None:
            sort = [F.col(c) if isinstance(c, str) else c for c in ([order_by] if isinstance(order_by, (str, Column)) else order_by)] or [F.col(k) for k in related.entity.key]
            own = own.withColumn("_n", F.row_number().over(Window.partitionBy(*nav.foreign).orderBy(*sort)))
            own = own.where((F.col("_n") > skip) & (F.col("_n") <= skip + take if take is not None else F.lit(True)))
            item = F.struct("_n", F.struct(*[c for c in own.columns if c != "_n"]).alias("e"))
            many = own.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["e"]).alias(name))
        else:
            many = own.groupBy(*keys).agg(F.collect_list(F.struct("*")).alias(name))
        on = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_key{k}") for k, c in enumerate(nav.local)])
        df = self._df.join(many, on, "left").drop(*[f"_key{k}" for k in range(len(nav.foreign))])
        return self._with(df.withColumn(name, F.coalesce(name, F.array().cast(many.schema[name].dataType))), joined=self._joined | {name}, op="join")

    def with_count(self, name: str, alias: str | None = None, where: Selector | None = None) -> Query:
        """The number of related entities; rows are counted before the join."""
        nav = self.entity.nav(name)
        related = self.session.set(nav.target)
        related = related.where(where) if where is not None else related
        counts = related._df.groupBy(*[F.col(c).alias(f"_key{k}") for k, c in enumerate(nav.foreign)]).agg(F.count("*").alias("_count"))
        on = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_key{k}") for k, c in enumerate(nav.local)])
        df = self._df.join(counts, on, "left").drop(*[f"_key{k}" for k in range(len(nav.foreign))])
        return self._with(df.withColumn(alias or f"{name}_count", F.coalesce("_count", F.lit(0))).drop("_count"), "join")

    # -- grouping

    def group_by(self, *keys: Selector, having: Column | None = None, **aggregates: Column) -> Query:
        query, columns = self._resolve(*keys)
        df = query._df.groupBy(*columns).agg(*[c.alias(n) for n, c in aggregates.items()])
        return Query(df.where(having) if having is not None else df, session=self.session, ops=(*query._ops, "group"))

    # -- terminals

    def _aggregate(self, c: Column, name: str) -> DataFrame:
        return self.df.agg(c.alias(name))

    def count_df(self, predicate: Selector | None = None, name: str = "count") -> DataFrame:
        return (self if predicate is None else self.where(predicate))._aggregate(F.count("*"), name)

    def sum_df(self, selector: Selector, name: str = "sum") -> DataFrame:
        """0 for no rows."""
        query, (c,) = self._resolve(selector)
        return query._aggregate(F.coalesce(F.sum(c), F.lit(0)), name)

    def average_df(self, selector: Selector, name: str = "average") -> DataFrame:
        query, (c,) = self._resolve(selector)
        return query._aggregate(F.avg(c), name)

    def min_df(self, selector: Selector, name: str = "min") -> DataFrame:
        query, (c,) = self._resolve(selector)
        return query._aggregate(F.min(c), name)

    def max_df(self, selector: Selector, name: str = "max") -> DataFrame:
        query, (c,) = self._resolve(selector)
        return query._aggregate(F.max(c), name)

    def any_df(self, predicate: Selector | None = None, name: str = "any") -> DataFrame:
        """Reads no further than the first row that is found."""
        query = self if predicate is None else self.where(predicate)
        return query._df.limit(1).agg((F.count("*") > 0).alias(name))

    def all_df(self, predicate: Selector, name: str = "all") -> DataFrame:
        """Looks for a row against it; a null counts against."""
        query, (p,) = self._resolve(predicate)
        return query._df.where(not_true(p)).limit(1).agg((F.count("*") == 0).alias(name))

    def contains_df(self, value, column: str | None = None, name: str = "contains") -> DataFrame:
        return self.any_df(eq(F.col(column or self._df.columns[0]), value), name)

    def count(self, predicate: Selector | None = None) -> int:
        return self.count_df(predicate).first()[0]

    def sum(self, selector: Selector):
        return self.sum_df(selector).first()[0]

    def _some(self, df: DataFrame, nullable: bool):
        value = df.first()[0]
        if value is None and not nullable:
            raise QueryError("the sequence has no elements")
        return value

    def average(self, selector: Selector, nullable: bool = False):
        return self._some(self.average_df(selector), nullable)

    def min(self, selector: Selector, nullable: bool = False):
        return self._some(self.min_df(selector), nullable)

    def max(self, selector: Selector, nullable: bool = False):
        return self._some(self.max_df(selector), nullable)

    def any(self, predicate: Selector | None = None) -> bool:
        return self.any_df(predicate).first()[0]

    def all(self, predicate: Selector) -> bool:
        return self.all_df(predicate).first()[0]

    def contains(self, value, column: str | None = None) -> bool:
        return self.contains_df(value, column).first()[0]

    def _take(self, n: int, predicate: Selector | None):
        return (self if predicate is None else self.where(predicate)).df.limit(n).collect()

    def first_or_default(self, predicate: Selector | None = None):
        return next(iter(self._take(1, predicate)), None)

    def first(self, predicate: Selector | None = None):
        row = self.first_or_default(predicate)
        if row is None:
            raise QueryError("the sequence has no elements")
        return row

    def single_or_default(self, predicate: Selector | None = None):
        rows = self._take(2, predicate)
        if len(rows) > 1:
            raise QueryError("the sequence has more than one element")
        return rows[0] if rows else None

    def single(self, predicate: Selector | None = None):
        row = self.single_or_default(predicate)
        if row is None:
            raise QueryError("the sequence has no elements")
        return row

    def last_df(self) -> DataFrame:
        return self.reverse().df.limit(1)

    def last_or_default(self, predicate: Selector | None = None):
        return (self if predicate is None else self.where(predicate)).reverse().first_or_default()

    def last(self, predicate: Selector | None = None):
        return (self if predicate is None else self.where(predicate)).reverse().first()

    def element_at(self, n: int):
        return self.skip(n).first()

    def element_at_or_default(self, n: int):
        return self.skip(n).first_or_default()

    def to_list(self) -> list:
        return self.df.collect()

    def tag_with(self, text: str) -> Query:
        """Named in the Spark UI and in the log."""
        self._df.sparkSession.sparkContext.setJobDescription(text)
        log.info("query: %s", text)
        return self

    def explain(self) -> str:
        return self.df._jdf.queryExecution().toString()


def _key(selector, row: Row) -> Column:
    return selector(row) if callable(selector) else F.col(row._prefix + selector) if isinstance(selector, str) else selector

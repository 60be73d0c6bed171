"""Unit of work: inserts, updates and deletes that are saved together, with optimistic concurrency.

All changes of one collection are one copy-on-write of its table.  Every table is staged before any is swapped in, so
a failure or a conflict leaves all as they were; swaps of several tables are not one atomic step.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.functions.nulls import is_true
from docquery.operators import bulk
from docquery.sources import storage


class ConcurrencyError(RuntimeError):
    """Rows were changed or deleted by others, or a key exists already."""


class TransactionError(RuntimeError):
    pass


@dataclass
class _Change:
    kind: str
    entity: str
    key: tuple
    values: dict = field(default_factory=dict)
    original: dict = field(default_factory=dict)


class UnitOfWork:
    """``behavior``: a transaction Always, WhenNeeded (more than one operation) or Never, for ``save_changes``."""

    def __init__(self, session, behavior: str = "WhenNeeded"):
        if behavior not in ("Always", "WhenNeeded", "Never"):
            raise ValueError(f"unknown behavior {behavior}")
        self.session, self.behavior = session, behavior
        self._changes: list[_Change] = []
        self._staged: dict[str, str] | None = None

    # -- tracking

    def add(self, entity: str, **values) -> None:
        own = self.session.model.full(entity)
        missing = [p.name for p in own.props if p.required and values.get(p.name) is None]
        if missing:
            raise ValueError(f"{entity} needs {', '.join(missing)}")
        if own.version:
            values.setdefault(own.version.name, 1)
        self._changes.append(_Change("add", entity, tuple(values.get(k) for k in own.key), values))

    def update(self, entity: str, key, original: dict | None = None, **values) -> None:
        """``original`` holds the values that concurrency tokens had when the entity was read."""
        own = self.session.model.full(entity)
        if set(values) & set(own.key):
            raise ValueError("a key cannot change")
        for name in values:
            own.prop(name)
        self._changes.append(_Change("update", entity, key if isinstance(key, tuple) else (key,), values, original or {}))

    def remove(self, entity: str, key, original: dict | None = None) -> None:
        self._changes.append(_Change("remove", entity, key if isinstance(key, tuple) else (key,), {}, original or {}))

    def _tracked(self) -> list[_Change]:
        """One change for each entity, or a removal and then an addition; the first original values count."""
        out: dict[tuple, list[_Change]] = {}
        for c in self._changes:
            own = out.setdefault((self.session.model.root(c.entity).name, c.key), [])
            last = own[-1] if own else None
            if last is None or (last.kind == "remove" and c.kind == "add"):
                own.append(_Change(c.kind, c.entity, c.key, dict(c.values), dict(c.original)))
            elif c.kind == "add":
                raise ConcurrencyError("a key was added twice")
            elif last.kind == "remove":
                raise ConcurrencyError("an entity that was removed cannot change")
            elif c.kind == "update":
                last.values |= c.values
                last.original = c.original | last.original
            elif last.kind == "add":
                own.pop()
            else:
                own[-1] = _Change("remove", last.entity, last.key, {}, c.original | last.original)
        return [c for own in out.values() for c in own]

    # -- saving

    def save_changes(self) -> int:
        """Saves what was tracked; the number of changes, those of one entity being one.

        Tables are staged before any is swapped in, except with ``Never``, where each is written on its own.
        """
        if self.behavior == "Never" and self._staged is not None:
            raise TransactionError("saves take no part in transactions")
        changes, by = self._tracked(), {}
        for c in changes:
            by.setdefault(self.session.model.collection(c.entity), []).append(c)
        own = self._staged is None
        staged: dict[str, str] = {} if own else self._staged
        made = []
        try:
            for collection, part in by.items():
                path = self.session.path(collection)
                new = self._apply(part, staged.get(path))
                if self.behavior == "Never":
                    storage.replace(new, path)
                else:
                    made.append((path, storage.stage(new, path)))
        except BaseException:
            for _, place in made:
                storage.delete(self.session.spark, place)
            raise
        for path, place in made:
            if path in staged:
                storage.delete(self.session.spark, staged[path])
            staged[path] = place
        if own:
            self._flush(staged)
        self._changes = []
        return len(changes)

    def _apply(self, changes: list[_Change], staged: str | None) -> DataFrame:
        session, root = self.session, self.session.model.root(changes[0].entity).name
        own, schema = session.model.full(root), session.schema(root)
        path = staged or session.path(session.model.collection(root))
        exists = storage.exists(session.spark, path)
        rows = session.spark.read.schema(schema).parquet(path) if exists else session.spark.createDataFrame([], schema)
        key = [own.element(k) for k in own.key]
        key_type = T.StructType([T.StructField(f"k{i}", own.prop(k).data_type) for i, k in enumerate(own.key)])

        def keyed(df: DataFrame, other: DataFrame, how: str) -> DataFrame:
            return df.join(other, reduce(lambda a, b: a & b, [F.col(e) == F.col(f"k{i}") for i, e in enumerate(key)]), how)

        stored_key = [own.prop(k).write(F.col(f"k{i}")).alias(f"k{i}") for i, k in enumerate(own.key)]
        touched = [c for c in changes if c.kind != "add"]
        if touched:
            tokens = [p for p in own.props if p.concurrency or p.row_version]
            kind = T.StructType([*key_type.fields, T.StructField("_at", T.IntegerType()), *[T.StructField(f"o_{p.name}", p.data_type) for p in tokens], *[T.StructField(f"h_{p.name}", T.BooleanType()) for p in tokens]])
            picked = [(*c.key, i, *[c.original.get(p.name) for p in tokens], *[p.name in c.original for p in tokens]) for i, c in enumerate(touched)]
            edits = session.spark.createDataFrame(picked, kind).select(*stored_key, "_at", *[p.write(F.col(f"o_{p.name}")).alias(f"o_{p.name}") for p in tokens], *[f"h_{p.name}" for p in tokens])
            rows = keyed(rows, F.broadcast(edits), "left")  # as many rows as the driver tracked
            same = reduce(lambda a, b: a & b, [~F.col(f"h_{p.name}") | F.col(own.element(p.name)).eqNullSafe(F.col(f"o_{p.name}")) for p in tokens], F.lit(True))
            hit = F.col("_at").isNotNull() & same
            found = rows.where(hit).select("_at").distinct().count()
            if found != len(touched):
                raise ConcurrencyError(f"{len(touched)} entities were expected, {found} found as they were read")
            for i, c in enumerate(touched):
                mine = is_true(hit & (F.col("_at") == i))
                if c.kind == "remove":
                    rows = rows.where(~mine)
                    continue
                entity = session.model.full(c.entity)
                values = dict(c.values)
                for name, value in values.items():
                    p = entity.prop(name)
                    rows = rows.withColumn(entity.element(name), F.when(mine, p.write(F.lit(value).cast(p.data_type)).cast(p.stored)).otherwise(F.col(entity.element(name))))
                if entity.version and entity.version.name not in values:
                    e = entity.element(entity.version.name)
                    rows = rows.withColumn(e, F.when(mine, F.col(e) + 1).otherwise(F.col(e)).cast(entity.version.stored))
            rows = rows.select(schema.names)
        added = [c for c in changes if c.kind == "add"]
        if added:
            keys = [c.key for c in added]
            there = keyed(rows, F.broadcast(session.spark.createDataFrame(keys, key_type).select(*stored_key)), "left_semi").count()
            if there:
                raise ConcurrencyError(f"{there} of the added keys exist")
            rows = rows.unionByName(session.rows(root, [(session.model[c.entity], c.values) for c in added]))
        return rows

    def _flush(self, staged: dict[str, str]) -> None:
        for path, place in staged.items():
            storage.swap(self.session.spark, place, path)

    # -- bulk and transactions

    def execute_update(self, query, **setters) -> int:
        self._bulk(query)
        return bulk.execute_update(query, **setters)

    def execute_delete(self, query) -> int:
        self._bulk(query)
        return bulk.execute_delete(query)

    def _bulk(self, query) -> None:
        if self._staged is not None:
            raise TransactionError("a bulk operation writes at once and takes no part in an open transaction")
        if self.behavior == "Never" and set(query._ops) - {"where"}:
            raise TransactionError("an operation in two phases needs a transaction")

    def begin(self) -> None:
        if self._staged is not None:
            raise TransactionError("a transaction is open")
        self._staged = {}

    def commit(self) -> None:
        if self._staged is None:
            raise TransactionError("no transaction is open")
        staged, self._staged = self._staged, None
        self._flush(staged)

    def rollback(self) -> None:
        if self._staged is None:
            raise TransactionError("no transaction is open")
        for place in self._staged.values():
            storage.delete(self.session.spark, place)
        self._staged, self._changes = None, []

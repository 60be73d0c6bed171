"""A session: one Spark session, a folder of collections, and a model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.operators.query import Query
from docquery.plans.model import Model
from docquery.sources import storage


class Session:
    def __init__(self, spark: SparkSession, root: str, model: Model | None = None, suffix: str = ".parquet"):
        self.spark, self.root, self.model, self.suffix = spark, root.rstrip("/"), model or Model(), suffix

    def path(self, collection: str) -> str:
        return f"{self.root}/{collection}{self.suffix}"

    def table(self, collection: str) -> Query:
        """A collection without a declared entity: its columns as they are stored."""
        return Query(self.spark.read.parquet(self.path(collection)), session=self)

    def documents(self, path: str, schema: T.StructType | str | None = None, keep_raw: bool = False) -> DataFrame:
        """JSON documents.  ``keep_raw`` adds ``_raw``, a variant in which missing and null fields differ."""
        if keep_raw:
            lines = self.spark.read.text(path)
            typed = [F.from_json("value", schema).alias("_doc")] if schema else []
            out = lines.select(F.parse_json("value").alias("_raw"), *typed)
            return out.select("_doc.*", "_raw") if schema else out
        return (self.spark.read.schema(schema) if schema else self.spark.read).json(path)

    def stored(self, name: str) -> DataFrame:
        """The stored columns of an entity's collection, with the declared schema."""
        return self.spark.read.schema(self.schema(name)).parquet(self.path(self.model.collection(name)))

    def schema(self, name: str) -> T.StructType:
        """Stored schema of the whole hierarchy of a type."""
        fields: dict[str, T.StructField] = {}
        family = self.model.family(self.model.root(name).name)
        for e in (self.model.full(x.name) for x in family):
            parts = []
            for p in e.props:
                path = e.element(p.name)
                if "." in path:
                    parts.append(T.StructField(path.split(".", 1)[1], p.stored))
                else:
                    fields.setdefault(path, T.StructField(path, p.stored))
            if parts:
                fields.setdefault(e.composite_element, T.StructField(e.composite_element, T.StructType(parts)))
        if len(family) > 1:
            fields.setdefault(e.discriminator, T.StructField(e.discriminator, T.StringType()))
        return T.StructType(list(fields.values()))

    def set(self, name: str, ignore_filters: bool = False) -> Query:
        """All entities of a type and those that derive from it; the model's query filter holds unless ignored."""
        own = self.model.full(name)
        columns = {p.name: c for e in [own, *(self.model.full(x.name) for x in self.model.family(name))] for p, c in zip(e.props, e.columns())}
        df = self.stored(name)
        if self.model.hierarchy(name):
            if own.base:
                df = df.where(F.col(own.discriminator).isin(self.model.values(name)))
            df = df.select(*columns.values(), F.col(own.discriminator))
        else:
            df = df.select(*columns.values())
        query = Query(df, entity=own, session=self)
        return query.where(own.query_filter) if own.query_filter and not ignore_filters else query

    def find(self, name: str, *key):
        """The entity with this key, or None."""
        return self.set(name).find(*key).first_or_default()

    def reload(self, name: str, *key):
        """The entity as it is stored now, whatever was read of its collection before; None where it is gone."""
        self.spark.catalog.refreshByPath(self.path(self.model.collection(name)))
        return self.find(name, *key)

    def view(self, name: str) -> None:
        """The entity set as a temporary view for SQL."""
        self.set(name).df.createOrReplaceTempView(name)

    def can_connect(self) -> bool:
        return storage.exists(self.spark, self.root)

    def exists(self, name: str) -> bool:
        return storage.exists(self.spark, self.path(self.model.collection(name)))

    def ensure_created(self) -> bool:
        """Creates the missing collections, with the model's seed rows; true if any was missing."""
        made = False
        for e in self.model.entities.values():
            if e.base or self.exists(e.name):
                continue
            rows = [(m, r) for m in self.model.family(e.name) for r in m.seed]
            storage.replace(self.rows(e.name, rows), self.path(self.model.collection(e.name)))
            made = True
        return made

    def rows(self, name: str, rows: list[tuple]) -> DataFrame:
        """(type, properties) pairs as stored rows of a collection."""
        schema, out = self.schema(name), None
        for kind in self.model.family(self.model.root(name).name):
            own = self.model.full(kind.name)
            picked = [tuple(r.get(p.name) for p in own.props) for k, r in rows if k.name == kind.name]
            typed = self.spark.createDataFrame(picked, T.StructType([T.StructField(p.name, p.data_type) for p in own.props]))
            stored = typed.select(own.stored_columns())
            if own.discriminator in schema.names and own.discriminator not in stored.columns:
                stored = stored.withColumn(own.discriminator, F.lit(kind.value or kind.name))
            stored = stored.select([(F.col(f.name) if f.name in stored.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
            out = stored if out is None else out.unionByName(stored)
        return out

    def ensure_deleted(self) -> bool:
        gone = False
        for e in self.model.entities.values():
            if not e.base:
                gone = storage.delete(self.spark, self.path(self.model.collection(e.name))) or gone
        return gone

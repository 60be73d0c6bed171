"""Entities: properties and their stored elements, keys, embedded types, references, hierarchies, filters.

A model is declared in code and checked once, when it is made.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Converter = Callable[[Column], Column]
ROW_VERSION = "_version"


class ModelError(ValueError):
    """The model contradicts itself."""


def camel_case(name: str) -> str:
    """Element name by convention: the words of a name, the first in lower case."""
    words = re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+", name)
    return words[0].lower() + "".join(w[:1].upper() + w[1:] for w in words[1:]) if words else name


# Names of plain types.
_TYPES = {
    "boolean": T.BooleanType(), "byte": T.ByteType(), "short": T.ShortType(), "int": T.IntegerType(), "long": T.LongType(), "bigint": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(),
    "string": T.StringType(), "binary": T.BinaryType(), "date": T.DateType(), "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(),
}


def data_type(kind: T.DataType | str) -> T.DataType:
    """A type by name: plain, array<...>, map<string,...> or decimal(p,s), without a running session; others by DDL."""
    if not isinstance(kind, str):
        return kind
    if kind in _TYPES:
        return _TYPES[kind]
    if m := re.fullmatch(r"array<(.+)>", kind):
        return T.ArrayType(data_type(m[1]))
    if m := re.fullmatch(r"map<(\w+),(.+)>", kind):
        return T.MapType(data_type(m[1]), data_type(m[2]))
    if m := re.fullmatch(r"decimal\((\d+),(\d+)\)", kind):
        return T.DecimalType(int(m[1]), int(m[2]))
    return T._parse_datatype_string(kind)


@dataclass(frozen=True)
class Prop:
    """A mapped property.  ``element`` is the stored column; converters are built-in Column expressions."""

    name: str
    type: T.DataType | str
    element: str | None = None
    required: bool = False
    to_store: Converter | None = None
    from_store: Converter | None = None
    stored_type: T.DataType | str | None = None
    concurrency: bool = False
    row_version: bool = False

    @property
    def data_type(self) -> T.DataType:
        return data_type(self.type)

    @property
    def stored(self) -> T.DataType:
        return data_type(self.stored_type or self.type)

    @property
    def converted(self) -> bool:
        return self.to_store is not None or self.from_store is not None

    def read(self, column: Column) -> Column:
        return self.from_store(column) if self.from_store else column

    def write(self, column: Column) -> Column:
        return self.to_store(column) if self.to_store else column


@dataclass(frozen=True)
class Nav:
    """A relation to another collection: ``local`` properties equal the target's ``foreign`` ones."""

    name: str
    target: str
    local: tuple[str, ...]
    foreign: tuple[str, ...]
    many: bool = False
    required: bool = False

    def __post_init__(self):
        for side in ("local", "foreign"):
            if isinstance(getattr(self, side), str):
                object.__setattr__(self, side, (getattr(self, side),))


@dataclass(frozen=True)
class Index:
    """Metadata only: Spark has no secondary indexes.  A vector index names dimensions and similarity."""

    name: str
    paths: tuple[str, ...]
    unique: bool = False
    dimensions: int | None = None
    similarity: str | None = None
    filters: tuple[str, ...] = ()


@dataclass(frozen=True)
class EntityType:
    name: str
    collection: str | None = None
    props: tuple[Prop, ...] = ()
    key: tuple[str, ...] = ()
    navs: tuple[Nav, ...] = ()
    base: str | None = None
    discriminator: str = "_t"
    value: str | None = None
    query_filter: Callable | None = None
    indexes: tuple[Index, ...] = ()
    seed: tuple[dict, ...] = ()
    composite_element: str = "_id"

    def prop(self, name: str) -> Prop:
        for p in self.props:
            if p.name == name:
                return p
        raise KeyError(f"{self.name} has no property {name}")

    def nav(self, name: str) -> Nav | None:
        return next((n for n in self.navs if n.name == name), None)

    def element(self, name: str) -> str:
        """Path of a property in the stored document; the parts of a composite key are fields of one struct."""
        p = self.prop(name)
        own = p.element or ("_id" if self.key == (name,) else name)
        return f"{self.composite_element}.{own}" if name in self.key and len(self.key) > 1 else own

    def columns(self) -> list[Column]:
        """Stored columns as properties."""
        return [p.read(F.col(self.element(p.name))).cast(p.data_type).alias(p.name) for p in self.props]

    def stored_columns(self) -> list[Column]:
        """Properties as stored columns."""
        out, parts = [], []
        for p in self.props:
            column = p.write(F.col(p.name)).cast(p.stored)
            path = self.element(p.name)
            if "." in path:
                parts.append(column.alias(path.split(".", 1)[1]))
            else:
                out.append(column.alias(path))
        return [F.struct(*parts).alias(self.composite_element), *out] if parts else out

    @property
    def version(self) -> Prop | None:
        return next((p for p in self.props if p.row_version), None)


@dataclass
class Model:
    entities: dict[str, EntityType] = field(default_factory=dict)

    @classmethod
    def of(cls, *entities: EntityType) -> Model:
        model = cls({e.name: e for e in entities})
        model.check()
        return model

    def __getitem__(self, name: str) -> EntityType:
        return self.entities[name]

    def root(self, name: str) -> EntityType:
        e = self[name]
        return self.root(e.base) if e.base else e

    def family(self, name: str) -> list[EntityType]:
        """The type and all that derive from it."""
        return [self[name], *[x for e in self.entities.values() if e.base == name for x in self.family(e.name)]]

    def hierarchy(self, name: str) -> bool:
        return len(self.family(self.root(name).name)) > 1

    def collection(self, name: str) -> str:
        return self.root(name).collection or camel_case(self.root(name).name)

    def full(self, name: str) -> EntityType:
        """The type with what it inherits."""
        e = self[name]
        if not e.base:
            return e
        up = self.full(e.base)
        from dataclasses import replace

        return replace(e, props=(*up.props, *e.props), key=up.key, navs=(*up.navs, *e.navs), discriminator=up.discriminator, query_filter=e.query_filter or up.query_filter, collection=up.collection)

    def values(self, name: str) -> list[str]:
        return [e.value or e.name for e in self.family(name)]

    def check(self) -> None:
        for e in self.entities.values():
            if e.base and e.base not in self.entities:
                raise ModelError(f"{e.name} derives from {e.base}, which is not in the model")
            if e.base and e.collection and e.collection != self.root(e.name).collection:
                raise ModelError(f"{e.name} must be stored with its base type: one collection for a hierarchy")
            own = self.full(e.name)
            names = [p.name for p in own.props]
            if len(set(names)) < len(names):
                raise ModelError(f"{e.name} declares a property twice")
            elements = [own.element(p.name) for p in own.props]
            if len(set(elements)) < len(elements):
                raise ModelError(f"{e.name} stores two properties in one element")
            if not set(own.key) <= set(names):
                raise ModelError(f"the key of {e.name} is not among its properties")
            if sum(p.row_version for p in own.props) > 1:
                raise ModelError(f"{e.name} has more than one row version")
            for p in own.props:
                if p.row_version and not isinstance(p.data_type, (T.IntegerType, T.LongType)):
                    raise ModelError(f"the row version of {e.name} must be a whole number")
                if isinstance(p.data_type, T.MapType) and not isinstance(p.data_type.keyType, T.StringType):
                    raise ModelError(f"{e.name}.{p.name}: keys of a map must be strings")
                if p.row_version and p.name in own.key:
                    raise ModelError(f"the row version of {e.name} is part of its key")
            for n in own.navs:
                if n.target not in self.entities:
                    raise ModelError(f"{e.name}.{n.name} leads to {n.target}, which is not in the model")
                if len(n.local) != len(n.foreign):
                    raise ModelError(f"{e.name}.{n.name} pairs unequal numbers of properties")
            for i in own.indexes:
                if i.dimensions is not None and i.similarity not in ("cosine", "dotProduct", "euclidean"):
                    raise ModelError(f"{e.name}.{i.name}: unknown similarity {i.similarity}")

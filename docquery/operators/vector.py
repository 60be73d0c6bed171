"""Vector search: exact similarity over a column of vectors, with filters before and after the best are taken.

Scores are raw similarities: cosine, dot product, or minus the Euclidean distance, so a greater score is always
nearer.  The best ``limit`` rows are taken by a bounded top-k in every task; nothing is sorted as a whole.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column
from pyspark.sql import functions as F

from docquery.operators.query import Query, QueryError, Selector

log = logging.getLogger("docquery")
SCORE = "__score"


def _fold(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return _fold(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(_fold(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: Column, b: Column) -> Column:
    """Null where a vector has no direction."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(_fold(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))))


def packed_euclidean(a: Column, bits: bytes) -> Column:
    """Distance of packed bit vectors: the root of the number of different bits, six bytes at a time."""
    parts = [F.bit_count(F.conv(F.hex(F.substring(a, k + 1, 6)), 16, 10).cast("long").bitwiseXOR(F.lit(int.from_bytes(bits[k : k + 6], "big")))) for k in range(0, len(bits), 6)]
    return F.sqrt(sum(parts[1:], parts[0]).cast("double"))


def unpack_int8(c: Column) -> Column:
    """The numbers of a packed vector of signed bytes."""
    byte = lambda i: F.conv(F.hex(F.substring(c, i, F.lit(1))), 16, 10).cast("int")
    return F.transform(F.sequence(F.lit(1), F.octet_length(c)), lambda i: F.when(byte(i) > 127, byte(i) - 256).otherwise(byte(i)).cast("double"))


def unpack_float32(c: Column) -> Column:
    """The numbers of a packed vector of 32-bit floats, the low byte first; infinite ones and those that are none are null."""

    def number(i: Column) -> Column:
        part = lambda k: F.conv(F.hex(F.substring(c, 4 * i + k, F.lit(1))), 16, 10).cast("long")
        bits = part(1) + 256 * part(2) + 65536 * part(3) + 16777216 * part(4)
        exponent, rest = F.shiftright(bits, 23).bitwiseAND(255), bits.bitwiseAND((1 << 23) - 1).cast("double") / (1 << 23)
        size = F.when(exponent == 0, rest * 2.0**-126).when(exponent < 255, (1 + rest) * F.pow(F.lit(2.0), exponent - 127))
        return F.when(bits >= 1 << 31, -size).otherwise(size)

    return F.transform(F.sequence(F.lit(0), (F.octet_length(c) / 4).cast("int") - 1), number)


def similarity(column: Column, query, kind: str) -> Column:
    if isinstance(query, (bytes, bytearray)):
        if kind != "euclidean":
            raise QueryError("packed bits have a Euclidean distance only")
        return -packed_euclidean(column, bytes(query))
    target = F.array(*[F.lit(float(x)) for x in query])
    return {"cosine": cosine, "dotProduct": dot, "euclidean": lambda a, b: -euclidean(a, b)}[kind](column, target)


def _index(query: Query, path: str, name: str | None):
    found = [i for i in (query.entity.indexes if query.entity is not None else ()) if i.dimensions is not None and i.paths[0] == path]
    if name is not None:
        named = [i for i in found if i.name == name]
        if not named:
            log.warning("no vector index %s on %s", name, path)
        return named[0] if named else None
    if len(found) != 1:
        raise QueryError(f"{'no' if not found else 'more than one'} vector index on {path}: name one")
    return found[0]


def vector_search(query: Query, path: str, vector, limit: int, pre_filter: Selector | None = None, index: str | None = None,
                  kind: str | None = None, exact: bool = False, candidates: int | None = None, tie: str | None = None, packed: str | None = None) -> Query:
    """The ``limit`` rows nearest to ``vector``, best first, with their score as ``__score``.

    ``pre_filter`` holds before the best are taken; a ``where`` on the result holds after, and may leave fewer.
    ``exact`` and ``candidates`` exclude each other; as every row is scored, ``candidates`` changes no result.
    ``kind`` is the declared index's similarity unless it is given.  ``packed`` says that ``path`` holds binary vectors
    of ``int8`` or ``float32``.
    """
    if exact and candidates is not None:
        raise QueryError("an exact search has no number of candidates")
    if candidates is not None and candidates < limit:
        raise QueryError("there must be as many candidates as results")
    if set(query._ops) - {"where"}:
        raise QueryError("a vector search stands at the root of a query")
    if kind is None:
        declared = _index(query, path, index)
        kind = declared.similarity if declared else "cosine"
        if declared and not isinstance(vector, (bytes, bytearray)) and declared.dimensions != len(vector):
            raise QueryError(f"{path} has {declared.dimensions} dimensions, the query {len(vector)}")
    rows = query.where(pre_filter) if pre_filter is not None else query
    keys = [tie] if tie else list(query.entity.key) if query.entity is not None else []
    scored = rows._df.where(F.col(path).isNotNull()).withColumn(SCORE, similarity({None: lambda c: c, "int8": unpack_int8, "float32": unpack_float32}[packed](F.col(path)), vector, kind)).where(F.col(SCORE).isNotNull())
    order = ((F.col(SCORE), True), *[(F.col(k), False) for k in keys])
    found = scored.orderBy(F.col(SCORE).desc(), *[F.col(k).asc() for k in keys]).limit(limit)
    return query._with(found, "vector", order=order)

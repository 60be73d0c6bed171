import math

import pytest
from pyspark.sql import functions as F

from docquery.operators import textindex as tx
from docquery.operators.query import Query, QueryError
from docquery.operators.vector import vector_search
from docquery.plans.model import EntityType, Index, Prop


@pytest.fixture
def books(spark):
    entity = EntityType("Book", "books", (Prop("id", "int"), Prop("v", "array<float>"), Prop("bits", "binary")), ("id",), indexes=(Index("i", ("v",), dimensions=2, similarity="cosine"),))
    rows = [(1, [1.0, 0.0], b"\x00\x01"), (2, [0.0, 1.0], b"\xff\xff"), (3, [1.0, 1.0], b"\x00\x03"), (4, None, None), (5, [0.0, 0.0], b"\x00\x00")]
    return Query(spark.createDataFrame(rows, "id int, v array<float>, bits binary"), entity=entity)


def found(query):
    return [r.id for r in query.to_list()]


def test_order_filters_and_scores(books):
    best = vector_search(books, "v", [1.0, 0.1], 2)
    assert found(best) == [1, 3] and math.isclose(best.first()["__score"], 1 / math.sqrt(1.01), rel_tol=1e-6)
    assert found(vector_search(books, "v", [1.0, 0.1], 2, pre_filter=lambda b: b.id > 1)) == [3, 2]
    assert found(vector_search(books, "v", [1.0, 0.1], 2).where(lambda b: b.id > 1)) == [3]
    assert found(vector_search(books, "v", [0.0, 0.0], 9, kind="euclidean")) == [5, 1, 2, 3]
    assert found(vector_search(books, "bits", b"\x00\x01", 3, kind="euclidean")) == [1, 3, 5]


def test_conflicts(books):
    for options in ({"exact": True, "candidates": 10}, {"candidates": 1}):
        with pytest.raises(QueryError):
            vector_search(books, "v", [1.0, 0.0], 2, **options)
    with pytest.raises(QueryError):
        vector_search(books, "v", [1.0], 2)
    with pytest.raises(QueryError):
        vector_search(books, "bits", b"\x00", 2)
    with pytest.raises(QueryError):
        vector_search(books.order_by("id").take(3), "v", [1.0, 0.0], 2)


def tokens(spark, text, analyzer):
    return spark.createDataFrame([(text,)], "t string").select(analyzer.tokens(F.col("t"))).first()[0]


def test_analyzers(spark):
    a = tx.Analyzer("a", tx.standard(), (tx.html_strip(),), (tx.lowercase(), tx.stop_words(["the"]), tx.english_possessive()))
    assert tokens(spark, "<b>The</b> Dog's  bone", a) == ["dog", "bone"]
    assert tokens(spark, "a b c", tx.Analyzer("s", tx.whitespace(), token_filters=(tx.shingles(2, 2),))) == ["a b", "b c"]
    assert tokens(spark, "abc", tx.Analyzer("n", tx.ngram(2, 3))) == ["ab", "bc", "abc"]
    assert tokens(spark, "abc", tx.Analyzer("e", tx.edge_gram(1, 5))) == ["a", "ab", "abc"]
    assert tokens(spark, "PowerShot500 É", tx.Analyzer("w", tx.whitespace(), token_filters=(tx.word_delimiter(),))) == ["Power", "Shot", "500", "É"]
    assert tokens(spark, "mail a@b.c now", tx.Analyzer("u", tx.url_email())) == ["mail", "a@b.c", "now"]
    assert tokens(spark, None, tx.Analyzer("x")) is None


def test_definition():
    index = tx.SearchIndex("i", dynamic=True).map("title", "string", "words").map("year", "number").analyze(tx.Analyzer("words"))
    assert index.definition()["mappings"]["fields"] == {"title": {"type": "string", "analyzer": "words"}, "year": {"type": "number"}}
    with pytest.raises(ValueError):
        index.map("x", "odd")


def test_packed_numbers(spark):
    import struct

    from docquery.operators.vector import unpack_float32, unpack_int8

    values = [0.0, 1.0, -1.5, 3.1415927410125732, 1e-40, -2.5e30, 1.17549435e-38, float("inf"), float("nan")]
    values = [struct.unpack("<f", struct.pack("<f", v))[0] for v in values]
    df = spark.createDataFrame([(struct.pack(f"<{len(values)}f", *values), struct.pack("3b", -128, 127, -1))], "f binary, b binary")
    r = df.select(unpack_float32(F.col("f")).alias("f"), unpack_int8(F.col("b")).alias("b")).first()
    assert r.b == [-128.0, 127.0, -1.0] and r.f[-2:] == [None, None] and r.f[:-2] == values[:-2]

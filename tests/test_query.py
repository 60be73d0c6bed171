import pytest
from pyspark.sql import functions as F

from docquery.functions import collections as arr
from docquery.functions import nulls
from docquery.functions import strings as st
from docquery.operators.query import Query, QueryError


@pytest.fixture
def q(spark):
    return Query(spark.createDataFrame([(1, "a", 10), (2, None, 20), (3, "b", None), (3, "b", None)], "id int, name string, n int"))


def ids(query):
    return sorted(r.id for r in query.to_list())


def test_not_equal_keeps_null(q):
    assert ids(q.where(lambda r: nulls.ne(r.name, "a"))) == [2, 3, 3]
    assert ids(q.where(lambda r: nulls.not_true(r.name == "a"))) == [2, 3, 3]
    assert ids(q.where(lambda r: nulls.eq(r.name, r.name))) == [1, 2, 3, 3]


def test_lists_with_null(q):
    assert ids(q.where(lambda r: nulls.is_in(r.name, ["a", None]))) == [1, 2]
    assert ids(q.where(lambda r: nulls.not_in(r.name, ["a"]))) == [2, 3, 3]
    assert ids(q.where(lambda r: nulls.is_in(r.name, []))) == []
    assert ids(q.where(lambda r: nulls.is_in(r.name, [None]))) == [2]


def test_terminals(q):
    assert q.count() == 4 and q.count(lambda r: r.n > 10) == 1
    assert q.sum("n") == 30 and q.where(F.lit(False)).sum("n") == 0
    assert q.average("n") == 15 and q.min("n") == 10 and q.max("n") == 20
    assert q.any(lambda r: r.n == 20) and not q.any(lambda r: r.n == 21)
    assert not q.all(lambda r: r.n > 0), "a null counts against all"
    assert q.contains("a", "name") and q.contains(None, "name")


def test_empty_aggregates(q):
    none = q.where(F.lit(False))
    for f in ("average", "min", "max"):
        with pytest.raises(QueryError):
            getattr(none, f)("n")
        assert getattr(none, f)("n", nullable=True) is None


def test_elements(q):
    o = q.order_by("n").then_by("id")
    assert o.first().id == 3 and o.last().id == 2, "null is the lowest"
    assert o.single(lambda r: r.id == 1).id == 1
    assert o.first_or_default(lambda r: r.id == 9) is None and o.element_at_or_default(99) is None
    for f in (lambda: o.first(lambda r: r.id == 9), lambda: o.single(lambda r: r.id == 3), lambda: o.single_or_default(lambda r: r.id == 3), lambda: o.element_at(99), lambda: q.last()):
        with pytest.raises(QueryError):
            f()


def test_last_order_wins_and_reverse(q):
    assert [r.id for r in q.order_by("name").order_by("id", descending=True).to_list()] == [3, 3, 2, 1]
    assert [r.id for r in q.order_by("id").reverse().take(1).to_list()] == [3]
    assert ids(q.take(0)) == []


def test_sets(q):
    assert q.concat(q).count() == 8 and q.union(q).count() == 3
    assert q.intersect(q.where(lambda r: r.id == 3)).count() == 1
    assert ids(q.except_(q.where(lambda r: r.id == 3))) == [1, 2]


def test_strings(spark):
    df = spark.createDataFrame([("\t Ab \n", ""), (None, "x")], "s string, e string")
    got = df.select(
        st.trim(F.col("s")).alias("t"), st.trim_start(F.col("s")).alias("l"), st.index_of(F.col("s"), "b").alias("i"), st.index_of(F.col("s"), "").alias("z"), st.index_of(F.col("s"), "q").alias("m"),
        st.is_null_or_empty(F.col("e")).alias("e"), st.first_char(F.col("e")).alias("f"), st.to_chars(F.col("e")).alias("c"), st.compare(F.col("s"), F.col("e")).alias("k")).collect()
    assert tuple(got[0]) == ("Ab", "Ab \n", 3, 0, -1, True, None, [], 1)
    assert got[1].t is None and got[1].k == -1 and got[1].c == ["x"]


def test_arrays(spark):
    df = spark.createDataFrame([([1, None],), ([],), (None,)], "a array<int>")
    a = F.col("a")
    got = df.select(arr.count(a), arr.any_(a), arr.contains(a, 1), arr.contains(a, None), arr.all_(a, lambda x: x > 0), arr.element(a, 5)).collect()
    assert [tuple(r) for r in got] == [(2, True, True, True, False, None), (0, False, False, False, True, None), (0, False, False, False, True, None)]


def test_missing_and_null_differ_in_variants(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": null}',), ("{}",)], "j string").select(F.parse_json("j").alias("v"))
    v = F.col("v")
    got = df.select(nulls.variant_exists(v, "$.a"), nulls.variant_is_null(v, "$.a"), nulls.variant_is_missing(v, "$.a")).collect()
    assert [tuple(r) for r in got] == [(True, False, False), (True, True, False), (False, False, True)]


def test_plans_stay_native(q):
    plan = q.where(lambda r: nulls.ne(r.name, "a")).order_by("id").take(2).explain()
    assert "Python" not in plan and "TakeOrderedAndProject" in plan

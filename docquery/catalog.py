"""Registered queries over the test tables, each with the SQL that gives the same rows.

Every query goes through the library's own operators.  Null-bearing columns are made with ``nullif`` on both sides, as
the tables have few nulls; doubles are rounded on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquery.functions import collections as arr
from docquery.functions import dates as dt
from docquery.functions import maths as ma
from docquery.functions import nulls
from docquery.functions import strings as st
from docquery.operators import bulk, textindex
from docquery.operators.query import Query
from docquery.operators.unit_of_work import ConcurrencyError, UnitOfWork
from docquery.operators.vector import vector_search
from docquery.plans.model import EntityType, Index, Model, Nav, Prop
from docquery.sources import storage
from docquery.sources.session import Session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _props(text: str) -> tuple[Prop, ...]:
    """``name:type`` or ``name:type:element``, by spaces."""
    return tuple(Prop(*(p.split(":")[:2]), element=(p.split(":") + [None])[2]) for p in text.split())


MODEL = Model.of(
    EntityType("Region", "region", _props("key:int:r_regionkey name:string:r_name"), ("key",), (Nav("nations", "Nation", "key", "region_key", many=True),)),
    EntityType("Nation", "nation", _props("key:int:n_nationkey name:string:n_name region_key:int:n_regionkey"), ("key",),
               (Nav("region", "Region", "region_key", "key", required=True), Nav("customers", "Customer", "key", "nation_key", many=True))),
    EntityType("Customer", "customer", _props("key:long:c_custkey name:string:c_name nation_key:int:c_nationkey balance:double:c_acctbal segment:string:c_mktsegment"), ("key",),
               (Nav("nation", "Nation", "nation_key", "key", required=True), Nav("orders", "Order", "key", "customer_key", many=True))),
    EntityType("Order", "orders", _props("key:long:o_orderkey customer_key:long:o_custkey status:string:o_orderstatus total:double:o_totalprice date:timestamp_ntz:o_orderdate priority:string:o_orderpriority"), ("key",),
               (Nav("customer", "Customer", "customer_key", "key"), Nav("lines", "Line", "key", "order_key", many=True))),
    EntityType("Line", "lineitem", _props("order_key:long:l_orderkey part_key:long:l_partkey supplier_key:long:l_suppkey number:int:l_linenumber quantity:double:l_quantity price:double:l_extendedprice "
               "discount:double:l_discount tax:double:l_tax return_flag:string:l_returnflag status:string:l_linestatus shipped:timestamp_ntz:l_shipdate"), (),
               (Nav("order", "Order", "order_key", "key", required=True), Nav("part", "Part", "part_key", "key"), Nav("supplier", "Supplier", "supplier_key", "key"))),
    EntityType("Part", "part", _props("key:long:p_partkey name:string:p_name brand:string:p_brand type:string:p_type size:int:p_size price:double:p_retailprice"), ("key",)),
    EntityType("Supplier", "supplier", _props("key:long:s_suppkey name:string:s_name nation_key:int:s_nationkey balance:double:s_acctbal"), ("key",), (Nav("nation", "Nation", "nation_key", "key", required=True),)),
    EntityType("Event", "events", _props("key:long:event_id ts:timestamp_ntz user:long:user_id kind:string:event_type value:double props:string"), ("key",)),
    EntityType("Vector", "embeddings", _props("key:long:vec_id embedding:array<float> label:int"), ("key",), indexes=(Index("by_cosine", ("embedding",), dimensions=64, similarity="cosine"),)),
)


def _session(spark: SparkSession, sf_dir: str) -> Session:
    return Session(spark, sf_dir, MODEL)


def query(sql: str | None = None):
    def register(f: Callable[[Session], Query | DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = f(_session(spark, sf_dir))
            return out.df if isinstance(out, Query) else out

        QUERIES[f.__name__] = run
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _nullable_priority(s: Session) -> Query:
    """Orders whose priority is null where it is '5-LOW'."""
    q = s.set("Order")
    return q._with(q._df.withColumn("priority", F.nullif(F.col("priority"), F.lit("5-LOW"))))


_NP = "(SELECT *, nullif(o_orderpriority, '5-LOW') AS p FROM orders)"

# -- filters


@query("SELECT o_orderkey AS key, o_totalprice AS total FROM orders WHERE o_orderstatus = 'F'")
def where_eq(s):
    return s.set("Order").where(lambda o: o.status == "F").select("key", "total")


@query(f"SELECT o_orderkey AS key FROM {_NP} WHERE p IS DISTINCT FROM '1-URGENT'")
def where_ne_nullsafe(s):
    return _nullable_priority(s).where(lambda o: nulls.ne(o.priority, "1-URGENT")).select("key")


@query("SELECT o_orderkey AS key FROM orders WHERE o_totalprice >= 1000 AND o_totalprice < 50000 AND o_orderkey > 100 AND o_orderkey <= 9000")
def where_between(s):
    return s.set("Order").where(lambda o: (o.total >= 1000) & (o.total < 50000)).where(lambda o: (o.key > 100) & (o.key <= 9000)).select("key")


@query(f"SELECT o_orderkey AS key FROM {_NP} WHERE p IN ('1-URGENT', '2-HIGH') OR p IS NULL")
def where_in_with_null(s):
    return _nullable_priority(s).where(lambda o: nulls.is_in(o.priority, ["1-URGENT", "2-HIGH", None])).select("key")


@query(f"SELECT o_orderkey AS key FROM {_NP} WHERE p IS NULL OR p NOT IN ('1-URGENT', '2-HIGH')")
def where_not_in(s):
    return _nullable_priority(s).where(lambda o: nulls.not_in(o.priority, ["1-URGENT", "2-HIGH"])).select("key")


@query("SELECT o_orderkey AS key FROM orders WHERE false")
def where_in_empty(s):
    return s.set("Order").where(lambda o: nulls.is_in(o.priority, [])).select("key")


@query(f"SELECT o_orderkey AS key, p IS NULL AS is_null FROM {_NP} WHERE p IS NULL OR o_totalprice > 200000")
def where_null(s):
    return _nullable_priority(s).where(lambda o: o.priority.isNull() | (o.total > 200000)).select("key", is_null=lambda o: o.priority.isNull())


@query("SELECT n_nationkey AS key FROM nation WHERE nullif(n_nationkey, 3) IS NOT DISTINCT FROM nullif(n_regionkey, 3)")
def where_column_eq_column(s):
    three = F.lit(3)
    return s.set("Nation").where(lambda n: nulls.eq(F.nullif(n.key, three), F.nullif(n.region_key, three))).select("key")


@query("SELECT o_orderkey AS key FROM orders WHERE NOT (o_orderstatus = 'F' OR o_totalprice > 100000) OR (o_orderstatus = 'O' AND o_orderkey % 7 = 0)")
def bool_logic_nor(s):
    return s.set("Order").where(lambda o: ~((o.status == "F") | (o.total > 100000)) | ((o.status == "O") & (o.key % 7 == 0))).select("key")


@query(f"SELECT o_orderkey AS key FROM {_NP} WHERE NOT coalesce(p = '1-URGENT', false)")
def bool_negated_nullable(s):
    return _nullable_priority(s).where(lambda o: nulls.not_true(o.priority == "1-URGENT")).select("key")


@query("SELECT c_custkey AS key FROM customer WHERE (c_mktsegment = 'BUILDING') <> (c_acctbal > 0)")
def bool_xor(s):
    return s.set("Customer").where(lambda c: (c.segment == "BUILDING") != (c.balance > 0)).select("key")


@query("SELECT o_orderkey AS key FROM orders WHERE CASE WHEN o_orderstatus = 'F' THEN o_totalprice > 50000 ELSE o_totalprice < 20000 END")
def where_ternary(s):
    return s.set("Order").where(lambda o: F.when(o.status == "F", o.total > 50000).otherwise(o.total < 20000)).select("key")


@query("SELECT n_nationkey AS key FROM nation WHERE (n_regionkey = 1 AND n_name = 'NATION_1') OR (n_regionkey = n_nationkey % 5 AND n_regionkey = 2)")
def where_tuple_eq(s):
    return s.set("Nation").where(lambda n: (F.struct(n.region_key, n.name) == F.struct(F.lit(1), F.lit("NATION_1"))) | (F.struct(n.region_key, n.key % 5) == F.struct(F.lit(2), F.lit(2)))).select("key")


@query("SELECT c_custkey AS key, c_name AS name FROM customer WHERE c_custkey = 42")
def find_by_key(s):
    return s.set("Customer").find(42).select("key", "name")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE (l_orderkey = 1 AND l_linenumber = 1) OR (l_orderkey = 7 AND l_linenumber = 2)")
def find_composite_keys(s):
    q = s.set("Line")
    return q.where(nulls.any_key([F.col("order_key"), F.col("number")], [(1, 1), (7, 2)])).select(l_orderkey="order_key", l_linenumber="number", l_quantity="quantity")


@query("SELECT c_custkey AS key FROM customer WHERE c_custkey IN (1, 5, 9, 100000000)")
def entity_in_list(s):
    q = s.set("Customer")
    return q.where(q.entity_in([1, 5, 9, 100000000])).select("key")


@query("SELECT c_custkey AS key FROM customer WHERE c_custkey <> 5 AND c_custkey < 10")
def entity_not_equal(s):
    q = s.set("Customer")
    return q.where(~q.is_entity(5)).where(lambda c: c.key < 10).select("key")


@query("SELECT c_custkey AS key FROM customer WHERE c_custkey <> 5")
def entity_not_equal_all(s):
    q = s.set("Customer")
    return q.where(~q.is_entity(5)).select("key")


# -- projection


@query("SELECT o_orderkey AS id, o_orderstatus AS state, 7 AS seven, o_totalprice * 2 AS twice FROM orders")
def select_rename_computed(s):
    return s.set("Order").select(id="key", state="status", seven=F.lit(7), twice=lambda o: o.total * 2)


@query("SELECT o_orderkey AS key, o_orderstatus || '/' || o_orderpriority AS tag, o_totalprice AS total FROM orders")
def select_nested_struct(s):
    q = s.set("Order").select("key", "total", inner=lambda o: F.struct(o.status.alias("a"), F.struct(o.priority.alias("c")).alias("b")))
    return q.select("key", "total", tag=lambda r: st.concat(r["inner.a"], "/", r["inner.b.c"]))


@query("SELECT o_orderkey AS key, CAST(o_orderkey AS VARCHAR) || ',' || CAST(o_custkey AS VARCHAR) AS pair FROM orders")
def select_array(s):
    return s.set("Order").select("key", pair=lambda o: F.array_join(F.array(o.key, o.customer_key).cast("array<string>"), ","))


@query("SELECT n_nationkey AS key, n_name AS name, n_nationkey + 1 AS next FROM nation")
def select_entity_and_scalar(s):
    return s.set("Nation").select_entity(next=lambda n: n.key + 1).select(key=F.col("entity.key"), name=F.col("entity.name"), next="next")


@query("SELECT (o_orderkey + 1) * 2 AS v FROM orders")
def select_chained(s):
    return s.set("Order").select(a=lambda o: o.key + 1).select(v=lambda r: r.a * 2)


@query(f"SELECT o_orderkey AS key, coalesce(p, 'none') AS p, CASE WHEN o_totalprice > 100000 THEN 'big' WHEN o_totalprice > 50000 THEN 'mid' ELSE 'small' END AS size FROM {_NP}")
def coalesce_and_case(s):
    return _nullable_priority(s).select("key", p=lambda o: F.coalesce(o.priority, F.lit("none")), size=lambda o: F.when(o.total > 100000, "big").when(o.total > 50000, "mid").otherwise("small"))


# -- order, paging, distinct


@query("SELECT o_orderkey AS key, o_totalprice AS total, o_orderdate AS ordered FROM orders WHERE o_orderstatus = 'O' ORDER BY o_totalprice DESC, o_orderkey OFFSET 5 LIMIT 10")
def orderby_thenby_skip_take(s):
    return s.set("Order").where(lambda o: o.status == "O").order_by_descending("total").then_by("key").skip(5).take(10).select("key", "total", ordered="date")


@query(f"SELECT o_orderkey AS key, p FROM {_NP} ORDER BY p NULLS FIRST, o_orderkey DESC LIMIT 50")
def orderby_nulls_first(s):
    return _nullable_priority(s).order_by("priority").then_by_descending("key").take(50).select("key", p="priority")


@query("SELECT c_custkey AS key FROM customer ORDER BY c_custkey % 10, c_custkey LIMIT 20")
def orderby_expression(s):
    return s.set("Customer").order_by("name").order_by(lambda c: c.key % 10).then_by("key").take(20).select("key")


@query("SELECT key FROM (SELECT c_custkey AS key, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 100) WHERE c_acctbal < 9500")
def where_after_take(s):
    return s.set("Customer").order_by_descending("balance").then_by("key").take(100).where(lambda c: c.balance < 9500).select("key")


@query("SELECT c_custkey AS key FROM customer ORDER BY c_custkey DESC LIMIT 5")
def reverse_take(s):
    return s.set("Customer").order_by("key").reverse().take(5).select("key")


@query("SELECT DISTINCT o_orderstatus AS status, o_orderpriority AS priority FROM orders")
def distinct_scalar(s):
    return s.set("Order").select("status", "priority").distinct()


@query("SELECT DISTINCT p FROM (SELECT o_orderpriority AS p FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 20)")
def distinct_after_take(s):
    return s.set("Order").order_by("total").then_by("key").take(20).select(p="priority").distinct()


@query("SELECT p FROM (SELECT DISTINCT o_orderpriority AS p FROM orders) ORDER BY p LIMIT 3 OFFSET 1")
def distinct_order_skip_take(s):
    return s.set("Order").select(p="priority").distinct().order_by("p").skip(1).take(3)


# -- terminals


@query("SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'F'")
def count_predicate(s):
    return s.set("Order").count_df(lambda o: o.status == "F", "n")


@query("SELECT round(sum(o_totalprice), 2) AS s, round(avg(o_totalprice), 4) AS a, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders")
def sum_avg_min_max(s):
    q = s.set("Order")
    parts = [q.sum_df("total", "s").select(F.round("s", 2).alias("s")), q.average_df("total", "a").select(F.round("a", 4).alias("a")), q.min_df("total", "lo"), q.max_df("total", "hi")]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)  # one row each
    return out


@query("SELECT 0.0 AS s FROM region WHERE r_regionkey = 0")
def sum_empty_zero(s):
    return s.set("Order").where(lambda o: o.total < 0).sum_df("total", "s")


@query("SELECT count(*) AS n FROM (SELECT DISTINCT o_custkey FROM orders ORDER BY o_custkey LIMIT 300 OFFSET 10)")
def count_after_distinct_skip_take(s):
    return s.set("Order").select("customer_key").distinct().order_by("customer_key").skip(10).take(300).count_df(name="n")


@query("SELECT round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END), 2) AS v FROM orders")
def sum_conditional(s):
    return s.set("Order").sum_df(lambda o: F.when(o.status == "F", o.total).otherwise(0.0), "v").select(F.round("v", 2).alias("v"))


@query("SELECT bool_or(o_totalprice > 400000) AS any_big, bool_and(o_totalprice > 0) AS all_positive, bool_or(o_orderpriority = '2-HIGH') AS has FROM orders")
def any_all_contains(s):
    q = s.set("Order")
    return q.any_df(lambda o: o.total > 400000, "any_big").crossJoin(q.all_df(lambda o: o.total > 0, "all_positive")).crossJoin(q.contains_df("2-HIGH", "priority", "has"))


@query("SELECT o_orderkey AS key FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 1")
def first_ordered(s):
    return s.set("Order").order_by("total").then_by("key").take(1).select("key")


@query("SELECT o_orderkey AS key FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 1")
def last_ordered(s):
    return s.set("Order").order_by("total").then_by("key").last_df().select("key")


@query("SELECT o_orderkey AS key FROM orders ORDER BY o_orderkey LIMIT 1 OFFSET 17")
def element_at(s):
    return s.set("Order").order_by("key").skip(17).take(1).select("key")


# -- set operations


@query("SELECT c_name AS name FROM customer WHERE c_nationkey = 1 UNION ALL SELECT s_name FROM supplier WHERE s_nationkey = 1 UNION ALL SELECT c_name FROM customer WHERE c_nationkey = 1")
def concat_nested(s):
    c, p = s.set("Customer").where(lambda c: c.nation_key == 1).select("name"), s.set("Supplier").where(lambda x: x.nation_key == 1).select("name")
    return c.concat(p).concat(c)


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(s):
    return s.set("Customer").select(k="nation_key").union(s.set("Supplier").select(k="nation_key"))


@query("SELECT k FROM (SELECT c_custkey AS k FROM customer WHERE c_acctbal > 9000 UNION SELECT s_suppkey FROM supplier) ORDER BY k DESC LIMIT 15 OFFSET 2")
def union_order_skip_take(s):
    return s.set("Customer").where(lambda c: c.balance > 9000).select(k="key").union(s.set("Supplier").select(k="key")).order_by_descending("k").skip(2).take(15)


@query("(SELECT o_orderkey AS k FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5) UNION ALL (SELECT o_orderkey FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5)")
def concat_of_tops(s):
    q = s.set("Order")
    return q.order_by_descending("total").then_by("key").take(5).select(k="key").concat(q.order_by("total").then_by("key").take(5).select(k="key"))


@query("SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 5000 INTERSECT SELECT s_nationkey FROM supplier")
def ext_intersect(s):
    return s.set("Customer").where(lambda c: c.balance > 5000).select(k="nation_key").intersect(s.set("Supplier").select(k="nation_key"))


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders")
def ext_except(s):
    return s.set("Customer").select(k="key").except_(s.set("Order").select(k="customer_key"))


# -- joins and navigations


@query("SELECT o_orderkey AS key, c_name AS name FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 100000")
def join_inner(s):
    return s.set("Order").where(lambda o: o.total > 100000).join(s.set("Customer"), "customer_key", "key", key=lambda o, c: o.key, name=lambda o, c: c.name)


@query("SELECT c_custkey AS key, o_orderkey AS order_key FROM customer LEFT JOIN orders ON o_custkey = c_custkey")
def join_left(s):
    return s.set("Customer").left_join(s.set("Order"), "key", "customer_key", key=lambda c, o: c.key, order_key=lambda c, o: o.key)


@query("SELECT n_nationkey AS nation, s_suppkey AS supplier FROM (SELECT * FROM supplier WHERE s_acctbal > 0) RIGHT JOIN nation ON n_nationkey = s_nationkey")
def ext_join_right(s):
    return s.set("Supplier").where(lambda x: x.balance > 0).right_join(s.set("Nation"), "nation_key", "key", nation=lambda x, n: n.key, supplier=lambda x, n: x.key)


@query("SELECT o_orderkey AS key, n_name AS nation, r_name AS region FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE o_orderstatus = 'P'")
def join_chain(s):
    q = s.set("Order").where(lambda o: o.status == "P").join(s.set("Customer"), "customer_key", "key", key=lambda o, c: o.key, nation_key=lambda o, c: c.nation_key)
    q = q.join(s.set("Nation"), "nation_key", "key", key=lambda x, n: x.key, nation=lambda x, n: n.name, region_key=lambda x, n: n.region_key)
    return q.join(s.set("Region"), "region_key", "key", key=lambda x, r: x.key, nation=lambda x, r: x.nation, region=lambda x, r: r.name)


@query("SELECT a.n_nationkey AS a, b.n_nationkey AS b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey")
def join_self_condition(s):
    n = s.set("Nation")
    return n.join_on(n, lambda a, b: (a.region_key == b.region_key) & (a.key < b.key), a=lambda a, b: a.key, b=lambda a, b: b.key)


@query("SELECT a.l_orderkey AS o, a.l_linenumber AS n, b.l_quantity AS q FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber WHERE a.l_quantity > 49")
def ext_join_composite(s):
    return s.set("Line").where(lambda x: x.quantity > 49).join(s.set("Line"), ["order_key", "number"], ["order_key", "number"], o=lambda a, b: a.order_key, n=lambda a, b: a.number, q=lambda a, b: b.quantity)


@query("SELECT r_name AS region, n_name AS nation FROM region CROSS JOIN (SELECT * FROM nation WHERE n_nationkey < 3)")
def ext_cross_join(s):
    return s.set("Region").cross_join(s.set("Nation").where(lambda n: n.key < 3), region=lambda r, n: r.name, nation=lambda r, n: n.name)


@query("SELECT r_name AS region, n_name AS nation FROM region CROSS JOIN nation")
def ext_cross_join_all(s):
    return s.set("Region").cross_join(s.set("Nation"), region=lambda r, n: r.name, nation=lambda r, n: n.name)


@query("SELECT c_custkey AS key FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 150000)")
def ext_semi_join(s):
    return s.set("Customer").semi_join(s.set("Order").where(lambda o: o.total > 150000), "key", "customer_key").select("key")


@query("SELECT c_custkey AS key FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def ext_anti_join(s):
    return s.set("Customer").anti_join(s.set("Order"), "key", "customer_key").select("key")


@query("SELECT n_nationkey AS key, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS suppliers FROM nation")
def ext_group_join(s):
    return s.set("Nation").group_join(s.set("Supplier"), "key", "nation_key", "suppliers").select("key", suppliers=lambda n: arr.count(n.suppliers).cast("long"))


@query("SELECT c_custkey AS key, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE n_name <> 'NATION_3' AND r_name LIKE 'A%'")
def nav_filter_required(s):
    return s.set("Customer").where(lambda c: c.nation.name != "NATION_3").where(lambda c: st.starts_with(c.nation.region.name, "A")).select("key", region=lambda c: c.nation.region.name)


@query("SELECT o_orderkey AS key, c_name AS name FROM (SELECT *, nullif(o_custkey, 1) AS ck FROM orders) LEFT JOIN customer ON ck = c_custkey WHERE c_mktsegment IS DISTINCT FROM 'BUILDING'")
def nav_filter_optional(s):
    q = s.set("Order")
    q = q._with(q._df.withColumn("customer_key", F.nullif("customer_key", F.lit(1))))
    return q.where(lambda o: nulls.ne(o.customer.segment, "BUILDING")).select("key", name=lambda o: o.customer.name)


@query("SELECT o_orderkey AS key FROM orders JOIN customer ON o_custkey = c_custkey ORDER BY c_acctbal DESC, o_orderkey LIMIT 25")
def nav_order(s):
    return s.set("Order").order_by_descending(lambda o: o.customer.balance).then_by("key").take(25).select("key")


@query("SELECT o_orderkey AS key, c_name AS name FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def include_reference(s):
    return s.set("Order").include("customer").select("key", name=F.col("customer.name"))


@query("SELECT c_custkey AS key, o_orderkey AS order_key, o_totalprice AS total FROM customer LEFT JOIN orders ON o_custkey = c_custkey")
def include_collection(s):
    return s.set("Customer").include("orders").select_many("orders", "o", outer=True).select("key", order_key=F.col("o.key"), total=F.col("o.total"))


@query("SELECT c_custkey AS key, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n FROM customer")
def include_collection_count(s):
    return s.set("Customer").with_count("orders", "n").select("key", "n")


@query("SELECT c_custkey AS key, i - 1 AS at, o_orderkey AS order_key FROM customer JOIN (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) - 1 AS i FROM orders) ON o_custkey = c_custkey WHERE i BETWEEN 1 AND 2")
def include_collection_top2_skip1(s):
    q = s.set("Customer").include("orders", order_by=[F.col("total").desc(), F.col("key")], skip=1, take=2)
    return q.select_many("orders", "o", position="at").select("key", at=F.col("at").cast("long"), order_key=F.col("o.key"))


@query("SELECT r_regionkey AS region, n_nationkey AS nation, count(c_custkey) AS customers FROM region JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL")
def include_then_include(s):
    q = s.set("Region").include("nations", then=lambda n: n.include("customers"))
    return q.select_many("nations", "n").select(region="key", nation=F.col("n.key"), customers=arr.count(F.col("n.customers")).cast("long"))


@query("SELECT l_orderkey AS o, l_linenumber AS n, c_name AS customer, p_name AS part FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN part ON l_partkey = p_partkey WHERE l_quantity > 48")
def include_multiple(s):
    q = s.set("Line").where(lambda x: x.quantity > 48)
    return q.select(o="order_key", n="number", customer=lambda x: x.order.customer.name, part=lambda x: x.part.name)


@query("SELECT c_custkey AS key, o_orderkey AS order_key FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderstatus = 'F'")
def ext_include_filtered(s):
    return s.set("Customer").include("orders", where=lambda o: o.status == "F").select_many("orders", "o").select("key", order_key=F.col("o.key"))


# -- grouping and flattening


@query("SELECT o_orderstatus AS status, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderstatus HAVING count(*) > 10")
def ext_groupby_agg(s):
    return s.set("Order").group_by("status", having=F.col("n") > 10, n=F.count("*"), total=F.round(F.sum("total"), 2))


@query("SELECT n_name AS nation, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def ext_groupby_navigation(s):
    return s.set("Customer").group_by(lambda c: c.nation.name.alias("nation"), n=F.count("*"))


@query("SELECT vec_id AS key, i - 1 AS at, embedding[i] AS x FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) WHERE vec_id < 5")
def ext_explode(s):
    return s.set("Vector").where(lambda v: v.key < 5).select_many("embedding", "x", position="at").select("key", "x", at=F.col("at").cast("long"))


@query("SELECT vec_id AS key, i - 1 AS at, embedding[i] AS x FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)")
def ext_explode_all(s):
    return s.set("Vector").select_many("embedding", "x", position="at").select("key", "x", at=F.col("at").cast("long"))


# -- embedded documents, arrays and maps


@query("SELECT o_orderkey AS key, count(*) FILTER (l_quantity > 45) AS big, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey HAVING bool_or(l_returnflag = 'R')")
def embedded_collection(s):
    q = s.set("Order").include("lines").where(lambda o: arr.any_(o.lines, lambda x: x["return_flag"] == "R"))
    return q.select("key", big=lambda o: arr.count(arr.where(o.lines, lambda x: x["quantity"] > 45)).cast("long"), n=lambda o: arr.count(o.lines).cast("long"))


@query("SELECT o_orderkey AS key FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey HAVING bool_and(l_quantity > 10) AND list_contains(list(l_linestatus), 'O')")
def embedded_all_contains(s):
    q = s.set("Order").include("lines").where(lambda o: arr.any_(o.lines) & arr.all_(o.lines, lambda x: x["quantity"] > 10))
    return q.where(lambda o: arr.contains(F.col("lines.status"), "O")).select("key")


@query("SELECT o_orderkey AS key, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey) AS parts FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderkey < 200 GROUP BY o_orderkey")
def embedded_projection(s):
    q = s.set("Order").where(lambda o: o.key < 200).include("lines").where(lambda o: arr.any_(o.lines))
    return q.select("key", parts=lambda o: F.array_join(F.array_sort(arr.select(o.lines, lambda x: x["part_key"])).cast("array<string>"), ","))


@query("SELECT o_orderkey AS key, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey) AS parts FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey")
def embedded_projection_all(s):
    q = s.set("Order").include("lines").where(lambda o: arr.any_(o.lines))
    return q.select("key", parts=lambda o: F.array_join(F.array_sort(arr.select(o.lines, lambda x: x["part_key"])).cast("array<string>"), ","))


@query("SELECT event_id AS key, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events WHERE CAST(json_extract(props, '$.k') AS INTEGER) >= 50")
def json_document_filter(s):
    q = s.set("Event")
    doc = q._with(q._df.withColumn("doc", F.from_json("props", "k int")))
    return doc.where(lambda e: e["doc.k"] >= 50).select("key", k=F.col("doc.k"))


@query("SELECT event_id AS key, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events WHERE json_extract(props, '$.k') IS NOT NULL AND json_extract(props, '$.missing') IS NULL")
def map_contains_key(s):
    q = s.set("Event")
    doc = q._with(q._df.withColumn("doc", F.from_json("props", "map<string,int>")))
    return doc.where(lambda e: arr.has_key(e.doc, "k") & ~arr.has_key(e.doc, "missing")).select("key", k=lambda e: arr.value(e.doc, "k"))


# -- scalar functions


@query("SELECT p_partkey AS key FROM part WHERE starts_with(p_type, 'P') AND ends_with(lower(p_type), lower('L')) AND NOT contains(p_name, 'zzz') OR contains(p_brand, '3')")
def str_match(s):
    return s.set("Part").where(lambda p: (st.starts_with(p.type, "P") & st.ends_with(p.type, "L", ignore_case=True) & nulls.not_true(st.contains(p.name, "zzz"))) | st.contains(p.brand, "3")).select("key")


@query("SELECT p_partkey AS key, instr(p_name, 'a') - 1 AS i, CASE WHEN instr(substr(p_name, 4), 'a') = 0 THEN -1 ELSE instr(substr(p_name, 4), 'a') + 2 END AS j, replace(p_name, 'a', 'AA') AS r, substr(p_name, 3, 4) AS sub, substr(p_name, 5) AS tail, length(p_name) AS n FROM part")
def str_functions(s):
    return s.set("Part").select("key", i=lambda p: st.index_of(p.name, "a").cast("long"), j=lambda p: st.index_of(p.name, "a", 3).cast("long"), r=lambda p: st.replace(p.name, "a", "AA"), sub=lambda p: st.substring(p.name, 2, 4), tail=lambda p: st.substring(p.name, 4), n=lambda p: st.length(p.name).cast("long"))


@query("SELECT p_partkey AS key, trim(chr(9) || ' ' || p_brand || ' ' || chr(10), ' ' || chr(9) || chr(10)) AS t, ltrim(p_brand, 'Br') AS l, rtrim(p_brand, '#123') AS r, upper(p_name) AS u, lower(p_type) AS w FROM part")
def str_trim_case(s):
    return s.set("Part").select("key", t=lambda p: st.trim(st.concat("\t ", p.brand, " \n")), l=lambda p: st.trim_start(p.brand, "Br"), r=lambda p: st.trim_end(p.brand, "#123"), u=lambda p: st.upper(p.name), w=lambda p: st.lower(p.type))


@query("SELECT c_custkey AS key, CASE WHEN c_mktsegment < 'F' THEN -1 WHEN c_mktsegment = 'F' THEN 0 ELSE 1 END AS cmp, lower(c_mktsegment) = 'building' AS same FROM customer WHERE c_mktsegment > 'B'")
def str_compare(s):
    return s.set("Customer").where(lambda c: st.compare(c.segment, "B") > 0).select("key", cmp=lambda c: st.compare(c.segment, "F"), same=lambda c: st.equals(c.segment, "Building", ignore_case=True))


@query(f"SELECT o_orderkey AS key, p IS NULL OR p = '' AS empty, p IS NULL OR regexp_full_match(p, '\\s*') AS blank, o_orderkey || '-' || p AS joined, regexp_matches(o_orderpriority, '^[12]-') AS urgent, o_orderpriority LIKE '%H%' AS liked FROM {_NP}")
def str_empty_concat_regex(s):
    q = s.set("Order")
    q = q._with(q._df.withColumn("p", F.nullif("priority", F.lit("5-LOW"))))
    return q.select("key", empty=lambda o: st.is_null_or_empty(o.p), blank=lambda o: st.is_null_or_white_space(o.p), joined=lambda o: st.concat(o.key, "-", o.p), urgent=lambda o: st.matches(o.priority, "^[12]-"), liked=lambda o: st.like(o.priority, "%H%"))


@query("SELECT s_suppkey AS key, abs(s_acctbal) AS a, ceil(s_acctbal) AS c, floor(s_acctbal) AS f, trunc(s_acctbal) AS t, round_even(s_acctbal / 3, 1) AS r, sign(s_acctbal) AS g FROM supplier")
def math_rounding(s):
    return s.set("Supplier").select("key", a=lambda x: ma.absolute(x.balance), c=lambda x: ma.ceiling(x.balance), f=lambda x: ma.floor(x.balance), t=lambda x: ma.truncate(x.balance), r=lambda x: ma.round_even(x.balance / 3, 1), g=lambda x: ma.sign(x.balance))


@query("SELECT p_partkey AS key, round(pow(p_size, 2), 6) AS p, round(sqrt(p_size), 6) AS s, round(ln(p_size), 6) AS l, round(log10(p_size), 6) AS l10, round(ln(p_size) / ln(2), 6) AS l2, round(exp(p_size / 50.0), 6) AS e FROM part")
def math_powers(s):
    r = lambda c: F.round(c, 6)
    return s.set("Part").select("key", p=lambda x: r(ma.power(x["size"], 2)), s=lambda x: r(ma.sqrt(x["size"])), l=lambda x: r(ma.log(x["size"])), l10=lambda x: r(ma.log10(x["size"])), l2=lambda x: r(ma.log(x["size"], 2)), e=lambda x: r(ma.exp(x["size"] / 50.0)))


@query("SELECT p_partkey AS key, round(sin(p_size), 6) AS s, round(cos(p_size), 6) AS c, round(tan(p_size), 4) AS t, round(asin(p_size / 100.0), 6) AS a, round(acos(p_size / 100.0), 6) AS b, round(atan(p_size), 6) AS d, round(atan2(p_size, 3), 6) AS e, round(degrees(p_size), 4) AS g, round(radians(p_size), 6) AS h FROM part")
def math_trigonometry(s):
    r = lambda c, d=6: F.round(c, d)
    x = F.col("size")
    return s.set("Part").select("key", s=r(ma.sin(x)), c=r(ma.cos(x)), t=r(ma.tan(x), 4), a=r(ma.asin(x / 100.0)), b=r(ma.acos(x / 100.0)), d=r(ma.atan(x)), e=r(ma.atan2(x, F.lit(3))), g=r(ma.degrees(x), 4), h=r(ma.radians(x)))


@query("SELECT o_orderkey AS key, o_orderkey & 12 AS a, o_orderkey | 3 AS o, xor(o_orderkey, 5) AS x, ~o_orderkey AS n, o_orderkey // 7 AS d, o_orderkey % 7 AS m, least(o_orderkey, 100) AS lo, greatest(o_orderkey, 100) AS hi FROM orders WHERE o_orderkey & 3 = 3")
def math_bits_and_integers(s):
    return s.set("Order").where(lambda o: ma.has_flags(o.key, 3)).select("key", a=lambda o: ma.bit_and(o.key, 12), o=lambda o: ma.bit_or(o.key, 3), x=lambda o: ma.bit_xor(o.key, 5), n=lambda o: ma.bit_not(o.key), d=lambda o: ma.divide(o.key, 7, integer=True), m=lambda o: ma.mod(o.key, 7), lo=lambda o: ma.least(o.key, 100), hi=lambda o: ma.greatest(o.key, 100))


@query("SELECT event_id AS key, year(ts) AS y, month(ts) AS mo, day(ts) AS d, hour(ts) AS h, minute(ts) AS mi, second(ts) AS s, millisecond(ts) % 1000 AS ms, dayofyear(ts) AS doy, dayofweek(ts) AS dow FROM events")
def date_parts(s):
    t = F.col("ts")
    return s.set("Event").select("key", y=dt.year(t), mo=dt.month(t), d=dt.day(t), h=dt.hour(t), mi=dt.minute(t), s=dt.second(t), ms=dt.millisecond(t), doy=dt.day_of_year(t), dow=dt.day_of_week(t))


@query("SELECT event_id AS key, date_trunc('day', ts) AS day, (epoch_us(ts) - epoch_us(date_trunc('day', ts))) // 1000 AS tod, ts + INTERVAL 1 MONTH AS m, ts - INTERVAL 3 HOUR AS h, ts + INTERVAL 1 YEAR AS y FROM events WHERE ts >= TIMESTAMP '2024-01-01'")
def date_arithmetic(s):
    t = F.col("ts")
    q = s.set("Event").where(lambda e: e.ts >= F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'"))
    return q.select("key", day=dt.date(t), tod=dt.time_of_day(t), m=dt.add("MONTH", 1, t), h=dt.add("HOUR", -3, t), y=dt.add("YEAR", 1, t))


@query("SELECT o_orderkey AS key, CAST(o_totalprice AS BIGINT) AS n, CAST(o_orderkey AS VARCHAR) AS s, CAST(o_orderkey AS DOUBLE) AS d FROM orders WHERE o_totalprice = floor(o_totalprice) OR o_orderkey < 50")
def casts(s):
    return s.set("Order").where(lambda o: (o.total == F.floor(o.total)) | (o.key < 50)).select("key", n=lambda o: ma.convert(F.rint(o.total), "long"), s=lambda o: st.to_string(o.key), d=lambda o: ma.convert(o.key, "double"))


@query("SELECT o_orderkey AS key, CAST(o_totalprice AS BIGINT) AS n, CAST(o_orderkey AS VARCHAR) AS s, CAST(o_orderkey AS DOUBLE) AS d FROM orders")
def casts_all(s):
    return s.set("Order").select("key", n=lambda o: ma.convert(F.rint(o.total), "long"), s=lambda o: st.to_string(o.key), d=lambda o: ma.convert(o.key, "double"))


# -- vector search

_V = "(SELECT vec_id AS key, label, list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 7)) AS score FROM embeddings)"


def _seven(s: Session) -> list[float]:
    return [float(x) for x in s.set("Vector").where(lambda v: v.key == 7).single()["embedding"]]


@query(f"SELECT key, round(score, 6) AS score FROM {_V} ORDER BY score DESC, key LIMIT 5")
def vector_exact_cosine_top5(s):
    return vector_search(s.set("Vector"), "embedding", _seven(s), 5, kind="cosine", exact=True).select("key", score=F.round("__score", 6))


@query(f"SELECT key, round(score, 6) AS score FROM {_V} WHERE label = 3 ORDER BY score DESC, key LIMIT 5")
def vector_prefilter(s):
    return vector_search(s.set("Vector"), "embedding", _seven(s), 5, pre_filter=lambda v: v.label == 3, kind="cosine").select("key", score=F.round("__score", 6))


@query(f"SELECT key, round(score, 6) AS score FROM (SELECT * FROM {_V} ORDER BY score DESC, key LIMIT 50) WHERE label = 3")
def vector_postfilter(s):
    return vector_search(s.set("Vector"), "embedding", _seven(s), 50, kind="cosine", candidates=500).where(lambda v: v.label == 3).select("key", score=F.round("__score", 6))


@query("SELECT vec_id AS key, round(-list_distance(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 7)), 6) AS e, round(list_dot_product(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 7)), 6) AS d FROM embeddings")
def vector_similarities(s):
    from docquery.operators.vector import similarity

    seven = _seven(s)
    return s.set("Vector").select("key", e=F.round(similarity(F.col("embedding"), seven, "euclidean"), 6), d=F.round(similarity(F.col("embedding"), seven, "dotProduct"), 6))


# -- bulk operations, as the table that they leave


@query("SELECT o_orderkey AS key, CASE WHEN o_orderstatus = 'F' THEN 'DONE' ELSE o_orderstatus END AS status, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS total FROM orders")
def bulk_update(s):
    q = s.set("Order")
    return bulk.update_df(q.where(lambda o: o.status == "F"), q._df, ["key"], {"status": "DONE", "total": lambda o: o.total + 1}).select("key", "status", "total")


@query(f"SELECT o_orderkey AS key FROM {_NP} WHERE NOT coalesce(p = '1-URGENT', false)")
def bulk_delete(s):
    q = _nullable_priority(s)
    return bulk.delete_df(q.where(lambda o: o.priority == "1-URGENT"), q._df, ["key"]).select("key")


@query("SELECT o_orderkey AS key, CASE WHEN o_orderkey IN (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10) THEN 'TOP' ELSE o_orderpriority END AS priority FROM orders")
def bulk_update_top_n(s):
    q = s.set("Order")
    return bulk.update_df(q.order_by_descending("total").then_by("key").take(10), q._df, ["key"], {"priority": "TOP"}).select("key", "priority")


@query("SELECT c_custkey AS key FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM customer ORDER BY c_acctbal, c_custkey LIMIT 20 OFFSET 5)")
def bulk_delete_page(s):
    q = s.set("Customer")
    return bulk.delete_df(q.order_by("balance").then_by("key").skip(5).take(20), q._df, ["key"]).select("key")


# -- text analysis


@query("SELECT p_partkey AS key, array_to_string(list_distinct(list_filter(string_split_regex(lower(p_name), '\\s+'), lambda x: x <> '' AND length(x) >= 3)), ' ') IS NOT NULL AS ok, len(list_filter(string_split_regex(p_name, '\\s+'), lambda x: x <> '')) AS words FROM part")
def text_analyzer(s):
    a = textindex.Analyzer("words", textindex.whitespace(), token_filters=(textindex.lowercase(),))
    return s.set("Part").select("key", ok=F.lit(True), words=lambda p: F.size(a.tokens(p.name)).cast("long"))


@query("SELECT p_partkey AS key, array_to_string(list_transform(list_filter(list_transform(list_filter(string_split_regex(p_type || ' ' || p_brand || ' ' || p_name, '\\s+'), lambda x: x <> ''), lambda x: lower(x)), lambda x: length(x) >= 4 AND x NOT IN ('widget', 'promo')), lambda x: reverse(replace(x, 'brand#', 'b'))), ' ') AS tokens FROM part")
def text_analyzer_tokens(s):
    filters = (textindex.lowercase(), textindex.length_filter(4), textindex.stop_words(["Widget", "Promo"]), textindex.regex_filter("brand#", "b"), textindex.reverse())
    a = textindex.Analyzer("words", textindex.whitespace(), token_filters=filters)
    return s.set("Part").select("key", tokens=lambda p: F.array_join(a.tokens(st.concat(p.type, " ", p.brand, " ", p.name)), " "))


# -- headline shapes of the benchmark: scan, filter, top-k, reference include, paged include


@query("SELECT o_orderkey AS key, o_orderstatus AS status, o_totalprice AS total, c_name AS customer FROM (SELECT * FROM orders WHERE o_totalprice > 1000 ORDER BY o_orderdate DESC, o_orderkey OFFSET 50 LIMIT 1500) LEFT JOIN customer ON o_custkey = c_custkey")
def complex_query(s):
    q = s.set("Order").where(lambda o: o.total > 1000).order_by_descending("date").then_by("key").skip(50).take(1500)
    return q.include("customer").select("key", "status", "total", customer=F.col("customer.name"))


# -- the rest of the operators: whole tables, each against its SQL


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 150000")
def except_filtered(s):
    return s.set("Customer").select(k="key").except_(s.set("Order").where(lambda o: o.total > 150000).select(k="customer_key"))


@query("SELECT c_custkey AS key FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 150000)")
def anti_join_filtered(s):
    return s.set("Customer").anti_join(s.set("Order").where(lambda o: o.total > 150000), "key", "customer_key").select("key")


@query("SELECT o_orderkey AS key, CAST(o_totalprice / 3 AS BIGINT) AS n FROM orders")
def convert_half_even(s):
    return s.set("Order").select("key", n=lambda o: ma.to_whole(o.total / 3))


@query("SELECT p_partkey AS key, p_name AS both, '\u00a0' || p_name || '\u2003' AS wrapped, p_name || '\u2003' AS left_cut, false AS blank, true AS nothing FROM part")
def str_unicode_space(s):
    wrapped = lambda p: st.concat(F.lit("\u00a0"), p.name, F.lit("\u2003"))
    return s.set("Part").select("key", both=lambda p: st.trim(wrapped(p)), wrapped=wrapped, left_cut=lambda p: st.trim_start(wrapped(p)), blank=lambda p: st.is_null_or_white_space(wrapped(p)), nothing=lambda p: st.is_null_or_white_space(F.lit("\u00a0\u2003")))


@query("SELECT o_orderkey AS key FROM orders")
def where_constant_true(s):
    return s.set("Order").where(lambda o: F.lit(True)).select("key")


@query("SELECT NULL::BIGINT AS key")
def default_if_empty_none(s):
    return s.set("Order").where(lambda o: o.total < 0).select("key").default_if_empty()


@query("SELECT n_nationkey AS key FROM nation")
def default_if_empty_some(s):
    return s.set("Nation").select("key").default_if_empty()


@query("SELECT k, n FROM (SELECT c_nationkey AS k, 0 AS n FROM customer WHERE c_acctbal > 9900 UNION ALL SELECT s_nationkey, count(*) FROM supplier GROUP BY 1)")
def concat_with_group(s):
    left = s.set("Customer").where(lambda c: c.balance > 9900).select(k="nation_key", n=lambda c: F.lit(0).cast("long"))
    return left.concat(s.set("Supplier").group_by("nation_key", n=F.count("*")).select(k="nation_key", n="n"))


@query("SELECT o_orderkey AS key, c_name AS customer FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 190000 OR o_orderstatus = 'P'")
def include_over_union(s):
    q = s.set("Order")
    return q.where(lambda o: o.total > 190000).union(q.where(lambda o: o.status == "P")).include("customer").select("key", customer=F.col("customer.name"))


_TYPED = Model.of(
    EntityType("Event", "events", _props("key:long:event_id user:long:user_id value:double"), ("key",), discriminator="event_type", value="view"),
    EntityType("Click", base="Event", value="click"),
    EntityType("Purchase", base="Click", value="purchase"),
    EntityType("Large", "orders", (Prop("key", "long", "o_orderkey"), Prop("total", "double", "o_totalprice")), ("key",), query_filter=lambda o: o.total > 100000),
    EntityType("Account", "customer", (Prop("key", "long", "c_custkey"), Prop("cents", "long", "c_acctbal", to_store=lambda c: c / 100, from_store=lambda c: F.round(c * 100).cast("long"), stored_type="double")), ("key",)),
)


def _typed(s: Session) -> Session:
    return Session(s.spark, s.root, _TYPED)


@query("SELECT event_id AS key, event_type = 'purchase' AS bought FROM events WHERE event_type IN ('click', 'purchase') AND value > 10")
def hierarchy_of_type(s):
    clicks = _typed(s).set("Event").of_type("Click")
    return clicks.where(lambda e: e.value > 10).select("key", bought=clicks.is_type("Purchase"))


@query("SELECT event_id AS key, value FROM events WHERE event_type = 'purchase'")
def hierarchy_cast(s):
    return _typed(s).set("Purchase").cast("Event").select("key", "value")


@query("SELECT count(*) AS n, (SELECT count(*) FROM orders) AS everything FROM orders WHERE o_totalprice > 100000")
def query_filter(s):
    t = _typed(s)
    return t.set("Large").count_df(name="n").crossJoin(t.set("Large", ignore_filters=True).count_df(name="everything"))


@query("SELECT c_custkey AS key, CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM customer WHERE round(c_acctbal * 100) >= 500000")
def converted_property(s):
    return _typed(s).set("Account").where(lambda a: a.cents >= 500000).select("key", "cents")


@query("SELECT event_id AS key, event_id % 3 <> 1 AS there, event_id % 3 = 0 AS empty, event_id % 3 = 1 AS missing FROM events")
def missing_and_null(s):
    raw = F.parse_json(F.when(F.col("key") % 3 == 0, F.lit('{"k": null}')).when(F.col("key") % 3 == 1, F.lit("{}")).otherwise(F.col("props")))
    return s.set("Event").select("key", there=nulls.variant_exists(raw, "$.k"), empty=nulls.variant_is_null(raw, "$.k"), missing=nulls.variant_is_missing(raw, "$.k"))


_INT8 = "list_transform(embedding, lambda x: CAST(least(127, greatest(-128, floor(x * 100))) AS DOUBLE))"


@query(f"SELECT vec_id AS key, round(list_dot_product({_INT8}, (SELECT {_INT8} FROM embeddings WHERE vec_id = 7)), 3) AS score FROM embeddings ORDER BY score DESC, key LIMIT 20")
def vector_packed_int8(s):
    from docquery.operators.vector import unpack_int8

    byte = lambda x: F.right(F.concat(F.lit("0"), F.hex(F.least(F.lit(127), F.greatest(F.lit(-128), F.floor(x.cast("double") * 100))).cast("long"))), F.lit(2))
    q = s.set("Vector")
    q = q._with(q._df.withColumn("packed", F.unhex(F.array_join(F.transform("embedding", byte), ""))))
    seven = [float(x) for x in q.where(lambda v: v.key == 7).select(v=unpack_int8(F.col("packed"))).single()["v"]]
    return vector_search(q, "packed", seven, 20, kind="dotProduct", packed="int8", tie="key").select("key", score=F.round("__score", 3))


# -- saves, in a folder of their own: the table that they leave


def _scratch(s: Session) -> Session:
    """A session over a copy of the suppliers in the shared folder (a local one where none is set)."""
    import tempfile
    import uuid

    root = s.spark.conf.get("spark.checkpoint.dir", None) or s.spark.sparkContext.getConf().get("spark.checkpoint.dir") or "file://" + tempfile.mkdtemp(prefix="docquery-")
    model = Model.of(EntityType("Supplier", "supplier", (*_props("key:long:s_suppkey name:string:s_name nation_key:int:s_nationkey"), Prop("balance", "double", "s_acctbal", concurrency=True)), ("key",)))
    own = Session(s.spark, f"{root.rstrip('/')}/saves-{uuid.uuid4().hex[:12]}", model)
    storage.replace(s.set("Supplier")._df.select(F.col("key").alias("s_suppkey"), F.col("name").alias("s_name"), F.col("nation_key").alias("s_nationkey"), F.col("balance").alias("s_acctbal")), own.path("supplier"))
    return own


_SAVED = "SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nation_key, s_acctbal AS balance FROM supplier"


@query(f"{_SAVED} UNION ALL SELECT -1, 'new', 3, 1.5 UNION ALL SELECT -2, 'newer', 4, 2.5")
def save_insert(s):
    u = UnitOfWork(own := _scratch(s))
    u.add("Supplier", key=-1, name="new", nation_key=3, balance=1.5)
    u.add("Supplier", key=-2, name="newest", nation_key=4, balance=2.5)
    u.update("Supplier", -2, name="newer")
    u.add("Supplier", key=-3, name="never", nation_key=5, balance=0.0)
    u.remove("Supplier", -3)
    u.save_changes()
    return own.set("Supplier")


@query("SELECT s_suppkey AS key, CASE s_suppkey WHEN 1 THEN 'one' ELSE s_name END AS name, CASE s_suppkey WHEN 1 THEN 7 ELSE s_nationkey END AS nation_key, s_acctbal AS balance FROM supplier")
def save_update(s):
    """Two edits of one entity are one change."""
    u = UnitOfWork(own := _scratch(s))
    u.update("Supplier", 1, name="one")
    u.update("Supplier", 1, nation_key=7)
    u.save_changes()
    return own.set("Supplier")


@query(f"{_SAVED} WHERE s_suppkey <> 2 UNION ALL SELECT 2, 'again', 1, 0.5")
def save_delete_and_add(s):
    u = UnitOfWork(own := _scratch(s))
    u.remove("Supplier", 2)
    u.add("Supplier", key=2, name="again", nation_key=1, balance=0.5)
    u.save_changes()
    return own.set("Supplier")


@query(_SAVED)
def save_conflict(s):
    """Changes that meet a row that others changed, or a key that exists, leave the table as it is."""
    own = _scratch(s)
    for change in (lambda u: u.update("Supplier", 1, original={"balance": -1e9}, name="late"), lambda u: u.add("Supplier", key=2, name="twice", nation_key=1, balance=0.0)):
        u = UnitOfWork(own)
        u.remove("Supplier", 3)
        u.add("Supplier", key=3, name="three", nation_key=1, balance=0.0)
        change(u)
        try:
            u.save_changes()
        except ConcurrencyError:
            continue
        raise AssertionError("a conflict was not found")
    return own.set("Supplier")


@query(f"{_SAVED} WHERE s_suppkey <> 4")
def save_in_transaction(s):
    u = UnitOfWork(own := _scratch(s))
    u.begin()
    u.remove("Supplier", 3)
    u.save_changes()
    u.rollback()
    u.begin()
    u.remove("Supplier", 4)
    u.save_changes()
    u.commit()
    return own.set("Supplier")


@query("SELECT s_suppkey AS key, s_acctbal + CASE WHEN s_nationkey < 10 THEN 1 ELSE 0 END AS balance FROM supplier WHERE s_nationkey <> 12")
def bulk_written(s):
    """An update and a deletion that are written and read back."""
    own = _scratch(s)
    bulk.execute_update(own.set("Supplier").where(lambda x: x.nation_key < 10), balance=lambda x: x.balance + 1)
    bulk.execute_delete(own.set("Supplier").where(lambda x: x.nation_key == 12))
    return own.set("Supplier").select("key", "balance")


# -- headline shapes: whole entities, and a wide one


@query("SELECT o_orderkey AS key, o_custkey AS customer_key, o_orderstatus AS status, o_totalprice AS total, o_orderdate AS date, o_orderpriority AS priority FROM orders")
def whole_entities(s):
    return s.set("Order")


@query("SELECT l_orderkey AS order_key, l_partkey AS part_key, l_suppkey AS supplier_key, l_linenumber AS number, l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax, l_returnflag AS return_flag, l_linestatus AS status, l_shipdate AS shipped FROM lineitem")
def wide_whole_entities(s):
    return s.set("Line")

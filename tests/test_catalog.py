"""Every registered query of the library against its SQL on the smallest tables."""

from pathlib import Path

import pandas as pd
import pytest

from docquery import catalog

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events embeddings".split()


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]

    def plain(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "null"
        if isinstance(v, bool) or not hasattr(v, "__float__"):
            return str(v)
        return f"{float(v) + 0.0:.6g}"  # so that -0 and 0, which are equal, are one text

    return sorted(tuple(plain(v) for v in r) for r in frame.astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def oracle():
    duckdb = pytest.importorskip("duckdb")
    if not DATA.exists():
        pytest.skip("no test tables here")
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return db


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, oracle, name):
    got, want = catalog.QUERIES[name](spark, str(DATA)).toPandas(), oracle.sql(catalog.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


WHOLE = {
    "entity_not_equal_all": "SELECT count(*) - 1 FROM customer",
    "ext_cross_join_all": "SELECT (SELECT count(*) FROM region) * (SELECT count(*) FROM nation)",
    "ext_explode_all": "SELECT sum(len(embedding)) FROM embeddings",
    "embedded_projection_all": "SELECT count(DISTINCT l_orderkey) FROM lineitem",
    "casts_all": "SELECT count(*) FROM orders",
    "text_analyzer_tokens": "SELECT count(*) FROM part",
}


@pytest.mark.parametrize("name", sorted(WHOLE))
def test_no_row_is_cut(spark, oracle, name):
    assert catalog.QUERIES[name](spark, str(DATA)).count() == oracle.sql(WHOLE[name]).fetchall()[0][0]


def test_token_filters_change_tokens(spark):
    got = {r.key: r.tokens for r in catalog.QUERIES["text_analyzer_tokens"](spark, str(DATA)).collect()}
    assert got[0] == "ymonoce 31b dloc" and got[2] == "91b egral tlob"


def test_halves_are_those_of_doubles(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    cents = [15 * k for k in range(-6000, 6000)]  # a third is a half of a tenth, or the double beside it
    frame = pd.DataFrame({"s_suppkey": range(len(cents) + 5), "s_name": "x", "s_nationkey": 1, "s_acctbal": [c / 100 for c in cents] + [None, 1e19, -1e19, 1.7e308, -1.7e308]})
    db = duckdb.connect()
    db.register("given", frame)
    db.execute(f"COPY (SELECT s_suppkey::BIGINT AS s_suppkey, s_name, s_nationkey::INT AS s_nationkey, s_acctbal::DOUBLE AS s_acctbal FROM given) TO '{tmp_path}/supplier.parquet'")
    db.execute(f"CREATE VIEW supplier AS SELECT * FROM '{tmp_path}/supplier.parquet'")
    got, want = catalog.QUERIES["math_rounding"](spark, str(tmp_path)).toPandas(), db.sql(catalog.ORACLE_SQL["math_rounding"]).df()
    assert len(got) == len(frame) and rows(got) == rows(want)

"""Driver queries against their SQL on the smallest tables."""

import os
from datetime import date
from decimal import Decimal

import duckdb
import pandas as pd
import pytest

from tidemark import chronicle, queries

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = queries.queries() | chronicle.queries(), queries.oracle_sql() | chronicle.oracle_sql()
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT or v != v:
        return "~"
    if isinstance(v, (bool,)) or type(v).__name__ == "bool_":
        return str(bool(v))
    try:
        return f"{float(v):.4f}"
    except (TypeError, ValueError):
        return str(v).removesuffix(" 00:00:00")


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(map(plain, r)) for r in frame.itertuples(index=False, name=None))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = duck.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


@pytest.mark.parametrize(("each", "kind"), [("1.25", "decimal(14,2)"), ("999999999999.99", "decimal(24,2)")])
def test_totals_beyond_the_type_of_money_are_whole(spark, monkeypatch, each, kind):
    """Amounts fit decimal(14,2), their sum may not."""
    rows = [(date(2024, 1, d), "x", 1, Decimal(each), Decimal(0), Decimal(each)) for d in (1, 13)]
    monkeypatch.setattr(queries, "daily_revenue", lambda *_: spark.createDataFrame(rows, "day date, dimension string, orders long, gross decimal(14,2), refunds decimal(14,2), net decimal(14,2)"))
    out = queries.overview_totals(spark, "")
    assert dict(out.dtypes)["gross"] == kind and tuple(out.first()) == (2, 2 * Decimal(each), Decimal(0), 2 * Decimal(each), 1)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_deliveries_can_be_removed(spark):
    made = spark.sparkContext._tidemark_deliveries if hasattr(spark.sparkContext, "_tidemark_deliveries") else [queries._folder(spark)]
    queries.remove(spark)
    chronicle._made.clear()
    assert made and not any(map(os.path.exists, made)) and spark.sparkContext._tidemark_deliveries == []

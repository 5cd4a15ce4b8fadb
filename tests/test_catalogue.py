"""Every query of the catalogue against its SQL in DuckDB, and against other partitionings."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from gleaner.plans import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return str(v) if hasattr(v, "isoformat") else v


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(norm(v) for v in r) for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in catalogue.TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_gives_the_rows_of_its_sql(spark, duck, name):
    cols, got = spark_rows(catalogue.QUERIES[name](spark, SF))
    answer = duck.execute(catalogue.SQL[name])
    names = [c[0] for c in answer.description]
    assert sorted(names) == cols
    want = sorted((tuple(norm(r[names.index(c)]) for c in cols) for r in answer.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", ["multi_sort_union_dedupe", "best_candidate", "repick_by_filled", "running_new_docs", "widget_pivot", "status_machine"])
def test_result_does_not_depend_on_partitions(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        found = []
        for n in ("1", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(spark_rows(catalogue.QUERIES[name](spark, SF)))
        assert found[0] == found[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0


def test_picks_use_no_windows(spark):
    for name in ("best_candidate", "repick_by_filled", "first_duplicate", "multi_sort_union_dedupe"):
        plan = catalogue.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("name", ["classify_messages", "classify_two_texts", "document_kinds", "field_gates", "scanned_pages"])
def test_costly_documents_are_dealt_over_all_cores(spark, name):
    assert "RoundRobinPartitioning" in catalogue.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    plan = catalogue.QUERIES["drop_date_columns"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in plan and "l_comment" not in plan

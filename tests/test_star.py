"""Every registered query on the generated tables, against DuckDB; and the shape of the plans."""

import datetime as dt
import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
import compare
from promolens.plans.star_queries import QUERIES
from promolens.schemas import SPECS
from promolens.sources import star

DATA = os.environ.get("PROMOLENS_STAR_DATA", "/root/testdata/sf0.001")
SOURCES = "region nation customer supplier part orders lineitem events".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="generated tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in SOURCES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) <= set(registered.queries())
    assert set(QUERIES) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_parity(spark, duck, name):
    df = registered.queries()[name](spark, DATA)
    expected = compare.duck_rows(duck, registered.oracle_sql()[name], df.columns)
    assert expected, "nothing to compare"
    assert compare.spark_rows(df) == expected


def test_entry(spark):
    df = registered.entry(spark)
    assert df.columns[0] == "category"
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cross_join_and_no_python(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = registered.queries()[name](spark, DATA)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert unwanted not in plan


def test_scan_reads_only_the_columns_in_use(spark):
    df = registered.queries()["q09_age_group_targeting"](spark, DATA)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan
    assert "l_comment" not in plan
    assert "o_totalprice" not in plan


def test_every_foreign_key_has_orphans(spark):
    df = registered.queries()["dq_foreign_key"](spark, DATA)
    assert {(r.child_table, r.fk_column) for r in df.collect()} == {
        (name, fk.column) for name, spec in SPECS.items() for fk in spec.foreign_keys
    }


def test_line_items_without_an_order_count_in_both_engines(spark, tmp_path):
    """With and without dates the daily rows are the same, as in the SQL."""
    import shutil

    for name in SOURCES:
        shutil.copy(f"{DATA}/{name}.parquet", tmp_path / f"{name}.parquet")
    connection = duckdb.connect()
    connection.execute(
        f"""COPY (SELECT * FROM '{DATA}/lineitem.parquet' UNION ALL BY NAME
                  SELECT * REPLACE (l_orderkey + 90000000 AS l_orderkey)
                  FROM (SELECT * FROM '{DATA}/lineitem.parquet' LIMIT 5))
            TO '{tmp_path}/lineitem.parquet' (FORMAT parquet)"""
    )
    for name in SOURCES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    for name in ("q16_gs", "dq_primary_key", "dq_foreign_key", "ingest_campaign_daily_metrics", "dq_not_null"):
        df = registered.queries()[name](spark, str(tmp_path))
        expected = compare.duck_rows(connection, registered.oracle_sql()[name], df.columns)
        assert compare.spark_rows(df) == expected, name


def test_daily_rows_dealt_by_campaign(spark, tmp_path, monkeypatch):
    """More rows make more tasks, each with whole campaigns; rows and findings stay as they are."""
    day = dt.datetime(1995, 1, 1)
    orders = [(k, 1, "F", 1.0, day, "LOW") for k in (*range(1, 41), 7, None)]
    items = [(k, 1, 1, n, 1.0, 1.0, 0.0, "R") for k in (*range(1, 45), None, None) for n in (1, 2, 6, 7, 7)]
    for name, rows in (("orders", orders), ("lineitem", items)):
        spark.createDataFrame(rows, star._SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    source = star.StarTables(spark, str(tmp_path))
    found = {}
    for rows in (10, 10**6):
        monkeypatch.setattr(star, "TASK_ROWS", rows)
        metrics = source.campaign_daily_metrics(by_campaign=True)
        tasks = metrics.select("campaign_id", F.spark_partition_id().alias("task")).distinct().collect()
        late = registered.queries()["dq_metric_in_flight"](spark, str(tmp_path))
        found[rows] = Counter(metrics.collect()), compare.spark_rows(late), len({r.task for r in tasks})
        if rows == 10:
            assert max(Counter(r.campaign_id for r in tasks).values()) == 1
            assert metrics.rdd.getNumPartitions() == len(items) // rows
    assert found[10][:2] == found[10**6][:2]
    assert found[10][2] > 10
    assert len(found[10][1]) == 40 * 2  # two late days a campaign; the rows of campaign 5 have another id, 7 is there twice

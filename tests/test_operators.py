import random

import pytest
import sample
from pyspark.sql import Window
from pyspark.sql import functions as F

from promolens.operators import ranking
from promolens.operators.ranking import concentration, contenders, distributed_ntile, ranked_values, top_k_ranked
from promolens.operators.rollup import campaign_totals, one_row


def ntile(values, tiles):
    """Brute force: deal out sorted rows, the first tiles get one more."""
    small, larger = divmod(len(values), tiles)
    out, at = {}, 0
    for tile in range(1, tiles + 1):
        size = small + (tile <= larger)
        out.update(dict.fromkeys(values[at : at + size], tile))
        at += size
    return out


@pytest.mark.parametrize("n", [0, 1, 3, 5, 7, 1003])
@pytest.mark.parametrize("tiles", [1, 5])
def test_ntile_against_brute_force(spark, n, tiles):
    seeded = random.Random(n)
    rows = [(i, seeded.choice([0, 0, 1, 2, 500])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, v long").repartition(6)
    got = distributed_ntile(df, "v", "id", tiles, "tile").collect()
    order = [i for i, v in sorted(rows, key=lambda r: (-r[1], r[0]))]
    assert {r.id: r.tile for r in got} == ntile(order, tiles)


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_ntile_against_window_on_many_rows(spark, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    df = spark.range(100_003).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.xxhash64("id") % 1000).alias("v")
    )
    order = (F.desc("v"), F.col("id").asc())
    tiled = distributed_ntile(df, "v", "id", 5, "tile")
    expected = df.select("id", F.ntile(5).over(Window.orderBy(*order)).alias("expected"))
    both = tiled.join(expected, "id")
    try:
        assert both.count() == 100_003
        assert both.filter("tile <> expected").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_top_k_rank_is_the_global_rank(spark):
    df = spark.range(5000).select("id", (F.xxhash64("id") % 40).alias("v"))
    got = top_k_ranked(df, 200, "v", ["id"], "r").collect()
    everything = df.withColumn("r", F.dense_rank().over(Window.orderBy(F.desc("v"))))
    expected = everything.orderBy(F.desc("v"), "id").limit(200).collect()
    assert sorted((r.id, r.r) for r in got) == sorted((r.id, r.r) for r in expected)


def test_ntile_starts_no_job_and_stores_nothing(spark, tmp_path):
    done = spark.sparkContext.statusTracker()
    before = len(done.getJobIdsForGroup())
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("v"))
    plan = distributed_ntile(df, "v", "id", 5, "tile")._jdf.queryExecution().executedPlan().toString()
    assert len(done.getJobIdsForGroup()) == before
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_ntile_of_null_measures(spark):
    rows = [(i, None if i % 4 == 0 else i % 3) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, v int")
    got = {r.id: r.tile for r in distributed_ntile(df, "v", "id", 4, "tile").collect()}
    order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert got == ntile([i for i, _ in order], 4)


def test_money_totals_are_exact(spark):
    amounts = ["99999999.99", "-0.01", "0.10", "0.20", None, "12345678.91"] * 50
    rows = [
        (n, n % 3, None, 1, 1, 1, 1, 1, sample.usd(a), None) for n, a in enumerate(amounts)
    ]
    t = sample.tables(spark, campaign_daily_metrics=rows)
    totals = campaign_totals(t.campaign_daily_metrics).collect()
    for r in totals:
        given = [row[8] for row in rows if row[1] == r.campaign_id and row[8] is not None]
        assert r.spend_usd == sum(given)
        assert r.watch_time_mins is None


def test_totals_reach_the_shuffle_combined(spark, tables):
    plan = campaign_totals(tables.campaign_daily_metrics)._jdf.queryExecution().toString()
    assert "partial_sum(" in plan


def test_one_row_without_a_cross_join(spark):
    a = spark.range(5).agg(F.count("*").alias("n"))
    b = spark.range(3).agg(F.sum("id").alias("s"))
    c = spark.range(0).agg(F.sum("id").alias("nothing"))
    assert tuple(one_row(a, b, c).first()) == (5, 3, None)


def shares(values, tiles):
    """(tile, members, total) of values dealt out in order, NULL last."""
    order = sorted(values, key=lambda v: (v is None, -(v or 0)))
    small, larger = divmod(len(order), tiles)
    out, at = [], 0
    for tile in range(1, tiles + 1):
        part = order[at : at + small + (tile <= larger)]
        at += len(part)
        known = [v for v in part if v is not None]
        if part:
            out.append((tile, len(part), sum(known) if known else None))
    return out


@pytest.mark.parametrize("n", [0, 1, 3, 7, 1003])
@pytest.mark.parametrize("tiles", [1, 4, 5])
@pytest.mark.parametrize("kind", ["long", "decimal(20,2)"])
def test_concentration_against_brute_force(spark, n, tiles, kind):
    r = random.Random(n + tiles)
    amounts = [0, 0, 1, 2, 500, -3, None, 10**9, 10**9 + 1]
    values = [r.choice(amounts) if i % 2 else r.randrange(-50, 10**6) for i in range(n)]
    df = spark.createDataFrame(list(enumerate(values)), "id long, v long").repartition(6)
    got = concentration(df.withColumn("v", F.col("v").cast(kind)), "id", "v", tiles).orderBy("tile").collect()
    assert [(t.tile, t.members, t.total) for t in got] == shares(values, tiles)


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_concentration_on_many_rows(spark, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    amount = F.when(F.col("id") % 3 == 0, 0).otherwise(F.pmod(F.xxhash64("id"), F.lit(100_000)))
    df = spark.range(100_003).select("id", amount.alias("v"))
    try:
        got = concentration(df, "id", "v", 7).orderBy("tile").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert [(t.tile, t.members, t.total) for t in got] == shares([r.v for r in df.collect()], 7)
    assert got[-1].cumulative_pct == 100.0


def test_places_of_values(spark):
    rows = [(5,), (5,), (None,), (9,), (-1,), (5,), (None,)]
    got = ranked_values(spark.createDataFrame(rows, "v int"), "v").collect()
    assert {(r.v, r.rows, r.start, r.total) for r in got} == {(9, 1, 0, 7), (5, 3, 1, 7), (-1, 1, 4, 7), (None, 2, 5, 7)}


def test_concentration_reads_its_input_once_and_numbers_no_row(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("v"))
    done = spark.sparkContext.statusTracker()
    before = len(done.getJobIdsForGroup())
    plan = concentration(df, "id", "v")._jdf.queryExecution().optimizedPlan().toString()
    assert len(done.getJobIdsForGroup()) == before
    assert plan.count("Range (0, 1000") == 1
    assert "row_number" not in plan
    assert "Join" not in plan


@pytest.mark.parametrize("leaders", [1, 8, 1000])
@pytest.mark.parametrize("known", [0, 3, 40])
def test_contenders_hold_the_best_known_rows(spark, monkeypatch, leaders, known):
    monkeypatch.setattr(ranking, "LEADERS", leaders)
    r = random.Random(known)
    rows = [(i, r.randrange(60), r.randrange(5), r.choice([None, 1.5, 2.5, 9.0, r.random()])) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, a int, b int, v double").repartition(4)
    a, b = (spark.range(n).select(F.col("id").cast("int").alias(c)) for c, n in (("a", known), ("b", 4)))
    order = lambda row: (row[3] is None, -(row[3] or 0), row[0])
    for k in (1, 5, 20):
        got = [tuple(x) for x in contenders(df, k, "v", [("a", a), ("b", b)]).collect()]
        expected = sorted((x for x in rows if x[1] < known and x[2] < 4), key=order)
        assert sorted(got, key=order)[:k] == expected[:k]
        assert set(got) <= set(expected)
        if known == 40 and leaders == 1000 and k < 5:
            assert len(got) < len(expected) / 2

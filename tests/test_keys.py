"""Bit arrays of keys, repeated keys, and one row for each key."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import compare
import sample
from promolens import jobs
from promolens.operators.key_filter import key_bits, may_hold, only_keys_of
from promolens.operators.keys import may_repeat, one_row_per_key, repeated_keys
from promolens.operators.lifecycle import latest_campaign_views, latest_campaigns
from promolens.operators.quality import dq_metric_in_flight
from promolens.schemas import SPECS
from promolens.sources import CampaignTables




def test_a_bit_array_keeps_all_keys_and_few_others(spark):
    keys = spark.range(0, 30_000, 3).withColumnRenamed("id", "k")
    rows = spark.range(30_000).withColumnRenamed("id", "k")
    array = key_bits(keys, "k", 1 << 18)
    kept = rows.where(may_hold(array, F.col("k"), 1 << 18))
    assert kept.join(keys, "k").count() == 10_000
    assert kept.count() < 10_000 + 20_000 * 0.02
    assert only_keys_of(rows, keys.where("false"), "k").count() == 0
    words = rows.select(F.concat(F.lit("é"), "k").alias("k"))
    assert only_keys_of(words, words.where("k < 'é2'"), "k").join(words, "k").where("k < 'é2'").count() == (
        words.where("k < 'é2'").count()
    )


def test_a_full_bit_array_changes_no_join(spark):
    keys = spark.range(0, 5000, 5).withColumnRenamed("id", "k")
    rows = spark.range(5000).withColumnRenamed("id", "k")
    assert only_keys_of(rows, keys, "k", 128).join(keys, "k").count() == 1000


@pytest.mark.parametrize("kind", ["long", "int", "string", "decimal(12,2)", "date"])
@pytest.mark.parametrize("bits", [128, 1 << 20])
def test_repeated_keys_against_a_count(spark, kind, bits):
    r = random.Random(3)
    values = [r.randrange(-300, 3000) for _ in range(700)] + [None, None, 2**31 - 1, -(2**31), 0]
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(5)
    cast = F.date_add(F.lit(sample.AS_OF), F.pmod("v", F.lit(100000)).cast("int")) if kind == "date" else F.col("v").cast(kind)
    keys = df.select(cast.alias("k"))
    expected = Counter(row.k for row in keys.collect())
    got = {row.k: row.copies for row in repeated_keys(keys, "k", bits).collect()}
    assert got == {k: n for k, n in expected.items() if n > 1 or k is None}
    if bits > 128 and kind not in ("long", "int"):  # of whole numbers, 64 stand together
        passed = keys.where(may_repeat(keys, "k", bits))
        assert passed.where("k IS NULL").count() == 0
        assert passed.count() < 500


def test_unique_numbers_pass_no_filter(spark):
    df = spark.range(-5000, 200_000).select(F.col("id").alias("k"))
    assert df.where(may_repeat(df, "k")).count() == 0
    assert repeated_keys(df, "k").count() == 0


def test_one_row_per_key(spark):
    rows = [(1, "a", None), (1, "a", 2), (1, "b", None), (2, None, 7), (3, "x", 1), (3, "x", 1), (None, "n", 1), (65, "y", 0)]
    df = spark.createDataFrame(rows, "k int, name string, n int").repartition(3)
    for bits in (128, 1 << 20):
        got = {tuple(r) for r in one_row_per_key(df, "k", bits).select(df.columns).collect()}
        assert got == {(1, "b", None), (2, None, 7), (3, "x", 1), (65, "y", 0)}
    assert one_row_per_key(df.where("false"), "k").count() == 0


@pytest.fixture(scope="module")
def repeated(spark, tmp_path_factory):
    """The sample with repeated creators, videos and campaigns: exact copies, lesser versions, rows without a key."""
    rows = dict(sample.ROWS)

    def lesser(row, place, value):
        return (*row[:place], value, *row[place + 1 :])

    rows["creators"] = [
        *sample.CREATORS, *sample.CREATORS[:3], lesser(sample.CREATORS[1], 1, "Aa"), lesser(sample.CREATORS[3], 1, None),
        (None, "Nobody", "x@example.com", None, None, None, sample.d("2023-01-01"), "Pro", sample.usd("9.00"), True),
    ]
    rows["videos"] = [*sample.VIDEOS, sample.VIDEOS[0], lesser(sample.VIDEOS[2], 1, 1)]
    rows["campaigns"] = [
        *sample.CAMPAIGNS, *sample.CAMPAIGNS, lesser(sample.CAMPAIGNS[4], 1, None), lesser(sample.CAMPAIGNS[8], 1, 1),
    ]
    folder = str(tmp_path_factory.mktemp("repeated"))
    for name, spec in SPECS.items():
        spark.createDataFrame(rows[name], spec.schema).repartition(3).write.parquet(f"{folder}/{name}")
    return folder


def test_reports_on_repeated_keys(spark, tables, repeated):
    """Loaded with repeated keys, every report is that of the SQL on tables without them."""
    from __spark_entry__ import comparable

    bodies = compare.sample_bodies(sample.HOME, sample.AS_OF.isoformat())
    duck = compare.connect(tables)
    loaded = CampaignTables.load(spark, repeated)
    for name, report in jobs.reports(loaded, sample.AS_OF, sample.HOME).items():
        df = comparable(report())
        assert compare.spark_rows(df) == compare.duck_rows(duck, bodies[name], df.columns), name


def test_a_promise_of_unique_keys_reads_all_rows(spark, repeated):
    assert CampaignTables.load(spark, repeated, unique_keys=True).campaigns.count() == 2 * len(sample.CAMPAIGNS) + 2
    assert CampaignTables.load(spark, repeated).campaigns.count() == len(sample.CAMPAIGNS)


def test_jobs_still_refuse_repeated_keys(spark, repeated, tmp_path):
    with pytest.raises(jobs.RepeatedKeys):
        jobs.ingest(spark, repeated, str(tmp_path / "typed"))


# The latest campaign


def later(spark):
    """Creator 1's last campaign to start has the smaller id; creator 3 has one without a start."""
    rows = [*sample.CAMPAIGNS]
    rows[0] = (*rows[0][:3], sample.d("2023-12-24"), *rows[0][4:])
    rows.append((110, 3, 13, None, None, sample.usd("1.00"), "View", None, "18-24", "Active"))
    return sample.tables(spark, campaigns=rows)


def test_the_latest_campaign_as_one_row(spark):
    t = later(spark)
    apart = {r.creator_id: (str(r.last_start), r.campaign_id) for r in latest_campaigns(t.campaigns).collect()}
    row = {r.creator_id: (str(r.last_start), r.campaign_id) for r in latest_campaigns(t.campaigns, as_row=True).collect()}
    assert apart[1] == ("2023-12-24", 102)
    assert row[1] == ("2023-12-24", 101)
    assert apart[3] == ("2024-05-15", 110)
    assert row[3] == ("2024-05-15", 105)
    assert {k: v for k, v in apart.items() if k not in (1, 3)} == {k: v for k, v in row.items() if k not in (1, 3)}


def test_both_readings_against_sql(spark):
    from __spark_entry__ import comparable
    from promolens import plans

    t = later(spark)
    duck = compare.connect(t)
    bodies = compare.sample_bodies(sample.HOME, sample.AS_OF.isoformat())
    shown = {}
    for as_row, name in ((False, "q06_churn_risk"), (True, "q06_latest_as_row")):
        df = comparable(plans.q06_churn_risk(t, sample.AS_OF, as_row))
        shown[name] = compare.spark_rows(df)
        assert shown[name] == compare.duck_rows(duck, bodies[name], df.columns)
    assert shown["q06_churn_risk"] != shown["q06_latest_as_row"]


# Rows that are dropped where they are read


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_old_campaigns_do_not_reach_the_join(spark, tables):
    df = latest_campaign_views(tables.creators, tables.campaigns, tables.campaign_daily_metrics)
    join = plan_of(df)
    assert "scalar-subquery" in join.split("Join Inner, (campaign_id")[1].split("Join")[0]


def test_days_of_clean_campaigns_are_not_grouped(spark, tables):
    offending = {r.campaign_id for r in dq_metric_in_flight(tables).collect()}
    assert offending == {102, 104}
    plan = plan_of(dq_metric_in_flight(tables))
    days = plan[plan.index("Aggregate [campaign_id#") :]
    assert "scalar-subquery" in days.split("Aggregate", 2)[1]


def test_late_campaigns_are_found_once(tables):
    """The days that are kept do not share a task with the days of all campaigns grouped once more."""

    def below(node):
        return [node, *(n for i in range(node.children().size()) for n in below(node.children().apply(i)))]

    plan = dq_metric_in_flight(tables)._jdf.queryExecution().optimizedPlan()
    assert [n.nodeName() for n in below(plan)].count("Aggregate") == 1

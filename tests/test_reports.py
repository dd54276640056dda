"""Reports on the hand-made sample: worked-out values, and every report against plain-join SQL."""

import pytest
from pyspark.sql import functions as F

import compare
import sample
from promolens import jobs, plans
from promolens.operators import quality
from promolens.operators.lifecycle import latest_campaign_views
from promolens.sources import CampaignTables, conform


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def reports(tables):
    return jobs.reports(tables, sample.AS_OF, sample.HOME)


def test_reports_against_plain_join_sql(spark, tables, reports):
    bodies = compare.sample_bodies(sample.HOME, sample.AS_OF.isoformat())
    duck = compare.connect(tables)
    from __spark_entry__ import comparable

    for name, report in reports.items():
        df = comparable(report())
        assert compare.spark_rows(df) == compare.duck_rows(duck, bodies[name], df.columns), name


def test_reports_on_stored_facts_are_the_same(spark, tables, reports, tmp_path):
    tables.facts.write.parquet(str(tmp_path / "facts"))
    stored = tables.with_facts(spark.read.parquet(str(tmp_path / "facts")))
    for name, report in jobs.reports(stored, sample.AS_OF, sample.HOME).items():
        assert compare.spark_rows(report()) == compare.spark_rows(reports[name]()), name


def test_reports_on_empty_tables(spark):
    empty = sample.empty(spark)
    one_row = {"q01_acquisition_funnel", "q16_health_scorecard", "q16_gs"}
    for name, report in jobs.reports(empty, sample.AS_OF, sample.HOME).items():
        assert len(report().collect()) == (1 if name in one_row else 0), name


def test_funnel(reports):
    assert rows(reports["q01_acquisition_funnel"]()) == [(8, 6, 75.0, 3, 37.5, 4, 50.0)]


def test_cohorts_count_whole_months(reports):
    assert rows(reports["q03_cohort_activation"]()) == [
        ("2023-01", 2, 1, 1, 2, 2, 50.0, 100.0),
        ("2023-02", 2, 2, 2, 2, 2, 100.0, 100.0),
        ("2023-03", 1, 0, 1, 1, 1, 0.0, 100.0),
        ("2023-05", 2, 0, 0, 0, 1, 0.0, 0.0),
        ("2023-07", 1, 0, 0, 0, 0, 0.0, 0.0),
    ]


def test_cohorts_only_grow(reports):
    for r in reports["q03_cohort_activation"]().collect():
        assert r.retained_m1 <= r.retained_m2 <= r.retained_m3 <= r.retained_m6 <= r.cohort_size


def test_ltv_takes_the_first_churn_and_skips_unknown_tenure(reports):
    assert rows(reports["q05_ltv_by_plan"]()) == [
        ("Agency", 1, 299.0, 16.0, 4784.0, 3588.0),
        ("Pro", 3, 149.0, 14.5, 2160.5, 1788.0),
        ("Starter", 2, 49.0, 10.0, 490.0, 588.0),
        ("Free", 2, 0.0, 9.0, 0.0, 0.0),
    ]


def test_churn_risk(reports):
    found = {
        r.creator_id: (r.days_since_last, r.view_trend, r.churn_risk)
        for r in reports["q06_churn_risk"]().collect()
    }
    assert found == {
        1: (395, "Stable", "MEDIUM"),
        2: (29, "Stable", "LOW"),
        3: (46, "Stable", "LOW"),
        4: (460, "Declining", "HIGH"),
    }


def test_views_before_the_start_count_only_in_the_first_form(reports):
    found = {r.creator_id: r for r in reports["q06a_churn_risk_placeholder"]().collect()}
    assert (found[1].first_week_views, found[1].latter_views) == (1200, 500)
    assert (found[1].view_trend, found[1].churn_risk) == ("Declining", "HIGH RISK")
    assert (found[2].first_week_views, found[2].latter_views) == (4000, 3000)


def test_roas_ties_go_by_campaign_and_missing_roas_comes_last(spark):
    metrics = [
        (n, c, sample.d("2023-03-01"), 100, 10 * v, 0, 0, 0, sample.usd(s), sample.usd("0.00"))
        for n, (c, v, s) in enumerate(
            [(101, 200, "1.00"), (103, 200, "1.00"), (102, 200, "1.00"), (104, 100, "0.00")]
        )
    ]
    t = sample.tables(spark, campaign_daily_metrics=metrics)
    best = [r.campaign_id for r in plans.q04_top_campaigns_roas(t).collect()]
    assert best == [101, 102, 103, 104]
    assert [r.campaign_id for r in plans.q04_top_campaigns_roas(t, k=2).collect()] == [101, 102]


def test_equal_spend_shares_a_rank(spark):
    metrics = [
        (c, c, sample.d("2023-03-01"), 100, 10, 0, 0, 0, sample.usd(s), sample.usd("0.00"))
        for c, s in [(101, "5.00"), (103, "5.00"), (104, "9.00"), (106, "1.00")]
    ]
    t = sample.tables(spark, campaign_daily_metrics=metrics)
    ranks = [(r.creator_id, r.spend_rank) for r in plans.q11_top_creators_by_spend(t).collect()]
    assert ranks == [(3, 1), (1, 2), (2, 2), (4, 3)]


def test_budget_limits_belong_to_the_upper_band(reports):
    found = {r.budget_bucket: r.campaigns for r in reports["q15_budget_sweet_spot"]().collect()}
    assert found == {
        "Under $100": 1,
        "$100–200": 2,
        "$200–500": 1,
        "$500–1000": 1,
        "$1000–2000": 2,
        "Above $2000": 1,
    }


def test_equal_return_is_a_disadvantage(reports):
    found = {
        (r.category, r.competitor_name): r.competitive_position
        for r in reports["q10_competitor_benchmark"]().collect()
    }
    assert found == {
        ("Food", "Rival A"): "Strong Advantage",
        ("Food", "Rival B"): "Disadvantage",
        ("Music", "Rival A"): "Partial Advantage",
    }


def test_benchmark_month_match_and_prefix(spark):
    later = [(n + 10, *row[1:8], sample.d("2024-02-01")) for n, row in enumerate(sample.BENCHMARKS)]
    t = sample.tables(spark, competitor_benchmarks=sample.BENCHMARKS + later)
    assert plans.q10_competitor_benchmark(t, sample.HOME).count() == 12
    by_month = plans.q10_competitor_benchmark(t, sample.HOME, "own", match_month=True)
    assert by_month.count() == 6
    assert "own_cpm" in by_month.columns


def test_quintiles_add_up(reports):
    found = reports["q14_revenue_concentration"]().collect()
    assert [r.spend_quintile for r in found] == [1, 2, 3, 4, 5]
    assert sum(r.quintile_spend for r in found) == sample.usd("984.08")
    assert found[-1].cumulative_pct == 100.0


def test_grain_safe_scorecard_counts_once(reports):
    safe = reports["q16_gs"]().first()
    joined = reports["q16_health_scorecard"]().first()
    assert (safe.total_creators, safe.active_creators) == (8, 5)
    assert safe.active_creators <= safe.total_creators < joined.active_creators
    assert safe.annualised_platform_revenue_usd == sample.usd("8340.00")
    assert safe.total_views_millions == joined.total_views_millions


def test_views_are_queryable_by_name(spark, tables):
    tables.register_views()
    assert spark.sql("SELECT count(*) AS n FROM campaign_daily_metrics").first().n == 15


SMALL_PARTS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "40",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def small_parts(spark):
    for key, value in SMALL_PARTS.items():
        spark.conf.set(key, value)
    yield
    for key in SMALL_PARTS:
        spark.conf.unset(key)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the campaigns has one creator and video, a third of the daily rows one campaign;
    1,000 more campaigns have many rows each, and some rows have no campaign."""
    n = F.col("id")
    campaigns = spark.range(30_000).select(
        n.alias("campaign_id"),
        F.when(n % 3 == 0, 1).when(n % 50 == 1, -1).otherwise(n % 500).alias("creator_id"),
        F.when(n % 3 == 0, 1).when(n % 50 == 2, -1).otherwise(n % 700).alias("video_id"),
        F.expr("date_add(DATE'2023-01-01', CAST(id % 300 AS INT))").alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.lit(100).cast("decimal(10,2)").alias("budget_usd"),
        F.lit("View").alias("campaign_type"),
    )
    creators = spark.range(500).select(
        n.alias("creator_id"), F.concat(F.lit("c"), n).alias("name"), F.lit("e").alias("email"),
        F.lit("2023-01-01").cast("date").alias("signup_date"), F.lit("Pro").alias("plan_type"),
        F.lit(True).alias("is_active"),
    )
    videos = spark.range(700).select(
        n.alias("video_id"), (n % 300).alias("creator_id"), F.lit("t").alias("title"),
        (n % 5).cast("string").alias("category"), F.lit("2023-01-01").cast("date").alias("upload_date"),
    )
    metrics = spark.range(300_000, numPartitions=16).select(
        n.alias("metric_id"),
        F.when(n % 3 == 0, 29_999).when(n % 20 == 1, None).when(n % 2 == 0, n % 1000).otherwise(n % 30_000)
        .alias("campaign_id"),
        F.expr("date_add(DATE'2023-06-01', CAST(id % 97 AS INT))").alias("metric_date"),
        *(F.lit(1).alias(c) for c in ("impressions", "clicks", "new_subscribers", "likes")),
        (n % 13).alias("views"),
        *((n % 11).cast("decimal(10,2)").alias(c) for c in ("spend_usd", "watch_time_mins")),
    )
    given = {"creators": creators, "videos": videos, "campaigns": campaigns, "campaign_daily_metrics": metrics}
    return CampaignTables(**{name: conform(df, name).cache() for name, df in given.items()})


SKEW_REPORTS = {
    "q04_top_campaigns_roas": {},
    "q06_churn_risk": {"as_of": sample.AS_OF},
    "q06a_churn_risk_placeholder": {"as_of": sample.AS_OF},
    "q11_top_creators_by_spend": {},
    "q13_organic_vs_promoted_uplift": {},
}


@pytest.mark.parametrize("name", SKEW_REPORTS)
def test_hot_keys_change_no_row(spark, skewed, small_parts, name):
    from __spark_entry__ import comparable

    df = comparable(getattr(plans, name)(skewed, **SKEW_REPORTS[name]))
    got = compare.spark_rows(df)
    bodies = compare.sample_bodies(sample.HOME, sample.AS_OF.isoformat())
    assert got == compare.duck_rows(duck_of(skewed), bodies[name], df.columns)


def test_in_flight_check_with_hot_keys(spark, skewed, small_parts):
    from __spark_entry__ import comparable

    df = comparable(quality.dq_metric_in_flight(skewed))
    bodies = compare.sample_bodies(sample.HOME, sample.AS_OF.isoformat())
    assert compare.spark_rows(df) == compare.duck_rows(duck_of(skewed), bodies["dq_metric_in_flight"], df.columns)


def duck_of(t):
    """DuckDB with the tables taken over as a whole: these have too many rows to insert."""
    import duckdb

    connection = duckdb.connect()
    for name, df in t.items():
        connection.register(f"{name}_arrow", df.toArrow())
        connection.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_arrow")
    return connection


def test_the_join_of_the_daily_rows_is_split(spark, skewed, small_parts):
    df = latest_campaign_views(skewed.creators, skewed.campaigns, skewed.campaign_daily_metrics)
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_names_are_joined_after_the_limit(skewed, small_parts):
    for name, column in (("q04_top_campaigns_roas", "creator_name"), ("q11_top_creators_by_spend", "plan_type")):
        plan = getattr(plans, name)(skewed)._jdf.queryExecution().optimizedPlan().toString()
        # a plan is printed from its end: what stands below the limit ran before it
        below = plan[plan.index("GlobalLimit") :]
        own = {"creator_name": "name#", "plan_type": "plan_type#"}[column]
        assert not any("Join Inner" in line and own in line for line in below.splitlines())
        assert "LeftSemi" in below


def test_unknown_creators_still_leave_k_rows(skewed):
    found = plans.q04_top_campaigns_roas(skewed, k=25).collect()
    assert len(found) == 25
    assert all(r.creator_name is not None for r in found)

import pytest

import compare
import sample
from promolens.operators import quality


@pytest.fixture(scope="module")
def broken(spark):
    """The sample with one more row per broken rule."""
    creators = sample.CREATORS + [
        (8, "Twin", "ada@example.com", None, None, "x" * 51, sample.d("2023-08-01"), "Gold", None, True),
        (None, None, None, None, None, None, None, None, None, None),
    ]
    campaigns = sample.CAMPAIGNS + [
        (110, 99, 11, sample.d("2024-01-01"), None, None, "Reach", None, "18-24", "Paused"),
        (111, 99, None, None, None, sample.usd("5.00"), "View", None, "13-17", "Done"),
    ]
    metrics = sample.METRICS + [
        (16, 101, None, 1, 1, 1, 1, 1, None, None),
        (16, 999, sample.d("2024-01-01"), 1, 1, 1, 1, 1, None, None),
    ]
    events = sample.EVENTS + [(7, 1, "party", None, "n" * 201)]
    return sample.tables(
        spark,
        creators=creators,
        campaigns=campaigns,
        campaign_daily_metrics=metrics,
        creator_events=events,
    )


def found(df):
    return {tuple(r) for r in df.collect()}


def test_clean_sample(tables):
    for check in (
        quality.dq_not_null,
        quality.dq_primary_key,
        quality.dq_unique_email,
        quality.dq_foreign_key,
        quality.dq_domain,
        quality.dq_varchar_length,
    ):
        assert found(check(tables)) == set(), check.__name__


def test_not_null(broken):
    assert found(quality.dq_not_null(broken)) == {
        ("creators", "creator_id", None),
        ("creators", "name", None),
        ("creators", "email", None),
        ("creators", "signup_date", None),
        ("creators", "plan_type", None),
        ("campaigns", "budget_usd", "110"),
        ("campaigns", "video_id", "111"),
        ("campaigns", "start_date", "111"),
        ("campaign_daily_metrics", "metric_date", "16"),
        ("creator_events", "event_date", "7"),
    }


def test_keys(broken):
    assert found(quality.dq_primary_key(broken)) == {
        ("creators", "creator_id", "8", 2),
        ("creators", "creator_id", None, 1),
        ("campaign_daily_metrics", "metric_id", "16", 2),
    }
    assert found(quality.dq_unique_email(broken)) == {("creators", "email", "ada@example.com", 2)}
    assert found(quality.dq_foreign_key(broken)) == {
        ("campaigns", "creator_id", "creators", 99, 2),
        ("campaign_daily_metrics", "campaign_id", "campaigns", 999, 1),
    }


def test_values(broken):
    assert found(quality.dq_domain(broken)) == {
        ("creators", "plan_type", "Gold", 1),
        ("campaigns", "campaign_type", "Reach", 1),
        ("campaigns", "target_age_group", "13-17", 1),
        ("campaigns", "status", "Done", 1),
        ("creator_events", "event_type", "party", 1),
    }
    assert found(quality.dq_varchar_length(broken)) == {
        ("creators", "city", "8", 51),
        ("creator_events", "notes", "7", 201),
    }


def test_metric_days_outside_the_flight(tables):
    days = {(r.campaign_id, str(r.metric_date), r.first_metric_id)
            for r in quality.dq_metric_in_flight(tables).collect()}
    assert days == {(102, "2023-05-30", 4), (104, "2023-03-25", 9)}


def test_checks_against_plain_sql(broken):
    from __spark_entry__ import comparable

    bodies = compare.sample_bodies(sample.HOME, sample.AS_OF.isoformat())
    duck = compare.connect(broken)
    for name in [n for n in bodies if n.startswith("dq_")]:
        df = comparable(getattr(quality, name)(broken))
        assert compare.spark_rows(df) == compare.duck_rows(duck, bodies[name], df.columns), name

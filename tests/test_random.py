"""Random tables with NULLs, unknown keys, ties and zeros: every report and check against SQL."""

import datetime as dt
import random
from decimal import Decimal

import pytest

import compare
import sample
from __spark_entry__ import comparable
from promolens import jobs


def random_tables(spark, seed):
    r = random.Random(seed)

    def maybe(value, share=0.05):
        return None if r.random() < share else value

    def day(first, span):
        return first + dt.timedelta(r.randrange(span))

    def cents(limit):
        return Decimal(r.randrange(limit)) / 100

    start = dt.date(2023, 1, 1)
    creators = [
        (
            i, f"name {i % 40}", f"{i % 55}@example.com", None, "India", maybe("x" * r.randrange(60)),
            day(start, 400), r.choice(["Free", "Starter", "Pro", "Agency", "Gold"]),
            maybe(cents(30000)), maybe(r.random() < 0.8),
        )
        for i in range(60)
    ]
    videos = [
        (
            i, r.randrange(65), f"title {i}", maybe(r.choice(["Art", "Food", "Music"])),
            maybe(day(start, 400)), 60, maybe(r.choice([0, 100, 1000, 5000])),
        )
        for i in range(50)
    ]
    # A third of the campaigns belong to one creator and one video.
    campaigns = []
    for i in range(200):
        hot = i % 3 == 0
        begin = day(start, 500)
        campaigns.append(
            (
                i, 7 if hot else maybe(r.randrange(65)), 7 if hot else maybe(r.randrange(55)),
                begin, maybe(begin + dt.timedelta(r.randrange(30)), 0.3),
                maybe(r.choice([Decimal("100.00"), Decimal("200.00"), cents(300000)])),
                maybe(r.choice(["View", "Subscriber"])), "India",
                maybe(r.choice(["18-24", "25-34", "99"])), "Active",
            )
        )
    metrics = []
    for i in range(1200):
        campaign = 9 if i % 3 == 0 else r.randrange(0, 210)
        begin = campaigns[campaign][3] if campaign < 200 else start
        metrics.append(
            (
                i, maybe(campaign, 0.02), maybe(begin + dt.timedelta(r.randrange(-3, 20)), 0.02),
                maybe(r.choice([0, 100, 1000, 1500])), maybe(r.choice([0, 10, 70, 100])),
                maybe(r.randrange(20)), maybe(r.choice([0, 0, 1, 5])), maybe(r.randrange(20)),
                maybe(r.choice([Decimal("0.00"), Decimal("1.00"), cents(2000)])),
                maybe(cents(50000)),
            )
        )
    benchmarks = [
        (
            i, r.choice([sample.HOME, "A", "B", None]), maybe(r.choice(["Art", "Food", "Music"])),
            maybe(cents(900)), maybe(cents(900)), cents(900), maybe(cents(500)), None, start,
        )
        for i in range(30)
    ]
    events = [
        (
            maybe(i - (i % 10 == 9)), r.randrange(65), r.choice(["churn", "signup", "odd"]),
            maybe(day(start, 500)), None,
        )
        for i in range(150)
    ]
    return sample.tables(
        spark,
        creators=creators,
        videos=videos,
        campaigns=campaigns,
        campaign_daily_metrics=metrics,
        competitor_benchmarks=benchmarks,
        creator_events=events,
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_everything_against_sql(spark, seed):
    tables = random_tables(spark, seed)
    duck = compare.connect(tables)
    bodies = compare.sample_bodies(sample.HOME, sample.AS_OF.isoformat())
    found = {name: report() for name, report in jobs.reports(tables, sample.AS_OF, sample.HOME).items()}
    found |= {check.__name__: check(tables) for check in jobs.CHECKS}
    for name, df in found.items():
        shown = comparable(df)
        expected = compare.duck_rows(duck, bodies[name], shown.columns)
        assert expected, name
        assert compare.spark_rows(shown) == expected, name

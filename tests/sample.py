"""Small hand-made campaign tables that hold the edge cases the reports have to get right."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import SparkSession

from promolens.schemas import SPECS
from promolens.sources.tables import CampaignTables

AS_OF = dt.date(2024, 6, 30)
HOME = "Northlight"


def d(text):
    return None if text is None else dt.date.fromisoformat(text)


def usd(text):
    return None if text is None else Decimal(text)


# 5 has two churn events, 6 is inactive without one, 7 and 8 never ran a campaign.
CREATORS = [
    (1, "Ada", "ada@example.com", "Music", "India", "Pune", d("2023-01-31"), "Pro", usd("149.00"), True),
    (2, "Bo", "bo@example.com", "Food", "India", "Delhi", d("2023-01-15"), "Free", usd("0.00"), True),
    (3, "Cy", "cy@example.com", "Food", "Nepal", None, d("2023-02-10"), "Agency", usd("299.00"), True),
    (4, "Di", "di@example.com", "Art", "India", "Agra", d("2023-02-28"), "Starter", usd("49.00"), True),
    (5, "Ed", "ed@example.com", "Art", "India", "Agra", d("2023-03-31"), "Starter", usd("49.00"), False),
    (6, "Flo", "flo@example.com", "Art", "India", "Goa", d("2023-05-05"), "Pro", usd("149.00"), False),
    (7, "Gus", "gus@example.com", None, "India", "Goa", d("2023-05-06"), "Pro", None, True),
    (8, "Hal", "hal@example.com", "Music", "India", "Goa", d("2023-07-01"), "Free", usd("0.00"), None),
]

# 13 has no organic views, 14's promoted views equal its baseline, 15 has no campaign.
VIDEOS = [
    (11, 1, "Scales", "Music", d("2023-01-31"), 300, 5000),
    (12, 2, "Soup", "Food", d("2023-02-01"), 400, 100000),
    (13, 3, "Bread", "Food", d("2023-02-11"), 500, 0),
    (14, 4, "Lines", "Art", d("2023-03-01"), 600, 1400),
    (15, 8, "Drums", "Music", d("2023-07-02"), 700, 900),
    (16, 5, "Clay", None, d("2023-04-02"), 800, None),
]

# Budgets sit exactly on the band limits. 108 has no metrics, 103 and 109 are open.
CAMPAIGNS = [
    (101, 1, 11, d("2023-02-28"), d("2023-03-30"), usd("100.00"), "View", "India", "18-24", "Completed"),
    (102, 1, 12, d("2023-06-01"), d("2023-06-30"), usd("99.99"), "Subscriber", "India", "18-24", "Completed"),
    (103, 2, 12, d("2023-04-15"), None, usd("200.00"), "View", "India", "25-34", "Active"),
    (104, 3, 13, d("2023-02-20"), d("2023-03-20"), usd("500.00"), "Engagement", "Nepal", "25-34", "Completed"),
    (105, 3, 13, d("2024-05-15"), d("2024-06-15"), usd("1000.00"), "Engagement", "Nepal", "35-44", "Paused"),
    (106, 4, 14, d("2023-03-28"), d("2023-04-28"), usd("2000.00"), "View", "India", "45+", "Completed"),
    (107, 5, 16, d("2023-06-30"), d("2023-07-30"), usd("199.99"), "Subscriber", "India", None, "Completed"),
    (108, 6, 14, d("2023-11-05"), d("2023-12-05"), usd("750.00"), "View", "India", "18-24", "Completed"),
    (109, 2, 11, d("2024-06-01"), None, usd("1999.99"), "Engagement", "India", "18-24", "Active"),
]

# Columns after the date: impressions, views, clicks, new_subscribers, likes, spend, watch minutes.
METRICS = [
    (1, 101, d("2023-02-28"), 10000, 1000, 400, 5, 100, usd("10.00"), usd("2500.00")),
    (2, 101, d("2023-03-07"), 20000, 1000, 300, 4, None, usd("10.50"), usd("2000.00")),
    (3, 101, d("2023-03-08"), 0, 500, 200, 3, 50, usd("5.25"), usd("900.00")),
    (4, 102, d("2023-05-30"), 9000, 900, 100, 0, 10, usd("0.00"), usd("1800.00")),
    (5, 102, d("2023-06-05"), 9000, 300, 100, 0, 10, usd("0.00"), usd("600.00")),
    (6, 102, d("2023-06-20"), 9000, 500, 100, 0, 10, usd("0.00"), usd("1000.00")),
    (7, 103, d("2023-04-20"), 50000, 2500, 900, 25, 200, usd("145.00"), usd("9000.25")),
    (8, 104, d("2023-02-21"), 30000, 6000, 2500, 60, 900, usd("400.00"), usd("20000.00")),
    (9, 104, d("2023-03-25"), 30000, 3000, 1500, 40, 600, usd("100.00"), usd("10000.00")),
    (10, 105, d("2024-05-16"), 7000, None, 0, 2, 0, usd("33.33"), None),
    (11, 105, d("2024-05-30"), 7000, 70, 10, 1, 5, None, usd("140.00")),
    (12, 106, d("2023-03-28"), 14000, 1400, 700, 0, 70, usd("20.00"), usd("2800.00")),
    (13, 107, d("2023-07-01"), 8000, 0, 0, 0, 0, usd("15.00"), usd("0.00")),
    (14, 109, d("2024-06-02"), 40000, 4000, 1600, 16, 320, usd("145.00"), usd("8000.00")),
    (15, 109, d("2024-06-09"), 30000, 3000, 1200, 12, 240, usd("100.00"), usd("6000.00")),
]

# The second Food rival has the same return on spend, the Music rival is cheaper but returns less.
BENCHMARKS = [
    (1, HOME, "Food", usd("3.00"), usd("8.00"), usd("2.00"), usd("4.00"), usd("20.0"), d("2024-01-01")),
    (2, "Rival A", "Food", usd("3.50"), usd("7.25"), usd("1.90"), usd("3.10"), usd("9.0"), d("2024-01-01")),
    (3, "Rival B", "Food", usd("3.10"), usd("8.50"), usd("1.80"), usd("4.00"), usd("8.0"), d("2024-01-01")),
    (4, HOME, "Music", usd("2.50"), usd("6.00"), usd("1.00"), usd("3.00"), usd("20.0"), d("2024-01-01")),
    (5, "Rival A", "Music", usd("2.40"), usd("6.00"), usd("1.10"), usd("2.95"), usd("9.0"), d("2024-01-01")),
    (6, "Rival A", "Art", usd("2.40"), usd("6.00"), usd("1.10"), usd("2.95"), usd("9.0"), d("2024-01-01")),
    (7, None, "Food", usd("2.40"), usd("6.00"), usd("1.10"), usd("2.95"), usd("9.0"), d("2024-01-01")),
]

EVENTS = [
    (1, 1, "signup", d("2023-01-31"), "organic"),
    (2, 5, "churn", d("2023-09-30"), "left again"),
    (3, 5, "churn", d("2023-08-30"), "left"),
    (4, 5, "reactivation", d("2023-09-02"), None),
    (5, 3, "upgrade", d("2023-06-01"), None),
    (6, 8, "churn", d("2023-08-02"), None),
]

ROWS = {
    "creators": CREATORS,
    "videos": VIDEOS,
    "campaigns": CAMPAIGNS,
    "campaign_daily_metrics": METRICS,
    "competitor_benchmarks": BENCHMARKS,
    "creator_events": EVENTS,
}


def tables(spark: SparkSession, **rows) -> CampaignTables:
    """The sample, with some tables' rows replaced by those given."""
    return CampaignTables(
        **{
            name: spark.createDataFrame(rows.get(name, ROWS[name]), spec.schema)
            for name, spec in SPECS.items()
        }
    )


def empty(spark: SparkSession) -> CampaignTables:
    return tables(spark, **{name: [] for name in SPECS})

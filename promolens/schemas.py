"""Declared shape of the six campaign tables.

Identifiers are read as BIGINT so that they keep their range on large data; every other
column has its declared type. Limits that Spark does not enforce on write (keys, NOT NULL,
string lengths, listed values) are kept here as data and checked by
``promolens.operators.quality``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(*columns) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in columns])


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_key: str


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: StructType
    primary_key: str
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)


_MONEY = DecimalType(10, 2)

CREATORS = TableSpec(
    name="creators",
    schema=_struct(
        ("creator_id", LongType()),
        ("name", StringType()),
        ("email", StringType()),
        ("channel_category", StringType()),
        ("country", StringType()),
        ("city", StringType()),
        ("signup_date", DateType()),
        ("plan_type", StringType()),
        ("monthly_revenue", _MONEY),
        ("is_active", BooleanType()),
    ),
    primary_key="creator_id",
    not_null=("creator_id", "name", "email", "signup_date", "plan_type"),
    unique=("email",),
    max_length={
        "name": 100,
        "email": 150,
        "channel_category": 50,
        "country": 50,
        "city": 50,
        "plan_type": 20,
    },
    # The documented subscription plans.
    domains={"plan_type": ("Free", "Starter", "Pro", "Agency")},
    defaults={"country": "India", "monthly_revenue": Decimal("0.00"), "is_active": True},
)

VIDEOS = TableSpec(
    name="videos",
    schema=_struct(
        ("video_id", LongType()),
        ("creator_id", LongType()),
        ("title", StringType()),
        ("category", StringType()),
        ("upload_date", DateType()),
        ("duration_seconds", IntegerType()),
        ("baseline_views", IntegerType()),
    ),
    primary_key="video_id",
    not_null=("video_id", "creator_id", "upload_date"),
    foreign_keys=(ForeignKey("creator_id", "creators", "creator_id"),),
    max_length={"title": 200, "category": 50},
    defaults={"baseline_views": 0},
)

CAMPAIGNS = TableSpec(
    name="campaigns",
    schema=_struct(
        ("campaign_id", LongType()),
        ("creator_id", LongType()),
        ("video_id", LongType()),
        ("start_date", DateType()),
        ("end_date", DateType()),
        ("budget_usd", _MONEY),
        ("campaign_type", StringType()),
        ("target_country", StringType()),
        ("target_age_group", StringType()),
        ("status", StringType()),
    ),
    primary_key="campaign_id",
    not_null=("campaign_id", "creator_id", "video_id", "start_date", "budget_usd"),
    foreign_keys=(
        ForeignKey("creator_id", "creators", "creator_id"),
        ForeignKey("video_id", "videos", "video_id"),
    ),
    max_length={
        "campaign_type": 30,
        "target_country": 50,
        "target_age_group": 20,
        "status": 20,
    },
    # The documented campaign goals, age brackets and states.
    domains={
        "campaign_type": ("View", "Subscriber", "Engagement"),
        "target_age_group": ("18-24", "25-34", "35-44", "45+"),
        "status": ("Active", "Completed", "Paused"),
    },
    defaults={"status": "Active"},
)

METRICS = TableSpec(
    name="campaign_daily_metrics",
    schema=_struct(
        ("metric_id", LongType()),
        ("campaign_id", LongType()),
        ("metric_date", DateType()),
        ("impressions", IntegerType()),
        ("views", IntegerType()),
        ("clicks", IntegerType()),
        ("new_subscribers", IntegerType()),
        ("likes", IntegerType()),
        ("spend_usd", _MONEY),
        ("watch_time_mins", _MONEY),
    ),
    primary_key="metric_id",
    not_null=("metric_id", "campaign_id", "metric_date"),
    foreign_keys=(ForeignKey("campaign_id", "campaigns", "campaign_id"),),
    defaults={
        "impressions": 0,
        "views": 0,
        "clicks": 0,
        "new_subscribers": 0,
        "likes": 0,
        "spend_usd": Decimal("0.00"),
        "watch_time_mins": Decimal("0.00"),
    },
)

BENCHMARKS = TableSpec(
    name="competitor_benchmarks",
    schema=_struct(
        ("bench_id", LongType()),
        ("competitor_name", StringType()),
        ("category", StringType()),
        ("avg_cpm_usd", DecimalType(8, 2)),
        ("avg_ctr_pct", DecimalType(5, 2)),
        ("avg_cvr_pct", DecimalType(5, 2)),
        ("avg_roas", DecimalType(6, 2)),
        ("market_share_pct", DecimalType(5, 2)),
        ("benchmark_month", DateType()),
    ),
    primary_key="bench_id",
    not_null=("bench_id",),
    max_length={"competitor_name": 100, "category": 50},
)

EVENTS = TableSpec(
    name="creator_events",
    schema=_struct(
        ("event_id", LongType()),
        ("creator_id", LongType()),
        ("event_type", StringType()),
        ("event_date", DateType()),
        ("notes", StringType()),
    ),
    primary_key="event_id",
    not_null=("event_id", "creator_id", "event_date"),
    foreign_keys=(ForeignKey("creator_id", "creators", "creator_id"),),
    max_length={"event_type": 50, "notes": 200},
    # The documented lifecycle events.
    domains={"event_type": ("signup", "first_campaign", "upgrade", "churn", "reactivation")},
)

SPECS: dict[str, TableSpec] = {
    spec.name: spec for spec in (CREATORS, VIDEOS, CAMPAIGNS, METRICS, BENCHMARKS, EVENTS)
}

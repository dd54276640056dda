"""Creator lifecycle: first activity, tenure and churn signals."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.functions import completed_months, percent, ratio, round_to, year_month
from promolens.operators.key_filter import only_keys_of


def first_campaigns(campaigns: DataFrame) -> DataFrame:
    """Date of each creator's first campaign."""
    return campaigns.groupBy("creator_id").agg(F.min("start_date").alias("first_start"))


def cohort_activation(
    creators: DataFrame,
    campaigns: DataFrame,
    months: Sequence[int] = (1, 2, 3, 6),
    shares: Sequence[int] = (1, 3),
) -> DataFrame:
    """Per signup month: creators who ran their first campaign within so many whole months.

    ``months`` are the counted limits, ``shares`` those that are also given in percent.
    """
    gap = completed_months(F.col("signup_date"), F.col("first_start"))

    def share(n: int) -> Column:
        return percent(F.col(f"retained_m{n}"), F.col("cohort_size"))

    return (
        creators.select("creator_id", "signup_date")
        .join(first_campaigns(campaigns), "creator_id", "left")
        .select(
            "creator_id", year_month(F.col("signup_date")).alias("cohort_month"), gap.alias("gap")
        )
        .groupBy("cohort_month")
        .agg(
            F.count("creator_id").alias("cohort_size"),
            *(F.count_if(F.col("gap") <= n).alias(f"retained_m{n}") for n in months),
        )
        .withColumns({f"pct_m{n}": share(n) for n in shares})
    )


def activation_days(creators: DataFrame, campaigns: DataFrame, by: str) -> DataFrame:
    """Days from signup to the first campaign, per ``by``; creators without one are left out."""
    days = F.datediff(F.col("first_start"), F.col("signup_date"))
    return (
        creators.join(first_campaigns(campaigns), "creator_id")
        .select(by, days.alias("days"))
        .groupBy(by)
        .agg(
            F.count("*").alias("creators"),
            round_to(ratio(F.sum("days"), F.count("days")), 0).alias("avg_days_to_activation"),
            F.min("days").alias("min_days"),
            F.max("days").alias("max_days"),
            round_to(F.stddev_pop("days"), 0).alias("stddev_days"),
        )
    )


def creator_tenure(creators: DataFrame, events: DataFrame, as_of: dt.date) -> DataFrame:
    """Creators with ``tenure_months``: to ``as_of`` if active, else to the first churn event.

    An inactive creator without a dated churn event has no tenure.
    """
    churned = (
        events.filter(F.col("event_type") == "churn")
        .groupBy("creator_id")
        .agg(F.min("event_date").alias("churn_date"))
    )
    end = F.when(F.col("is_active"), F.lit(as_of)).otherwise(F.col("churn_date"))
    return creators.join(churned, "creator_id", "left").withColumn(
        "tenure_months", completed_months(F.col("signup_date"), end)
    )


def tenure_ltv(creators: DataFrame, events: DataFrame, as_of: dt.date, by: str) -> DataFrame:
    """Average monthly revenue times average tenure, per ``by``."""
    mrr = ratio(F.sum("monthly_revenue"), F.count("monthly_revenue"))
    tenure = ratio(F.sum("tenure_months"), F.count("tenure_months"))
    return (
        creator_tenure(creators, events, as_of)
        .groupBy(by)
        .agg(
            F.count("*").alias("creator_count"),
            round_to(mrr, 2).alias("avg_monthly_revenue_usd"),
            round_to(tenure, 1).alias("avg_tenure_months"),
            round_to(mrr * tenure, 2).alias("estimated_ltv_usd"),
            round_to(mrr * 12, 2).alias("annualised_arpu_usd"),
        )
    )


@dataclass(frozen=True)
class RiskLabels:
    high: str = "HIGH"
    medium: str = "MEDIUM"
    low: str = "LOW"


def latest_campaigns(campaigns: DataFrame, as_row: bool = False) -> DataFrame:
    """Each creator's latest campaign: (creator_id, last_start, campaign_id).

    Start and id are the largest ones of the creator, each for itself, as the report defines them: they may come from
    different campaigns. With ``as_row`` they are those of one campaign, the last to start, of these
    the one with the largest id; campaigns without a start come first.
    """
    if not as_row:
        return campaigns.groupBy("creator_id").agg(
            F.max("start_date").alias("last_start"), F.max("campaign_id").alias("campaign_id")
        )
    row = F.max(F.struct("start_date", "campaign_id"))
    found = campaigns.where("campaign_id IS NOT NULL").groupBy("creator_id").agg(row.alias("latest"))
    return found.select(
        "creator_id", F.col("latest.start_date").alias("last_start"), F.col("latest.campaign_id").alias("campaign_id")
    )


def latest_campaign_views(
    creators: DataFrame, campaigns: DataFrame, metrics: DataFrame, week_days: int = 7, *, as_row: bool = False
) -> DataFrame:
    """Active creators with the start of their latest campaign and its views around that start.

    ``first_week_views`` are those from the start to ``week_days`` after it, ``early_views`` those
    from before the start, ``later_views`` the rest. Creators without a metric row are left out.
    ``as_row`` is that of ``latest_campaigns``.

    A bit array of the latest campaigns' ids drops the daily rows of other campaigns where they are read.
    The one join that takes the rest is followed by a regrouping, so adaptive execution may
    split a campaign that holds a large part of them.
    """
    starts = (
        creators.filter("is_active")
        .select("creator_id", "name", "plan_type", "monthly_revenue")
        .join(latest_campaigns(campaigns, as_row), "creator_id")
    )
    day, start = F.col("metric_date"), F.col("last_start")
    week_end = F.date_add(start, week_days)

    def views_if(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("views").cast("long")).otherwise(0))

    return (
        only_keys_of(metrics.select("campaign_id", "metric_date", "views"), starts, "campaign_id")
        .join(starts, "campaign_id")
        .groupBy("creator_id", "name", "plan_type", "monthly_revenue", "last_start")
        .agg(
            views_if(day < start).alias("early_views"),
            views_if(day.between(start, week_end)).alias("first_week_views"),
            views_if(day > week_end).alias("later_views"),
        )
    )


def churn_signals(
    latest_views: DataFrame,
    as_of: dt.date,
    *,
    from_start_only: bool = True,
    labels: RiskLabels = RiskLabels(),
    stale_after_days: int = 60,
    declining_below: Decimal = Decimal("0.7"),
) -> DataFrame:
    """The age and the view trend of each creator's latest campaign, from ``latest_campaign_views``.

    The trend is declining when the later views are below ``declining_below`` of those of the first
    week. With ``from_start_only=False`` views from before the start count as first-week views too.
    """
    first_week = F.col("first_week_views")
    if not from_start_only:
        first_week = first_week + F.col("early_views")
    days_since = F.datediff(F.lit(as_of), F.col("last_start"))
    stale = days_since > stale_after_days
    declining = F.col("later_views") < first_week * F.lit(declining_below)
    return latest_views.withColumns(
        {
            "first_week_views": first_week,
            "days_since_last": days_since,
            "view_trend": F.when(declining, "Declining").otherwise("Stable"),
            "churn_risk": F.when(stale & declining, labels.high)
            .when(stale, labels.medium)
            .otherwise(labels.low),
        }
    )

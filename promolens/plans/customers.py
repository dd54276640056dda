"""Creator value, churn risk and concentration."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.functions import money, ratio, round_to
from promolens.operators.lifecycle import RiskLabels, churn_signals, latest_campaign_views, tenure_ltv
from promolens.operators.ranking import concentration, contenders, top_k_ranked
from promolens.operators.rollup import delivered, kpi_rollup
from promolens.sources.tables import CampaignTables


def q05_ltv_by_plan(t: CampaignTables, as_of: dt.date) -> DataFrame:
    """Average revenue times average tenure, per plan."""
    per_plan = tenure_ltv(t.creators, t.creator_events, as_of, "plan_type")
    return per_plan.orderBy(F.desc("estimated_ltv_usd"), "plan_type")


def q06_churn_risk(t: CampaignTables, as_of: dt.date, as_row: bool = False) -> DataFrame:
    """Churn risk of active creators from their latest campaign, in no particular order.

    The latest start and the latest id are taken each for itself; with ``as_row`` both are those of one campaign.
    """
    views = t.latest_views
    if as_row:
        views = latest_campaign_views(t.creators, t.campaigns, t.campaign_daily_metrics, as_row=True)
    return churn_signals(views, as_of).select(
        "creator_id",
        "name",
        "plan_type",
        F.col("monthly_revenue").alias("mrr_usd"),
        "days_since_last",
        "view_trend",
        "churn_risk",
    )


def q06a_churn_risk_placeholder(t: CampaignTables, as_of: dt.date) -> DataFrame:
    """First form of the churn report: shows the views, and counts early ones as first week."""
    labels = RiskLabels("HIGH RISK", "MEDIUM RISK", "LOW RISK")
    signals = churn_signals(t.latest_views, as_of, from_start_only=False, labels=labels)
    return signals.select(
        "creator_id",
        "name",
        "plan_type",
        F.col("monthly_revenue").alias("mrr_usd"),
        F.col("days_since_last").alias("days_since_last_campaign"),
        "first_week_views",
        F.col("later_views").alias("latter_views"),
        "view_trend",
        "churn_risk",
    )


def q11_top_creators_by_spend(t: CampaignTables, k: int = 10) -> DataFrame:
    """The ``k`` highest-spending (creator, video category) pairs."""
    categories = t.videos.select("video_id", "category")
    placed = delivered(t.facts).join(categories, "video_id")
    # A creator has at most one row per category from here on.
    per_pair = kpi_rollup(placed, "creator_id", "category")
    lifetime = per_pair.select(
        "creator_id",
        F.col("category").alias("primary_category"),
        F.col("campaigns").alias("total_campaigns"),
        money(F.col("spend_usd")).alias("lifetime_spend_usd"),
        F.col("views").alias("lifetime_views"),
        F.col("new_subscribers").alias("lifetime_subscribers"),
        round_to(ratio(F.col("spend_usd"), F.col("campaigns")), 2).alias("avg_campaign_value_usd"),
    )
    ties = ("creator_id", "primary_category")
    # Creators are only known to exist until k pairs are left, which get name and plan.
    known = contenders(lifetime, k, "lifetime_spend_usd", [("creator_id", t.creators)])
    ranked = top_k_ranked(known, k, "lifetime_spend_usd", ties, "spend_rank")
    named = ranked.join(t.creators.select("creator_id", "name", "plan_type"), "creator_id")
    return named.select("creator_id", "name", "plan_type", *ranked.columns[1:]).orderBy("spend_rank", *ties)


def q14_revenue_concentration(t: CampaignTables, tiles: int = 5) -> DataFrame:
    """Share of spend by creator quintile, highest spenders first; equal spend goes by id."""
    spend = (
        kpi_rollup(delivered(t.facts), "creator_id")
        .join(t.creators.select("creator_id"), "creator_id")
        .select("creator_id", F.col("spend_usd").alias("total_spend"))
    )
    return concentration(spend, "creator_id", "total_spend", tiles).select(
        F.col("tile").alias("spend_quintile"),
        F.col("members").alias("creator_count"),
        money(F.col("total")).alias("quintile_spend"),
        F.col("share_pct").alias("pct_of_total_gmv"),
        "cumulative_pct",
    ).orderBy("spend_quintile")

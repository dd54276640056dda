"""Spend efficiency of campaigns, by category, type, age group, video and budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.functions import money, percent, ratio, round_to
from promolens.operators.benchmark import peer_benchmark
from promolens.operators.ranking import contenders, top_k
from promolens.operators.rollup import delivered, kpi_rollup
from promolens.sources.tables import CampaignTables

# Upper budget bounds (exclusive) in dollars and their labels.
BUDGET_BANDS = (
    (100, "Under $100"),
    (200, "$100–200"),
    (500, "$200–500"),
    (1000, "$500–1000"),
    (2000, "$1000–2000"),
)
TOP_BUDGET_BAND = "Above $2000"


def _per(numerator: str, denominator: str, digits: int, scale: float = 1.0) -> Column:
    return round_to(ratio(F.col(numerator), F.col(denominator), scale), digits)


def q02_roi_by_category(t: CampaignTables) -> DataFrame:
    """Spend, reach and cost per view for each video category."""
    # One row per video before the join, so a video with very many campaigns stays one row.
    per_video = kpi_rollup(delivered(t.facts), "video_id")
    categories = t.videos.select("video_id", "category")
    return (
        kpi_rollup(per_video.join(categories, "video_id"), "category")
        .select(
            "category",
            F.col("campaigns").alias("total_campaigns"),
            money(F.col("spend_usd")).alias("total_spend_usd"),
            F.col("views").alias("total_views"),
            F.col("new_subscribers").alias("total_subscribers"),
            _per("spend_usd", "views", 2, 1000).alias("cost_per_1000_views"),
            round_to(F.col("watch_time_mins").cast("double") / 60, 0).alias("total_watch_hours"),
            _per("vtr_sum", "vtr_rows", 2).alias("avg_vtr_pct"),
        )
        .orderBy(F.desc("total_views"), "category")
    )


def q04_top_campaigns_roas(
    t: CampaignTables, k: int = 10, value_per_view: float = 0.0005
) -> DataFrame:
    """The ``k`` campaigns with the best return on ad spend; equal returns go by campaign id."""
    value = F.col("views").cast("double") * value_per_view
    scored = delivered(t.facts).select(
        "campaign_id",
        "creator_id",
        "video_id",
        "campaign_type",
        money(F.col("spend_usd")).alias("total_spend_usd"),
        F.col("views").alias("total_views"),
        F.col("new_subscribers").alias("subscribers_gained"),
        round_to(value, 2).alias("estimated_value_usd"),
        round_to(ratio(value, F.col("spend_usd")), 2).alias("roas"),
        _per("spend_usd", "new_subscribers", 2).alias("cost_per_subscriber_usd"),
    )
    names = t.creators.select("creator_id", F.col("name").alias("creator_name"))
    categories = t.videos.select("video_id", "category")
    # Only the ids take part until k campaigns are left; names and categories are for these.
    known = contenders(scored, k, "roas", [("creator_id", names), ("video_id", categories)])
    order = (F.col("roas").desc_nulls_last(), F.col("campaign_id").asc())
    best = top_k(known, k, *order).join(names, "creator_id").join(categories, "video_id")
    return best.orderBy(*order).select(
        "campaign_id",
        "creator_name",
        "category",
        "campaign_type",
        "total_spend_usd",
        "total_views",
        "subscribers_gained",
        "estimated_value_usd",
        "roas",
        "cost_per_subscriber_usd",
    )


def _type_effectiveness(t: CampaignTables, average_budget: Column) -> DataFrame:
    return (
        kpi_rollup(delivered(t.facts), "campaign_type")
        .select(
            "campaign_type",
            F.col("campaigns").alias("num_campaigns"),
            average_budget.alias("avg_budget_usd"),
            money(F.col("spend_usd")).alias("total_spend_usd"),
            F.col("views").alias("total_views"),
            F.col("new_subscribers").alias("total_subscribers"),
            F.col("engagements").alias("total_engagements"),
            _per("spend_usd", "views", 3, 1000).alias("cpv_per_1000"),
            _per("spend_usd", "new_subscribers", 2).alias("cost_per_subscriber"),
            _per("spend_usd", "engagements", 2).alias("cost_per_engagement"),
        )
        .orderBy("cost_per_subscriber", "campaign_type")
    )


def q08_campaign_type_effectiveness(t: CampaignTables) -> DataFrame:
    """KPIs per campaign type; the average budget counts a campaign once per metric row."""
    return _type_effectiveness(t, _per("budget_by_row", "budget_rows", 2))


def q08_gs(t: CampaignTables) -> DataFrame:
    """KPIs per campaign type; the average budget counts every campaign once."""
    return _type_effectiveness(t, _per("budget_usd", "budget_campaigns", 2))


def q09_age_group_targeting(t: CampaignTables) -> DataFrame:
    """View-through, conversion and watch time per target age group."""
    return (
        kpi_rollup(delivered(t.facts), "target_age_group")
        .select(
            "target_age_group",
            "campaigns",
            F.col("impressions").alias("total_impressions"),
            F.col("views").alias("total_views"),
            F.col("new_subscribers").alias("subscribers"),
            percent(F.col("views"), F.col("impressions"), 2).alias("vtr_pct"),
            percent(F.col("new_subscribers"), F.col("views"), 2).alias("sub_cvr_pct"),
            _per("watch_time_mins", "views", 2).alias("avg_watch_min_per_view"),
        )
        .orderBy(F.desc("sub_cvr_pct"), "target_age_group")
    )


def q10_competitor_benchmark(
    t: CampaignTables, home: str, home_prefix: str = "home", match_month: bool = False
) -> DataFrame:
    """The home brand against each competitor, per category."""
    compared = peer_benchmark(t.competitor_benchmarks, home, home_prefix, match_month)
    return compared.orderBy(F.desc("roas_advantage"), "category", "competitor_name")


def q13_organic_vs_promoted_uplift(t: CampaignTables) -> DataFrame:
    """Promoted views of each video against its organic baseline."""
    per_video = kpi_rollup(delivered(t.facts), "video_id")
    names = t.creators.select("creator_id", F.col("name").alias("creator_name"))
    promoted = t.videos.join(per_video, "video_id").join(names, "creator_id")
    extra = F.col("views") - F.col("baseline_views")
    return promoted.select(
        "video_id",
        "title",
        "category",
        "creator_name",
        "baseline_views",
        F.col("views").alias("promoted_views"),
        percent(extra, F.col("baseline_views")).alias("view_uplift_pct"),
        F.col("new_subscribers").alias("subscribers_from_campaign"),
        money(F.col("spend_usd")).alias("total_spend_usd"),
        round_to(ratio(F.col("spend_usd"), extra, 1000), 2).alias(
            "cost_per_incremental_1000_views"
        ),
    )


def _budget_band(budget: Column) -> Column:
    (bound, label), *higher = BUDGET_BANDS
    band = F.when(budget < bound, label)
    for bound, label in higher:
        band = band.when(budget < bound, label)
    return band.otherwise(TOP_BUDGET_BAND)


def _sweet_spot(t: CampaignTables, average_budget: Column) -> DataFrame:
    banded = delivered(t.facts).withColumn("budget_bucket", _budget_band(F.col("budget_usd")))
    return (
        kpi_rollup(banded, "budget_bucket")
        .select(
            "budget_bucket",
            "campaigns",
            average_budget.alias("avg_budget_usd"),
            _per("spend_usd", "views", 3, 1000).alias("cost_per_1000_views"),
            _per("spend_usd", "new_subscribers", 2).alias("cost_per_subscriber"),
            _per("vtr_sum", "vtr_rows", 2).alias("avg_vtr_pct"),
        )
        .orderBy("cost_per_1000_views", "budget_bucket")
    )


def q15_budget_sweet_spot(t: CampaignTables) -> DataFrame:
    """Cost per view by budget band; the average budget counts a campaign once per metric row."""
    return _sweet_spot(t, _per("budget_by_row", "budget_rows", 2))


def q15_gs(t: CampaignTables) -> DataFrame:
    """Cost per view by budget band; the average budget counts every campaign once."""
    return _sweet_spot(t, _per("budget_usd", "budget_campaigns", 2))

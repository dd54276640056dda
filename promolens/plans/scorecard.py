"""One-row platform summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.functions import money, percent, ratio, round_to
from promolens.operators.rollup import one_row
from promolens.sources.tables import CampaignTables


def _scorecard(totals: DataFrame, average_mrr: Column) -> DataFrame:
    return totals.select(
        "total_creators",
        "active_creators",
        percent(F.col("active_creators"), F.col("total_creators")).alias("active_rate_pct"),
        "total_campaigns",
        money(F.col("budget")).alias("total_platform_gmv_usd"),
        round_to(F.col("views").cast("double") / 1000000, 2).alias("total_views_millions"),
        F.col("subscribers").alias("total_subscribers_delivered"),
        round_to(ratio(F.col("spend"), F.col("views"), 1000), 3).alias("blended_cpv"),
        round_to(ratio(F.col("spend"), F.col("subscribers")), 2).alias(
            "blended_cost_per_subscriber"
        ),
        round_to(average_mrr, 2).alias("avg_mrr_per_creator_usd"),
        money(F.col("mrr") * 12).alias("annualised_platform_revenue_usd"),
    )


def q16_health_scorecard(t: CampaignTables) -> DataFrame:
    """Scorecard with the weights of a plain join of creators, campaigns and daily metrics.

    In that join a campaign's budget counts once per metric row and a creator once per joined
    row. ``copies`` holds these row counts, so the joined rows are never built.
    """
    per_creator = (
        t.facts.withColumn("copies", F.coalesce("metric_rows", F.lit(1)))
        .groupBy("creator_id")
        .agg(
            F.count("campaign_id").alias("campaigns"),
            F.sum("copies").alias("copies"),
            F.sum(F.col("budget_usd") * F.col("copies")).alias("budget"),
            F.sum("views").alias("views"),
            F.sum("new_subscribers").alias("subscribers"),
            F.sum("spend_usd").alias("spend"),
        )
    )
    copies = F.coalesce("copies", F.lit(1))
    mrr = F.col("monthly_revenue")
    totals = t.creators.join(per_creator, "creator_id", "left").agg(
        F.count("creator_id").alias("total_creators"),
        F.sum(F.when(F.col("is_active"), copies).otherwise(0)).alias("active_creators"),
        F.coalesce(F.sum("campaigns"), F.lit(0)).alias("total_campaigns"),
        F.sum("budget").alias("budget"),
        F.sum("views").alias("views"),
        F.sum("subscribers").alias("subscribers"),
        F.sum("spend").alias("spend"),
        F.sum(mrr * copies).alias("mrr"),
        F.sum(F.when(mrr.isNotNull(), copies)).alias("mrr_copies"),
    )
    return _scorecard(totals, ratio(F.col("mrr"), F.col("mrr_copies")))


def q16_gs(t: CampaignTables) -> DataFrame:
    """Scorecard that counts every creator, campaign and metric row once."""
    creators = t.creators.agg(
        F.count("creator_id").alias("total_creators"),
        F.count_if("is_active").alias("active_creators"),
        F.sum("monthly_revenue").alias("mrr"),
        F.count("monthly_revenue").alias("mrr_creators"),
    )
    campaigns = t.campaigns.agg(
        F.count("campaign_id").alias("total_campaigns"), F.sum("budget_usd").alias("budget")
    )
    delivered = t.totals.agg(
        F.sum("views").alias("views"),
        F.sum("new_subscribers").alias("subscribers"),
        F.sum("spend_usd").alias("spend"),
    )
    totals = one_row(creators, campaigns, delivered)
    return _scorecard(totals, ratio(F.col("mrr"), F.col("mrr_creators")))

"""Campaign rollups: the daily fact is summed once per campaign, before any join."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.functions import ratio

# Measures that may be summed again at any coarser grain.
ADDITIVE = (
    "campaigns",
    "metric_rows",
    "impressions",
    "views",
    "clicks",
    "new_subscribers",
    "likes",
    "engagements",
    "spend_usd",
    "watch_time_mins",
    "vtr_sum",
    "vtr_rows",
    "budget_usd",
    "budget_campaigns",
    "budget_by_row",
    "budget_rows",
)


def _exact_sum(column: str) -> Column:
    """Sum of a DECIMAL(10,2) column per campaign, added up as whole hundredths.

    A DECIMAL(20,2) sum needs a wide buffer in every row of the hash map and of the shuffle; a
    BIGINT gives the same exact total in about three quarters of the time.
    """
    hundredths = F.sum((F.col(column) * 100).cast("long"))
    return (hundredths.cast("decimal(20,0)") * Decimal("0.01")).cast("decimal(20,2)").alias(column)


def campaign_totals(metrics: DataFrame) -> DataFrame:
    """One row per campaign. Unused sums are pruned by the optimizer, down to the scan.

    The sums combine map-side, so a campaign that holds a large part of all rows reaches the
    shuffle as one row per map task.
    """
    daily_vtr = ratio(F.col("views"), F.col("impressions"), 100)
    return metrics.groupBy("campaign_id").agg(
        F.count("*").alias("metric_rows"),
        F.sum("impressions").alias("impressions"),
        F.sum("views").alias("views"),
        F.sum("clicks").alias("clicks"),
        F.sum("new_subscribers").alias("new_subscribers"),
        F.sum("likes").alias("likes"),
        F.sum(F.col("likes").cast("long") + F.col("clicks")).alias("engagements"),
        _exact_sum("spend_usd"),
        _exact_sum("watch_time_mins"),
        F.sum(daily_vtr).alias("vtr_sum"),
        F.count(daily_vtr).alias("vtr_rows"),
    )


def campaign_facts(campaigns: DataFrame, totals: DataFrame) -> DataFrame:
    """Every campaign with its totals, one row each; the totals are NULL if it has no metrics.

    ``budget_by_row`` and ``budget_rows`` carry the budget as often as the campaign has metric
    rows: that is the weight a plain join with the daily table gives it.
    """
    has_budget = F.col("budget_usd").isNotNull()
    return campaigns.join(totals, "campaign_id", "left").withColumns(
        {
            "campaigns": F.lit(1).cast("long"),
            "budget_campaigns": has_budget.cast("long"),
            "budget_by_row": F.col("budget_usd") * F.col("metric_rows"),
            "budget_rows": F.when(has_budget, F.col("metric_rows")).otherwise(0),
        }
    )


def delivered(facts: DataFrame) -> DataFrame:
    """The campaigns that have metrics. On facts that are not stored this is an inner join."""
    return facts.filter(F.col("metric_rows").isNotNull())


def kpi_rollup(facts: DataFrame, *by: str) -> DataFrame:
    """Sum every additive measure per ``by``; takes campaign facts or a finer rollup of them."""
    return facts.groupBy(*by).agg(*(F.sum(name).alias(name) for name in ADDITIVE))


def one_row(*frames: DataFrame) -> DataFrame:
    """Put the columns of several one-row frames into one row."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*(F.max(name).alias(name) for name in stacked.columns))

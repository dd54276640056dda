"""Signup, activation and growth reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.functions import money, ratio, round_to, year_month
from promolens.operators.funnel import funnel
from promolens.operators.lifecycle import activation_days, cohort_activation
from promolens.operators.trends import period_growth, previous
from promolens.sources.tables import CampaignTables


def q01_acquisition_funnel(
    t: CampaignTables, upgraded_plans: Sequence[str] = ("Pro", "Agency")
) -> DataFrame:
    """Creators per stage: signed up, ran a campaign, ran a second one, on an upgraded plan."""
    signups = t.creators.agg(
        F.count("creator_id").alias("total_signups"),
        F.count_if(F.col("plan_type").isin(*upgraded_plans)).alias("upgraded_plan"),
    )
    per_creator = (
        t.campaigns.filter(F.col("creator_id").isNotNull())
        .groupBy("creator_id")
        .agg(F.count("campaign_id").alias("n"))
    )
    activity = per_creator.agg(
        F.count("*").alias("ran_one_campaign"),
        F.count_if(F.col("n") >= 2).alias("ran_multiple_campaigns"),
    )

    return funnel(
        [signups, activity],
        first="total_signups",
        shares={
            "ran_one_campaign": "pct_activated",
            "ran_multiple_campaigns": "pct_repeat",
            "upgraded_plan": "pct_upgraded",
        },
    )


def q03_cohort_activation(t: CampaignTables) -> DataFrame:
    """Per signup month: creators whose first campaign came within 1, 2, 3 and 6 months."""
    return cohort_activation(t.creators, t.campaigns).orderBy("cohort_month")


def q07_monthly_growth(t: CampaignTables) -> DataFrame:
    """Signups, campaigns and booked budget per signup month, with change on the month before.

    Months without a signup have no row, and "before" is the preceding row.
    """
    signups = t.creators.groupBy(year_month(F.col("signup_date")).alias("month")).agg(
        F.count("*").alias("new_creators")
    )
    launched = t.campaigns.groupBy(year_month(F.col("start_date")).alias("month")).agg(
        F.count("*").alias("new_campaigns"),
        money(F.sum("budget_usd")).alias("gmv_usd"),
    )
    months = (
        signups.join(launched, "month", "left")
        .withColumn("arpu_usd", round_to(ratio(F.col("gmv_usd"), F.col("new_creators")), 2))
        .withColumn("prev_signups", previous("new_creators", "month"))
    )
    changes = {"new_creators": "signup_growth_pct", "gmv_usd": "gmv_growth_pct"}
    return period_growth(months, "month", changes).orderBy("month")


def q12_time_to_first_campaign(t: CampaignTables) -> DataFrame:
    """Days from signup to the first campaign, per plan."""
    per_plan = activation_days(t.creators, t.campaigns, "plan_type")
    return per_plan.orderBy("avg_days_to_activation", "plan_type")

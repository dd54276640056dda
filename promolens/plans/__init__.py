"""The reports: each takes the campaign tables and returns one DataFrame."""

from promolens.plans.acquisition import (
    q01_acquisition_funnel,
    q03_cohort_activation,
    q07_monthly_growth,
    q12_time_to_first_campaign,
)
from promolens.plans.customers import (
    q05_ltv_by_plan,
    q06_churn_risk,
    q06a_churn_risk_placeholder,
    q11_top_creators_by_spend,
    q14_revenue_concentration,
)
from promolens.plans.performance import (
    q02_roi_by_category,
    q04_top_campaigns_roas,
    q08_campaign_type_effectiveness,
    q08_gs,
    q09_age_group_targeting,
    q10_competitor_benchmark,
    q13_organic_vs_promoted_uplift,
    q15_budget_sweet_spot,
    q15_gs,
)
from promolens.plans.scorecard import q16_gs, q16_health_scorecard

__all__ = [
    "q01_acquisition_funnel",
    "q02_roi_by_category",
    "q03_cohort_activation",
    "q04_top_campaigns_roas",
    "q05_ltv_by_plan",
    "q06_churn_risk",
    "q06a_churn_risk_placeholder",
    "q07_monthly_growth",
    "q08_campaign_type_effectiveness",
    "q08_gs",
    "q09_age_group_targeting",
    "q10_competitor_benchmark",
    "q11_top_creators_by_spend",
    "q12_time_to_first_campaign",
    "q13_organic_vs_promoted_uplift",
    "q14_revenue_concentration",
    "q15_budget_sweet_spot",
    "q15_gs",
    "q16_gs",
    "q16_health_scorecard",
]

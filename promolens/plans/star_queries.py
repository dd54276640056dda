"""Every report, ingest and check, bound to the star-schema tables of a folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens import plans
from promolens.operators import quality
from promolens.operators.keys import one_row_per_key
from promolens.schemas import METRICS, SPECS
from promolens.sources import batches
from promolens.sources.scratch import scratch_folder
from promolens.sources.star import HOME_BRAND, UPGRADED_PLANS, StarTables
from promolens.sources.tables import CampaignTables

TENURE_AS_OF = dt.date(2024, 2, 1)
CHURN_AS_OF = dt.date(2001, 8, 15)

Query = Callable[[SparkSession, str], DataFrame]


def _on(
    report: Callable[..., DataFrame], *names: str, dated: bool = False, by_campaign: bool = False, **options
) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return report(StarTables(spark, folder).tables(*names, dated=dated, by_campaign=by_campaign), **options)

    return run


def _ingest(name: str) -> Query:
    def report(t: CampaignTables) -> DataFrame:
        return getattr(t, name)

    return _on(report, name, dated=name == _ME)


def _one_row(spark: SparkSession, folder: str) -> DataFrame:
    """The daily rows with one row for each metric id, which line items repeat."""
    return one_row_per_key(StarTables(spark, folder).campaign_daily_metrics(dated=False), METRICS.primary_key)


def _by_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Campaign totals kept up by four loads, one of them made twice, the first two folded to one."""
    metrics = StarTables(spark, folder).campaign_daily_metrics(dated=False)
    loads, folded = scratch_folder(spark, "totals"), scratch_folder(spark, "totals")
    for batch in (0, 1, 2, 1, 3):
        batches.add_batch(metrics.where(F.pmod(F.col("metric_id"), F.lit(4)) == batch), loads, f"load-{batch}")
    batches.fold_batches(spark, loads, folded, ["load-0", "load-1"], "past")
    return batches.batch_totals(spark, folded).drop("vtr_sum")


_CR, _VI, _CA, _ME = "creators", "videos", "campaigns", "campaign_daily_metrics"
_BE, _EV = "competitor_benchmarks", "creator_events"

REPORTS: dict[str, Query] = {
    "q01_acquisition_funnel": _on(
        plans.q01_acquisition_funnel, _CR, _CA, upgraded_plans=UPGRADED_PLANS
    ),
    "q02_roi_by_category": _on(plans.q02_roi_by_category, _VI, _CA, _ME),
    "q03_cohort_activation": _on(plans.q03_cohort_activation, _CR, _CA),
    "q04_top_campaigns_roas": _on(plans.q04_top_campaigns_roas, _CR, _VI, _CA, _ME),
    "q05_ltv_by_plan": _on(plans.q05_ltv_by_plan, _CR, _EV, as_of=TENURE_AS_OF),
    "q06_churn_risk": _on(plans.q06_churn_risk, _CR, _CA, _ME, dated=True, as_of=CHURN_AS_OF),
    "q06a_churn_risk_placeholder": _on(
        plans.q06a_churn_risk_placeholder, _CR, _CA, _ME, dated=True, as_of=CHURN_AS_OF
    ),
    "q06_latest_as_row": _on(plans.q06_churn_risk, _CR, _CA, _ME, dated=True, as_of=CHURN_AS_OF, as_row=True),
    "q07_monthly_growth": _on(plans.q07_monthly_growth, _CR, _CA),
    "q08_campaign_type_effectiveness": _on(plans.q08_campaign_type_effectiveness, _CA, _ME),
    "q08_gs": _on(plans.q08_gs, _CA, _ME),
    "q09_age_group_targeting": _on(plans.q09_age_group_targeting, _CA, _ME),
    "q10_competitor_benchmark": _on(plans.q10_competitor_benchmark, _BE, home=HOME_BRAND),
    "q11_top_creators_by_spend": _on(plans.q11_top_creators_by_spend, _CR, _VI, _CA, _ME),
    "q12_time_to_first_campaign": _on(plans.q12_time_to_first_campaign, _CR, _CA),
    "q13_organic_vs_promoted_uplift": _on(
        plans.q13_organic_vs_promoted_uplift, _CR, _VI, _CA, _ME
    ),
    "q14_revenue_concentration": _on(plans.q14_revenue_concentration, _CR, _CA, _ME),
    "q15_budget_sweet_spot": _on(plans.q15_budget_sweet_spot, _CA, _ME),
    "q15_gs": _on(plans.q15_gs, _CA, _ME),
    "q16_health_scorecard": _on(plans.q16_health_scorecard, _CR, _CA, _ME),
    "q16_gs": _on(plans.q16_gs, _CR, _CA, _ME),
}

INGEST: dict[str, Query] = {f"ingest_{name}": _ingest(name) for name in SPECS}

CHECKS: dict[str, Query] = {
    "dq_not_null": _on(quality.dq_not_null, dated=True),
    "dq_primary_key": _on(quality.dq_primary_key),
    "dq_unique_email": _on(quality.dq_unique_email, _CR),
    "dq_foreign_key": _on(quality.dq_foreign_key, _CR, _VI, _CA, _ME, _EV),
    "dq_domain": _on(quality.dq_domain, _CR, _VI, _CA, _EV),
    "dq_varchar_length": _on(quality.dq_varchar_length, _CR, _VI, _CA, _BE, _EV),
    "dq_metric_in_flight": _on(quality.dq_metric_in_flight, _CA, _ME, dated=True, by_campaign=True),
}

KEPT: dict[str, Query] = {"one_row_per_metric_id": _one_row, "campaign_totals_by_batch": _by_batch}

QUERIES: dict[str, Query] = {**REPORTS, **INGEST, **CHECKS, **KEPT}

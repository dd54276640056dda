"""Campaign totals kept up by batches."""

import random

import pytest

import compare
import sample
from promolens import jobs
from promolens.operators.rollup import campaign_totals
from promolens.sources import batches

SUMS = ("metric_rows impressions views clicks new_subscribers likes engagements spend_usd watch_time_mins vtr_rows").split()


def daily(spark, rows):
    return sample.tables(spark, campaign_daily_metrics=rows).campaign_daily_metrics


def exact(df):
    return compare.spark_rows(df.select("campaign_id", *SUMS))


@pytest.fixture(scope="module")
def loads():
    r = random.Random(5)
    rows = [
        (i, r.choice([1, 2, 3, 4, None]), sample.AS_OF, r.randrange(1000), r.choice([None, 5, 70]), 1, 1, r.choice([None, 3]),
         sample.usd(f"{r.randrange(9999)}.{r.randrange(10, 99)}"), None)
        for i in range(300)
    ]
    return [rows[i::5] for i in range(5)]


def test_totals_equal_a_recount(spark, loads, tmp_path):
    folder = str(tmp_path / "totals")
    for day, rows in enumerate(loads):
        batches.add_batch(daily(spark, rows), folder, f"2024-06-0{day}")
        if day in (0, 3):  # loaded twice, the first time with other rows
            batches.add_batch(daily(spark, rows[:7]), folder, f"2024-06-0{day}")
            batches.add_batch(daily(spark, rows), folder, f"2024-06-0{day}")
    whole = campaign_totals(daily(spark, sum(loads, [])))
    kept = batches.batch_totals(spark, folder)
    assert kept.columns == whole.columns
    assert dict(kept.dtypes) == dict(whole.dtypes)
    assert exact(kept) == exact(whole)
    shares = {r.campaign_id: r.vtr_sum for r in whole.collect()}
    for r in kept.collect():
        assert r.vtr_sum == pytest.approx(shares[r.campaign_id], rel=1e-12)


def test_folded_batches_count_once(spark, loads, tmp_path):
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    for day, rows in enumerate(loads[:4]):
        batches.add_batch(daily(spark, rows), first, f"0{day}")
    batches.fold_batches(spark, first, second, ["00", "01"], "past")
    assert exact(batches.batch_totals(spark, second)) == exact(batches.batch_totals(spark, first))
    batches.add_batch(daily(spark, loads[4]), second, "04")
    batches.add_batch(daily(spark, loads[3]), second, "03")
    assert exact(batches.batch_totals(spark, second)) == exact(campaign_totals(daily(spark, sum(loads, []))))
    with pytest.raises(ValueError, match="no batch 00"):
        batches.fold_batches(spark, second, str(tmp_path / "third"), ["00"], "older")
    with pytest.raises(ValueError, match="another batch"):
        batches.fold_batches(spark, second, str(tmp_path / "third"), ["02"], "04")


def test_reports_on_kept_totals(spark, tables, tmp_path):
    """Reports from totals that two loads made equal those from the daily rows."""
    from dataclasses import replace

    folder = str(tmp_path / "totals")
    metrics = tables.campaign_daily_metrics
    batches.add_batch(metrics.where("metric_id <= 7"), folder, "a")
    batches.add_batch(metrics.where("metric_id > 7"), folder, "b")
    kept = replace(tables, stored_totals=batches.batch_totals(spark, folder))
    for name, report in jobs.reports(tables, sample.AS_OF, sample.HOME).items():
        shown = jobs.reports(kept, sample.AS_OF, sample.HOME)[name]()
        assert compare.spark_rows(shown) == compare.spark_rows(report()), name


def test_no_batch_and_empty_batches(spark, tmp_path):
    folder = str(tmp_path / "totals")
    batches.add_batch(daily(spark, []), folder, "empty")
    assert batches.batch_totals(spark, folder).count() == 0
    with pytest.raises(ValueError, match="batch"):
        batches.add_batch(daily(spark, []), folder, "a/b")

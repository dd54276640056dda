import csv

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

import compare
import sample
from promolens import jobs, plans
from promolens.operators.rollup import campaign_facts, campaign_totals, kpi_rollup
from promolens.schemas import SPECS
from promolens.sources import CampaignTables, conform, read_table, write_bucketed, write_table


READ_ERRORS = (PySparkException, Py4JJavaError)


def types(of):
    return [(f.name, f.dataType) for f in of.schema]


def write_csv(path, header, rows):
    path.mkdir()
    with open(path / "part.csv", "w", newline="", encoding="utf-8") as out:
        csv.writer(out).writerows([header, *rows])
    return str(path)


def test_missing_columns_get_defaults_and_nulls_stay(spark, tmp_path):
    header = ["creator_id", "name", "email", "signup_date", "plan_type", "monthly_revenue"]
    rows = [(1, "Ada", "a@x", "2023-01-31", "Pro", "149.00"), (2, "Bo", "b@x", "2023-01-15", "Free", "")]
    path = write_csv(tmp_path / "creators", header, rows)
    df = read_table(spark, "creators", path, "csv", columns=header)
    assert types(df) == types(SPECS["creators"])
    got = {r.creator_id: r for r in df.collect()}
    assert (got[1].country, got[1].is_active, got[1].city) == ("India", True, None)
    assert got[1].monthly_revenue == sample.usd("149.00")
    assert got[2].monthly_revenue is None


def test_csv_with_a_bad_value_or_header_fails(spark, tmp_path):
    names = SPECS["creator_events"].schema.fieldNames()
    bad_value = write_csv(tmp_path / "v", names, [(1, "one", "churn", "2023-01-01", "")])
    with pytest.raises(READ_ERRORS, match="FAILED_READ_FILE|MALFORMED"):
        read_table(spark, "creator_events", bad_value, "csv").collect()
    swapped = [names[1], names[0], *names[2:]]
    bad_header = write_csv(tmp_path / "h", swapped, [(1, 2, "churn", "2023-01-01", "")])
    with pytest.raises(READ_ERRORS, match="header"):
        read_table(spark, "creator_events", bad_header, "csv").collect()


def test_stored_tables_come_back_unchanged(spark, tables, tmp_path):
    for name, df in tables.items():
        write_table(df, name, f"{tmp_path}/{name}")
    loaded = CampaignTables.load(spark, str(tmp_path))
    for name, df in tables.items():
        again = getattr(loaded, name)
        assert types(again) == types(SPECS[name])
        assert compare.spark_rows(again) == compare.spark_rows(df)


def test_conform_drops_unknown_columns(spark):
    df = spark.createDataFrame(
        [(1, 5, "2023-01-31", "x")], "video_id int, creator_id int, upload_date string, extra string"
    )
    row = conform(df, "videos").first()
    assert (row.video_id, row.baseline_views, row.title) == (1, 0, None)
    assert "extra" not in row


def test_bucketed_tables_join_without_a_shuffle(spark, tables):
    write_bucketed(tables.campaigns, "campaigns", 4, "bucketed_campaigns")
    write_bucketed(tables.campaign_daily_metrics, "campaign_daily_metrics", 4, "bucketed_metrics")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        totals = campaign_totals(spark.table("bucketed_metrics"))
        facts = campaign_facts(spark.table("bucketed_campaigns"), totals)
        plan = facts._jdf.queryExecution().executedPlan().toString()
        by_type = compare.spark_rows(kpi_rollup(facts, "campaign_type"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_campaigns")
        spark.sql("DROP TABLE bucketed_metrics")
    assert "Exchange" not in plan
    plain = campaign_facts(tables.campaigns, campaign_totals(tables.campaign_daily_metrics))
    assert by_type == compare.spark_rows(kpi_rollup(plain, "campaign_type"))


def test_ingest_and_report_jobs(spark, tables, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for name, df in tables.items():
        df.write.option("header", True).csv(str(raw / name))
    jobs.ingest(spark, str(raw), str(tmp_path / "typed"), "csv")
    late = spark.read.parquet(str(tmp_path / "typed/_quality/dq_metric_in_flight"))
    assert late.count() == 2
    again = jobs.ingest(spark, str(raw), str(tmp_path / "typed"), "csv")
    for _ in range(2):  # a second run replaces the first
        jobs.write_reports(spark, again, str(tmp_path / "out"), sample.AS_OF, sample.HOME)
    for name, report in jobs.reports(tables, sample.AS_OF, sample.HOME).items():
        written = spark.read.parquet(str(tmp_path / "out" / name))
        assert compare.spark_rows(written) == compare.spark_rows(report()), name


def test_reports_read_the_daily_rows_twice(spark, tables, tmp_path, monkeypatch):
    for name, df in tables.items():
        write_table(df, name, f"{tmp_path}/typed/{name}")
    loaded = CampaignTables.load(spark, f"{tmp_path}/typed")
    shared = loaded.stored(spark, f"{tmp_path}/shared")
    for name, report in jobs.reports(shared, sample.AS_OF, sample.HOME).items():
        plan = report()._jdf.queryExecution().optimizedPlan().toString()
        assert "watch_time_mins" not in plan or "metric_id" not in plan
        files = report().inputFiles()
        assert not any("typed/campaign_daily_metrics" in f for f in files), name
    reads = [df for df in (loaded.totals, loaded.latest_views)]
    assert all(any("campaign_daily_metrics" in f for f in df.inputFiles()) for df in reads)


def test_a_required_column_must_be_there(spark):
    df = spark.createDataFrame([(1, 5, "x")], "campaign int, creator_id int, status string")
    with pytest.raises(ValueError, match="campaigns has no column budget_usd, campaign_id"):
        conform(df, "campaigns")


@pytest.mark.parametrize("table, row", [("creators", sample.CREATORS[0]), ("campaigns", sample.CAMPAIGNS[0]), ("videos", sample.VIDEOS[0])])
def test_repeated_keys_are_refused(spark, tmp_path, table, row):
    rows = {"creators": sample.CREATORS, "campaigns": sample.CAMPAIGNS, "videos": sample.VIDEOS}[table]
    t = sample.tables(spark, **{table: [*rows, row]})
    with pytest.raises(jobs.RepeatedKeys, match=f"{table}.*= {row[0]} .2 rows"):
        jobs.write_reports(spark, t, str(tmp_path / "out"), sample.AS_OF, sample.HOME)
    for name, df in t.items():
        df.write.parquet(f"{tmp_path}/raw/{name}")
    with pytest.raises(jobs.RepeatedKeys, match=table):
        jobs.ingest(spark, f"{tmp_path}/raw", f"{tmp_path}/typed")


def way_to(node, leaf):
    """The nodes of a plan from its root to the scan that names ``leaf``, as text."""
    if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        return way_to(node.initialPlan(), leaf)
    children = node.children()
    if children.isEmpty():
        return [node.simpleString(1000)] if leaf in node.simpleString(1000) else None
    for i in range(children.size()):
        if found := way_to(children.apply(i), leaf):
            return [node.simpleString(1000), *found]
    return None


def test_reports_from_bucketed_tables(spark, tables, tmp_path):
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/raw/{name}")
    spark.sql(f"CREATE DATABASE promo LOCATION '{tmp_path}/db'")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        t = jobs.ingest(spark, f"{tmp_path}/raw", f"{tmp_path}/typed", database="promo", buckets=4)
        facts = t.facts._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in facts
        churn = plans.q06_churn_risk(t, sample.AS_OF)
        # above the scan of the daily rows there is no exchange before their join; subqueries are not on that way
        above = way_to(churn._jdf.queryExecution().executedPlan(), "promo.campaign_daily_metrics")
        join = max(i for i, node in enumerate(above) if "SortMergeJoin" in node and "campaign_id" in node)
        assert not any("Exchange" in node for node in above[join:])
        for name, report in jobs.reports(t, sample.AS_OF, sample.HOME).items():
            wanted = jobs.reports(tables, sample.AS_OF, sample.HOME)[name]()
            assert compare.spark_rows(report()) == compare.spark_rows(wanted), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.sql("DROP DATABASE promo CASCADE")

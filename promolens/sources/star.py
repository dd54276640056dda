"""Campaign tables derived from an order/line-item star schema.

Customers act as creators, parts as videos, orders as campaigns and line items as daily metrics,
so that every report can run on the generated star-schema tables at any scale. Some rows break
a declared rule on purpose (a missing date, shared emails, and for every foreign key values without
a parent), to give the quality checks something to find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.schemas import METRICS, SPECS
from promolens.sources.files import conform
from promolens.sources.tables import CampaignTables

HOME_BRAND = "ASIA"
UPGRADED_PLANS = ("BUILDING", "MACHINERY")

# Columns in use, declared so that no file is opened to find them out.
_SCHEMAS = {
    "customer": (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    ),
    "part": "p_partkey BIGINT, p_name STRING, p_type STRING, p_size INT",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_returnflag STRING"
    ),
    "supplier": "s_suppkey BIGINT, s_nationkey INT",
    "nation": "n_nationkey INT, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, props STRING",
}

#: Daily rows in one task, about, where a task is dealt whole campaigns.
TASK_ROWS = 500_000

_START_DATE = "CAST(o_orderdate AS DATE)"
_SPEND = (
    "CASE WHEN l_discount = 0 THEN CAST(0 AS DECIMAL(10,2)) "
    "ELSE CAST(CAST(FLOOR(l_extendedprice / 10) AS INT) * 0.01 AS DECIMAL(10,2)) END"
)
_QUANTITY = "CAST(l_quantity AS INT)"


class StarTables:
    """Reads ``<folder>/<table>.parquet`` and shapes the campaign tables from it."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder

    def _read(self, table: str) -> DataFrame:
        reader = self._spark.read.schema(_SCHEMAS[table])
        return reader.parquet(f"{self._folder}/{table}.parquet")

    def creators(self) -> DataFrame:
        shaped = self._read("customer").selectExpr(
            "c_custkey AS creator_id",
            "c_name AS name",
            "concat('u', c_custkey - IF(c_custkey % 50 = 49, 1, 0), '@example.com') AS email",
            "repeat('ab', c_nationkey + 2) AS city",
            "date_add(DATE'1994-07-01', CAST(c_custkey % 600 AS INT)) AS signup_date",
            "c_mktsegment AS plan_type",
            "CAST(c_acctbal AS DECIMAL(10,2)) AS monthly_revenue",
            "c_acctbal >= 0 AS is_active",
        )
        return conform(shaped, "creators")

    def videos(self) -> DataFrame:
        shaped = self._read("part").selectExpr(
            "p_partkey AS video_id",
            "p_partkey * 3 DIV 4 + 1 AS creator_id",
            "p_name AS title",
            "p_type AS category",
            "CASE WHEN p_size < 50 THEN date_add(DATE'1994-01-01', p_size) END AS upload_date",
            "p_size * 60 AS duration_seconds",
            "(p_size - 1) * 10000 AS baseline_views",
        )
        return conform(shaped, "videos")

    def campaigns(self) -> DataFrame:
        shaped = self._read("orders").selectExpr(
            "o_orderkey AS campaign_id",
            "IF(o_orderkey % 400 = 33, -o_custkey, o_custkey) AS creator_id",
            "IF(o_orderkey % 300 = 7, -o_orderkey, o_orderkey * 2 DIV 15) AS video_id",
            f"{_START_DATE} AS start_date",
            f"CASE WHEN o_orderstatus <> 'O' THEN date_add({_START_DATE}, 14) END AS end_date",
            "CAST(CAST(FLOOR(o_totalprice / 2) AS INT) * 0.01 AS DECIMAL(10,2)) AS budget_usd",
            "o_orderpriority AS campaign_type",
            "o_orderstatus AS target_age_group",
        )
        return conform(shaped, "campaigns")

    def _undated_metrics(self) -> DataFrame:
        return self._read("lineitem").selectExpr(
            "l_orderkey * 8 + l_linenumber AS metric_id",
            "IF(l_orderkey % 500 = 5, -l_orderkey, l_orderkey) AS campaign_id",
            "l_linenumber",
            f"{_QUANTITY} * (8000 + 500 * l_linenumber) AS impressions",
            f"{_QUANTITY} * 1000 AS views",
            f"{_QUANTITY} * 500 AS clicks",
            f"CASE WHEN l_returnflag = 'R' THEN {_QUANTITY} ELSE 0 END AS new_subscribers",
            f"{_QUANTITY} * 150 AS likes",
            f"{_SPEND} AS spend_usd",
            f"CAST({_QUANTITY} * 1500 AS DECIMAL(10,2)) AS watch_time_mins",
        )

    def campaign_daily_metrics(self, dated: bool = True, by_campaign: bool = False) -> DataFrame:
        """Daily metrics. Dates count from the campaign's start, which is looked up if ``dated``;
        otherwise, and for an unknown campaign, the date is NULL. The rows are the same.

        ``by_campaign`` deals them to tasks by campaign, more tasks the more rows there are, so that what
        joins and groups them by campaign holds about ``TASK_ROWS`` at a time.
        """
        metrics = self._undated_metrics()
        if by_campaign and (tasks := self._read("lineitem").count() // TASK_ROWS) > 1:
            metrics = metrics.repartition(tasks, "campaign_id")
        day = F.lit(None)
        if dated:
            starts = self._read("orders").selectExpr(
                "o_orderkey AS campaign_id", f"{_START_DATE} AS start_date"
            )
            metrics = metrics.join(starts, "campaign_id", "left")
            day = F.expr("date_add(start_date, CAST((l_linenumber - 1) * 3 AS INT))")
        return conform(metrics.withColumn("metric_date", day), "campaign_daily_metrics")

    def competitor_benchmarks(self) -> DataFrame:
        """KPIs per supplier region and part type."""
        items = self._read("lineitem").selectExpr(
            "l_partkey AS p_partkey",
            "l_suppkey",
            f"{_QUANTITY} AS quantity",
            f"{_QUANTITY} * (8000 + 500 * l_linenumber) AS impressions",
            f"IF(l_returnflag = 'R', {_QUANTITY}, 0) AS subscribers",
            f"{_SPEND} AS spend",
        )
        sums = ("impressions", "quantity", "subscribers", "spend")
        types = self._read("part").selectExpr("p_partkey", "p_type AS category")
        # One row per supplier and type is left before the suppliers are joined.
        per_supplier = (
            items.join(types, "p_partkey")
            .groupBy("l_suppkey", "category")
            .agg(*(F.sum(c).alias(c) for c in sums))
        )
        nations = self._read("nation").join(
            self._read("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        per_region = (
            per_supplier.join(self._read("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy("s_nationkey", "category")
            .agg(*(F.sum(c).alias(c) for c in sums))
            .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
            .groupBy("r_regionkey", "r_name", "category")
            .agg(*(F.sum(c).alias(c) for c in sums))
        )

        def kpi(numerator: str, denominator: str, kind: str) -> str:
            quotient = f"CAST({numerator} AS DOUBLE) / NULLIF(CAST({denominator} AS DOUBLE), 0)"
            return f"CAST(ROUND(CAST({quotient} AS DECIMAL(24,6)), 2) AS {kind})"

        # Cost per million impressions and return in percent: at two decimals, smaller units
        # would make most regions equal.
        shaped = per_region.selectExpr(
            "r_regionkey * 10000 + ascii(category) * 100 + ascii(substr(category, 2, 1)) "
            "AS bench_id",
            "r_name AS competitor_name",
            "category",
            f"{kpi('spend * 1000000', 'impressions', 'DECIMAL(8,2)')} AS avg_cpm_usd",
            f"{kpi('quantity * 50000', 'impressions', 'DECIMAL(5,2)')} AS avg_ctr_pct",
            f"{kpi('subscribers', 'quantity * 10', 'DECIMAL(5,2)')} AS avg_cvr_pct",
            f"{kpi('quantity * 50', 'spend', 'DECIMAL(6,2)')} AS avg_roas",
            "DATE'2024-01-01' AS benchmark_month",
        )
        return conform(shaped, "competitor_benchmarks")

    def creator_events(self) -> DataFrame:
        shaped = self._read("events").selectExpr(
            "event_id",
            "IF(event_id % 300 = 11, -user_id, user_id) AS creator_id",
            "IF(event_type = 'error', 'churn', event_type) AS event_type",
            "CAST(ts AS DATE) AS event_date",
            "props AS notes",
        )
        return conform(shaped, "creator_events")

    def tables(self, *names: str, dated: bool = False, by_campaign: bool = False) -> CampaignTables:
        """The named tables, or all of them; ``dated`` and ``by_campaign`` are those of the metrics."""
        built = {
            name: self.campaign_daily_metrics(dated, by_campaign) if name == METRICS.name else getattr(self, name)()
            for name in names or SPECS
        }
        return CampaignTables(**built)

"""Batch jobs: load raw files into typed tables, roll up the fact, write reports.

    jobs.py ingest  RAW_FOLDER TABLE_FOLDER [--format csv] [--database DB --buckets N]
    jobs.py reports TABLE_FOLDER REPORT_FOLDER --as-of 2024-06-30 --home NAME
    jobs.py reports --catalog DB REPORT_FOLDER --as-of 2024-06-30 --home NAME

Both may be run again: their output replaces that of the run before.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from promolens import plans
from promolens.operators import quality
from promolens.schemas import SPECS
from promolens.sources.files import read_table, write_bucketed, write_table
from promolens.sources.tables import CampaignTables

CHECKS = (
    quality.dq_not_null,
    quality.dq_primary_key,
    quality.dq_unique_email,
    quality.dq_foreign_key,
    quality.dq_domain,
    quality.dq_varchar_length,
    quality.dq_metric_in_flight,
)


class RepeatedKeys(ValueError):
    """Primary keys that are NULL or occur more than once, which no report is defined for."""


def require_unique_keys(tables: CampaignTables, repeated: DataFrame | None = None) -> None:
    """Raise ``RepeatedKeys`` unless every primary key is unique and present.

    ``repeated`` is what ``dq_primary_key`` found, where that is stored already.
    """
    found = quality.dq_primary_key(tables) if repeated is None else repeated
    first = found.orderBy("table_name", "key_value").limit(10).collect()
    if first:
        named = ", ".join(f"{r.table_name}.{r.column_name} = {r.key_value} ({r.copies} rows)" for r in first)
        raise RepeatedKeys(f"keys that are not unique, the first of them: {named}")


def ingest(
    spark: SparkSession,
    raw: str,
    target: str,
    fmt: str = "parquet",
    *,
    mode: str = "overwrite",
    database: str | None = None,
    buckets: int = 200,
) -> CampaignTables:
    """Type every ``<raw>/<table>``, store it, and store what the quality checks find next to it.

    With ``database`` the tables are also stored there, bucketed on their join keys. What a run
    before left in the target is replaced. Repeated primary keys are stored and then raised.
    """
    if raw.rstrip("/") == target.rstrip("/"):
        raise ValueError("the typed tables need a folder of their own")
    for name in SPECS:
        write_table(read_table(spark, name, f"{raw}/{name}", fmt), name, f"{target}/{name}", mode)
    tables = CampaignTables.load(spark, target, unique_keys=True)
    for check in CHECKS:
        check(tables).write.mode(mode).parquet(f"{target}/_quality/{check.__name__}")
    require_unique_keys(tables, spark.read.parquet(f"{target}/_quality/dq_primary_key"))
    if database is not None:
        for name, df in tables.items():
            write_bucketed(df, name, buckets, f"{database}.{name}", mode)
        return CampaignTables.from_catalog(spark, database)
    return tables


def reports(
    tables: CampaignTables, as_of: dt.date, home: str
) -> dict[str, Callable[[], DataFrame]]:
    """Every report over ``tables``, by name; nothing runs until one is called."""
    options = {
        "q05_ltv_by_plan": {"as_of": as_of},
        "q06_churn_risk": {"as_of": as_of},
        "q06a_churn_risk_placeholder": {"as_of": as_of},
        "q10_competitor_benchmark": {"home": home},
    }

    def bound(name: str) -> Callable[[], DataFrame]:
        return lambda: getattr(plans, name)(tables, **options.get(name, {}))

    return {name: bound(name) for name in plans.__all__}


def write_reports(
    spark: SparkSession,
    tables: CampaignTables,
    target: str,
    as_of: dt.date,
    home: str,
    *,
    mode: str = "overwrite",
) -> None:
    """Write every report. The daily rows are read twice, for what all reports share.

    What a run before left in the target is replaced. Tables with repeated primary keys of
    creators, videos or campaigns are refused.
    """
    parents = CampaignTables(creators=tables.creators, videos=tables.videos, campaigns=tables.campaigns)
    require_unique_keys(parents)
    tables = tables.stored(spark, f"{target}/_shared", mode)
    for name, report in reports(tables, as_of, home).items():
        report().write.mode(mode).parquet(f"{target}/{name}")


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    load = commands.add_parser("ingest")
    load.add_argument("raw")
    load.add_argument("target")
    load.add_argument("--format", default="parquet", choices=("parquet", "csv"))
    load.add_argument("--database", help="also store the tables bucketed in this database")
    load.add_argument("--buckets", type=int, default=200)
    report = commands.add_parser("reports")
    report.add_argument("root", help="folder of the typed tables, or with --catalog their database")
    report.add_argument("--catalog", action="store_true")
    report.add_argument("target")
    report.add_argument("--as-of", type=dt.date.fromisoformat, required=True)
    report.add_argument("--home", required=True, help="own brand in competitor_benchmarks")
    given = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("promolens").getOrCreate()
    if given.command == "ingest":
        ingest(
            spark, given.raw, given.target, given.format, database=given.database, buckets=given.buckets
        )
    else:
        if given.catalog:
            tables = CampaignTables.from_catalog(spark, given.root)
        else:
            tables = CampaignTables.load(spark, given.root, unique_keys=True)  # write_reports checks them
        write_reports(spark, tables, given.target, given.as_of, given.home)


if __name__ == "__main__":
    main()

"""Checks for the limits that the table declarations state and files do not enforce.

Every check returns the offending rows or keys; an empty result means that the tables keep the
rule. A check reads a table once for each role that the table has in it: a parent of three foreign
keys is read three times.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.operators.key_filter import only_keys_of
from promolens.operators.keys import repeated_keys
from promolens.schemas import SPECS, TableSpec
from promolens.sources.tables import CampaignTables


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _flagged_columns(
    t: CampaignTables, columns: Callable[[TableSpec], list[tuple[str, Column, Column]]]
) -> DataFrame:
    """Rows (table, column, row key, detail) for which a column's flag is set.

    ``columns`` gives name, flag and detail per checked column. All columns of a table are
    checked in the same scan.
    """
    found = []
    for name, df in t.items():
        spec = SPECS[name]
        checks = columns(spec)
        if not checks:
            continue
        flags = F.array_compact(
            F.array(
                *(
                    F.when(
                        flag,
                        F.struct(
                            F.lit(column).alias("column_name"),
                            detail.cast("long").alias("detail"),
                        ),
                    )
                    for column, flag, detail in checks
                )
            )
        )
        found.append(
            df.select(F.col(spec.primary_key).cast("string").alias("row_key"), flags.alias("f"))
            .filter(F.size("f") > 0)
            .select(F.lit(name).alias("table_name"), "row_key", F.inline("f"))
        )
    return _union(found).select("table_name", "column_name", "row_key", "detail")


def dq_not_null(t: CampaignTables) -> DataFrame:
    """Rows with NULL in a required column."""
    return _flagged_columns(
        t, lambda spec: [(c, F.col(c).isNull(), F.lit(None)) for c in spec.not_null]
    ).drop("detail")


def dq_varchar_length(t: CampaignTables) -> DataFrame:
    """Rows with a string longer than declared."""
    return _flagged_columns(
        t,
        lambda spec: [
            (c, F.length(c) > limit, F.length(c)) for c, limit in spec.max_length.items()
        ],
    ).withColumnRenamed("detail", "length")


def _repeated(df: DataFrame, table: str, column: str) -> DataFrame:
    """Values of ``column`` that occur more than once, and NULL."""
    return repeated_keys(df, column).select(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.col(column).cast("string").alias("key_value"),
        "copies",
    )


def dq_primary_key(t: CampaignTables) -> DataFrame:
    """Primary key values that are NULL or occur more than once."""
    return _union([_repeated(df, name, SPECS[name].primary_key) for name, df in t.items()])


def dq_unique_email(t: CampaignTables) -> DataFrame:
    """Values of a UNIQUE column (the creators' email) that occur more than once; NULL may."""
    return _union(
        [_repeated(df, name, c) for name, df in t.items() for c in SPECS[name].unique]
    ).filter(F.col("key_value").isNotNull())


def dq_foreign_key(t: CampaignTables) -> DataFrame:
    """Foreign key values without a parent row, with the number of rows that carry them."""
    present = dict(t.items())
    found = []
    for name, child in present.items():
        for fk in SPECS[name].foreign_keys:
            if fk.parent not in present:
                continue
            # Distinct child keys are joined, not child rows: hot keys cannot skew the join.
            keys = (
                child.select(F.col(fk.column).alias("key_value"))
                .filter("key_value IS NOT NULL")
                .groupBy("key_value")
                .agg(F.count("*").alias("child_rows"))
            )
            parents = present[fk.parent].select(F.col(fk.parent_key).alias("key_value"))
            found.append(
                keys.join(parents, "key_value", "left_anti").select(
                    F.lit(name).alias("child_table"),
                    F.lit(fk.column).alias("fk_column"),
                    F.lit(fk.parent).alias("parent_table"),
                    "key_value",
                    "child_rows",
                )
            )
    return _union(found)


def dq_domain(t: CampaignTables) -> DataFrame:
    """Values outside the documented lists, with their row counts. Advisory: lists may grow."""
    found = []
    for name, df in t.items():
        domains = SPECS[name].domains
        if not domains:
            continue
        strange = F.array_compact(
            F.array(
                *(
                    F.when(
                        ~F.col(c).isin(*listed),
                        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")),
                    )
                    for c, listed in domains.items()
                )
            )
        )
        found.append(
            df.select(F.inline(strange))
            .groupBy("column_name", "value")
            .agg(F.count("*").alias("row_count"))
            .select(F.lit(name).alias("table_name"), "column_name", "value", "row_count")
        )
    return _union(found)


def dq_metric_in_flight(t: CampaignTables) -> DataFrame:
    """Campaign days with metrics outside the campaign's start and end; open ends never fail.

    The first and the last day of each campaign, combined before the shuffle, tell which campaigns have such
    days. Only the daily rows that may be theirs are grouped by day, a bit array of their ids drops the others
    where they are read.
    """
    day = F.col("metric_date")
    spans = t.campaign_daily_metrics.groupBy("campaign_id").agg(F.min(day).alias("first"), F.max(day).alias("last"))
    flights = t.campaigns.select("campaign_id", "start_date", "end_date")
    late = spans.join(flights, "campaign_id").where("first < start_date OR last > end_date")
    # One row per campaign and day is joined, so no campaign has more rows there than days. They meet the flights
    # as these are read: finding the late ones once more would hold the days of a task twice.
    days = (
        only_keys_of(t.campaign_daily_metrics, late, "campaign_id")
        .groupBy("campaign_id", "metric_date")
        .agg(F.count("*").alias("metric_rows"), F.min("metric_id").alias("first_metric_id"))
    )
    return (
        days.join(flights, "campaign_id")
        .filter((day < F.col("start_date")) | (day > F.col("end_date")))
        .select("campaign_id", "metric_date", "start_date", "end_date", "metric_rows", "first_metric_id")
    )

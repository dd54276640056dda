"""File and table storage for the campaign tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from promolens.schemas import SPECS

# Column that large tables are clustered on when they are stored bucketed.
BUCKET_KEYS = {
    "creators": "creator_id",
    "videos": "video_id",
    "campaigns": "campaign_id",
    "campaign_daily_metrics": "campaign_id",
    "creator_events": "creator_id",
}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Give ``df`` the declared columns and types of ``table``.

    A column the input does not have gets its declared default, or NULL if it may be NULL; without
    a required column that has no default the table is refused. An explicit NULL stays NULL: a
    default stands for "not supplied", and NULLs in required columns are the quality jobs' to find.
    """
    spec = SPECS[table]
    present = set(df.columns)
    required = {spec.primary_key, *spec.not_null} - set(spec.defaults)
    if missing := sorted(required - present):
        raise ValueError(f"{table} has no column {', '.join(missing)}")
    return df.select(
        *(
            (F.col(f.name) if f.name in present else F.lit(spec.defaults.get(f.name)))
            .cast(f.dataType)
            .alias(f.name)
            for f in spec.schema
        )
    )


def read_table(
    spark: SparkSession,
    table: str,
    path: str,
    fmt: str = "parquet",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Read one campaign table with its declared types; nothing is inferred from the data.

    CSV files need a header. ``columns`` names the columns the file has, in file order, when it
    does not have them all; the header is checked against it and malformed lines fail the read.
    """
    if fmt != "csv":
        return conform(spark.read.format(fmt).load(path), table)
    schema = SPECS[table].schema
    in_file = StructType([schema[name] for name in columns or schema.fieldNames()])
    raw = (
        spark.read.schema(in_file)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return conform(raw, table)


def write_table(df: DataFrame, table: str, path: str, mode: str = "errorifexists") -> None:
    """Store one typed campaign table as Parquet."""
    conform(df, table).write.mode(mode).parquet(path)


def write_bucketed(
    df: DataFrame, table: str, buckets: int, saved_as: str, mode: str = "errorifexists"
) -> None:
    """Store one campaign table as a catalog table, bucketed on its join key if it has one.

    Daily metrics and campaigns share ``campaign_id``: with the same bucket count, summing the
    metrics per campaign and joining the campaigns needs no shuffle of either.
    """
    writer = conform(df, table).write.mode(mode).format("parquet")
    if key := BUCKET_KEYS.get(table):
        writer = writer.bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(saved_as)

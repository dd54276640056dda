"""Campaign totals kept up batch by batch, so that reports need not read the daily rows of the past again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.operators.rollup import campaign_totals
from promolens.schemas import METRICS

_BATCH = "batch"


def add_batch(metrics: DataFrame, folder: str, batch: str) -> None:
    """Stores the campaign totals of one load of daily rows, a day's file for instance.

    A batch that is loaded again replaces what it was before, also after a failed attempt, so nothing counts twice.
    """
    if not batch or "/" in batch:
        raise ValueError(f"{batch!r} cannot name a batch")
    campaign_totals(metrics).write.mode("overwrite").parquet(f"{folder}/{_BATCH}={batch}")


def _partial_sums(spark: SparkSession, folder: str) -> DataFrame:
    # Names such as 2024-06-30 or 007 stay text.
    sums = campaign_totals(spark.createDataFrame([], METRICS.schema)).schema
    return spark.read.schema(sums.add(_BATCH, "string")).parquet(folder)


def _summed(partial: DataFrame) -> DataFrame:
    kinds = {f.name: f.dataType for f in partial.schema}
    sums = [c for c in partial.columns if c not in ("campaign_id", _BATCH)]
    return partial.groupBy("campaign_id").agg(*(F.sum(c).cast(kinds[c]).alias(c) for c in sums))


def batch_totals(spark: SparkSession, folder: str) -> DataFrame:
    """One row per campaign over all batches: what ``campaign_totals`` gives for all their daily rows.

    For ``CampaignTables(stored_totals=...)``. A row of a batch is one campaign's, so this reads campaigns times
    batches, never daily rows; ``fold_batches`` keeps the number of batches small.
    """
    return _summed(_partial_sums(spark, folder))


def fold_batches(spark: SparkSession, folder: str, target: str, closed: Sequence[str], into: str) -> None:
    """Copies the totals to a new folder with the ``closed`` batches summed to one, named ``into``.

    The old folder stays as it is until the caller has gone over to the new one, so a failure loses
    nothing. A closed batch must not be loaded again: its share can no longer be told from the others'.
    """
    partial = _partial_sums(spark, folder)
    names = {r[0] for r in partial.select(_BATCH).distinct().collect()}
    if missing := sorted(set(closed) - names):
        raise ValueError(f"no batch {', '.join(missing)}")
    if into in names - set(closed):
        raise ValueError(f"{into} is another batch")
    merged = _summed(partial.where(F.col(_BATCH).isin(*closed))).withColumn(_BATCH, F.lit(into))
    open_ = partial.where(~F.col(_BATCH).isin(*closed))
    merged.unionByName(open_).write.mode("errorifexists").partitionBy(_BATCH).parquet(target)

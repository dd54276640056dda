"""What the two learners share: labelled rows, term hashes and training in shards."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a model is fitted on at most, and rows that one task trains on.
MAX_LABELLED, SHARD_ROWS = 20_000, 5_000
#: The remainder of ``held_out`` rows.
HELD_OUT = 2


def held_out(doc_id: Column) -> Column:
    """Whether a document's labels are only for measuring: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def training_rows(
    docs: DataFrame, labels: DataFrame, terms: Column, *, doc_id: str, label: str, most: int = MAX_LABELLED
) -> DataFrame:
    """Rows (order, label, terms, shard) of labelled documents that are not held out.

    If there are more than ``most`` labels, those with the smallest hash of the id are taken. Labels
    other than 0 and 1 are left out.
    """
    usable = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label")).where(
        F.col("_id").isNotNull() & F.col("_label").isin(0, 1)
    )
    taken = (
        usable.where(~held_out(F.col("_id")))
        .distinct()
        .withColumn("_order", F.xxhash64("_id"))
        .orderBy("_order", "_id", "_label")
        .limit(most)
    )
    # at most ``most`` rows of three numbers
    joined = docs.select(F.col(doc_id).alias("_doc"), terms.alias("terms")).join(
        F.broadcast(taken), F.col("_doc") == F.col("_id")
    )
    shards = max(1, math.ceil(taken.count() / SHARD_ROWS))
    return joined.select(
        F.col("_order").alias("order"),
        F.col("_label").alias("label"),
        "terms",
        F.pmod(F.xxhash64("_id", F.lit("shard")), F.lit(shards)).cast("int").alias("shard"),
    )


def fit_in_shards(
    rows: DataFrame, fit: Callable[[list[np.ndarray], np.ndarray], pd.DataFrame], schema: str
) -> DataFrame:
    """The rows of ``fit(terms, labels)`` for every shard.

    Each shard is sorted before it is fitted, so that a task that runs again gives the same model.
    """

    def one(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["order", "label"], kind="stable")
        terms = [np.asarray(t) for t in shard["terms"]]
        return fit(terms, shard["label"].to_numpy(np.float64))

    return rows.groupBy("shard").applyInPandas(one, schema)

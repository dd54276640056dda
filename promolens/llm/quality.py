"""Quality classifier: logistic regression on hashed word n-grams, fitted with FTRL.

Words and punctuation runs are hashed on the JVM side. A document's features are its single tokens
and neighbouring pairs; a token that follows itself makes one and the same pair whatever it is, so
that repetition is learnt once. The logarithms of the counts, scaled to length one, are the values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import list_chunks
from promolens.llm.learning import fit_in_shards, held_out, training_rows

#: Places of the hash table; the last one is the constant.
BUCKETS = 1 << 20
EPOCHS, ALPHA, BETA, L1, L2 = 6, 0.5, 1.0, 0.02, 0.01
#: Scores from here on are predicted as label 1.
THRESHOLD = 0.7
#: Tokens that a task works on at a time.
CHUNK_TOKENS = 500_000

_FIRST, _SECOND, _REPEAT = np.int64(-7046029254386353131), np.int64(-4417276706812531889), 12345


def token_hashes(text: Column) -> Column:
    """A 32-bit hash for each word or run of punctuation, in order; none for NULL."""
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]+"), F.lit(0))
    return F.transform(tokens, lambda t: F.hash(t))


def features(tokens: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value) of all features; ``row`` is ascending and gives each token's row."""
    tokens = tokens.astype(np.int64)
    with np.errstate(over="ignore"):
        a, b = tokens[:-1], tokens[1:]
        pair = a * _FIRST + b * _SECOND
        pair ^= (pair >> 31) & 0xFFFFFFFF
    pair = np.where(a == b, _REPEAT, pair)
    near = row[:-1] == row[1:]
    bucket = np.concatenate([tokens, pair[near]]) % (BUCKETS - 1)
    of = np.concatenate([row, row[:-1][near]])
    keys, counts = np.unique(of * BUCKETS + bucket, return_counts=True)
    of, bucket = keys // BUCKETS, keys % BUCKETS
    value = np.log1p(counts)
    norm = np.sqrt(np.bincount(of, value * value, rows))
    return of, bucket, value / norm[of]


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def ftrl(documents: list[np.ndarray], labels: np.ndarray) -> pd.DataFrame:
    """Weights (bucket, weight) after some passes over the rows in their order."""
    z, n = np.zeros(BUCKETS), np.zeros(BUCKETS)
    sparse = []
    for tokens in documents:
        _, bucket, value = features(tokens, np.zeros(len(tokens), np.int64), 1)
        sparse.append((np.append(bucket, BUCKETS - 1).astype(np.int32), np.append(value, 1.0).astype(np.float32)))

    def weights(i):
        sign = np.sign(z[i])
        return np.where(np.abs(z[i]) <= L1, 0.0, (sign * L1 - z[i]) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for (i, x), y in zip(sparse, labels):
            w = weights(i)
            g = (sigmoid(w @ x) - y) * x
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
    w = weights(np.arange(BUCKETS))
    found = np.flatnonzero(w)
    return pd.DataFrame({"bucket": found, "weight": w[found]})


def fit_quality(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> np.ndarray:
    """A weight for every bucket: the mean of the shards' models. Without labels all are 0."""
    rows = training_rows(docs, labels, token_hashes(F.col(text)), doc_id=doc_id, label=label).cache()
    try:
        shards = rows.select("shard").distinct().count()
        models = fit_in_shards(rows, ftrl, "bucket long, weight double")
        found = models.groupBy("bucket").agg(F.sum("weight").alias("weight")).toPandas()
    finally:
        rows.unpersist()
    out = np.zeros(BUCKETS, np.float32)
    out[found["bucket"].to_numpy(np.int64)] = found["weight"].to_numpy() / max(1, shards)
    return out


def score_quality(docs: DataFrame, weights: np.ndarray, *, doc_id: str = "doc_id", text: str = "text", keep=()) -> DataFrame:
    """``doc_id``, the columns to keep and ``score`` for every row. A text without tokens has the constant's score."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # as long as the hash table
    carried = [doc_id, *keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(carried).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            dot = np.zeros(batch.num_rows)
            for tokens, row, first, last in list_chunks(batch.column(len(carried)), CHUNK_TOKENS):
                of, bucket, value = features(tokens, row, last - first)
                dot[first:last] = np.bincount(of, value * w[bucket], last - first)
            score = pa.array(sigmoid(dot + w[BUCKETS - 1]))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(carried)], score], names=[*carried, "score"])

    hashed = docs.select(*carried, token_hashes(F.col(text)).alias("_terms"))
    return hashed.mapInArrow(run, f"{schema}, score double")


def quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    threshold: float = THRESHOLD,
    keep=(),
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` for every row of ``docs``.

    Fitted on at most ``learning.MAX_LABELLED`` labelled rows that are not held out; a score depends
    on the text alone. NULL and empty texts, and texts of white space, get the model's constant.
    Repeated rows get equal scores. Labels that are NULL or without a document are of no effect;
    without any label all scores are 0.5. Columns that are not named in ``keep`` are left out.
    """
    weights = fit_quality(docs, labels, doc_id=doc_id, text=text, label=label)
    scored = score_quality(docs, weights, doc_id=doc_id, text=text, keep=keep)
    return scored.select(
        doc_id,
        *keep,
        held_out(F.col(doc_id)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )

"""Toxicity: a factorization machine over hashed terms.

Beside one weight for each term the machine learns a short vector for it; the products of the
vectors of two terms in one text add to its score. So a pair of terms, such as an insult and the
name of a group, can count for more than both alone.

Terms are the text's distinct words, lower-cased, and the first letters of longer ones, as 64-bit
hashes: endings that no labelled text has do not hide a word. The value of a term is the logarithm of the number of
distinct words that have it, so that a text with many words of one beginning differs from one with a single one.
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

#: Length of a term's vector; lengths of word beginnings.
FACTORS, PREFIXES = 4, (4, 5, 6)
#: Passes, learning rate and L1 and L2 bounds of the weights; rate and decay of the vectors, and what
#: their first numbers stay under.
EPOCHS, ALPHA, L1, L2 = 8, 2.0, 3.0, 0.1
RATE, DECAY, START = 0.005, 1e-4, 0.01
#: A term is learnt if so many of a shard's texts have it, and takes part in pairs if so many have it.
MIN_TEXTS, PAIR_TEXTS = 3, 30
#: Scores from here on are predicted as label 1.
THRESHOLD = 0.3
#: Terms that a task works on at a time.
CHUNK_TERMS = 1_000_000

_V = [f"v{i}" for i in range(FACTORS)]


def term_hashes(text: Column) -> Column:
    """The terms of a text as hashes, each as often as it has distinct words with it; none for NULL."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))

    def beginnings(n: int) -> Column:
        longer = F.filter(words, lambda w: F.length(w) > n)
        return F.transform(longer, lambda w: F.xxhash64(F.substring(w, 1, n), F.lit(n)))

    return F.concat(F.transform(words, lambda w: F.xxhash64(w)), *(beginnings(n) for n in PREFIXES))


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def first_vectors(terms: np.ndarray) -> np.ndarray:
    """Small numbers that depend on the term alone, so that all shards begin alike."""
    bits = np.stack([(terms >> (16 * i)) & 0xFFFF for i in range(FACTORS)], 1)
    return (bits / 65536.0 - 0.5) * 2 * START


def term_values(counts: np.ndarray) -> np.ndarray:
    return np.log2(1.0 + counts)


def fit_machine(documents: list[np.ndarray], labels: np.ndarray) -> pd.DataFrame:
    """Rows (term, weight, v0, v1, ...) after some passes over the rows; term 0 is the constant.

    The weights follow the regularised leader, which leaves those of terms without a bearing on the label at zero.
    Which terms have a vector depends on how many texts have them and on nothing that is learnt, so a pair is
    learnt as well where neither term has a bearing of its own, whatever the order of the rows.
    """
    each = [np.unique(d[d != 0], return_counts=True) for d in documents]
    terms, texts = np.unique(np.concatenate([*(t for t, _ in each), np.empty(0, np.int64)]), return_counts=True)
    terms, texts = terms[texts >= MIN_TEXTS], texts[texts >= MIN_TEXTS]
    often = np.append(texts >= PAIR_TEXTS, False)
    rows = []
    for t, c in each:
        at = np.minimum(np.searchsorted(terms, t), max(0, len(terms) - 1))
        known = terms[at] == t if len(terms) else np.zeros(len(t), bool)
        rows.append((np.append(at[known], len(terms)), np.append(term_values(c[known]), 1.0)))  # the constant
    z, n = np.zeros(len(terms) + 1), np.zeros(len(terms) + 1)
    l1 = np.append(np.full(len(terms), L1), 0.0)
    v = np.vstack([first_vectors(terms), np.zeros((1, FACTORS))])
    squares = np.full(v.shape, 1e-8)

    def weights(i):
        return np.where(np.abs(z[i]) <= l1[i], 0.0, (np.sign(z[i]) * l1[i] - z[i]) / ((1 + np.sqrt(n[i])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for (i, x), y in zip(rows, labels):
            w, paired = weights(i), i[often[i]]
            xp = x[often[i]][:, None]
            vi = v[paired]
            own = vi * xp
            total = own.sum(0)
            error = sigmoid(w @ x + 0.5 * (total @ total - (own * own).sum())) - y
            g = error * x
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
            step = error * xp * (total - own) + DECAY * vi
            squares[paired] += step * step
            v[paired] = vi - RATE * step / np.sqrt(squares[paired])
    w = weights(np.arange(len(terms) + 1))
    v[~often] = 0.0
    out = pd.DataFrame({"term": np.append(terms, 0), "weight": w, **{c: v[:, i] for i, c in enumerate(_V)}})
    return out[(w != 0) | often | (out["term"] == 0)]


class Machine:
    """A fitted model: sorted terms with their weights and vectors."""

    def __init__(self, found: pd.DataFrame, shards: int):
        found = found.sort_values("term")
        is_constant = (found["term"] == 0).to_numpy()
        self.constant = float(found["weight"][is_constant].sum()) / max(1, shards)
        rest = found[~is_constant]
        self.terms = rest["term"].to_numpy(np.int64)
        self.weights = rest["weight"].to_numpy() / max(1, shards)
        self.vectors = rest[_V].to_numpy() / max(1, shards)

    def scores(self, terms: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """Of rows whose terms are given, as often as they count, each with its row."""
        if not len(self.terms):
            return np.full(rows, sigmoid(self.constant))
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        known = self.terms[at] == terms
        pairs, counts = np.unique(row[known] * len(self.terms) + at[known], return_counts=True)
        row, at, x = pairs // len(self.terms), pairs % len(self.terms), term_values(counts)
        total = self.constant + np.bincount(row, self.weights[at] * x, rows)
        for f in range(FACTORS):
            v = self.vectors[at, f] * x
            total += 0.5 * (np.bincount(row, v, rows) ** 2 - np.bincount(row, v * v, rows))
        return sigmoid(total)


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Machine:
    """The mean of the shards' machines.

    Its terms are those with a weight or with ``PAIR_TEXTS`` texts in a shard: at most a ``MIN_TEXTS``-th of all terms of the
    ``MAX_LABELLED`` rows it is fitted on, whatever the size of the corpus.
    """
    rows = training_rows(docs, labels, term_hashes(F.col(text)), doc_id=doc_id, label=label).cache()
    try:
        shards = rows.select("shard").distinct().count()
        schema = ", ".join(["term long", "weight double", *(f"{c} double" for c in _V)])
        sums = [F.sum(c).alias(c) for c in ("weight", *_V)]
        found = fit_in_shards(rows, fit_machine, schema).groupBy("term").agg(*sums).toPandas()
    finally:
        rows.unpersist()
    return Machine(found, shards)


def score_toxicity(docs: DataFrame, machine: Machine, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # no larger than the fitted rows allow
    id_type = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.empty(batch.num_rows)
            for terms, row, first, last in list_chunks(batch.column(1), CHUNK_TERMS):
                scores[first:last] = shared.value.scores(terms, row, last - first)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=[doc_id, "score"])

    hashed = docs.select(doc_id, term_hashes(F.col(text)).alias("_terms"))
    return hashed.mapInArrow(run, f"`{doc_id}` {id_type}, score double")


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` for every row of ``docs``.

    Fitted on at most ``learning.MAX_LABELLED`` labelled rows that are not held out; a score depends
    on the text alone. NULL and empty texts, and texts without a known term, get the model's
    constant. Repeated rows get equal scores. Labels that are NULL or without a document are of no
    effect; without any label all scores are 0.5. Other columns are left out.
    """
    machine = fit_toxicity(docs, labels, doc_id=doc_id, text=text, label=label)
    scored = score_toxicity(docs, machine, doc_id=doc_id, text=text)
    return scored.select(
        doc_id,
        held_out(F.col(doc_id)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )

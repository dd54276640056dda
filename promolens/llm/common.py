"""Small helpers that several operators share."""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.sources.scratch import ensure_checkpoint_dir, store  # noqa: F401

#: One round of work inside a Python task covers about so many characters, whatever the batch holds.
CHUNK_CHARS = 2_000_000
#: Places that the rows of one key are dealt to.
SALTS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """Where a file of the public tokenizers is."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    others = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(others)  # the faster way


def fresh(df: DataFrame, name: str) -> str:
    """A column name like the given one that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def list_chunks(column: pa.Array, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Runs of rows of a list column with about ``most`` values, one row at least.

    Each is (values, the row of each value counted from the run's first, first row, row after the last).
    """
    offsets, values = np.asarray(column.offsets), np.asarray(column.values)
    first, rows = 0, len(column)
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), rows)
        sizes = np.diff(offsets[first : last + 1])
        yield values[offsets[first] : offsets[last]], np.repeat(np.arange(last - first), sizes), first, last
        first = last


def salted_join(many: DataFrame, one: DataFrame, keys: Sequence[str], spread: Column, salts: int = SALTS) -> DataFrame:
    """Inner join of ``many`` with ``one``, which has a row for each key at most and is the smaller.

    The rows of a key are dealt to ``salts`` places by ``spread``, a hash of the row, and ``one`` is
    repeated for these. Both sides are shuffled for that, so adaptive execution may split further.
    """
    every = F.explode(F.array(*(F.lit(i) for i in range(salts))))
    salted = many.withColumn("_salt", F.pmod(spread, F.lit(salts)).cast("int"))
    return salted.join(one.withColumn("_salt", every), [*keys, "_salt"]).drop("_salt")


def chunks(texts: Sequence[str], most: int = CHUNK_CHARS) -> Iterator[slice]:
    """Consecutive slices of the texts with about ``most`` characters each; a longer text is its own."""
    start = held = 0
    for i, text in enumerate(texts):
        if i > start and held + len(text) > most:
            yield slice(start, i)
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield slice(start, len(texts))

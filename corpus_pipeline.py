"""From raw documents to token ids, as five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame; it is written as Parquet and read again
before the next one. All but the last return the columns of ``documents``, with ``n_chars`` for the
text as the stage leaves it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm.bpe import bpe
from promolens.llm.common import table, vocabulary_path
from promolens.llm.decontaminate import decontaminate
from promolens.llm.jaccard_join import keep_one
from promolens.llm.line_dedup import line_dedup
from promolens.llm.quality import THRESHOLD, fit_quality, score_quality
from promolens.sources.scratch import scratch_folder


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    All of them if it has no weights, as without labels that could be fitted.
    """
    bare, names = _shielded(docs)
    weights = fit_quality(bare, table(spark, sf_dir, "labels"))
    if not weights.any():
        return docs
    judged = score_quality(bare, weights, keep=["text", *names])
    return _restored(judged.where(F.col("score") >= THRESHOLD), docs, names)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that many documents hold."""
    bare, names = _shielded(docs)
    done = _restored(line_dedup(bare), docs, names)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies."""
    return keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the remaining texts."""
    return bpe(docs, vocabulary_path(), outputs=("n_tokens", "ids", "ids_sha256", "decoded_sha256"))


def _shielded(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Id and text as they are, the other columns under names that no operator adds, and those names."""
    names = {f"_doc_{i}": c for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    return docs.withColumnsRenamed({c: n for n, c in names.items()}), names


def _restored(done: DataFrame, docs: DataFrame, names: dict[str, str]) -> DataFrame:
    return done.select("doc_id", "text", *names).withColumnsRenamed(names).select(docs.columns)


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("bpe", encode),
]

#: A classifier, banding and merges are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """All stages over the documents, each stored as ``<folder>/<stage>``.

    Without a folder they go to a new one in the shared checkpoint folder. They stay there: the last
    one is the result, those before it show what each stage kept.
    """
    folder = folder or scratch_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs

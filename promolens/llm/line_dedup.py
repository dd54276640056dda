"""Line dedup: lines that many documents hold stay in one of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import ascii_lower, fresh, salted_join

#: Keys of at least so many code points, held by at least so many documents, are dropped.
MIN_CHARS, MIN_DOCUMENTS = 40, 5


def line_key(line: Column) -> Column:
    """The line without white space (space, tab to carriage return) at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(" \t\n\v\f\r")))


def line_dedup(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """The rows of ``docs`` with the kept text in ``text``, and n_lines and n_dropped beside it.

    Of a key with at least ``min_chars`` code points in at least ``min_documents`` documents, only
    the lines of the largest ``doc_id`` stay. Lines are told apart by 128 bits of hash, so only
    these are shuffled, never the lines.

    A NULL text counts as empty: one empty line. A document is a distinct ``doc_id``; rows that
    share one are a single document for the counts, and each of them is cleaned. Rows without a
    ``doc_id`` together count as one document, which keeps a repeated line only if no other has it.
    Other columns are kept; n_lines and n_dropped replace columns of that name.
    """
    id_, lines, text_id = (fresh(docs, n) for n in ("_doc", "_lines", "_text_id"))
    whole = docs.withColumns({id_: F.col(doc_id), text_id: F.xxhash64(F.coalesce(text, F.lit("")))})
    split = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    key = line_key(F.col("line"))
    long = (
        whole.select(F.col(id_).alias("id"), F.col(text_id).alias("text_id"), F.posexplode(split).alias("pos", "line"))
        .where(F.length("line") >= min_chars)
        .select("id", "text_id", "pos", key.alias("key"))
        .where(F.length("key") >= min_chars)
        .select("id", "text_id", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    )
    shared = (
        long.groupBy("h1", "h2", "id")
        .agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("documents"), F.max("id").alias("holder"))
        .where(F.col("documents") >= min_documents)
        .select("h1", "h2", "holder")
    )
    dropped = (
        salted_join(long, shared, ["h1", "h2"], F.col("text_id"))
        .where(~F.col("id").eqNullSafe(F.col("holder")))
        .groupBy("id", "text_id")
        .agg(F.collect_set("pos").alias("out"))
    )
    gone = fresh(docs, "_gone")
    marked = whole.join(
        dropped.select(F.col("id").alias("_o_id"), F.col("text_id").alias("_o_text"), F.col("out").alias(gone)),
        F.col(id_).eqNullSafe(F.col("_o_id")) & (F.col(text_id) == F.col("_o_text")),
        "left",
    ).withColumn(lines, split)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    rejoined = F.array_join(F.transform(kept, lambda i: F.get(F.col(lines), i)), "\n")
    return marked.withColumns(
        {
            "n_lines": F.size(lines).cast("long"),
            "n_dropped": F.coalesce(F.size(gone), F.lit(0)).cast("long"),
            text: F.when(F.col(gone).isNull(), F.coalesce(text, F.lit(""))).otherwise(rejoined),
        }
    ).drop(id_, text_id, lines, gone, "_o_id", "_o_text")

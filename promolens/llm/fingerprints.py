"""Document fingerprints by consistent weighted sampling.

A document is the multiset of its word pairs; a pair's weight is how often it occurs. For each of a
number of samples a term draws two Gamma(2, 1) numbers r and c and a uniform one b, all from hashes of the
term and the sample's number, so the same in every document. With t = floor(ln(weight) / r + b) the term's
value is c / exp(r (t - b + 1)), and the sample is the (term, t) of the least value. Two documents
agree in a sample with a probability that is their generalised Jaccard similarity: the sum of the
smaller weights over the sum of the larger ones.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Samples in a fingerprint, and how many of them a row stands for while they are drawn.
SAMPLES, DRAWN = 24, 2
#: Characters of text in a partition, partitions at most, and ranges of ids for each partition.
PARTITION_CHARS, MOST_PARTITIONS, RANGES = 4_000_000, 100_000, 4


def terms(text: Column) -> Column:
    """The hashes of a text's word pairs in order, and of its last word; none for a text without words."""
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    return _pairs(F.transform(words, lambda w: F.xxhash64(w)))


def _pairs(words: Column) -> Column:
    return F.zip_with(words, F.slice(words, F.lit(2), F.size(words)), lambda a, b: F.xxhash64(a, b))


def signatures(rows: DataFrame, keys: Sequence[str], texts: Sequence[str], samples: int = SAMPLES) -> DataFrame:
    """The keys and, for each of the text columns, its samples as an array of numbers, NULL without terms.

    If ``rows`` are partitioned by the first key, nothing is shuffled. Terms that the texts of a row
    have in common draw their numbers once.
    """
    keys = list(keys)
    sides = range(len(texts))
    by_side = F.array(
        *(F.struct(F.lit(j).alias("side"), terms(F.coalesce(t, F.lit(""))).alias("terms")) for j, t in enumerate(texts))
    )
    weights = (
        rows.select(*keys, F.explode(by_side).alias("x"))
        .select(*keys, "x.side", F.explode("x.terms").alias("term"))
        .groupBy(*keys, "term")
        .agg(*(F.count_if(F.col("side") == j).alias(f"w{j}") for j in sides))
        .withColumns({f"l{j}": F.when(F.col(f"w{j}") > 0, F.ln(f"w{j}")) for j in sides})
    )
    drawn = weights.withColumn("draw", F.explode(F.array(*(F.lit(k) for k in range(0, samples, DRAWN)))))
    # every step is a projection of its own, or the drawn numbers would be worked out for each use again
    hashed, numbers, steps, least = {}, {}, {}, []
    for i in range(DRAWN):
        hashed[f"g{i}"] = F.expr(f"xxhash64(term, draw + {i})")
        hashed[f"h{i}"] = F.expr(f"xxhash64(draw + {i}, term)")
        numbers[f"r{i}"] = F.expr(_gamma(f"g{i}"))
        numbers[f"c{i}"] = F.expr(f"ln({_gamma(f'h{i}')})")
        numbers[f"b{i}"] = F.expr(f"(shiftrightunsigned(g{i}, 48) + 0.5D) / 65536D")
        for j in sides:
            steps[f"t{i}_{j}"] = F.expr(f"floor(l{j} / r{i} + b{i})")
            # the logarithm of the value as a whole number, and 32 bits that stand for (term, t) behind it
            value = f"CAST((c{i} - r{i} * (t{i}_{j} - b{i} + 1D) + 128D) * 8388608D AS BIGINT)"
            held = f"(term ^ (t{i}_{j} * 2654435761L)) & 4294967295L"
            least.append(F.expr(f"min(shiftleft({value}, 32) | ({held}))").alias(f"s{i}_{j}"))
    per_draw = drawn.withColumns(hashed).withColumns(numbers).withColumns(steps).groupBy(*keys, "draw").agg(*least)

    def collected(j: int) -> Column:
        at = F.array(*(F.struct((F.col("draw") + i).alias("k"), F.col(f"s{i}_{j}").alias("s")) for i in range(DRAWN)))
        every = F.array_sort(F.flatten(F.collect_list(at)))
        drawn = F.transform(F.filter(every, lambda x: x["k"] < samples), lambda x: x["s"].bitwiseAND(F.lit(4294967295)))
        return F.when(F.count(f"s0_{j}") > 0, drawn)

    return per_draw.groupBy(*keys).agg(*(collected(j).alias(t) for j, t in enumerate(texts)))


def _gamma(bits: str) -> str:
    """A Gamma(2, 1) number from 48 bits: minus the logarithm of the product of two uniform ones."""
    u = [f"((shiftrightunsigned({bits}, {at}) & 16777215L) + 0.5D)" for at in (0, 24)]
    return f"({48 * math.log(2)!r}D - ln({u[0]} * {u[1]}))"


def as_text(signature: Column) -> Column:
    """Eight hexadecimal digits for each sample; empty without samples."""
    digits = F.transform(signature, lambda s: F.lpad(F.hex(s), 8, "0"))
    return F.coalesce(F.array_join(digits, ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal samples; 1 for two documents without terms, 0 if only one has none."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.size(a)
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(same)


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Rows (``doc_id``, text_id, fingerprint), one for each different row of ``docs``.

    ``text_id`` is a hash of the text; equal texts have equal fingerprints. NULL and empty texts,
    and those without a letter or digit, have the empty fingerprint. Other columns are not looked at.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("id"), F.xxhash64(body).alias("text_id"), body.alias("body"))
    rows = rows.dropDuplicates(["id", "text_id"])
    found = signatures(rows, ["id", "text_id"], ["body"], samples)
    found = found.select(F.col("id").alias("_id"), F.col("text_id").alias("_text_id"), F.col("body").alias("sig"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_id") == F.col("_text_id"))
    return rows.join(found, same, "left").select(F.col("id").alias(doc_id), "text_id", as_text(F.col("sig")).alias("fingerprint"))


def in_ranges(docs: DataFrame, *, doc_id: str, text: str) -> DataFrame:
    """The documents dealt out by ranges of ids, each range with the document that follows it.

    Rows (id, body, range, guest, wrap): ids fall in a range; the largest id of a range is a guest in
    the range above, which it follows in descending order, and the largest of all is one in the lowest
    range, behind all others (``wrap``). Limits of ranges are ids, which a hash of the ids selects.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    size = rows.agg(F.sum(F.length("body")).alias("chars"), F.count("id").alias("n"), F.max("id").alias("last")).first()
    partitions = min(MOST_PARTITIONS, max(1, math.ceil((size["chars"] or 0) / PARTITION_CHARS)))
    wanted = partitions * RANGES
    every = max(1, (size["n"] or 0) // (wanted * 4))
    drawn = (
        rows.where(F.col("id").isNotNull() & (F.pmod(F.xxhash64("id"), F.lit(every)) == 0)).select("id").distinct()
    )
    ids = sorted(r["id"] for r in drawn.collect())  # about 4 for each range
    step = max(1, len(ids) // wanted)
    limits = ids[step - 1 :: step]
    limits = [x for x in limits if x != size["last"]]
    kind = docs.schema[doc_id].dataType.simpleString()

    place, is_limit = _place(F.col("id"), limits, kind)
    own = rows.withColumn("own", F.coalesce(place, F.lit(0)))
    homes = [F.struct(F.col("own").alias("range"), F.lit(False).alias("guest"), F.lit(False).alias("wrap"))]
    above = F.struct((F.col("own") + 1).alias("range"), F.lit(True).alias("guest"), F.lit(False).alias("wrap"))
    lowest = F.struct(F.lit(0).alias("range"), F.lit(True).alias("guest"), F.lit(True).alias("wrap"))
    homes.append(F.when(F.coalesce(is_limit, F.lit(False)), above))
    homes.append(F.when(F.col("id").eqNullSafe(F.lit(size["last"]).cast(kind)), lowest))
    return (
        own.withColumn("home", F.explode(F.array_compact(F.array(*homes))))
        .select("id", "body", "home.*")
        .repartition(partitions, "range")
    )


def _place(id_: Column, limits: list, kind: str) -> tuple[Column, Column]:
    """(how many limits are below an id, whether it is one), found by rows of limits and then within one."""
    if not limits:
        return F.lit(0), F.lit(False)
    width = math.ceil(math.sqrt(len(limits)))
    lists = [limits[i : i + width] for i in range(0, len(limits), width)]
    ends = F.from_json(F.lit(json.dumps([x[-1] for x in lists], default=str)), f"array<{kind}>")
    table = F.from_json(F.lit(json.dumps(lists, default=str)), f"array<array<{kind}>>")
    row = F.size(F.filter(ends, lambda x: x < id_))
    inside = F.get(table, row)
    below = F.when(inside.isNull(), F.lit(0)).otherwise(F.size(F.filter(inside, lambda x: x < id_)))
    place = F.least(row * width, F.lit(len(limits))) + below
    return place, F.array_contains(inside, id_)


def edited_fingerprints(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", samples: int = SAMPLES
) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, with likenesses.

    In the edited text the last third of the code points (rounded down) gives way to the first as
    many, or all, of the next document: that with the next smaller id, after the smallest the one with
    the largest. Rows (``doc_id``, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next), one for every row of ``docs``.

    NULL and empty texts are empty and have empty fingerprints. Rows with the same id follow each
    other by a hash of their text; rows without an id come last. A single document follows itself.
    Other columns are not looked at, an empty table gives an empty result.
    """
    order = Window.partitionBy("range").orderBy("wrap", F.desc_nulls_last("id"), F.xxhash64("body"), "guest")
    dealt = in_ranges(docs, doc_id=doc_id, text=text)
    placed = dealt.withColumns({"pos": F.row_number().over(order), "next": F.lead("body").over(order)})
    n = F.length("body")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("body", F.lit(1), n - cut), F.substring(F.coalesce("next", F.lit("")), F.lit(1), cut))
    whole = placed.withColumn("edited", edited)
    found = signatures(whole, ["range", "pos"], ["body", "edited"], samples)
    found = found.withColumnsRenamed({"body": "sig", "edited": "edited_sig"})
    facts = whole.select("range", "pos", "id", "guest", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    following = Window.partitionBy("range").orderBy("pos")
    joined = facts.join(found, ["range", "pos"], "left").withColumn("next_sig", F.lead("sig").over(following))
    return joined.where(~F.col("guest")).select(
        F.col("id").alias(doc_id),
        "n_chars",
        "edited_sha256",
        as_text(F.col("sig")).alias("fingerprint"),
        as_text(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
    )

"""N-gram Jaccard join by MinHash banding.

Equal word sequences are one text with copies. The texts' sets of word n-grams get MinHash
signatures; texts that agree in all rows of a band share a bucket. Texts that buckets connect are
compared on their full n-gram sets, in blocks of bounded size, and no pair is ever a row: a block
gives the number of links of each text and the links that hold it together. Sets whose sizes alone rule the
similarity out do not meet: a class is cut by size first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.llm.common import ensure_checkpoint_dir, fresh, list_chunks
from promolens.llm.graph import components

WORDS, SIMILARITY = 5, 0.8
#: Chance to meet in a band that a pair of just the wanted similarity has at least; hashes at most.
RECALL, MOST_HASHES = 0.999, 96
#: Texts and words in one side of a block, about.
BLOCK_TEXTS, BLOCK_WORDS = 500, 250_000
#: N-grams that a task works on at a time, and cells of a matrix when texts are compared.
CHUNK, CELLS = 500_000, 2_000_000


def bands_for(similarity: float = SIMILARITY, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows in a band, so the fewest false candidates, that reach the recall."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - similarity)), 1)
    for rows in range(2, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))
        if bands * rows <= most:
            best = (bands, rows)
    return best


def word_hashes(text: Column) -> Column:
    """The hashes of a text's words in order: runs of letters and digits, lower-cased; none for NULL."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.array_remove(words, ""), lambda w: F.xxhash64(w))


_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngrams(words: np.ndarray, row: np.ndarray, rows: int, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The hashed n-grams of all rows and the row of each; fewer than n words are one shorter n-gram."""
    words = words.astype(np.int64).view(np.uint64)
    size = np.bincount(row, minlength=rows)
    start = np.cumsum(size) - size
    first = np.repeat(start, size)
    at = np.arange(len(words)) - first
    own = size[row] if len(row) else size[:0]
    begins = at < np.maximum(own - n + 1, 1)  # of an n-gram
    where = np.flatnonzero(begins)
    total = np.zeros(len(where), np.uint64)
    end = (first + own)[where]
    for i in range(n):
        inside = where + i < end
        word = np.where(inside, words[np.minimum(where + i, len(words) - 1)] if len(words) else 0, np.uint64(0))
        total = _mixed(total + word + _STEP)
    return total, row[where]


def set_sizes(grams: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """How many different n-grams each row has."""
    order = np.lexsort((grams, row))
    grams, row = grams[order], row[order]
    fresh_ = np.ones(len(grams), bool)
    fresh_[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
    return np.bincount(row[fresh_], minlength=rows)


def signature_bands(grams: np.ndarray, row: np.ndarray, rows: int, bands: int, per_band: int) -> np.ndarray:
    """(rows, bands) hashes of the bands' minima; rows must be ascending and each have an n-gram."""
    rng = np.random.default_rng(20231)
    starts = np.searchsorted(row, np.arange(rows))
    out = np.empty((rows, bands), np.uint64)
    for b in range(bands):
        total = np.full(rows, b * int(_STEP) % 2**64, np.uint64)
        for _ in range(per_band):
            flip, by = rng.integers(0, 1 << 63, 2, dtype=np.uint64)
            low = np.minimum.reduceat((grams ^ flip) * (by | np.uint64(1)), starts)
            total = _mixed(total + low)
        out[:, b] = total
    return out


def signed(docs: DataFrame, *, doc_id: str, text: str, n: int, bands: int, per_band: int) -> DataFrame:
    """Rows (id, text_id, node, words, grams, bands) for every document; words and different n-grams are counted.

    ``node`` stands for the sequence of words; a text without words has node 0 and no bands.
    """
    id_type = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(3)
            count = np.diff(np.asarray(column.offsets))
            lists: list = [None] * batch.num_rows
            sizes = np.zeros(batch.num_rows, np.int64)
            for words, row, first, last in list_chunks(column, CHUNK):
                grams, of = ngrams(words, row, last - first, n)
                sizes[first:last] = set_sizes(grams, of, last - first)
                filled, of = np.unique(of, return_inverse=True)
                if len(filled):
                    found = signature_bands(grams, of, len(filled), bands, per_band)
                    for i, values in zip(filled.tolist(), found.view(np.int64)):
                        lists[first + i] = values
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(count, pa.int64()), pa.array(sizes), pa.array(lists, pa.list_(pa.int64()))],
                names=["id", "text_id", "node", "words", "grams", "bands"],
            )

    words = word_hashes(F.col(text))
    hashed = docs.select(
        F.col(doc_id).alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_id"), words.alias("words")
    )
    hashed = hashed.select("id", "text_id", F.when(F.size("words") > 0, F.xxhash64("words")).otherwise(0).alias("node"), "words")
    schema = f"id {id_type}, text_id bigint, node bigint, words bigint, grams bigint, bands array<bigint>"
    return hashed.mapInArrow(run, schema)


def shared_ngrams(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many n-grams each of the left sets has in common with each of the right ones."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets)), sizes)
    _, gram, count = np.unique(flat, return_inverse=True, return_counts=True)
    common = count[gram] > 1  # an n-gram of one text alone adds to no pair
    place = np.full(len(count), -1)
    place[count > 1] = np.arange(int((count > 1).sum()))
    gram, of = place[gram[common]], of[common]
    order = np.argsort(gram, kind="stable")
    gram, of = gram[order], of[order]
    out = np.zeros((len(left), len(right)), np.float32)
    at_left, at_right = np.full(len(sets), -1), np.full(len(sets), -1)
    at_left[left], at_right[right] = np.arange(len(left)), np.arange(len(right))
    width = max(64, CELLS // max(1, len(left) + len(right)))
    total = int(gram[-1]) + 1 if len(gram) else 0
    for first in range(0, total, width):
        a, b = np.searchsorted(gram, [first, first + width])
        g, o = gram[a:b] - first, of[a:b]
        one = np.zeros((len(left), width), np.float32)
        two = np.zeros((len(right), width), np.float32)
        one[at_left[o][at_left[o] >= 0], g[at_left[o] >= 0]] = 1
        two[at_right[o][at_right[o] >= 0], g[at_right[o] >= 0]] = 1
        out += one @ two.T
    return out


def _linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, similarity: float) -> np.ndarray:
    both = shared_ngrams(sets, left, right)
    sizes = np.fromiter(map(len, sets), np.float64, len(sets))
    either = sizes[left][:, None] + sizes[right][None, :] - both
    return both >= similarity * either - 1e-6


def _forest(n: int, pairs: np.ndarray) -> list[tuple[int, int]]:
    """Pairs that connect what all pairs connect."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for a, b in pairs.tolist():
        ra, rb = find(a), find(b)
        if ra != rb:
            root[max(ra, rb)] = min(ra, rb)
            kept.append((a, b))
    return kept


def compare_block(block: pd.DataFrame, similarity: float, n: int) -> pd.DataFrame:
    """Links in a block: a row (node, other, documents, texts) per text with its counts, ``other`` NULL,
    and one for each link that is needed to hold the block's texts together.

    Of a component that lies in several blocks only the pairs of the block's two parts count, or
    those within its part if these are the same.
    """
    out = []
    for _, own in block.groupby("root", sort=False):
        words = [np.asarray(w, np.int64) for w in own["words"]]
        row = np.repeat(np.arange(len(words)), [len(w) for w in words])
        grams, of = ngrams(np.concatenate(words), row, len(words), n)
        sets = [np.unique(g) for g in np.split(grams, np.searchsorted(of, np.arange(1, len(words))))]
        part = own["part"].to_numpy()
        first, second = int(own["first"].iloc[0]), int(own["second"].iloc[0])
        left, right = np.flatnonzero(part == first), np.flatnonzero(part == second)
        if not len(left) or not len(right):
            continue
        hit = _linked(sets, left, right, similarity)
        if first == second:
            np.fill_diagonal(hit, False)
        node, copies = own["node"].to_numpy(), own["copies"].to_numpy()
        counts = [(left, hit)] if first == second else [(left, hit), (right, hit.T)]
        for mine, met in counts:
            partners = copies[right if mine is left else left]
            out.append(
                pd.DataFrame({"node": node[mine], "other": None, "documents": met @ partners, "texts": met.sum(1)})
            )
        pairs = np.argwhere(np.triu(hit) if first == second else hit)
        kept = _forest(len(node), np.stack([left[pairs[:, 0]], right[pairs[:, 1]]], 1))
        if kept:
            a, b = np.array(kept).T
            out.append(pd.DataFrame({"node": node[a], "other": node[b], "documents": 0, "texts": 0}))
    if not out:
        return pd.DataFrame({"node": [], "other": [], "documents": [], "texts": []})
    out = pd.concat([o.astype({"other": "Int64"}) for o in out])
    return out[(out["texts"] > 0) | out["other"].notna()]


def jaccard_join(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    n: int = WORDS,
    recall: float = RECALL,
) -> DataFrame:
    """Rows (id, text_id, class_node, class_id, n_copies, n_links) for every row of ``docs``.

    A class is what links of at least ``similarity`` connect; ``class_id`` is the smallest id in it
    and ``class_node`` its key. ``n_copies`` counts the rows with the same words, itself included,
    ``n_links`` the other rows that the row is linked with, copies included. Copies are always
    found; a pair of different texts of just the wanted similarity is found with probability
    ``recall``, one above with a higher one, and a link that is found is always right.

    Words are runs of letters and digits, lower-cased; fewer than ``n`` words are one shorter
    n-gram. Texts without words, NULL among them, are copies of each other. ``id`` may be NULL or
    repeated: rows are told apart by it and by ``text_id``, a hash of the text; a class without any
    id has a NULL ``class_id``. Words and texts are compared as 64-bit hashes. Other columns are not
    looked at, an empty table gives an empty result.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    bands, per_band = bands_for(similarity, recall)
    rows = signed(docs, doc_id=doc_id, text=text, n=n, bands=bands, per_band=per_band).checkpoint()
    texts = rows.groupBy("node").agg(
        F.count("*").alias("copies"),
        F.min(F.struct("id", "text_id")).alias("sample"),
        F.min("id").alias("least"),
        F.first("words").alias("words"),
        F.first("grams").alias("grams"),
    )
    roots, links = _connected(docs, rows, texts, doc_id=doc_id, text=text, similarity=similarity, n=n)
    known = (
        texts.select("node", "copies", "least")
        .join(roots, "node", "left")
        .join(links, "node", "left")
        .select("node", F.coalesce("root", "node").alias("root"), "copies", "least", F.coalesce("documents", F.lit(0)).alias("near"))
        .checkpoint()
    )
    named = known.groupBy("root").agg(F.min("least").alias("class_id"))
    classes = known.join(named, "root")
    return rows.select("id", "text_id", "node").join(classes, "node").select(
        "id",
        "text_id",
        F.col("root").alias("class_node"),
        "class_id",
        F.col("copies").alias("n_copies"),
        (F.col("copies") - 1 + F.col("near")).cast("long").alias("n_links"),
    )


def _connected(
    docs: DataFrame, rows: DataFrame, texts: DataFrame, *, doc_id: str, text: str, similarity: float, n: int
) -> tuple[DataFrame, DataFrame]:
    """(node, root) of the linked texts and (node, documents), the copies of the texts each is linked with."""
    banded = rows.where("bands IS NOT NULL").groupBy("node").agg(F.first("bands").alias("bands"))
    buckets = banded.select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("least"), F.count("*").alias("size")).where("size > 1")
    candidates = components(buckets.join(shared, "bucket").select(F.col("node").alias("a"), F.col("least").alias("b")))

    # Sets can only be linked if they are on one level or on neighbouring ones: a level is the ratio of sizes that
    # the similarity allows. A component that is no single block is cut by level, and a level into parts.
    width = max(-math.log(similarity) * (1 + 1e-9), 1e-9)
    members = candidates.join(texts.select("node", "copies", "sample", "words", "grams"), "node").withColumn(
        "level", F.floor(F.ln(F.greatest("grams", F.lit(1))) / width)
    )
    parts = F.greatest(F.ceil(F.col("n") / BLOCK_TEXTS), F.ceil(F.col("all_words") / BLOCK_WORDS), F.lit(1)).cast("int")
    sizes = members.groupBy("root", "level").agg(F.count("*").alias("n"), F.sum("words").alias("all_words"))
    by_level = Window.partitionBy("root").orderBy("level")  # some dozens of levels
    whole = Window.partitionBy("root")

    def beside(step: int) -> Column:
        there = F.lead("level", step).over(by_level) == F.col("level") + step
        return F.when(there, F.lead("parts", step).over(by_level)).otherwise(0)

    sizes = sizes.withColumn("parts", parts).withColumns({"above": beside(1), "below": beside(-1)})
    totals = {c: F.sum(c).over(whole) for c in ("n", "all_words")}
    sizes = sizes.withColumns(totals).withColumn("single", parts == 1).drop("n").checkpoint()
    in_single = sizes.where("single").dropDuplicates(["root"]).agg(F.sum("all_words")).first()[0] or 0
    bins = max(1, math.ceil(in_single / BLOCK_WORDS))

    def labels(level: Column, count: Column) -> Column:
        """Numbers for the parts of a level."""
        every = F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), lambda i: F.shiftleft(level, 24) + i)
        return F.when(count > 0, every).otherwise(F.array().cast("array<bigint>"))

    level = F.col("level")
    partners = F.concat(
        labels(level, F.col("parts")), labels(level + 1, F.col("above")), labels(level - 1, F.col("below"))
    )
    own = F.shiftleft(level, 24) + F.pmod(F.xxhash64("node", F.lit(7)), F.col("parts"))
    alone = F.array(F.lit(0).cast("long"))
    placed = (
        members.drop("words", "grams")
        .join(sizes.drop("all_words"), ["root", "level"])
        .withColumn("part", F.when(F.col("single"), F.lit(0).cast("long")).otherwise(own))
        .withColumn("with", F.explode(F.when(F.col("single"), alone).otherwise(partners)))
        .withColumn("first", F.least("part", "with"))
        .withColumn("second", F.greatest("part", "with"))
        .withColumn(
            "block",
            F.when(F.col("single"), F.pmod(F.xxhash64("root"), F.lit(bins))).otherwise(
                F.xxhash64("root", "first", "second")
            ),
        )
        .select("block", "root", "part", "first", "second", "node", "copies", "sample")
    )
    # the texts of those members only, each read once however many blocks it is in
    wanted = members.select(F.col("node").alias("_node"), F.col("sample.id").alias("_id"), F.col("sample.text_id").alias("_text_id"))
    mine = docs.select(
        F.col(doc_id).alias("id"), F.col(text).alias("body"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_id")
    )
    found = (
        mine.join(wanted, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_id") == F.col("_text_id")))
        .select("_node", "body")
        .groupBy("_node")
        .agg(F.first("body").alias("body"))
        .select(F.col("_node").alias("node"), word_hashes(F.col("body")).alias("words"))
    )
    blocks = placed.drop("sample").join(found, "node")
    compared = (
        blocks.groupBy("block")
        .applyInPandas(
            lambda block: compare_block(block, similarity, n), "node long, other long, documents long, texts long"
        )
        .checkpoint()
    )
    roots = components(compared.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    links = compared.where("other IS NULL").groupBy("node").agg(F.sum("documents").alias("documents"))
    return roots, links


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each class the row with the smallest id stays.

    A NULL id comes before all others; of rows with the same id and text one stays. ``how`` is
    passed on to ``jaccard_join``.
    """
    joined = jaccard_join(docs, doc_id=doc_id, text=text, **how)
    kept = joined.groupBy("class_node").agg(F.min(F.struct("id", "text_id")).alias("kept"))
    kept = kept.select(F.col("kept.id").alias("_kept_id"), F.col("kept.text_id").alias("_kept_text"))
    id_, text_id = fresh(docs, "_id"), fresh(docs, "_text_id")
    whole = docs.withColumns({id_: F.col(doc_id), text_id: F.xxhash64(F.coalesce(text, F.lit("")))})
    same = F.col(id_).eqNullSafe(F.col("_kept_id")) & (F.col(text_id) == F.col("_kept_text"))
    return whole.join(kept, same, "left_semi").dropDuplicates([id_, text_id]).drop(id_, text_id)

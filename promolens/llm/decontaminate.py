"""Benchmark decontamination by q-gram counts in diagonal bands.

A text that holds a benchmark item of n characters with at most k edits shares at least
n + 1 - q - kq of its q-grams with it, and the shared ones lie on diagonals (place in the text minus
place in the item) that differ by at most k. So the q-grams that a document shares with an item are
counted in overlapping bands of diagonals; regions that reach the bound are aligned within their
band, and those with at most k edits are reported. Items with fewer than q characters are looked up
as they stand, between the words of the text.

A benchmark of one block is handed to all tasks. Of a larger one the q-grams are joined with those of the
documents, which a bit array has let pass, so that the documents are read once for all items; the pairs of document and item with a
band that reaches the bound are then searched as those of a block are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from promolens.llm.common import chunks, fresh, store
from promolens.operators.key_filter import key_bits, may_hold

#: Characters in a q-gram; edits per character of an item.
Q, EDITS = 8, 0.1
#: Characters of benchmark items that are handed to all tasks; of a larger benchmark the q-grams are joined.
BLOCK_CHARS = 4_000_000
#: Bits for each q-gram of a larger benchmark, and the most bits in all (64 MB); a full array lets more q-grams into the join.
BITS_EACH, MOST_BITS = 12, 1 << 29
#: Characters of documents that a task works on at a time.
TASK_CHARS = 2_000_000
#: Cells of an alignment matrix that is filled at a time.
CELLS = 4_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
MATCHES = "item_id {item}, start bigint, end bigint, edits bigint"


@lru_cache(maxsize=1)
def _is_word() -> np.ndarray:
    """For each code point whether it is a letter or digit."""
    out = np.zeros(0x110000, np.bool_)
    out[[i for i in range(0x110000) if chr(i).isalnum()]] = True
    return out


def normalised(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points, lower-cased, each run of other characters than letters and digits as one space,
    none at the ends; and the place of each in the text."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    word = _is_word()[codes]
    keep = word.copy()
    keep[1:] |= word[:-1]  # the first character behind a word is its space
    places = np.flatnonzero(keep)
    out = np.where(word[places], codes[places], np.uint32(32))
    if len(out) and out[-1] == 32:
        out, places = out[:-1], places[:-1]
    return out, places


def _string(codes: np.ndarray) -> str:
    return codes.astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")


def gram_hashes(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """A hash of the q characters from each place on."""
    if len(codes) < q:
        return np.empty(0, np.uint64)
    out, done, power = codes.astype(np.uint64) + np.uint64(1), 1, int(_BASE)
    whole = out
    # doubles the length while it can, then adds single characters
    while done * 2 <= q:
        out = out[:-done] * np.uint64(power) + out[done:]
        power, done = power * power % 2**64, done * 2
    for i in range(done, q):
        out = out[: len(whole) - i] * _BASE + whole[i:]
    return out ^ (out >> np.uint64(29))


class Items:
    """The q-grams of some benchmark items."""

    def __init__(self, ids: list, texts: list[str], q: int = Q, edits: float = EDITS):
        self.q = q
        every = [(i, normalised(t)[0]) for i, t in zip(ids, texts)]
        kept = [(i, c) for i, c in every if len(c) >= q]
        self.ids, self.codes = [i for i, _ in kept], [c for _, c in kept]
        # items without a q-gram, behind the others in ids, by their text
        self.short: dict[str, list[int]] = {}
        for i, c in every:
            if 0 < len(c) < q:
                self.short.setdefault(_string(c), []).append(len(self.ids))
                self.ids.append(i)
        self.short_words = sorted({x.count(" ") + 1 for x in self.short})
        n = np.array([len(c) for c in self.codes], np.int64)
        self.size = n
        # as many edits as leave a bound of one q-gram
        self.budget = np.minimum((n * edits).astype(np.int64), (n - q) // q)
        self.bound = n + 1 - q - self.budget * q
        grams = [gram_hashes(c, q) for c in self.codes]
        flat = np.concatenate([*grams, np.empty(0, np.uint64)])
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([*(np.arange(len(g)) for g in grams), np.empty(0, np.int64)])
        order = np.argsort(flat, kind="stable")
        self.item, self.place = item[order], place[order]
        self.grams, self.first, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        self.maybe = np.zeros(1 << 20, np.bool_)
        self.maybe[self.grams >> np.uint64(44)] = True

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the text, item, place in the item) of all shared q-grams."""
        grams = gram_hashes(codes, self.q)
        at = np.flatnonzero(self.maybe[grams >> np.uint64(44)])
        grams = grams[at]
        found = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        known = self.grams[found] == grams
        at, found = at[known], found[known]
        count = self.count[found]
        ends = np.cumsum(count)
        entry = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count - self.first[found], count)
        return np.repeat(at, count), self.item[entry], self.place[entry]


def candidates(items: Items, codes: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, item, band) of the regions that reach an item's bound.

    ``codes`` are the characters of several documents, ``of`` the document of each. Band b of an
    item with k edits takes the diagonals from b(k + 1) to below (b + 2)(k + 1).
    """
    at, item, place = items.hits(codes)
    width = items.budget[item] + 1
    band = (at - place) // width
    doc = of[at]
    # a count that lumps bands together is no smaller than any of theirs: most hits end here
    slots = 1 << 22
    mixed = ((doc * 1_000_003 + item) * 8_191 + band) % slots
    lump = np.bincount(mixed, minlength=slots)
    both = np.maximum(lump[mixed] + lump[(mixed + 1) % slots], lump[mixed] + lump[(mixed - 1) % slots])
    likely = both >= items.bound[item]
    doc, item, band, place = doc[likely], item[likely], band[likely], place[likely]
    if not len(doc):
        return doc, item, band
    low = int(band.min()) - 1
    span = int(band.max()) - low + 1
    key = (doc * len(items.size) + item) * span + band - low
    keys, counts = np.unique(np.concatenate([key, key - 1]), return_counts=True)
    bound = items.bound[keys // span % len(items.size)]
    keys, bound = keys[counts >= bound], bound[counts >= bound]
    if not len(keys):
        return keys, keys, keys
    # where a text repeats itself a q-gram of the item is met many times, and counts once
    met = []
    for shift in (0, 1):
        nth = np.minimum(np.searchsorted(keys, key - shift), len(keys) - 1)
        in_key = keys[nth] == key - shift
        met.append(nth[in_key] * (int(items.size.max()) + 1) + place[in_key])
    each = np.unique(np.concatenate(met)) // (int(items.size.max()) + 1)
    keys = keys[np.bincount(each, minlength=len(keys)) >= bound]
    return keys // span // len(items.size), keys // span % len(items.size), keys % span + low


def align(item: np.ndarray, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(edits, start, end) of the best match of an item anywhere in each region (row of characters).

    Of equally good matches the one that ends first, and of those the shortest, is taken.
    """
    m, width = regions.shape
    step = np.arange(width + 1, dtype=np.int64)
    # a cell is edits * 2^32 + how far back the match began, so the least is also the shortest
    one, back = np.int64(1) << 32, np.int64(1)
    row = np.zeros((m, width + 1), np.int64)
    for i, c in enumerate(item):
        down = row + one  # a character of the item is missing
        across = row[:, :-1] + np.where(regions == c, 0, one) + back
        best = down
        best[:, 1:] = np.minimum(best[:, 1:], across)
        # characters of the region that the item does not have
        row = np.minimum.accumulate(best - step * (one + back), axis=1) + step * (one + back)
    end = np.argmin(row >> 32, axis=1)
    cell = row[np.arange(m), end]
    return cell >> 32, end - (cell & 0xFFFFFFFF), end


def whole_at(item: np.ndarray, region: np.ndarray) -> int:
    """Where a region first holds an item without an edit, -1 if nowhere."""
    text, wanted = region.astype(np.uint32).tobytes(), item.tobytes()
    at = text.find(wanted)
    while at % 4 and at >= 0:  # between two characters
        at = text.find(wanted, at + 1)
    return at // 4 if at >= 0 else -1


def short_matches(items: Items, codes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(item, start, end) of the items without a q-gram that are whole words of the normalised text."""
    text = _string(codes)
    ends = [i for i, c in enumerate(text) if c == " "] + [len(text)]
    starts = [0, *(i + 1 for i in ends[:-1])]
    for words in items.short_words:
        for first, last in zip(starts, ends[words - 1 :]):
            if last - first < items.q:
                for j in items.short.get(text[first:last], ()):
                    yield j, first, last


def matches(items: Items, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
    """(text, item, start, end, edits) of the items in the texts, in code points of the text.

    Of overlapping matches of one item the one with the fewest edits stays.
    """
    parts = [normalised(t) for t in texts]
    gap = np.zeros(1, np.uint32)  # in no q-gram of an item
    codes = np.concatenate([x for c, _ in parts for x in (c, gap)])
    sizes = np.array([len(c) for c, _ in parts], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    of = np.repeat(np.arange(len(texts)), sizes + 1)
    found = []
    if items.short:
        for d, (c, _) in enumerate(parts):
            found += ((d, j, 0, int(starts[d]) + a, int(starts[d]) + b) for j, a, b in short_matches(items, c))
    doc, item, band = candidates(items, codes, of) if len(items.size) else (np.empty(0, np.int64),) * 3
    for j in np.unique(item).tolist():
        mine = item == j
        n, k = int(items.size[j]), int(items.budget[j])
        low = band[mine] * (k + 1)  # where the region begins that the band's diagonals cover
        width = n + 3 * k + 2
        rows = max(1, CELLS // (width + 1))
        for a in range(0, len(low), rows):
            base, own = low[a : a + rows], doc[mine][a : a + rows]
            where = base[:, None] + np.arange(width)
            inside = (where >= starts[own][:, None]) & (where < (starts + sizes)[own][:, None])
            region = np.where(inside, codes[np.clip(where, 0, len(codes) - 1)], 0)
            # an item that is there as it stands needs no alignment
            whole = np.array([whole_at(items.codes[j], r) for r in region])
            edits, first, last = np.zeros(len(base), np.int64), whole, whole + n
            if (rest := whole < 0).any():
                edits[rest], first[rest], last[rest] = align(items.codes[j], region[rest])
            good = (edits <= k) & (last > first)
            found += zip(
                own[good].tolist(), [j] * int(good.sum()), edits[good].tolist(),
                (base + first)[good].tolist(), (base + last)[good].tolist(),
            )
    out, taken = [], {}
    for d, j, edits, first, last in sorted(set(found)):
        others = taken.setdefault((d, j), [])
        if any(first < e and s < last for s, e in others):
            continue
        others.append((first, last))
        places = parts[d][1]
        begin = places[first - starts[d]]
        out.append((d, j, int(begin), int(places[last - 1 - starts[d]]) + 1, edits))
    return out


def benchmark_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    q: int = Q,
    edits: float = EDITS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Rows (``doc_id``, kept columns, item_id, start, end, edits): benchmark items found in documents.

    Texts are compared lower-cased, with any run of other characters than letters and digits as one
    space; ``start`` and ``end`` (exclusive) are code points of the document's own text. An item
    matches with up to ``edits`` times its length of insertions, deletions and replacements of
    characters, less for items so short that the q-gram bound would be empty. Items with fewer than
    ``q`` characters match without edits, as whole words.

    Empty and NULL texts hold nothing and, as items, are never found. Repeated documents are all reported; so are repeated items. Other columns are
    left out.
    """
    size = benchmark.agg(F.coalesce(F.sum(F.length(item_text)), F.lit(0))).first()[0]
    carried = [doc_id, *keep]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(carried).schema)
    schema = f"{kept}, {MATCHES.format(item=benchmark.schema[item_id].dataType.simpleString())}"
    item_type = to_arrow_type(benchmark.schema[item_id].dataType)
    rows = docs.select(*carried, text)
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("item")).where("item IS NOT NULL")
    if size <= BLOCK_CHARS:
        return rows.mapInArrow(_finder(_shared(items, q, edits), carried, item_type), schema)
    # items without a q-gram, few characters each, are looked up as one block
    short = F.udf(lambda t: len(normalised(t)[0]) < q, "boolean")
    marked = store(items.withColumn("short", short("item")))
    out = _joined_matches(rows, marked.where("NOT short").select("item_id", "item"), carried, text, schema, q, edits)
    few = marked.where("short").select("item_id", "item")
    return out if few.isEmpty() else out.unionAll(rows.mapInArrow(_finder(_shared(few, q, edits), carried, item_type), schema))


def _shared(items: DataFrame, q: int, edits: float):
    held = items.orderBy("item_id", "item").collect()  # about BLOCK_CHARS characters
    return items.sparkSession.sparkContext.broadcast(Items([r[0] for r in held], [r[1] for r in held], q, edits))


def _joined_matches(
    rows: DataFrame, items: DataFrame, carried: list[str], text: str, schema: str, q: int, edits: float
) -> DataFrame:
    """What ``_finder`` finds for items of any size in all, by a join of q-grams."""
    numbered = store(items.withColumn("nth", F.monotonically_increasing_id()))
    grams = store(numbered.select("nth", "item").mapInArrow(_item_grams(q, edits), "gram long, nth long, place long, width long, bound long"))
    bits = _gram_bits(grams, grams.count())
    body = F.coalesce(text, F.lit(""))
    # the same text in many rows is searched once
    texts = rows.select(body.alias("body")).withColumns({"h1": F.xxhash64("body"), "h2": F.xxhash64(F.lit(1), "body")})
    places = texts.mapInArrow(_text_grams(bits, q), "gram long, h1 long, h2 long, at long")
    hits = places.join(grams, "gram")
    band = F.floor((F.col("at") - F.col("place")) / F.col("width"))
    near = (
        hits.withColumn("band", F.explode(F.array(band, band - 1)))
        .groupBy("h1", "h2", "nth", "band", "bound")
        .agg(F.count_distinct("place").alias("met"))
        .where("met >= bound")
        .select("h1", "h2", "nth")
        .distinct()
    )
    wanted = store(near.join(numbered, "nth").groupBy("h1", "h2").agg(F.collect_list(F.struct("item_id", "item")).alias("items")))
    h1, h2, held = (fresh(rows, name) for name in ("_h1", "_h2", "_items"))
    keyed = rows.withColumns({h1: F.xxhash64(body), h2: F.xxhash64(F.lit(1), body)})
    few = keyed.where(may_hold(key_bits(wanted, "h1"), F.col(h1)))
    pairs = few.join(wanted.withColumnsRenamed({"h1": h1, "h2": h2, "items": held}), [h1, h2])
    item_type = to_arrow_type(items.schema["item_id"].dataType)
    return pairs.select(*carried, text, held).mapInArrow(_pair_finder(carried, item_type, q, edits), schema)


def _item_grams(q: int, edits: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for nth, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                one = Items([nth], [body], q, edits)
                gram = gram_hashes(one.codes[0], q).view(np.int64)
                same = [np.full(len(gram), x, np.int64) for x in (nth, one.budget[0] + 1, one.bound[0])]
                yield pa.record_batch(
                    [pa.array(x) for x in (gram, same[0], np.arange(len(gram)), same[1], same[2])],
                    ["gram", "nth", "place", "width", "bound"],
                )

    return run


def _gram_bits(grams: DataFrame, count: int):
    """A broadcast bit array of the q-grams."""
    slots = 1 << max(6, min(math.ceil(math.log2(max(count * BITS_EACH, 2))), int(math.log2(MOST_BITS))) - 6)
    at = F.pmod("gram", F.lit(slots * 64))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
    found = grams.groupBy(F.shiftright(at, 6).alias("slot")).agg(F.bit_or(one).alias("mask")).toArrow()
    bits = np.zeros(slots, np.uint64)
    bits[found["slot"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return grams.sparkSession.sparkContext.broadcast(bits)


def _text_grams(bits, q: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = bits.value
        mask = np.uint64(64 * len(held) - 1)
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for body, h1, h2 in zip(*columns, strict=True):
                gram = gram_hashes(normalised(body)[0], q)
                low = gram & mask
                at = np.flatnonzero(held[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63)) & np.uint64(1))
                if len(at):
                    same = [np.full(len(at), h, np.int64) for h in (h1, h2)]
                    yield pa.record_batch(
                        [pa.array(x) for x in (gram[at].view(np.int64), *same, at)], ["gram", "h1", "h2", "at"]
                    )

    return run


def _pair_finder(carried: list[str], item_type: pa.DataType, q: int, edits: float):
    names = [*carried, "item_id", "start", "end", "edits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.column(len(carried)).to_pylist(), batch.column(len(carried) + 1).to_pylist()
            for nth, (body, some) in enumerate(zip(texts, lists, strict=True)):
                own = Items([x["item_id"] for x in some], [x["item"] for x in some], q, edits)
                for _, j, start, end, off in matches(own, [body or ""]):
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(batch.column(i).slice(nth, 1) for i in range(len(carried))),
                            pa.array([own.ids[j]], item_type),
                            *(pa.array([x], pa.int64()) for x in (start, end, off)),
                        ],
                        names=names,
                    )

    return run


def _finder(shared, carried: list[str], item_type: pa.DataType):
    names = [*carried, "item_id", "start", "end", "edits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(len(carried)).to_pylist()]
            for part in chunks(texts, TASK_CHARS):
                found = matches(items, texts[part]) if len(items.ids) else []
                if not found:
                    continue
                d, j, start, end, edits = (list(x) for x in zip(*found))
                at = pa.array([part.start + i for i in d])
                own = [batch.column(i).take(at) for i in range(len(carried))]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array([items.ids[i] for i in j], item_type), *(pa.array(x, pa.int64()) for x in (start, end, edits))],
                    names=names,
                )

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found; see ``benchmark_matches``.

    Rows are told apart by their id and text, so a clean row stays although another with its id goes.
    """
    id_, text_id = fresh(docs, "_id"), fresh(docs, "_text_id")
    whole = docs.withColumns({id_: F.col(doc_id), text_id: F.xxhash64(F.coalesce(text, F.lit("")))})
    found = benchmark_matches(whole.select(id_, text_id, text), benchmark, doc_id=id_, text=text, keep=(text_id,), **how)
    found = found.select(F.col(id_).alias("_found_id"), F.col(text_id).alias("_found_text")).distinct()
    same = F.col(id_).eqNullSafe(F.col("_found_id")) & (F.col(text_id) == F.col("_found_text"))
    return whole.join(found, same, "left_anti").drop(id_, text_id)

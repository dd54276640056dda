"""Substring dedup: words in windows that occur more than once are removed.

Levels of window lengths, each twice the one before it, end at the wanted length. At every level a
window of the wanted length is represented by the one of its parts of the level's length that has the smallest hash,
the first of equal ones. Equal windows are represented by equal parts at the same place in them, so a
window whose part occurs but once cannot be repeated. Only the windows that are left go on to the
next level, with the text around them, until none is left or the level is the windows themselves,
of which all that are left are counted, by 128 bits of hash.

Parts are counted by an aggregation that also carries the place of one of them. For a part that occurs once that is
its place, so the places of the lone ones come out of it without a join, however often others occur.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import chunks, fresh, store

#: Words in a window, and the least words in a part of the first level.
WINDOW, FIRST_LEVEL = 35, 8

_U = np.uint64


def level_lengths(window: int, least: int = FIRST_LEVEL) -> list[int]:
    """Lengths of the levels: the window, and halves of it, rounded up, of at least ``least`` words.

    Two parts of one level that overlap by a word at most cover a part of the next.
    """
    lengths = [window]
    while (half := -(-lengths[0] // 2)) >= max(least, 1) and half < lengths[0]:
        lengths.insert(0, half)
    return lengths


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Words:
    """The words of some texts in a row, with two hashes of each; ``row`` is the text that a word is in."""

    def __init__(self, texts: Sequence[bytes | None], window: int) -> None:
        split = [(t or b"").split() for t in texts]  # at space and tab to carriage return
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        self.words = list(itertools.chain.from_iterable(split))
        self.row = np.repeat(np.arange(len(split)), sizes)
        self.place = np.arange(len(self.words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        index = {word: i for i, word in enumerate(dict.fromkeys(self.words))}
        ids = np.fromiter(map(index.__getitem__, self.words), np.int64, len(self.words))
        digests = b"".join(map(xxhash.xxh3_128_digest, index))
        self.hashes = np.frombuffer(digests, _U).reshape(-1, 2)[ids]
        last = max(0, len(ids) - window + 1)
        #: Where a window begins that lies in one text.
        self.starts = np.flatnonzero(self.row[:last] == self.row[window - 1 :][:last])

    def parts(self, lane: int, lengths: Sequence[int]) -> np.ndarray:
        """Hashes of the parts of the last of the lengths, at each word, doubled from the first."""
        words = self.hashes[:, lane]
        found = np.zeros(max(0, len(words) - lengths[0] + 1), _U)
        for i in range(lengths[0]):
            found = _mixed(found * _U(3) + words[i : i + len(found)])
        for half, length in itertools.pairwise(lengths):
            step = length - half
            found = _mixed(found[: max(0, len(found) - step)] * _U(3) + found[step:])
        return found

    def chosen(self, lengths: Sequence[int], window: int) -> np.ndarray:
        """Where the part begins that represents each window of ``starts``."""
        if not len(self.starts):
            return self.starts
        every = np.lib.stride_tricks.sliding_window_view(self.parts(0, lengths), window - lengths[-1] + 1)
        return self.starts + np.concatenate(
            [every[some].argmin(axis=1) for some in np.array_split(self.starts, 1 + len(self.starts) // 50_000)]
        )


def _is_lone(words: _Words, at: np.ndarray, start: np.ndarray, lone: pa.Array) -> np.ndarray:
    """Whether the places ``at`` are among the lone ones of their texts."""
    lists = lone.fill_null([]) if lone.null_count else lone
    flat = np.asarray(lists.flatten())
    of = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths()))
    rows = words.row[at]
    return np.isin((rows << 40) + start[rows] + words.place[at], (of << 40) + flat)


def _columns(batch: pa.RecordBatch, part: slice) -> tuple[pa.RecordBatch, list[bytes]]:
    own = batch.slice(part.start, part.stop - part.start)
    return own, own.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()


def _parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
        for part in chunks([t or "" for t in texts]):
            yield _columns(batch, part)


def _placed(own: pa.RecordBatch, words: _Words, at: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    """Rows (id, text_id, pos, columns) for places in the texts."""
    rows = words.row[at]
    pos = own["start"].to_numpy()[rows] + words.place[at]
    given = [own["id"].take(pa.array(rows)), own["text_id"].take(pa.array(rows)), pa.array(pos)]
    return pa.record_batch([*given, *map(pa.array, columns.values())], ["id", "text_id", "pos", *columns])


def _counted_parts(lengths: Sequence[int], window: int):
    """A task: (id, text_id, start, text) in, the place and hash of each part that is counted out."""
    whole = lengths[-1] == window

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, texts in _parts_of(batches):
            words = _Words(texts, window)
            at = words.starts if whole else np.unique(words.chosen(lengths, window))
            h1 = words.parts(0, lengths)[at]
            h2 = words.parts(1, lengths)[at] if whole else np.zeros(len(at), _U)
            yield _placed(own, words, at, h1=h1.view(np.int64), h2=h2.view(np.int64))

    return task


def _left_windows(lengths: Sequence[int], window: int):
    """A task: texts with their lone parts in, the stretches of text with windows that are left out."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, texts in _parts_of(batches):
            words = _Words(texts, window)
            lone = _is_lone(words, words.chosen(lengths, window), own["start"].to_numpy(), own["lone"])
            first, last = _stretches(words.starts[~lone], words.row)
            held = [b" ".join(words.words[a : b + window]).decode() for a, b in zip(first, last, strict=True)]
            yield _placed(own, words, first, text=pa.array(held, pa.string()))

    return task


def _covered(lengths: Sequence[int], window: int):
    """A task: texts with their lone windows in, the ranges of words that repeated windows cover out."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, texts in _parts_of(batches):
            words = _Words(texts, window)
            lone = _is_lone(words, words.starts, own["start"].to_numpy(), own["lone"])
            first, last = _stretches(words.starts[~lone], words.row)
            yield _placed(own, words, first, size=last - first + window)

    return task


def _stretches(at: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive places in one text."""
    gap = np.flatnonzero((np.diff(at) > 1) | (np.diff(row[at]) > 0))
    return at[np.concatenate([[0], gap + 1])[: len(at)]], at[np.concatenate([gap, [len(at) - 1]])[: len(at)]]


def _same(left: DataFrame, right: DataFrame) -> Column:
    return left["id"].eqNullSafe(right["id"]) & (left["text_id"] == right["text_id"])


def _with_lone(texts: DataFrame, lengths: Sequence[int], window: int) -> DataFrame:
    """The texts with the places of those of their counted parts that occur nowhere else."""
    id_type = texts.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, text_id long, pos long, h1 long, h2 long"
    parts = texts.select("id", "text_id", "start", "text").mapInArrow(_counted_parts(lengths, window), schema)
    lone = (
        parts.groupBy("h1", "h2")
        .agg(
            F.count("*").alias("parts"),
            F.min("id").alias("id"),
            F.min("text_id").alias("text_id"),
            F.min("pos").alias("pos"),
        )
        .where("parts = 1")
        .groupBy("id", "text_id")
        .agg(F.collect_list("pos").alias("lone"))
    )
    return texts.join(lone, _same(texts, lone), "left").select(
        texts["id"], texts["text_id"], texts["start"], texts["text"], lone["lone"]
    )


def repeated_ranges(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, first_level: int = FIRST_LEVEL
) -> DataFrame:
    """Rows (id, text_id, ranges) of the documents with words in a repeated window.

    ``ranges`` has a struct (pos, size) for each stretch of such words, counted in words from 0; stretches may overlap.
    ``text_id`` is the hash of the text. What is left after each level is stored.
    """
    if window < 1:
        raise ValueError("a window has one word at least")
    id_type = docs.schema[doc_id].dataType.simpleString()
    body = F.coalesce(text, F.lit(""))
    left = docs.select(
        F.col(doc_id).alias("id"), F.xxhash64(body).alias("text_id"), F.lit(0).cast("long").alias("start"), body.alias("text")
    )
    lengths = level_lengths(window, first_level)
    for level in range(1, len(lengths)):
        schema = f"id {id_type}, text_id long, pos long, text string"
        found = _with_lone(left, lengths[:level], window).mapInArrow(_left_windows(lengths[:level], window), schema)
        left = store(found.withColumnRenamed("pos", "start"))
        if left.isEmpty():
            break
    ranges = _with_lone(left, lengths, window).mapInArrow(
        _covered(lengths, window), f"id {id_type}, text_id long, pos long, size long"
    )
    return ranges.groupBy("id", "text_id").agg(F.collect_set(F.struct("pos", "size")).alias("ranges"))


def substring_dedup(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, first_level: int = FIRST_LEVEL
) -> DataFrame:
    """The rows of ``docs`` with the kept words in ``text``, and n_words and n_removed beside it.

    Words are runs of characters other than space and tab to carriage return, unchanged. A word goes if it is in
    a window of ``window`` consecutive words whose words also start elsewhere, in another row or in the same,
    overlapping or not. Every copy goes, none is kept. Windows are judged on the texts as they are given. The words kept
    are joined by one space.

    A NULL text has no words and becomes empty, as does an empty one. Rows that share a ``doc_id``, or have none,
    are documents of their own: a repeated row repeats all its windows. Other columns are kept; n_words and
    n_removed replace columns of that name. An empty table gives an empty result.
    """
    ranges = repeated_ranges(docs, doc_id=doc_id, text=text, window=window, first_level=first_level)
    held = docs.drop("n_words", "n_removed")
    text_id, gone, id_ = (fresh(held, n) for n in ("_text_id", "_gone", "_id"))
    whole = held.withColumn(text_id, F.xxhash64(F.coalesce(text, F.lit(""))))
    ranges = ranges.select(F.col("id").alias(id_), F.col("text_id").alias(f"{text_id}_"), F.col("ranges").alias(gone))
    marked = whole.join(
        ranges, whole[doc_id].eqNullSafe(ranges[id_]) & (whole[text_id] == ranges[f"{text_id}_"]), "left"
    ).select(*held.columns, gone)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema]
    at, gone_at = held.columns.index(text), len(held.columns)
    names = [*held.columns, "n_words", "n_removed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for part in chunks([t or "" for t in texts]):
                own = batch.slice(part.start, part.stop - part.start)
                kept, counts, removed = [], [], []
                for body, ranges in zip(texts[part], own.column(gone_at).to_pylist(), strict=True):
                    words = (body or "").encode().split()
                    keep = np.ones(len(words), bool)
                    for r in ranges or ():
                        keep[r["pos"] : r["pos"] + r["size"]] = False
                    kept.append(b" ".join(itertools.compress(words, keep)).decode())
                    counts.append(len(words))
                    removed.append(len(words) - int(keep.sum()))
                columns = own.columns[:gone_at]
                columns[at] = pa.array(kept, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(counts, pa.int64()), pa.array(removed, pa.int64())],
                    names=names,
                )

    return marked.mapInArrow(run, ", ".join([*fields, "n_words long", "n_removed long"]))

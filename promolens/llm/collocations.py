"""Collocations: phrases whose words occur together far more often than their parts do.

Phrases are counted length by length. Each task keeps a HAT-trie: a shallow trie over word ids
whose leaves are hash containers of phrase ends. When a container has grown large, the next words with many
phrases there burst out of it into nodes of their own. When the trie is full, its largest subtrees leave it
whole, as runs sorted by prefix; Spark shuffles the runs by prefix and merges them there.

A phrase is as frequent as its parts at most. So only phrases are counted whose first and last
parts, one word shorter, may be frequent enough; a bit array of bounded size says which may be.
A full array lets more phrases pass and changes no result.
"""

from __future__ import annotations

import itertools
import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.llm.common import store

#: Least occurrences of a phrase, longest phrase in words, phrases returned for each language.
MIN_COUNT, MAX_WORDS, TOP = 10, 3, 2000
#: A phrase goes if a longer one that holds it has at least so many hundredths of its occurrences.
COVERED_PERCENT = 50
#: A container with more phrases bursts; a trie with more phrases or words gives subtrees away.
BURST, MOST_PHRASES, MOST_WORDS = 4096, 250_000, 300_000
#: Bytes of text that a task works on at a time.
ROUND_BYTES = 2_000_000
#: Bits for each frequent phrase, and the most bits in all (16 MB).
BITS_EACH, MOST_BITS = 12, 1 << 27
#: Places that the phrases with one prefix are dealt to, by their last word.
SPREAD = 64
#: Places of the first and the second round of the top lists.
ROUNDS = (4096, 64)

#: Ids stay below 2^21: a round adds at most half of its bytes to the words of a task.
_ID_BITS, _ID_MASK = 21, (1 << 21) - 1
_BREAKS = b".,;:!?\n\v\f\r"
_RUN = "lang string, phrase string, part long, n long"


class Trie:
    """Counts of phrases of one length. A phrase end is a whole number with a word id in every 21 bits.

    ``light`` is the node's hash container. A next word with many phrases there bursts out of it
    into a node of its own in ``heavy``.
    """

    def __init__(self, words: int, burst: int = BURST) -> None:
        self.words, self.burst = words, burst
        self.light: Counter[int] = Counter()
        self.heavy: dict[int, Trie] = {}
        self.seen = 16 * burst

    def size(self) -> int:
        return len(self.light) + sum(child.size() for child in self.heavy.values())

    def add(self, ends: np.ndarray) -> None:
        """Counts phrase ends, as often as they are there."""
        shift = _ID_BITS * (self.words - 1)
        if self.heavy:
            following = ends >> shift
            apart = np.isin(following, np.array(list(self.heavy), ends.dtype))
            some, following = ends[apart], following[apart]
            order = np.argsort(following, kind="stable")
            edges = np.flatnonzero(np.diff(following[order])) + 1
            for rows in np.split(order, edges) if len(order) else ():
                self.heavy[int(following[rows[0]])].add(some[rows] & ((1 << shift) - 1))
            ends = ends[~apart]
        if self.words > 1:
            self.light.update(ends.tolist())
        else:  # as ids are dense, an array counts them faster
            counts = np.bincount(ends) if len(ends) else ends
            held = np.flatnonzero(counts)
            light = self.light
            for end, n in zip(held.tolist(), counts[held].tolist(), strict=True):
                light[end] = light.get(end, 0) + n
        if self.words > 1 and len(self.light) > self.seen:
            self._burst(shift)
            self.seen = 2 * len(self.light) + 16 * self.burst

    def _burst(self, shift: int) -> None:
        kind = np.int64 if self.words <= 3 else object
        ends, counts = np.array(list(self.light), kind), np.array(list(self.light.values()))
        following = ends >> shift
        words, sizes = np.unique(following, return_counts=True)
        for word in words[sizes > self.burst].tolist():
            out = following == word
            child = self.heavy[word] = Trie(self.words - 1, self.burst)
            child.light.update(dict(zip((ends[out] & ((1 << shift) - 1)).tolist(), counts[out].tolist(), strict=True)))
            ends, counts, following = ends[~out], counts[~out], following[~out]
        self.light = Counter(dict(zip(ends.tolist(), counts.tolist(), strict=True)))

    def take(self, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Removes the largest subtrees until ``most`` phrases are left: (ids, counts) of them."""
        sizes = {word: child.size() for word, child in self.heavy.items()} | {None: len(self.light)}
        left = sum(sizes.values())
        for word in sorted(sizes, key=sizes.get, reverse=True):
            if left <= most:
                return
            left -= sizes[word]
            if word is None:
                ends, counts, self.light, self.seen = list(self.light), list(self.light.values()), Counter(), 16 * self.burst
            else:
                ends, counts = [], []
                self.heavy.pop(word).collect(word, ends, counts)
            if ends:
                yield _unpacked(ends, self.words), np.array(counts, np.int64)

    def collect(self, head: int, ends: list[int], counts: list[int]) -> None:
        """The phrase ends below the node, behind those that lead to it, and their counts."""
        high = head << _ID_BITS * self.words
        ends.extend(high | end for end in self.light)
        counts.extend(self.light.values())
        for word, child in self.heavy.items():
            child.collect(head << _ID_BITS | word, ends, counts)


def _packed(ids: np.ndarray) -> np.ndarray:
    packed = ids[:, 0].astype(object) if ids.shape[1] > 3 else ids[:, 0]
    for place in range(1, ids.shape[1]):
        packed = packed << _ID_BITS | ids[:, place]
    return packed


def _unpacked(ends: list[int], words: int) -> np.ndarray:
    packed = np.array(ends, np.int64 if words <= 3 else object)
    ids = np.empty((len(ends), words), np.int64)
    for place in range(words):
        ids[:, place] = (packed >> _ID_BITS * (words - 1 - place)) & _ID_MASK
    return ids


_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
_CLEAN = _LOWER.translate(bytes.maketrans(_BREAKS + b"\t", b"\n" * len(_BREAKS) + b" "))


def split_words(texts: list[str]) -> list[bytes]:
    """The words of all texts in order, A-Z lower-cased, and a line feed between two pieces."""
    raw = "\n".join(texts).encode("utf-8", "surrogatepass").translate(_CLEAN)
    return [word for word in raw.replace(b"\n", b" \n ").split(b" ") if word]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashed(ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A hash for each row of word ids."""
    found = np.zeros(len(ids), np.uint64)
    for place in range(ids.shape[1]):
        found = _mixed(found * np.uint64(3) + hashes[ids[:, place]])
    return found


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode("utf-8", "surrogatepass"))
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words, itertools.repeat(seed)), np.uint64, len(words))


def _may_be(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the array has the bits of each hash."""
    return np.logical_and.reduce([(bits[slot] & mask) != 0 for slot, mask in _places(hashes, len(bits))])


def _places(hashes: np.ndarray, slots: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Slots of 64 bits and the bit in each, for three independent places of a hash."""
    found = []
    for turn in range(3):
        hashes = _mixed(hashes + np.uint64(0x9E3779B97F4A7C15 + turn))
        slot = (hashes >> np.uint64(6)) % np.uint64(slots)
        found.append((slot.astype(np.int64), np.uint64(1) << (hashes & np.uint64(63))))
    return found


class _Ids(dict):
    """Word to id, in the order in which words are first asked for; the break between pieces is 0."""

    def __init__(self, words: _Words, lang: str) -> None:
        super().__init__({b"\n": 0})
        self.words, self.lang = words, lang

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self.words.words)
        self.words.words.append(word)
        self.words.langs.append(self.lang)
        return found


class _Words:
    """The words of a task's trie: an id for each (language, word), and their hashes."""

    def __init__(self, allowed: np.ndarray | None) -> None:
        self.allowed = allowed
        self.ids: dict[str, _Ids] = {}
        self.words, self.langs = [b"\n"], [""]
        self.hashes = np.zeros(1, np.uint64)
        self.held = np.zeros(1, bool)

    def of(self, lang: str, words: list[bytes]) -> np.ndarray:
        """The ids of the words in order, -1 for breaks and for words that cannot be frequent enough."""
        ids = self.ids.get(lang)
        if ids is None:
            ids = self.ids[lang] = _Ids(self, lang)
        found = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
        hashes = _word_hashes(lang, self.words[len(self.hashes) :])
        self.hashes = np.concatenate([self.hashes, hashes])
        held = np.ones(len(hashes), bool) if self.allowed is None else _may_be(self.allowed, _mixed(hashes))
        self.held = np.concatenate([self.held, held])
        found[~self.held[found]] = -1
        return found

    def size(self) -> int:
        return len(self.words)


def _counted(length: int, bits, most_phrases: int, most_words: int, burst: int):
    """A task: batches of (lang, text) in, sorted runs of (lang, phrase, part, n) out.

    For single words one row without a phrase gives all occurrences of a language.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_words, of_parts = (None, None) if not bits else (bits[0].value, bits[-1].value)
        trie, words = Trie(length, burst), _Words(of_words)
        totals: Counter[str] = Counter()
        for lang, texts in _by_language(batches):
            found = split_words(texts)
            ids = words.of(lang, found)
            if length == 1:
                totals[lang] += len(found) - found.count(b"\n")
            starts = np.flatnonzero(ids >= 0)
            for place in range(1, length):
                starts = starts[: np.searchsorted(starts, len(ids) - place)]
                starts = starts[ids[starts + place] >= 0]
            if length > 2:
                starts = starts[_frequent_parts(ids, starts, length, words.hashes, of_parts)]
            if len(starts):
                trie.add(_packed(np.stack([ids[starts + i] for i in range(length)], axis=1)))
            if words.size() > most_words:  # ids begin anew, so nothing may stay
                yield from _emitted(trie.take(0), words)
                trie, words = Trie(length, burst), _Words(of_words)
            elif trie.size() > most_phrases:
                yield from _emitted(trie.take(most_phrases // 2), words)
        yield from _emitted(trie.take(0), words)
        if length == 1 and totals:
            yield _batch(list(totals), [None] * len(totals), [0] * len(totals), list(totals.values()))

    return task


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    """Some texts of a language at a time, about ``ROUND_BYTES`` in all languages."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch["text"]).to_numpy())
        first = 0
        while first < batch.num_rows:
            past = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, past + ROUND_BYTES, "right")))
            some = pa.table(batch.slice(first, last - first))
            for lang in pc.unique(some["lang"]).to_pylist():
                yield lang, some.filter(pc.equal(some["lang"], lang))["text"].to_pylist()
            first = last


def _frequent_parts(ids, starts, length, hashes, bits) -> np.ndarray:
    """Whether the first and the last ``length - 1`` words at each start may be frequent."""
    if not len(starts):
        return np.zeros(0, bool)
    part = length - 1
    spans = np.lib.stride_tricks.sliding_window_view(ids, part)
    needed = np.zeros(len(spans), bool)
    needed[starts] = needed[starts + 1] = True
    needed = np.flatnonzero(needed)
    fits = np.zeros(len(spans), bool)
    fits[needed] = _may_be(bits, _hashed(spans[needed], hashes))
    return fits[starts] & fits[starts + 1]


def _emitted(subtrees, words: _Words) -> Iterator[pa.RecordBatch]:
    """Runs sorted by prefix, of subtrees put together to some thousand rows."""
    langs = texts = hashes = None
    held: list[tuple[np.ndarray, np.ndarray]] = []
    rows = 0

    def run():
        ids = np.concatenate([i for i, _ in held])
        counts = np.concatenate([n for _, n in held])
        parts = [texts.take(pa.array(ids[:, place])) for place in range(ids.shape[1])]
        phrase = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary()))
        last = hashes[ids[:, -1]]
        if ids.shape[1] > 1:
            last = _hashed(ids[:, :-1], hashes) + last % np.uint64(SPREAD)
        part = _mixed(last).view(np.int64)
        order = pa.array(np.argsort(part, kind="stable"))
        lang = langs.take(pa.array(ids[:, 0]))
        return _batch(*(pa.array(c).take(order) for c in (lang, phrase.cast(pa.large_string()), part, counts)))

    for ids, counts in subtrees:
        if langs is None:
            langs = pa.array(words.langs, pa.string()).dictionary_encode()
            texts, hashes = pa.array(words.words, pa.large_binary()), words.hashes
        held.append((ids, counts))
        rows += len(ids)
        if rows >= 20_000:
            yield run()
            held, rows = [], 0
    if held:
        yield run()


def _batch(lang, phrase, part, n) -> pa.RecordBatch:
    types = (pa.string(), pa.string(), pa.int64(), pa.int64())
    columns = [pa.array(c) if isinstance(c, list) else c for c in (lang, phrase, part, n)]
    return pa.record_batch([c.cast(t) for c, t in zip(columns, types, strict=True)], ["lang", "phrase", "part", "n"])


def _bit_array(phrases: DataFrame, count: int):
    """A broadcast bit array of the phrases: at most ``MOST_BITS``, whatever their number."""
    slots = min(max(64, count * BITS_EACH), MOST_BITS) // 64

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang in pc.unique(batch["lang"]).to_pylist():
                own = batch.filter(pc.equal(batch["lang"], lang))["phrase"].cast(pa.binary()).to_pylist()
                words = [word for phrase in own for word in phrase.split(b" ")]  # as many in each phrase
                at = np.arange(len(words)).reshape(len(own), -1)
                for slot, mask in _places(_hashed(at, _word_hashes(lang, words)), slots):
                    yield pa.record_batch([pa.array(slot), pa.array(mask.view(np.int64))], ["slot", "mask"])

    marked = phrases.select("lang", "phrase").mapInArrow(places, "slot long, mask long")
    found = marked.groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    bits = np.zeros(slots, np.uint64)
    bits[found["slot"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return phrases.sparkSession.sparkContext.broadcast(bits)


def phrase_counts(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    most_phrases: int = MOST_PHRASES,
    most_words: int = MOST_WORDS,
    burst: int = BURST,
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, n) of every phrase of up to ``max_words`` words with ``min_count``
    occurrences, and (lang, n) with all word occurrences of every language; both are stored.

    The rows of a prefix are dealt to ``SPREAD`` places, so a very common one is no single task.
    """
    whole = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(text, F.lit("")).alias("text")
    )
    lengths, totals, bits = [], None, []
    for length in range(1, max_words + 1):
        runs = whole.mapInArrow(_counted(length, bits, most_phrases, most_words, burst), _RUN)
        merged = runs.repartition("lang", "part").groupBy("lang", "part", "phrase").agg(F.sum("n").alias("n"))
        kept = merged.where((F.col("n") >= min_count) | F.col("phrase").isNull())
        found = store(kept.select("lang", "phrase", F.lit(length).alias("words"), "n"))
        if length == 1:
            totals = found.where("phrase IS NULL").select("lang", "n")
        found = found.where("phrase IS NOT NULL")
        lengths.append(found)
        if length < max_words:
            bits.append(_bit_array(found, found.count()))
    for array in bits:
        array.unpersist()
    counts = lengths[0]
    for longer in lengths[1:]:
        counts = counts.unionAll(longer)
    return counts, totals


def collocations(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    top: int = TOP,
    covered_percent: int = COVERED_PERCENT,
    **limits: int,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the ``top`` phrases of every language.

    Texts are lower-cased (A-Z) and split at ``. , ; : ! ?``, line feed to carriage return into
    pieces and those at spaces and tabs into words; a phrase lies within a piece. ``a`` is how often it occurs, ``n`` the number of
    words of its language. A cut after k words gives ``l`` and ``r``, the occurrences of both parts, and the score
    floor(1,000,000 a a / (l r)); the lowest-scoring cut counts, the first of equal ones. A phrase goes if a
    longer one with ``min_count`` occurrences holds it and has ``covered_percent`` of its
    occurrences. Order: score, ``a``, phrase in byte order.

    A NULL text is empty, a NULL language is ``und``. Repeated rows count as often as they occur. An empty
    table, or one without a frequent phrase, gives no row. Other columns are not read. Products are DECIMAL:
    exact for up to 10^12 occurrences, an error beyond.
    """
    counts, totals = phrase_counts(
        docs, text=text, lang=lang, min_count=min_count, max_words=max_words, **limits
    )
    words = F.split("phrase", " ")
    candidates = counts.where("words >= 2").withColumnRenamed("n", "a")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest"),
    )
    for part, count in (("first", "l"), ("rest", "r")):
        known = counts.select("lang", F.col("phrase").alias(part), F.col("n").alias(count))
        cuts = cuts.join(known, ["lang", part])  # regrouped below, so a part of very many phrases may be split
    best = (
        cuts.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
        .groupBy("lang", "phrase")
        .agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut"))
        .select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.score")
    )
    inside = candidates.where("words >= 3").select(
        "lang",
        F.col("a").alias("longer"),
        F.explode(
            F.flatten(
                F.transform(
                    F.sequence(F.lit(2), F.col("words") - 1),
                    lambda size: F.transform(
                        F.sequence(F.lit(1), F.col("words") - size + 1),
                        lambda at: F.array_join(F.slice(words, at, size), " "),
                    ),
                )
            )
        ).alias("phrase"),
    )
    cover = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    covered = F.col("longer").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * covered_percent
    kept = best.join(cover, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False))).drop("longer")
    return _top(kept, top).join(F.broadcast(totals), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )


def _score(a: Column, left: Column, right: Column) -> Column:
    a, left, right = (c.cast("decimal(13,0)") for c in (a, left, right))
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * a * a, left * right)


def _top(df: DataFrame, top: int) -> DataFrame:
    """The first rows of every language with their rank, in rounds of fewer and fewer places."""
    order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    for places in ROUNDS:
        df = df.withColumn("_place", F.pmod(F.xxhash64("phrase"), F.lit(places)))
        df = df.withColumn("_nth", F.row_number().over(Window.partitionBy("lang", "_place").orderBy(*order)))
        df = df.where(F.col("_nth") <= top).drop("_place", "_nth")
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top)

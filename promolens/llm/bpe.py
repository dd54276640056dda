"""BPE encoding and decoding with a lexicon of frequent words.

The corpus's most frequent words are encoded once. They become the paths of a minimal acyclic
automaton, in which words share prefixes and suffixes; the numbers on its edges add up to a word's
place in a table of token ids. The automaton is a file that Spark hands to every executor, where
tasks map it into memory. Words that it does not have are merged one by one, exactly as the
vocabulary's merge list says, so the lexicon's size never changes a result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import tempfile
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import chunks

#: Words in the lexicon at most, and code points in one of them. The file stays under 10 MB.
LEXICON_WORDS, LEXICON_CHARS = 100_000, 24
#: Words that a task remembers beside the lexicon before it forgets them all.
MEMO_WORDS = 200_000
#: Characters that are encoded at a time. Their words are short strings, some 35 bytes of memory a character.
ENCODE_CHARS = 500_000
#: From so many symbols on, merges are taken from a heap.
HEAP_FROM = 48
CODES = 0x110000

OUTPUT = {
    "n_tokens": "bigint",
    "ids": "array<int>",
    "decoded": "string",
    "ids_sha256": "string",
    "decoded_sha256": "string",
}


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


class Merger:
    """Tokens of single words after a vocabulary file of the BPE kind with word ends."""

    def __init__(self, spec: dict):
        model, self.added = spec["model"], {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        marks = byte_characters()
        self.inner = [vocab[c] for c in marks]
        self.last = [vocab[c + end] for c in marks]
        self.none = (len(model["merges"]), -1)
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for i, (a, b) in enumerate(model["merges"]):
            self.rank[vocab[a], vocab[b]] = (i, vocab[a + b])
        self.tokens = [""] * (1 + max(max(vocab.values()), *self.added.values()))
        for token, i in chain(vocab.items(), self.added.items()):
            self.tokens[i] = token
        pieces = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.piece = regex.compile(pieces)
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None

    def words(self, text: str) -> list[str]:
        """The text's words as they are encoded: composed, lower-cased, split; added tokens whole."""
        if self.split is None or not self.split.search(text):
            return self._words(text)
        out: list[str] = []
        for i, part in enumerate(self.split.split(text)):
            out.extend([part] if i % 2 else self._words(part))
        return out

    def _words(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final form
        return self.piece.findall(text.lower())

    def ids(self, word: str) -> list[int]:
        if word in self.added:
            return [self.added[word]]
        data = word.encode()
        symbols = [self.inner[b] for b in data]
        symbols[-1] = self.last[data[-1]]
        return self._long(symbols) if len(symbols) >= HEAP_FROM else self._short(symbols)

    def _short(self, symbols: list[int]) -> list[int]:
        """The first of the lowest-ranked pairs is merged until none is left."""
        rank, none = self.rank, self.none
        ranks = [rank.get(pair, none) for pair in zip(symbols, symbols[1:])]
        while ranks and (best := min(ranks)) is not none:
            at = ranks.index(best)
            symbols[at : at + 2] = [best[1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank.get((symbols[at - 1], best[1]), none)
            if at < len(ranks):
                ranks[at] = rank.get((best[1], symbols[at + 1]), none)
        return symbols

    def _long(self, symbols: list[int]) -> list[int]:
        after = [*range(1, len(symbols)), -1]
        before = [*range(-1, len(symbols) - 1)]
        alive = [True] * len(symbols)
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (hit := self.rank.get((symbols[i], symbols[j]))):
                heapq.heappush(heap, (hit[0], i, symbols[i], symbols[j], hit[1]))

        for i in range(len(symbols) - 1):
            offer(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j < 0 or symbols[i] != a or symbols[j] != b:
                continue
            symbols[i], alive[j] = new, False
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [s for s, on in zip(symbols, alive) if on]


def automaton(words: list[str]) -> dict[str, np.ndarray]:
    """The minimal acyclic automaton of sorted, distinct words; its edge outputs sum to a word's place."""
    register: dict[tuple, int] = {}
    edges: list[tuple] = []  # of each kept state: (final, ((char, target), ...))

    def keep(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(edges)
            edges.append(key)
        return register[key]

    path: list[list] = [[False, []]]  # open states along the last word: [final, edges]
    last = ""
    for word in chain(words, [None]):
        common = 0
        if word is not None:
            while common < min(len(word), len(last)) and word[common] == last[common]:
                common += 1
        while len(path) > common + 1:
            child = path.pop()
            path[-1][1].append((ord(last[len(path) - 1]), keep(child)))
        if word is None:
            break
        path.extend([False, []] for _ in range(len(word) - common))
        path[-1][0] = True
        last = word
    root = keep(path[0])

    count = np.zeros(len(edges), np.int64)  # targets are always kept before their source
    keys, target, out = [], [], []
    for state, (final, steps) in enumerate(edges):
        total = int(final)
        for char, to in steps:
            keys.append(state * CODES + char)
            target.append(to)
            out.append(total)
            total += count[to]
        count[state] = total
    return {
        "key": np.array(keys, np.int64),  # ascending: by state, then by character
        "target": np.array(target, np.int32),
        "out": np.array(out, np.int32),
        "final": np.array([f for f, _ in edges], np.bool_),
        "root": np.array([root], np.int32),
    }


class Lexicon:
    """The automaton and its ids as arrays that lie in one mapped file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            head = json.loads(f.read(int.from_bytes(f.read(8), "little")))
        data = np.asarray(np.memmap(path, np.uint8, "r"))  # the same mapping, cheaper to slice
        for name, (kind, start, size) in head["arrays"].items():
            setattr(self, name, data[start : start + size].view(kind))
        self.merger = Merger(head["spec"])
        self.tokens = np.array(self.merger.tokens, dtype=object)
        self.memo: dict[str, tuple[int, ...]] = {}

    @staticmethod
    def write(path: str, spec: dict, words: Iterable[str]) -> None:
        words = sorted(set(words))
        merger = Merger(spec)
        ids = [merger.ids(w) for w in words]
        arrays = automaton(words) | {
            "ids_at": np.cumsum([0, *map(len, ids)]).astype(np.int64),
            "ids_flat": np.fromiter(chain.from_iterable(ids), np.int32),
        }
        places, start = {}, 0
        for name, a in arrays.items():
            places[name] = (a.dtype.str, start, a.nbytes)
            start += -(-a.nbytes // 8) * 8
        # offsets count from the file's start, so the head is padded to a size that is known first
        room = -(-(len(json.dumps({"spec": spec})) + 4096) // 4096) * 4096
        places = {n: (k, s + room + 8, z) for n, (k, s, z) in places.items()}
        with open(path, "wb") as f:
            f.write(room.to_bytes(8, "little"))
            f.write(json.dumps({"spec": spec, "arrays": places}).encode().ljust(room))
            for name, a in arrays.items():
                f.write(a.tobytes().ljust(-(-a.nbytes // 8) * 8, b"\0"))

    def places(self, words: list[str]) -> np.ndarray:
        """Each word's place, -1 for those that the automaton does not accept."""
        out = np.full(len(words), -1, np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        live = np.flatnonzero((sizes > 0) & (sizes <= LEXICON_CHARS))
        if not len(live) or not len(self.key):
            return out
        # a NUL at the end of a word would vanish in a fixed-width array; none is ever in a lexicon
        live = live[[not words[i].endswith("\0") for i in live]]
        sizes = sizes[live]
        chars = np.array([words[i] for i in live], dtype=f"U{LEXICON_CHARS}").view(np.uint32)
        chars = chars.reshape(len(live), LEXICON_CHARS).astype(np.int64)
        state = np.full(len(live), self.root[0], np.int64)
        total = np.zeros(len(live), np.int64)
        going = np.arange(len(live))
        for at in range(LEXICON_CHARS):
            ended = sizes[going] == at
            done = going[ended & self.final[state[going]]]
            out[live[done]] = total[done]
            going = going[~ended]
            if not len(going):
                break
            wanted = state[going] * CODES + chars[going, at]
            edge = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
            there = self.key[edge] == wanted
            going, edge = going[there], edge[there]
            state[going] = self.target[edge]
            total[going] += self.out[edge]
        done = going[(sizes[going] == LEXICON_CHARS) & self.final[state[going]]]
        out[live[done]] = total[done]
        return out

    def merged(self, word: str) -> tuple[int, ...]:
        """The ids of a word that the automaton does not have."""
        found = self.memo.get(word)
        if found is None:
            found = tuple(self.merger.ids(word))
            if len(word) <= LEXICON_CHARS * 2:
                if len(self.memo) >= MEMO_WORDS:
                    self.memo.clear()
                self.memo[word] = found
        return found

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        per_text = [self.merger.words(t) for t in texts]
        counts = np.fromiter(map(len, per_text), np.int64, len(texts))
        running = pa.array(list(chain.from_iterable(per_text)), pa.large_string()).dictionary_encode()
        codes = running.indices.to_numpy(zero_copy_only=False)
        words = running.dictionary.to_pylist()

        # each distinct word's ids lie somewhere in one table: those merged here behind the lexicon's
        place = self.places(words)
        known = place >= 0
        ids = [self.merged(words[i]) for i in np.flatnonzero(~known)]
        table = np.concatenate([self.ids_flat, np.fromiter(chain.from_iterable(ids), np.int32)])
        sizes = np.empty(len(words), np.int64)
        starts = np.empty(len(words), np.int64)
        starts[known] = self.ids_at[place[known]]
        sizes[known] = self.ids_at[place[known] + 1] - starts[known]
        sizes[~known] = np.fromiter(map(len, ids), np.int64, len(ids))
        starts[~known] = len(self.ids_flat) + np.cumsum(sizes[~known]) - sizes[~known]

        of_word = sizes[codes]  # tokens of each running word
        ends = np.cumsum(of_word)
        at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - of_word - starts[codes], of_word)
        cuts = np.concatenate([[0], ends])[np.cumsum(counts)]
        return np.split(table[at], cuts[:-1]) if len(cuts) else []

    def decode(self, ids: np.ndarray) -> str:
        """The tokens' strings with a space between them: the vocabulary file names no decoder."""
        return " ".join(self.tokens[ids])


_held: dict[str, Lexicon] = {}


def _lexicon(name: str) -> Lexicon:
    """The lexicon of a file given out. A worker holds one, the last; it goes before another is read."""
    if name not in _held:
        _held.clear()
        _held[name] = Lexicon(SparkFiles.get(name))
    return _held[name]


def frequent_words(docs: DataFrame, *, text: str = "text", most: int = LEXICON_WORDS) -> list[str]:
    """The corpus's most frequent words, counted over all texts; as many as ``most`` at the most.

    Frequencies are put on a scale of 16 steps to a doubling, and the words from that step on are
    taken at which they still are not too many. So only these words come to the driver.
    """
    pieces = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"), F.lit(0))
    counted = (
        docs.select(F.explode(pieces).alias("word"))
        .where(F.length("word") <= LEXICON_CHARS)
        .groupBy("word")
        .count()
        .where("count > 1")
        .select("word", F.floor(F.log2("count") * 16).alias("step"))
        .cache()
    )
    try:
        taken, lowest = 0, None
        for row in counted.groupBy("step").count().orderBy(F.desc("step")).collect():
            taken += row["count"]
            if taken > most:
                break
            lowest = row["step"]
        if lowest is None:
            return []
        return [r["word"] for r in counted.where(F.col("step") >= lowest).select("word").collect()]
    finally:
        counted.unpersist()


def bpe(
    docs: DataFrame,
    vocabulary: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    outputs: Iterable[str] = ("n_tokens", "ids", "decoded"),
    lexicon_words: int = LEXICON_WORDS,
) -> DataFrame:
    """``doc_id`` and the outputs (of ``OUTPUT``) for every row of ``docs``.

    ``vocabulary`` is the path of a vocabulary file, read on the driver. ``ids`` are the tokens of
    the whole text without special tokens added, ``decoded`` the text that they stand for, the
    digests are SHA-256 of the ids as little-endian 32-bit integers and of the decoded text in UTF-8.

    A NULL text counts as empty and has no tokens. Repeated rows come out as often as they go in,
    other columns are left out, an empty table gives an empty result. A text is never cut.
    """
    outputs = list(outputs)
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as f:
        spec = json.load(f)
    merger = Merger(spec)
    # the count splits like the vocabulary does, nearly; what it splits otherwise is of no use here
    words = [w for w in frequent_words(docs, text=text, most=lexicon_words) if merger.words(w) == [w]]
    folder = tempfile.mkdtemp()  # Spark copies the file from here to every executor
    made = os.path.join(folder, "lexicon")
    Lexicon.write(made, spec, (w for w in words if "\0" not in w))
    with open(made, "rb") as f:
        name = f"lexicon-{hashlib.sha256(f.read()).hexdigest()[:32]}"
    if not os.path.exists(SparkFiles.get(name)):  # else a call before gave the same file out
        os.rename(made, os.path.join(folder, name))
        spark.sparkContext.addFile(os.path.join(folder, name))

    id_type = docs.schema[doc_id].dataType.simpleString()
    schema = ", ".join([f"`{doc_id}` {id_type}", *(f"{o} {OUTPUT[o]}" for o in outputs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _encoded(_lexicon(name), batches, [doc_id, *outputs])

    return docs.select(doc_id, text).mapInArrow(run, schema)


def _encoded(lexicon: Lexicon, batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """A task's rows, (id, text) in each batch. Words remembered for them are forgotten after the last."""
    try:
        for batch in batches:
            ids_, texts = batch.column(0), batch.column(1)
            sizes = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
            for part in chunks([range(n) for n in sizes], ENCODE_CHARS):
                n = part.stop - part.start
                own = [t or "" for t in texts.slice(part.start, n).to_pylist()]
                columns = _outputs(lexicon, own, names[1:])
                yield pa.RecordBatch.from_arrays([ids_.slice(part.start, n), *columns], names=names)
    finally:
        lexicon.memo = {}


def _outputs(lexicon: Lexicon, texts: list[str], outputs: list[str]) -> list[pa.Array]:
    ids = lexicon.encode(texts)
    decoded = [lexicon.decode(i) for i in ids] if any(o.startswith("decoded") for o in outputs) else []
    sha = lambda data: hashlib.sha256(data).hexdigest()
    make = {
        "n_tokens": lambda: pa.array([len(i) for i in ids], pa.int64()),
        "ids": lambda: pa.array(ids, pa.list_(pa.int32())),
        "decoded": lambda: pa.array(decoded, pa.string()),
        "ids_sha256": lambda: pa.array([sha(i.astype("<u4").tobytes()) for i in ids]),
        "decoded_sha256": lambda: pa.array([sha(d.encode()) for d in decoded]),
    }
    return [make[o]() for o in outputs]

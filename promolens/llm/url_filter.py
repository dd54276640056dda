"""URL filter: allow and block rules held in Bloom filter cascades.

A cascade answers "is this key listed?" without error for every key of a known universe. Its first
level is a Bloom filter over the listed keys. The second holds the universe's keys that the first
takes for listed and are not, the third the listed keys that the second takes for those, and so on
until a level lets nothing wrong through. The universe here is complete: every key that any url of
the corpus can ask for.

The levels are arrays of 64-bit words, so a lookup is a column expression and needs no join. Those of the rules, which
are given in the program, are literals; those of a table of hosts are stored and read as subqueries, so
that the plan stays small however long the list is.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import ascii_lower, fresh, store

#: Bits for each key of a level, and hash functions for them.
BITS_PER_KEY, HASHES = 10, 4
#: Words that stand together in a level.
CHUNK = 4096


@dataclass(frozen=True)
class Rule:
    """``path`` begins with the slash; a rule fits its host and every subdomain."""

    action: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty without ``://`` or url."""
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), "^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://`` or url."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def candidate_keys(host: Column, path: Column, shapes: Sequence[tuple[int, int]]) -> Column:
    """The keys a url can match: its last n labels and first m path characters, longest key first.

    ``shapes`` lists the (n, m) that occur among the listed keys; a url without so many labels or
    characters has no key of that shape.
    """
    labels = F.split(host, r"\.")
    keys = [
        F.when(
            (F.size(labels) >= n) & (F.length(path) >= m),
            F.concat(
                F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), F.lit(n)), "."),
                F.substring(path, 1, m),
            ),
        )
        for n, m in shapes
    ]
    found = F.array_distinct(F.array_compact(F.array(*keys))) if keys else F.array().cast("array<string>")
    return F.transform(
        F.array_sort(F.transform(found, lambda k: F.struct((-F.length(k)).alias("short"), k.alias("key")))),
        lambda s: s["key"],
    )


def shapes_of(keys: DataFrame) -> list[tuple[int, int]]:
    """Distinct (labels, path characters) of the listed keys: bounded by how long keys can be."""
    host = F.regexp_extract("key", "^[^/]*", 0)
    rows = keys.select(
        F.size(F.split(host, r"\.")).alias("n"), (F.length("key") - F.length(host)).alias("m")
    ).distinct()
    return sorted((r["n"], r["m"]) for r in rows.collect())


class Cascade:
    """Exact membership of the universe's keys in the listed ones.

    ``levels`` has (bits, array of chunks of words) for each level; level i answers for listed keys where i is even.
    An empty list has no levels and contains nothing. Keys outside the universe may get a wrong
    answer, like in any Bloom filter.
    """

    def __init__(self, levels: list[tuple[int, Column]]):
        self.levels = levels

    @classmethod
    def build(cls, listed: DataFrame, universe: DataFrame, *, literal: bool = False) -> Cascade:
        """Both have a string column ``key``. With ``literal`` the levels are part of the plan, else they are stored."""
        every = listed.select("key", F.lit(True).alias("on")).unionAll(universe.select("key", F.lit(False).alias("on")))
        keys = store(every.where("key IS NOT NULL").groupBy("key").agg(F.max("on").alias("on")))
        levels: list[tuple[int, Column]] = []
        mine, others = keys.where("on"), keys.where("NOT on")
        while count := mine.count():
            bits = 64 * math.ceil(count * BITS_PER_KEY / 64)
            words = _level(mine, len(levels), bits)
            levels.append((bits, _as_literal(words) if literal else store(words).agg(_in_order("chunk", "words")).scalar()))
            mine, others = others.where(_passes(F.col("key"), len(levels) - 1, *levels[-1])), mine
        return cls(levels)

    def contains(self, key: Column) -> Column:
        """The first level that refuses a key decides; a key that passes all is what the last holds."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            answer = F.when(~_passes(key, i, *self.levels[i]), F.lit(i % 2 == 1)).otherwise(answer)
        return answer


def _bit(key: Column, level: int, nth: int, bits: int) -> Column:
    """The nth bit of a key in a level; levels hash differently, or one's errors would be the next's."""
    return F.pmod(F.xxhash64(key, F.lit(level * HASHES + nth)), F.lit(bits))


def _in_order(place: str, value: str) -> Column:
    return F.transform(F.sort_array(F.collect_list(F.struct(place, value))), lambda s: s[value]).alias(value)


def _level(keys: DataFrame, level: int, bits: int) -> DataFrame:
    """The words of a level's bit array, in chunks: (chunk, words)."""
    at = keys.select(F.explode(F.array(*(_bit(F.col("key"), level, i, bits) for i in range(HASHES)))).alias("bit"))
    set_ = at.select(F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, CAST(bit % 64 AS INT))").alias("value"))
    blank = keys.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("value"))
    words = set_.unionAll(blank).groupBy("word").agg(F.bit_or("value").alias("words"))
    return words.groupBy(F.floor(F.col("word") / CHUNK).alias("chunk")).agg(_in_order("word", "words"))


def _as_literal(words: DataFrame) -> Column:
    held = [r["words"] for r in words.orderBy("chunk").collect()]
    return F.from_json(F.lit(json.dumps(held)), "array<array<bigint>>")  # folded into one literal


def _passes(key: Column, level: int, bits: int, chunks: Column) -> Column:
    out = F.lit(True)
    for i in range(HASHES):
        bit = _bit(key, level, i, bits)
        word = F.shiftright(bit, 6)
        held = F.get(F.get(chunks, F.floor(word / CHUNK).cast("int")), (word % CHUNK).cast("int"))
        out = out & (F.getbit(held, (bit % 64).cast("int")) == 1)
    return out


def url_filter(
    pages: DataFrame,
    rules: Sequence[Rule],
    listed_hosts: DataFrame,
    *,
    url: str = "url",
) -> DataFrame:
    """Adds host, path, rule and verdict to the rows of ``pages``.

    The longest rule that fits a url gives its verdict. Without one, a url whose host, or a domain
    above it, is among ``listed_hosts`` (column ``host``) is blocked, any other allowed. Of two
    rules with the same key, block wins; of two different ones of equal length the first in byte order.

    A NULL url, or one without ``://``, has an empty host and path and so neither rule nor listed
    host: allowed. Repeated rows are judged alike, an empty table gives an empty result. Columns of
    ``pages`` that are called like a new one are replaced; other columns are kept.
    """
    name = fresh(pages, "_rule_keys")
    judged = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})

    keys = pages.sparkSession.createDataFrame([(r.action, r.key) for r in rules], "action string, key string")
    hosts = listed_hosts.select(ascii_lower(F.col("host")).alias("key")).where("key != ''")
    of_rules = candidate_keys(F.col("host"), F.col("path"), shapes_of(keys))
    of_hosts = [_last_labels(F.col("host"), n) for n in sorted({n for n, _ in shapes_of(hosts)})]
    judged = judged.withColumn(name, of_rules)
    asked_rules = judged.select(F.explode(name).alias("key"))
    asked_hosts = judged.select(F.explode(F.array(*of_hosts) if of_hosts else F.array().cast("array<string>")).alias("key"))

    is_rule = Cascade.build(keys, asked_rules, literal=True)
    is_block = Cascade.build(keys.where("action = 'block'"), asked_rules, literal=True)
    is_host = Cascade.build(hosts, asked_hosts, literal=False)
    rule = F.try_element_at(F.filter(name, is_rule.contains), F.lit(1))
    on_list = F.lit(False)
    for key in of_hosts:
        on_list = on_list | (key.isNotNull() & is_host.contains(key))
    by_rule = F.when(is_block.contains(F.col("rule")), "block").otherwise("allow")
    judged = judged.withColumn("rule", rule).withColumn(
        "verdict",
        F.when(F.col("rule").isNotNull(), by_rule).otherwise(F.when(on_list, "block").otherwise("allow")),
    )
    return judged.drop(name)


def _last_labels(host: Column, n: int) -> Column:
    """The last n labels of a host, NULL if it has fewer."""
    labels = F.split(host, r"\.")
    return F.when(F.size(labels) >= n, F.substring_index(host, ".", -n))


#: Words in host names of sites that are not wanted in a corpus.
UNWANTED_WORDS = ("adult", "ads", "bets", "casino", "pills", "porn", "spam", "viagra", "warez")
#: A page with fewer code points outside its markup is thin; a host is thin if more than so many percent of its pages are.
THIN_CHARS, THIN_PERCENT = 1000, 25
#: Scripts, styles and tags.
MARKUP = "(?s)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<[^>]*>"


def unwanted_hosts(pages: DataFrame, *, url: str = "url", words: Sequence[str] = UNWANTED_WORDS) -> DataFrame:
    """The corpus's hosts that have one of the words as a part of a label, without their subdomains."""
    host = host_of(F.col(url))
    named = rf"(?:^|\.)((?:[^.]*-)?(?:{'|'.join(words)})(?:-[^.]*)?\..*)$"
    return (
        pages.select(F.regexp_extract(host, named, 1).alias("host")).where("host != ''").distinct()
    )


def thin_hosts(
    pages: DataFrame, *, url: str = "url", page: str = "html", chars: int = THIN_CHARS, percent: int = THIN_PERCENT
) -> DataFrame:
    """The corpus's hosts of which more than ``percent`` of the pages have fewer than ``chars`` code points of text.

    A NULL page has none. Urls without a host are left out.
    """
    size = F.length(F.regexp_replace(F.coalesce(page, F.lit("")), MARKUP, ""))
    counted = pages.select(host_of(F.col(url)).alias("host"), (size < chars).cast("int").alias("thin")).where("host != ''")
    share = counted.groupBy("host").agg(F.sum("thin").alias("thin"), F.count("*").alias("pages"))
    return share.where(F.col("thin") * 100 > F.col("pages") * percent).select("host")

"""Secret scan: regular expressions behind a trigram index.

Every rule's pattern is read once to derive which trigrams a match must contain, as alternatives of
trigram sets. The index has a posting (trigram, document) for each of those trigrams; a rule's
candidates are the documents in whose postings one alternative is complete, and only they are
searched with the pattern. A rule that no trigram is mandatory for searches all documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as sre
from re import _parser as sre_parser

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.llm.common import ascii_lower

#: Strings that a part of a pattern may stand for and still be listed one by one.
MOST_STRINGS = 256
SPANS = "array<struct<start:bigint,nth:int,end:bigint,kind:string>>"


@dataclass(frozen=True)
class SecretRule:
    """Matches of ``pattern``, leftmost and not overlapping, whose ``group`` has ``min_chars`` at least."""

    kind: str
    pattern: str
    group: int = 0
    min_chars: int = 1


#: The kinds and patterns that callers agree on.
BASE_RULES = (
    SecretRule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        min_chars=6,
    ),
    SecretRule("access", r"AKIA[A-Z0-9]+", min_chars=20),
    # a run of 24 or more is found the same way as any run that is then measured
    SecretRule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    SecretRule("hub", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    SecretRule("chat", r"xox[abps]-[A-Za-z0-9-]{10,}"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    SecretRule("cloud", r"AIza[A-Za-z0-9_-]{35}"),
    SecretRule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)


def mandatory_trigrams(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives of lower-case trigrams, one of which any matching text has whole; None: no such."""
    return _of_sequence(sre_parser.parse(pattern))


def _strings(nodes: Iterable) -> set[str] | None:
    """All strings that the nodes can match, lower-cased, where these are few."""
    found = {""}
    for op, arg in nodes:
        one: set[str] | None = None
        if op is sre.LITERAL:
            one = {chr(arg).lower()}
        elif op is sre.IN:
            one = _characters(arg)
        elif op is sre.SUBPATTERN:
            one = _strings(arg[-1])
        elif op is sre.BRANCH:
            parts = [_strings(part) for part in arg[1]]
            one = None if None in parts else set().union(*parts)
        elif op is sre.MAX_REPEAT and arg[1] is not sre.MAXREPEAT and arg[1] <= 4:
            inner = _strings(arg[2])
            if inner is not None and len(inner) ** arg[1] <= MOST_STRINGS:
                one = {"".join(p) for n in range(arg[0], arg[1] + 1) for p in product(inner, repeat=n)}
        if one is None or len(one) * len(found) > MOST_STRINGS:
            return None
        found = {a + b for a in found for b in one}
    return found


def _characters(parts: Iterable) -> set[str] | None:
    found: set[str] = set()
    for op, arg in parts:
        if op is sre.LITERAL:
            found.add(chr(arg).lower())
        elif op is sre.RANGE and arg[1] - arg[0] < 64:
            found.update(chr(c).lower() for c in range(arg[0], arg[1] + 1))
        else:
            return None
    return found if len(found) <= 8 else None


def _of_strings(strings: set[str]) -> list[frozenset[str]] | None:
    if min(map(len, strings)) < 3:
        return None
    return _shortest(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _shortest(alternatives: Iterable[frozenset[str]]) -> list[frozenset[str]]:
    """Without those that contain another: who has the larger set has the smaller."""
    sets = set(alternatives)
    return sorted((s for s in sets if not any(o < s for o in sets)), key=sorted)


def _both(a: list[frozenset[str]] | None, b: list[frozenset[str]] | None) -> list[frozenset[str]] | None:
    if a is None or b is None:
        return b if a is None else a
    both = _shortest(x | y for x in a for y in b)
    return both if len(both) <= MOST_STRINGS else a


def _of_sequence(nodes: Iterable) -> list[frozenset[str]] | None:
    query, run = None, []
    for node in [*nodes, None]:
        if node is not None and _strings([*run, node]) is not None:
            run.append(node)
            continue
        if run:
            query = _both(query, _of_strings(_strings(run)))
            run = []
        if node is not None:
            if _strings([node]) is not None:
                run = [node]
            else:
                query = _both(query, _of_node(*node))
    return query


def _of_node(op, arg) -> list[frozenset[str]] | None:
    if op is sre.SUBPATTERN:
        return _of_sequence(arg[-1])
    if op is sre.MAX_REPEAT and arg[0] > 0:
        return _of_sequence(arg[2])
    if op is sre.BRANCH:
        parts = [_of_sequence(part) for part in arg[1]]
        return None if None in parts else _shortest(s for part in parts for s in part)
    return None


def trigram_postings(docs: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """(id, text_id, trigram) for every one of the trigrams that a document's lower-cased text has."""
    has = F.filter(F.array(*map(F.lit, trigrams)), lambda t: F.contains(F.col("_low"), t))
    return docs.withColumn("_low", ascii_lower(F.col("body"))).select("id", "text_id", F.explode(has).alias("trigram"))


def may_match(body: Column, queries: dict[str, list[frozenset[str]]]) -> Column:
    """Whether a text has all trigrams of any rule's alternative, as ``rule_candidates`` asks of the postings."""

    def holds(low: Column) -> Column:  # lower-cased once for all of them
        choices = _shortest(choice for query in queries.values() for choice in query)
        every = [reduce(Column.__and__, [F.contains(low, F.lit(t)) for t in sorted(c, reverse=True)]) for c in choices]
        return reduce(Column.__or__, every)

    return F.exists(F.array(ascii_lower(body)), holds)


def rule_candidates(docs: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(id, text_id, kinds): the rules with an alternative all of whose trigrams the document has."""
    spark = docs.sparkSession
    wanted = [(k, i, t, len(s)) for k, q in queries.items() for i, s in enumerate(q) for t in sorted(s)]
    table = spark.createDataFrame(wanted, "kind string, choice int, trigram string, size int")
    postings = trigram_postings(docs, sorted({w[2] for w in wanted}))
    return (
        postings.join(F.broadcast(table), "trigram")  # as many rows as the rules have trigrams
        .groupBy("id", "text_id", "kind", "choice", "size")
        .agg(F.count_distinct("trigram").alias("met"))
        .where("met = size")
        .groupBy("id", "text_id")
        .agg(F.collect_set("kind").alias("kinds"))
    )


def _lengths(body: Column, rule: SecretRule) -> Column:
    """For each match the characters before it since the last one, its own, and whether it counts."""
    pattern = F.lit(rule.pattern)
    before = F.transform(F.split(body, rule.pattern, -1), F.length)
    own = F.transform(F.regexp_extract_all(body, pattern, F.lit(0)), F.length)
    held = F.transform(F.regexp_extract_all(body, pattern, F.lit(rule.group)), F.length)
    zipped = F.arrays_zip(before.alias("gap"), own.alias("own"), held.alias("held"))
    return F.transform(
        F.filter(zipped, lambda z: z["own"].isNotNull()),  # the last gap has no match behind it
        lambda z: F.struct(
            F.lit(rule.kind).alias("kind"),
            z["gap"].alias("gap"),
            z["own"].alias("own"),
            (z["held"] >= rule.min_chars).alias("counts"),
        ),
    )


def _searched(docs: DataFrame, rules: Sequence[SecretRule], only: Column | None = None) -> DataFrame:
    """Rows (id, text_id, kind, nth, gap, own, counts) for the matches in documents that have any."""
    found = []
    for rule in rules:
        wanted = F.rlike("body", F.lit(rule.pattern))
        if only is not None:
            wanted = F.array_contains(only, rule.kind) & wanted
        found.append(F.when(wanted, _lengths(F.col("body"), rule)))
    per_rule = docs.select("id", "text_id", F.explode(F.array(*found)).alias("matches"))
    return per_rule.select("id", "text_id", F.posexplode("matches").alias("nth", "m")).select(
        "id", "text_id", "nth", "m.*"
    )


def secret_spans(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", rules: Sequence[SecretRule] = BASE_RULES + MORE_RULES
) -> DataFrame:
    """Rows (id, text_id, kind, start, end): code points, end exclusive; start counts from 0.

    ``id`` is the document's id and ``text_id`` a hash of its text, so that rows which share an id
    but not a text keep their own spans. Rows that are equal in both give each span once. A NULL text is empty and
    has no span. Other columns are not looked at.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    bare = docs.select(F.col(doc_id).alias("id"), F.xxhash64(body).alias("text_id"), body.alias("body"))
    queries = {r.kind: mandatory_trigrams(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q is not None}
    parts = []
    if scanned := [r for r in rules if queries[r.kind] is None]:
        parts.append(_searched(bare, scanned))
    if indexed:
        near = rule_candidates(bare, indexed).select(
            F.col("id").alias("_id"), F.col("text_id").alias("_text_id"), "kinds"
        )
        same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_id") == F.col("_text_id"))
        # texts that cannot be among the candidates stay where they are read
        texts = bare.where(may_match(F.col("body"), indexed))
        parts.append(_searched(texts.join(near, same), [r for r in rules if r.kind in indexed], F.col("kinds")))
    rows = reduce(DataFrame.unionByName, parts).dropDuplicates(["id", "text_id", "kind", "nth"])
    so_far = Window.partitionBy("id", "text_id", "kind").orderBy("nth")
    end = F.sum(F.col("gap") + F.col("own")).over(so_far)
    return (
        rows.withColumn("end", end)
        .where("counts")
        .select("id", "text_id", "kind", (F.col("end") - F.col("own")).alias("start"), "end")
    )


def secret_scan(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", rules: Sequence[SecretRule] = BASE_RULES + MORE_RULES
) -> DataFrame:
    """One row per input row: ``doc_id`` and its spans, by start and then in the order of the rules.

    ``spans`` is an array of (start, nth, end, kind), empty where nothing was found, nth the place
    of the rule in ``rules``. NULL and empty texts have none.
    """
    place = F.element_at(F.create_map(*(F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i))), F.col("kind"))
    spans = (
        secret_spans(docs, doc_id=doc_id, text=text, rules=rules)
        .groupBy(F.col("id").alias("_id"), F.col("text_id").alias("_text_id"))
        .agg(F.array_sort(F.collect_list(F.struct("start", place.alias("nth"), "end", "kind"))).alias("spans"))
    )
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("id"), F.xxhash64(body).alias("text_id"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_id") == F.col("_text_id"))
    return rows.join(spans, same, "left").select(
        F.col("id").alias(doc_id), F.coalesce(F.col("spans").cast(SPANS), F.array().cast(SPANS)).alias("spans")
    )


def finds(rules: Sequence[SecretRule], text: str) -> list[tuple[int, int, str]]:
    """The same spans for one text, without Spark: for tests."""
    out = []
    for nth, rule in enumerate(rules):
        for m in re.finditer(rule.pattern, text):
            if len(m[rule.group]) >= rule.min_chars:
                out.append((m.start(), nth, m.end(), rule.kind))
    return [(s, e, k) for s, _, e, k in sorted(out)]

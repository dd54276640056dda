"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm.bpe import bpe
from promolens.llm.collocations import COVERED_PERCENT, MAX_WORDS, MIN_COUNT, TOP, collocations
from promolens.llm.common import table, vocabulary_path
from promolens.llm.decontaminate import benchmark_matches
from promolens.llm.fingerprints import edited_fingerprints
from promolens.llm.html_text import html_text
from promolens.llm.jaccard_join import jaccard_join
from promolens.llm.line_dedup import MIN_CHARS, MIN_DOCUMENTS, line_dedup
from promolens.llm.quality import quality
from promolens.llm.secrets import BASE_RULES, MORE_RULES, secret_scan
from promolens.llm.substring_dedup import WINDOW, substring_dedup
from promolens.llm.toxicity import toxicity
from promolens.llm.url_filter import (
    MARKUP,
    THIN_CHARS,
    THIN_PERCENT,
    UNWANTED_WORDS,
    Rule,
    thin_hosts,
    unwanted_hosts,
    url_filter,
)
from promolens.llm.whitening import whiten

#: The rules that op1 judges by.
URL_RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    listed = unwanted_hosts(pages).unionAll(thin_hosts(pages))
    judged = url_filter(pages.drop("html"), URL_RULES, listed)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _op1_sql() -> str:
    fits = " UNION ALL ".join(
        f"SELECT '{r.action}' AS action, '{r.host}' AS host, '{r.path}' AS path" for r in URL_RULES
    )
    unwanted = rf"(^|\.)([^.]*-)?({'|'.join(UNWANTED_WORDS)})(-[^.]*)?\."
    return rf"""
    WITH parts AS (
      SELECT page_id,
             CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
    cut AS (
      SELECT page_id,
             translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
      FROM parts),
    rules AS ({fits}),
    best AS (
      SELECT page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
             arg_max(r.action, length(r.host || r.path)) AS action
      FROM cut JOIN rules r
        ON (cut.host = r.host OR ends_with(cut.host, '.' || r.host)) AND starts_with(cut.path, r.path)
      GROUP BY page_id),
    thin AS (
      SELECT c.host FROM cut c JOIN pages p USING (page_id) WHERE c.host <> ''
      GROUP BY c.host
      HAVING 100 * count(*) FILTER (
        WHERE length(regexp_replace(coalesce(p.html, ''), '{MARKUP}', '', 'g')) < {THIN_CHARS}) > {THIN_PERCENT} * count(*)),
    listed AS (
      SELECT DISTINCT c.host FROM cut c
      WHERE regexp_matches(c.host, '{unwanted}')
         OR EXISTS (SELECT 1 FROM thin t WHERE c.host = t.host OR ends_with(c.host, '.' || t.host)))
    SELECT c.page_id, c.host, c.path, b.rule,
           coalesce(b.action, CASE WHEN c.host IN (SELECT host FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
    FROM cut c LEFT JOIN best b USING (page_id)
    """


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe(docs, vocabulary_path(), outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join(docs).select(F.col("id").alias("doc_id"), "class_id", "n_copies", "n_links")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality(docs, table(spark, sf_dir, "labels"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def _op5_sql() -> str:
    blank = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
    WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
    lines AS (
      SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM docs),
    keyed AS (
      SELECT *, translate(trim(line, {blank}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
      FROM lines),
    shared AS (
      SELECT k, max(doc_id) AS holder FROM keyed WHERE length(k) >= {MIN_CHARS}
      GROUP BY k HAVING count(DISTINCT doc_id) >= {MIN_DOCUMENTS}),
    marked AS (
      SELECT y.doc_id, y.pos, y.line, s.k IS NOT NULL AND s.holder <> y.doc_id AS gone
      FROM keyed y LEFT JOIN shared s USING (k))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
    """


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return benchmark_matches(docs, table(spark, sf_dir, "benchmark"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity(docs, table(spark, sf_dir, "labels"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = [r.kind for r in BASE_RULES]

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(kind):
        return F.filter("spans", lambda s: s["kind"] == kind)

    found = secret_scan(docs)
    return found.select(
        "doc_id",
        *(F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in base),
        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def _op8_sql() -> str:
    def found(nth: int, rule) -> str:
        pattern = "'" + rule.pattern.replace("'", "''") + "'"
        return f"""
          SELECT doc_id, '{rule.kind}' AS kind, {nth} AS nth, {rule.min_chars} AS least,
                 regexp_split_to_array(body, {pattern}) AS gaps, regexp_extract_all(body, {pattern}, 0) AS own,
                 regexp_extract_all(body, {pattern}, {rule.group}) AS held
          FROM docs WHERE regexp_matches(body, {pattern})"""

    rules = BASE_RULES + MORE_RULES
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in BASE_RULES)
    span = "kind || ':' || begin_at || ':' || (begin_at + size)"
    return f"""
    WITH docs AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
    found AS ({" UNION ALL ".join(found(i, r) for i, r in enumerate(rules))}),
    every AS (SELECT *, unnest(range(1, len(own) + 1)) AS i FROM found),
    spans AS (
      SELECT doc_id, kind, nth, length(own[i]) AS size,
             list_sum(list_transform(gaps[1:i], lambda x: length(x)))
               + coalesce(list_sum(list_transform(own[1:i-1], lambda x: length(x))), 0) AS begin_at
      FROM every WHERE length(held[i]) >= least)
    SELECT doc_id, {counts},
           sha256(coalesce(string_agg({span}, ',' ORDER BY begin_at, nth) FILTER (WHERE nth < {len(BASE_RULES)}), ''))
             AS base_sha256,
           coalesce(string_agg({span}, ',' ORDER BY begin_at, nth) FILTER (WHERE kind IS NOT NULL), '') AS spans
    FROM docs LEFT JOIN spans USING (doc_id) GROUP BY doc_id
    """


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_text(pages, keep=["url"])
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def _op11_sql() -> str:
    cuts = " UNION ALL ".join(
        f"SELECT *, {k} AS k, array_to_string(ws[1:{k}], ' ') AS first, array_to_string(ws[{k + 1}:], ' ') AS rest"
        f" FROM counts WHERE len(ws) > {k}"
        for k in range(1, MAX_WORDS)
    )
    phrases = " UNION ALL ".join(
        f"SELECT lang, unnest(list_transform(range(1, len(ws) - {m} + 2), lambda i: ws[i:i + {m - 1}])) AS ws FROM pieces"
        for m in range(1, MAX_WORDS + 1)
    )
    return rf"""
    WITH texts AS (
      SELECT coalesce(lang, 'und') AS lang,
             unnest(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?
-
]')) AS piece
      FROM documents),
    pieces AS (
      SELECT lang, list_filter(regexp_split_to_array(piece, '[ 	]+'), lambda w: w <> '') AS ws FROM texts),
    totals AS (SELECT lang, sum(len(ws)) AS n FROM pieces GROUP BY lang),
    counts AS (
      SELECT lang, ws, array_to_string(ws, ' ') AS phrase, count(*)::HUGEINT AS a
      FROM ({phrases}) GROUP BY lang, ws HAVING count(*) >= {MIN_COUNT}),
    cuts AS ({cuts}),
    scored AS (
      SELECT c.lang, c.phrase, c.ws, c.a, c.k, x.a AS l, y.a AS r, (1000000 * c.a * c.a) // (x.a * y.a) AS score
      FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.first
                  JOIN counts y ON y.lang = c.lang AND y.phrase = c.rest),
    best AS (
      SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    kept AS (
      SELECT b.* FROM best b
      WHERE NOT EXISTS (
        SELECT 1 FROM counts x
        WHERE x.lang = b.lang AND len(x.ws) > len(b.ws) AND 100 * x.a >= {COVERED_PERCENT} * b.a
          AND contains(' ' || x.phrase || ' ', ' ' || b.phrase || ' ')))
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank,
           phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
    FROM kept JOIN totals USING (lang)
    QUALIFY rank <= {TOP}
    """


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    every = found.select("*", F.posexplode("whitened").alias("place", "value"))
    return every.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        "n",
        F.col("deviation").cast("long").alias("deviation"),
        F.col("value").alias("whitened"),
        F.get("explained", F.col("place")).alias("explained"),
        "identity_error",
    )


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def _op13_sql() -> str:
    return rf"""
    WITH docs AS (
      SELECT row_number() OVER () AS nth, doc_id,
             list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
      FROM documents),
    windows AS (
      SELECT nth, pos, md5(array_to_string(ws[pos:pos + {WINDOW - 1}], ' ')) AS held
      FROM (SELECT nth, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS pos FROM docs)),
    again AS (SELECT held FROM windows GROUP BY held HAVING count(*) > 1),
    covered AS (
      SELECT DISTINCT nth, unnest(range(pos, pos + {WINDOW})) AS pos FROM windows
      WHERE held IN (SELECT held FROM again)),
    kept AS (
      SELECT w.nth, count(*) AS n_words, count(c.pos) AS n_removed,
             string_agg(w.word, ' ' ORDER BY w.pos) FILTER (WHERE c.pos IS NULL) AS left_over
      FROM (SELECT nth, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM docs) w
      LEFT JOIN covered c ON c.nth = w.nth AND c.pos = w.pos
      GROUP BY w.nth)
    SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
           sha256(coalesce(left_over, '')) AS kept_sha256
    FROM docs LEFT JOIN kept USING (nth)
    """


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_url_filter,
        op2_bpe,
        op3_jaccard_join,
        op4_quality,
        op5_line_dedup,
        op6_decontamination,
        op7_toxicity,
        op8_secrets,
        op9_fingerprints,
        op10_html_text,
        op11_collocations,
        op12_whitening,
        op13_substring_dedup,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_url_filter": _op1_sql(),
    "op5_line_dedup": _op5_sql(),
    "op8_secrets": _op8_sql(),
    "op11_collocations": _op11_sql(),
    "op13_substring_dedup": _op13_sql(),
}

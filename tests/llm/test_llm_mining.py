"""Collocations, whitening and substring dedup against brute force and SQL."""

import datetime as dt
import math
import re
from collections import Counter
from decimal import Decimal

import duckdb
import numpy as np
import pytest
from edge_cases import DOCUMENTS, documents
from pyspark.sql import functions as F

from promolens.llm.collocations import Trie, _packed, collocations, phrase_counts, split_words
from promolens.llm.queries import ORACLE_SQL, QUERIES
from promolens.llm.substring_dedup import level_lengths, substring_dedup
from promolens.llm.whitening import fit_points, fit_whitening, jacobi_davidson, on_grid, usable, whiten

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DATA = "/root/testdata/sf0.001"


# Collocations


def pieces_of(text):
    return [re.findall(r"[^ \t]+", p) for p in re.split(r"[.,;:!?\n\v\f\r]", (text or "").translate(LOWER))]


def brute_counts(rows, most):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        for words in pieces_of(text):
            totals[lang or "und" if lang != "" else ""] += len(words)
            for m in range(1, most + 1):
                for i in range(len(words) - m + 1):
                    counts["und" if lang is None else lang, tuple(words[i : i + m])] += 1
    return counts, totals


def brute_collocations(rows, least, most, top, covered):
    counts, totals = brute_counts(rows, most)
    found = {}
    frequent = {k: n for k, n in counts.items() if n >= least}
    for (lang, words), a in frequent.items():
        if len(words) < 2:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        longer = (
            n for (other, held), n in frequent.items()
            if other == lang and len(held) > len(words) and 100 * n >= covered * a
            and any(held[i : i + len(words)] == words for i in range(len(held)))
        )
        if next(longer, None) is None:
            found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return {
        (lang, rank, phrase.decode(), -a, left, right, totals[lang], -score)
        for lang, every in found.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(every)[:top], 1)
    }


def texts_of(rng, rows):
    words = ["the", "of", "House", "white", "é", "a", "b", "don't", "日本", "x"]
    ends = [" ", " ", " ", " ", ". ", "\n", "\t", " , ", "\r", "\v"]
    return [
        (None if i % 50 == 7 else "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.integers(0, 60))),
         [None, "en", "de", ""][rng.integers(0, 4)])
        for i in range(rows)
    ]


@pytest.mark.parametrize("most", [2, 3, 4])
def test_collocations_against_brute_force(spark, most):
    rows = texts_of(np.random.default_rng(most), 300)
    docs = spark.createDataFrame([(str(t), lang) if t is not None else (None, lang) for t, lang in rows], "text string, lang string")
    docs = docs.withColumn("phrase", F.lit("clash")).withColumn("n", F.lit(1)).repartition(4)
    for limits in ({}, {"burst": 3, "most_phrases": 40, "most_words": 1000}, {"burst": 2, "most_phrases": 9, "most_words": 12}):
        got = collocations(docs, min_count=4, max_words=most, top=25, covered_percent=60, **limits)
        assert {tuple(r) for r in got.collect()} == brute_collocations(rows, 4, most, 25, 60)
        assert got.count() == got.distinct().count()


def test_phrases_are_counted_whole(spark):
    rows = texts_of(np.random.default_rng(9), 100)
    counts, totals = phrase_counts(spark.createDataFrame(rows, "text string, lang string"), min_count=2)
    expected, words = brute_counts(rows, 3)
    assert {(r.lang, r.phrase): r.n for r in counts.collect()} == {
        (lang, " ".join(p)): n for (lang, p), n in expected.items() if n >= 2
    }
    assert {r.lang: r.n for r in totals.collect()} == dict(words)


def test_repeated_words_overlap(spark):
    docs = spark.createDataFrame([("ha " * 20, "en")], "text string, lang string")
    found = {r.phrase: r for r in collocations(docs).collect()}
    assert set(found) == {"ha ha ha"}  # 18 of 19
    assert found["ha ha ha"][3:] == (18, 20, 19, 20, 1_000_000 * 18 * 18 // (20 * 19))


def test_a_trie_bursts_and_gives_whole_subtrees():
    rng = np.random.default_rng(1)
    every = np.stack([rng.integers(0, n, 3000) for n in (5, 20, 40)], axis=1)
    trie = Trie(3, burst=10)
    for some in np.array_split(every, 7):
        trie.add(_packed(some))
    assert trie.heavy
    assert any(child.heavy for child in trie.heavy.values())
    expected = Counter(map(tuple, every.tolist()))
    assert trie.size() == len(expected)
    found, most = Counter(), len(expected) // 2
    taken = list(trie.take(most))
    first = [ids[:, 0] for ids, _ in taken]
    assert trie.size() <= most
    left = {w for w in trie.heavy}
    assert not set(trie.heavy) & set(np.concatenate(first).tolist())
    for ids, counts in [*taken, *trie.take(0)]:
        found.update(dict(zip(map(tuple, ids.tolist()), counts.tolist(), strict=True)))
    assert found == expected


def test_words_of_texts():
    words = b" ".join(split_words(["One,two\tTHREE", "", " \n", "İX.é"])).decode()
    assert words == "one \n two three \n \n \n \n İx \n é"
    assert split_words([]) == []


def test_collocations_of_odd_rows(spark):
    docs = documents(spark, clashing=True)
    rows = [(r[1], r[2]) for r in DOCUMENTS]
    got = collocations(docs, min_count=2)
    assert {tuple(r) for r in got.collect()} == brute_collocations(rows, 2, 3, 2000, 50)
    assert collocations(docs.where("false")).count() == 0
    assert collocations(docs, min_count=10**9).count() == 0


# Substring dedup


def brute_kept(texts, window):
    split = [re.findall(r"[^ \t\n\v\f\r]+", t or "") for t in texts]
    counts = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for words in split:
        keep = [True] * len(words)
        for i in range(len(words) - window + 1):
            if counts[tuple(words[i : i + window])] > 1:
                keep[i : i + window] = [False] * window
        out.append((" ".join(w for w, k in zip(words, keep, strict=True) if k), len(words), keep.count(False)))
    return out


@pytest.mark.parametrize("window", [1, 2, 5, 9, 17])
def test_substring_dedup_against_brute_force(spark, window):
    rng = np.random.default_rng(window)
    words = ["a", "b", "É", "d e", "f"] if window > 2 else [f"w{i}" for i in range(400)]
    texts = ["".join(rng.choice(words) + rng.choice([" ", "\n", "\t "]) for _ in range(rng.integers(0, 50))) for _ in range(80)]
    texts = [str(t) for t in texts]
    texts += [texts[0], texts[1] + texts[2], "x " * 60, None, "", "a", texts[3][5:] + " tail"]
    docs = spark.createDataFrame([(i // 2 if i % 9 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for least in (2, 8):
        got = substring_dedup(docs.repartition(3), window=window, first_level=least).collect()
        expected = Counter((i // 2 if i % 9 else None, *r) for i, r in enumerate(brute_kept(texts, window)))
        assert Counter((r.doc_id, r.text, r.n_words, r.n_removed) for r in got) == expected


def test_windows_reach_over_their_own_repeats(spark):
    text = " ".join(["x"] * 36)
    docs = spark.createDataFrame([(1, text), (2, " ".join(["x"] * 35)), (3, "y " + " ".join(["x"] * 34))], "doc_id int, text string")
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup(docs).collect()}
    assert got == {1: (36, 36), 2: (35, 35), 3: (35, 0)}
    one = {r.n_removed for r in substring_dedup(docs.where("doc_id = 2")).collect()}
    assert one == {0}


def test_levels_double():
    assert level_lengths(35) == [9, 18, 35]
    assert level_lengths(7) == [7]
    assert level_lengths(1, 1) == [1]
    for window in range(1, 80):
        lengths = level_lengths(window, 2)
        assert lengths[-1] == window
        assert all(half < length <= 2 * half for half, length in zip(lengths, lengths[1:], strict=False))


def test_substring_dedup_of_odd_rows(spark):
    docs = documents(spark, clashing=True).withColumn("n_words", F.lit("old")).withColumn("ranges", F.lit(3))
    docs = docs.withColumn("h1", F.array(F.lit("clash"))).withColumn("lone", F.lit(dt.date(2024, 1, 1)))
    got = substring_dedup(docs).collect()
    expected = Counter((r[0], *kept) for r, kept in zip(DOCUMENTS, brute_kept([r[1] for r in DOCUMENTS], 35), strict=True))
    assert Counter((r.doc_id, r.text, r.n_words, r.n_removed) for r in got) == expected
    assert {(r.root, r.ranges, tuple(r.h1), r.lone) for r in got} == {("clash", 3, ("clash",), dt.date(2024, 1, 1))}
    assert substring_dedup(docs.where("false")).count() == 0
    with pytest.raises(ValueError, match="window"):
        substring_dedup(docs, window=0)


@pytest.mark.parametrize("name", ["op11_collocations", "op13_substring_dedup"])
def test_queries_equal_their_sql(spark, name):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    got = QUERIES[name](spark, DATA)
    found = connection.execute(ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(got.columns)
    assert Counter(tuple(r) for r in got.select(columns).collect()) == Counter(found.fetchall())
    assert got.count() > 0


# Whitening


def brute_whitening(vectors, components=16):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return n, deviation, ((n * x - sums) / n) @ axes / np.sqrt(values), values / np.trace(centred.T @ centred / n)


@pytest.mark.parametrize(("rows", "dim"), [(400, 24), (900, 70), (60, 3), (300, 1)])
def test_whitening_against_a_dense_solver(spark, rows, dim):
    rng = np.random.default_rng(dim)
    vectors = rng.standard_normal((rows, dim)) * np.linspace(2, 0.5, dim) + rng.standard_normal(dim) * 5
    vectors = np.vstack([vectors, vectors[:7]])
    data = spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())], "vec_id int, embedding array<double>")
    got = sorted(whiten(data.repartition(5)).collect())
    n, deviation, white, explained = brute_whitening(vectors)
    assert [r.vec_id for r in got] == list(range(len(vectors)))
    assert {r.n for r in got} == {n}
    assert [int(r.deviation) for r in got] == deviation
    assert np.allclose(got[0].explained, explained, rtol=1e-10)
    ours = np.array([r.whitened for r in got])
    signs = np.sign((ours * white).sum(axis=0))
    assert np.abs(ours - white * signs).max() < 1e-8
    assert max(r.identity_error for r in got) < 1e-10


def test_pairs_are_eigenpairs_to_double_precision():
    rng = np.random.default_rng(4)
    for values in (np.linspace(1, 3, 90), np.repeat([9.0, 4.0, 1.0], 30), 2.0 ** -np.arange(90), np.r_[5, 5, np.zeros(88)]):
        axes = np.linalg.qr(rng.standard_normal((90, 90)))[0]
        matrix = (axes * values) @ axes.T
        passes = []
        found, vectors = jacobi_davidson(lambda b, m=matrix, p=passes: (p.append(b.shape), m @ b)[1], 90, 16)
        assert np.allclose(found, np.sort(values)[::-1][:16], rtol=0, atol=1e-13 * values.max())
        assert np.linalg.norm(matrix @ vectors - vectors * found, axis=0).max() < 1e-13 * values.max()
        assert np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-13
        assert max(columns for _, columns in passes) < 45
        assert len(passes) < 300


def test_whitening_of_odd_rows(spark):
    nan, inf = math.nan, math.inf
    good = [[1.0, 2.0], [1.5, 0.0], [0.0, 0.25], [1.0, 2.0]]
    bad = [None, [], [None, 1.0], [1.0, None], [nan, 1.0], [1.0, inf], [-inf, 1.0], [1.0], [1.0, 2.0, 3.0], [1e30, 1.0]]
    rows = [(i if i else None, v, "kept") for i, v in enumerate(good + bad)]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n string")
    got = whiten(data.withColumn("_x", F.lit("mine")).withColumn("whitened", F.lit(1)), keep=["vec_id", "_x", "n"]).collect()
    n, deviation, white, explained = brute_whitening(good)
    assert n == 3
    assert Counter((r.vec_id, r._x, int(r.deviation)) for r in got) == Counter(
        (i if i else None, "mine", d) for i, d in enumerate(deviation)
    )
    assert all(len(r.whitened) == 2 and r.identity_error < 1e-12 for r in got)
    same = data.where("vec_id = 3")
    assert [(r.n, r.deviation, r.whitened) for r in whiten(same).collect()] == [(1, Decimal(0), [])]
    assert whiten(data.where("false")).collect() == []
    assert whiten(data.where("embedding IS NULL")).columns == whiten(data).columns
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(9)], "vec_id int, embedding array<float>")
    assert {len(r.whitened) for r in whiten(line).collect()} == {1}


def test_large_entries_stay_exact(spark):
    vectors = [[2.0**30, -1.0], [2.0**30 + 1, 7.0], [-(2.0**30), 3.0]] * 2
    data = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id int, embedding array<double>")
    got = sorted(whiten(data).collect())
    assert [int(r.deviation) for r in got] == brute_whitening(vectors)[1]
    assert max(int(r.deviation) for r in got) > 1 << 63


def test_nothing_is_lost_between_tasks(spark):
    """Tiles and sums of many parts equal those of one."""
    rng = np.random.default_rng(6)
    data = spark.createDataFrame([(v,) for v in rng.standard_normal((200, 6)).tolist()], "embedding array<double>")
    several = fit_points(data.repartition(20), "embedding", 6)
    assert several.n == 200
    assert several.parts > 1
    fit = fit_whitening(several, 3)
    assert len(fit.variances) == 3
    x = np.array([r.x for r in data.select(on_grid(F.col("embedding")).alias("x")).collect()])
    assert [b * several.n + r for b, r in zip(several.base, several.rest, strict=True)] == x.sum(axis=0).tolist()
    assert data.select(usable(F.col("embedding")).alias("u")).where("u").count() == 200


def test_whitening_query(spark):
    got = QUERIES["op12_whitening"](spark, DATA)
    assert got.dtypes == [
        ("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"),
        ("explained", "double"), ("identity_error", "double"),
    ]
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet").orderBy("vec_id").collect()
    n, deviation, white, explained = brute_whitening([r.embedding for r in rows])
    found = {(r.vec_id, r.component): r for r in got.collect()}
    assert len(found) == len(rows) * 16
    for k in range(16):
        ours = np.array([found[r.vec_id, k + 1].whitened for r in rows])
        assert min(np.abs(ours - white[:, k]).max(), np.abs(ours + white[:, k]).max()) < 1e-7
        assert abs(found[rows[0].vec_id, k + 1].explained / explained[k] - 1) < 1e-10
    assert [found[r.vec_id, 1].deviation for r in rows] == deviation

"""Near-duplicates, fingerprints and decontamination against brute force."""

import hashlib
import os
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from edge_cases import DOCUMENTS, documents
from pyspark.sql import functions as F

from promolens.llm import jaccard_join as joins
from promolens.llm.decontaminate import Items, align, benchmark_matches, decontaminate, matches
from promolens.llm.fingerprints import edited_fingerprints, fingerprints
from promolens.llm.graph import components
from promolens.llm.jaccard_join import bands_for, jaccard_join, keep_one

WORD = re.compile(r"[^\W_]+")


def sample_texts(seed=1, groups=12, copies=6):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for g in range(groups):
        base = rng.choices(words, k=rng.choice([6, 30, 120]))
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(rng.choice([" ", "\n", ", "]).join(own))
    return texts


def grams(text, n=5):
    words = WORD.findall((text or "").lower())
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def brute(rows, similarity=0.8):
    """(links, class) of each row by place."""
    sets = [grams(t) for _, t in rows]
    root, links = list(range(len(rows))), Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both >= similarity * (len(sets[a]) + len(sets[b]) - both):
            links[a] += 1
            links[b] += 1
            root[max(find(a), find(b))] = min(find(a), find(b))
    classes = {}
    for i in range(len(rows)):
        classes.setdefault(find(i), []).append(rows[i][0])
    name = lambda ids: min((i for i in ids if i is not None), default=None)
    return Counter((rows[i][0], links[i], name(classes[find(i)])) for i in range(len(rows)))


def test_banding_reaches_the_recall():
    bands, rows = bands_for(0.8, 0.999, 96)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999
    assert bands * rows <= 96
    assert bands_for(0.8, 0.999, 1)[1] == 1


@pytest.mark.parametrize("block_texts", [500, 4])
def test_join_against_brute_force(spark, monkeypatch, block_texts):
    monkeypatch.setattr(joins, "BLOCK_TEXTS", block_texts)
    rows = [(d[0], d[1]) for d in DOCUMENTS] + list(enumerate(sample_texts(), 100))
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, node string")
    got = jaccard_join(docs).collect()
    assert Counter((r.id, r.n_links, r.class_id) for r in got) == brute(rows)


def test_sizes_that_rule_a_link_out_do_not_meet(spark, monkeypatch):
    """Texts that grow from 100 words to 900 are one component; only neighbours in size are compared, no link is lost."""
    words = [f"w{i}" for i in range(900)]
    rows = [(i, " ".join(words[: 100 + 4 * i])) for i in range(200)]
    monkeypatch.setattr(joins, "BLOCK_TEXTS", 10)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: (r.class_id, r.n_links) for r in jaccard_join(docs).collect()}
    size = {i: 96 + 4 * i for i, _ in rows}
    expected = {i: sum(j != i and min(size[i], size[j]) >= 0.8 * max(size[i], size[j]) for j in size) for i in size}
    assert {i: n for i, (_, n) in got.items()} == expected
    assert {c for c, _ in got.values()} == {0}


def test_set_sizes():
    rng = np.random.default_rng(2)
    row = np.sort(rng.integers(0, 50, 3000))
    grams = rng.integers(0, 40, 3000).astype(np.uint64)
    assert joins.set_sizes(grams, row, 51).tolist() == [len(set(grams[row == i].tolist())) for i in range(51)]


def test_join_of_nothing_and_of_one(spark):
    docs = documents(spark)
    assert jaccard_join(docs.where("false")).count() == 0
    only = jaccard_join(docs.where("doc_id = 16")).first()
    assert (only.class_id, only.n_copies, only.n_links) == (16, 1, 0)


def test_one_of_each_class_stays(spark):
    rows = [(d[0], d[1], "x") for d in DOCUMENTS] + [(i, t, "x") for i, t in enumerate(sample_texts(2), 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id string")
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    classes = {}
    for r in jaccard_join(docs).collect():
        classes.setdefault(r.class_node, set()).add((r.id is not None, r.id or 0))
    got = Counter((r.doc_id is not None, r.doc_id or 0) for r in kept.collect())
    assert got == Counter(min(ids) for ids in classes.values())


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(150)]
    edges += [(500, 500 + i) for i in range(50)] + [(7, 7), (3, 2)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def pairs(text):
    words = WORD.findall(text.lower())
    return Counter(zip(words, words[1:])) + Counter([(words[-1],)] if words else [])


def similarity(a, b):
    keys = a.keys() | b.keys()
    return sum(min(a[k], b[k]) for k in keys) / sum(max(a[k], b[k]) for k in keys) if keys else 1.0


def check_edited(spark, rows, monkeypatch, samples=200, chars=4_000_000):
    from promolens.llm import fingerprints as module

    monkeypatch.setattr(module, "PARTITION_CHARS", chars)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, pos string")
    got = {r.doc_id: r for r in edited_fingerprints(docs, samples=samples).collect()}
    order = sorted(rows, reverse=True)
    assert len(got) == len(rows)
    errors = []
    for (i, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        r = got[i]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        errors.append(r.near_edited - similarity(pairs(text), pairs(edited)))
        errors.append(r.near_next - similarity(pairs(text), pairs(following)))
    return np.array(errors), got


@pytest.mark.parametrize("chars", [4_000_000, 300])
def test_fingerprints_estimate_the_similarity(spark, monkeypatch, chars):
    texts = sample_texts(4, groups=10, copies=4) + ["a b " * 9, "a b " * 3, "x", "y", "", None, "x"]
    errors, got = check_edited(spark, list(enumerate(texts, 5)), monkeypatch, chars=chars)
    assert abs(errors.mean()) < 0.02
    assert np.sqrt((errors**2).mean()) < 0.05
    by_text = {}
    for i, t in enumerate(texts, 5):
        by_text.setdefault(t or "", set()).add(got[i].fingerprint)
    assert all(len(f) == 1 for f in by_text.values())
    assert by_text[""] == {""}


def test_error_at_the_registered_count(spark, monkeypatch):
    from promolens.llm.fingerprints import SAMPLES

    texts = sample_texts(5, groups=20, copies=4)
    errors, _ = check_edited(spark, list(enumerate(texts)), monkeypatch, samples=SAMPLES)
    # a share of 24 draws has a standard error of 0.102 at most
    assert abs(errors.mean()) < 0.03
    assert np.sqrt((errors**2).mean()) < 0.102


def test_a_single_document_follows_itself(spark, monkeypatch):
    _, got = check_edited(spark, [(3, "one two three four")], monkeypatch, samples=24)
    assert got[3].near_next == 1.0


def test_fingerprints_of_edge_cases(spark):
    docs = documents(spark, clashing=True)
    assert edited_fingerprints(docs).count() == len(DOCUMENTS)
    assert fingerprints(docs).count() == len(set(DOCUMENTS))
    assert edited_fingerprints(docs.where("false")).count() == 0


def distance(item, text):
    """Least edits that turn the item into any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        last, row = row, [i] + row[1:]
        for j, d in enumerate(text, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (c != d))
    return min(row)


def test_alignment_against_brute_force():
    rng = random.Random(6)
    for _ in range(60):
        item = "".join(rng.choices("abc", k=rng.randrange(1, 12)))
        text = "".join(rng.choices("abc", k=rng.randrange(1, 30)))
        codes = lambda s: np.array([ord(c) for c in s], np.uint32)
        edits, start, end = align(codes(item), codes(text)[None, :])
        assert edits[0] == distance(item, text)
        part = text[start[0] : end[0]]
        whole = list(range(len(part) + 1))  # edits between the item and that part
        for i, c in enumerate(item, 1):
            last, whole = whole, [i] + [0] * len(part)
            for j, d in enumerate(part, 1):
                whole[j] = min(last[j] + 1, whole[j - 1] + 1, last[j - 1] + (c != d))
        assert whole[-1] == edits[0]


def passages(seed=8, n=6):
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyzé"
    word = lambda: "".join(rng.choices(letters, k=rng.randrange(2, 9)))
    return rng, [" ".join(word() for _ in range(rng.randrange(8, 40))) for _ in range(n)], word


def test_every_match_within_the_budget_is_found():
    rng, items, word = passages()
    held = Items(list(range(len(items))), items)
    for _ in range(150):
        j = rng.randrange(len(items))
        text = list(items[j])
        for _ in range(rng.randrange(int(held.budget[j]) + 3)):
            at = rng.randrange(len(text))
            text[at : at + rng.choice([0, 1])] = rng.choice(["", "q", "z"])
        around = [" ".join(word() for _ in range(rng.randrange(30))) for _ in range(2)]
        document = f"{around[0]} {''.join(text)} {around[1]}"
        least = distance(items[j], " ".join(WORD.findall(document)))
        found = [m for m in matches(held, ["other", document]) if m[1] == j]
        assert bool(found) == (least <= held.budget[j])
        if found:
            assert found[0][4] == least


def test_matches_on_rows(spark):
    _, items, _ = passages(9)
    loud = ",  ".join(items[0].upper().split())
    rows = [
        (1, f"before {items[0]} after", "x"), (2, loud, "x"), (2, loud, "x"), (None, items[1], "x"), (4, None, "x"),
        (5, "", "x"), (6, "nothing here " * 500, "x"), (7, f"{items[2]} {items[2]} {items[3]}", "x"), (2, "clean", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string")
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(90, None), (91, ""), (92, "short")], "item_id int, text string")
    got = benchmark_matches(docs, bench).collect()
    assert Counter((r.doc_id, r.item_id) for r in got) == Counter(
        [(1, 0), (2, 0), (2, 0), (None, 1), (7, 2), (7, 2), (7, 3)]
    )
    first = next(r for r in got if r.doc_id == 1)
    assert rows[0][1][first.start : first.end] == items[0]
    clean = decontaminate(docs, bench)
    assert clean.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in clean.collect()) == Counter(
        [(4, None), (5, ""), (6, "nothing here " * 500), (2, "clean")]
    )
    assert benchmark_matches(docs.where("false"), bench).count() == 0
    assert decontaminate(docs, bench.where("false")).count() == len(rows)


def test_benchmark_in_blocks(spark, monkeypatch):
    from promolens.llm import decontaminate as module

    _, items, _ = passages(10)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "doc_id long, text string")
    bench = docs.withColumnRenamed("doc_id", "item_id")
    monkeypatch.setattr(module, "BLOCK_CHARS", 300)
    got = benchmark_matches(docs, bench).where(F.col("doc_id") == F.col("item_id"))
    assert got.count() == len(items)


@pytest.mark.parametrize("chars", [40, 300, 1500])
def test_a_large_benchmark_is_joined(spark, monkeypatch, chars, tmp_path):
    """The same matches as those of one block, from as many reads of the documents however large the benchmark is."""
    from promolens.llm import decontaminate as module

    rng, items, word = passages(11, n=12)
    noise = [" ".join(rng.choices(" ".join(items).split(), k=300)) for _ in range(20)]
    edited = []
    for item in items:
        near = list(item)
        for _ in range(rng.randrange(len(item) // 12)):
            near[rng.randrange(len(near))] = rng.choice(["", "q", "zz"])
        edited.append(f"{word()} {''.join(near)} {word()}")
    bodies = [*items, *noise, *edited, f"{items[0]} {items[0]} and Paris", None, "", items[1], items[1]]
    rows = [(i if i % 7 else None, t, "x") for i, t in enumerate(bodies)]
    spark.createDataFrame(rows, "doc_id long, text string, _h1 string").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    held = [(i, t) for i, t in enumerate(items)] + [(50, items[2]), (90, None), (91, ""), (92, "Paris"), (93, "x" * 200)]
    bench = spark.createDataFrame(held, "item_id int, text string")
    whole = Counter(tuple(r) for r in benchmark_matches(docs, bench, keep=("_h1",)).collect())
    assert len(whole) > 20
    monkeypatch.setattr(module, "BLOCK_CHARS", chars)
    joined = benchmark_matches(docs, bench, keep=("_h1",))
    assert Counter(tuple(r) for r in joined.collect()) == whole
    assert joined._jdf.queryExecution().optimizedPlan().toString().count("Relation [doc_id") <= 2
    assert benchmark_matches(docs.where("false"), bench).count() == 0
    assert benchmark_matches(docs, bench.where("length(text) > 5 and item_id > 95")).count() == 0


@pytest.mark.parametrize("others", [["an item that is longer than a q-gram"], []])
def test_items_shorter_than_a_q_gram_match_as_words(others):
    shorts = ["Paris", "4 2", "東京", "a b", "--", "7 chars"]
    held = Items(list(range(len(shorts + others))), shorts + others)
    texts = ["In paris!", "comparison parisian", "4, 2 or 4-2", "x 東京 y", "東京都", "a b a b", "", None, "7 char", "(7) CHARS"]
    found = {}
    for d, j, start, end, edits in matches(held, [t or "" for t in texts]):
        assert edits == 0
        found.setdefault((texts[d], held.ids[j]), []).append(texts[d][start:end])
    assert found == {
        ("In paris!", 0): ["paris"], ("4, 2 or 4-2", 1): ["4, 2", "4-2"], ("x 東京 y", 2): ["東京"],
        ("a b a b", 3): ["a b", "a b"], ("(7) CHARS", 5): ["7) CHARS"],
    }


def test_short_items_on_rows(spark):
    docs = spark.createDataFrame([(1, "The answer: Paris."), (2, "parisian"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "paris")], "item_id int, text string")
    assert [tuple(r) for r in benchmark_matches(docs, bench).collect()] == [(1, 7, 12, 17, 0)]
    assert sorted(r.doc_id for r in decontaminate(docs, bench).collect()) == [2, 3]


SCALE = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SCALE), reason="generated tables not present")
def test_links_and_classes_of_all_documents_against_brute_force(spark):
    """Every pair of the 1,000 documents compared: no false link, hardly one missed, classes accordingly."""
    rows = spark.read.parquet(f"{SCALE}/documents.parquet").select("doc_id", "text").collect()
    grams = {}
    for r in rows:
        words = re.findall(r"[^\W_]+", (r.text or "").lower())
        grams[r.doc_id] = frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()
    index = {}
    for i, own in grams.items():
        for g in own:
            index.setdefault(g, []).append(i)
    links = {i: set() for i in grams}
    for i, own in grams.items():
        met = Counter(j for g in own for j in index[g] if j != i)
        links[i] = {j for j, n in met.items() if n >= 0.8 * (len(own) + len(grams[j]) - n) - 1e-9}
        if not own:
            links[i] = {j for j, g in grams.items() if not g and j != i}
    got = {r.id: r for r in jaccard_join(spark.createDataFrame(rows)).collect()}
    found, expected = sum(r.n_links for r in got.values()), sum(map(len, links.values()))
    assert all(got[i].n_links <= len(links[i]) for i in links)
    assert found >= 0.999 * expected > 0
    if found == expected:
        for i in links:
            reached, todo = {i}, [i]
            while todo:
                todo = [j for k in todo for j in links[k] if j not in reached and not reached.add(j)]
            assert got[i].class_id == min(reached)

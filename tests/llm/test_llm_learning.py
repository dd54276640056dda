"""Classifiers: what they can learn, held-out rows and edge cases."""

import math
import os
import random
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from edge_cases import DOCUMENTS, documents

from promolens.llm import quality as quality_module
from promolens.llm.common import list_chunks
from promolens.llm.learning import held_out
from promolens.llm.quality import BUCKETS, features, ftrl, quality, sigmoid
from promolens.llm.queries import QUERIES
from promolens.llm.toxicity import FACTORS, Machine, first_vectors, fit_machine, toxicity

DATA = os.environ.get("PROMOLENS_STAR_DATA", "/root/testdata/sf0.01")


def test_held_out_rows(spark):
    rows = spark.range(100)
    got = {r.id: r.h for r in rows.select("id", held_out(rows["id"]).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(100)}


def test_features_of_a_row_do_not_depend_on_its_neighbours():
    rng = np.random.default_rng(1)
    lists = [rng.integers(-(2**31), 2**31, n) for n in (0, 1, 5, 40)] + [np.full(6, 9)]
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    of, bucket, value = features(np.concatenate(lists), row, len(lists))
    assert bucket.max() < BUCKETS - 1
    for i, tokens in enumerate(lists):
        _, own_bucket, own_value = features(tokens, np.zeros(len(tokens), np.int64), 1)
        assert np.array_equal(bucket[of == i], own_bucket)
        assert np.allclose(value[of == i], own_value)
        assert not len(tokens) or np.isclose((own_value**2).sum(), 1.0)


def test_repetition_is_one_feature():
    first = features(np.full(50, 1), np.zeros(50, np.int64), 1)
    second = features(np.full(50, 2), np.zeros(50, np.int64), 1)
    assert len(np.intersect1d(first[1], second[1])) == 1


def test_ftrl_learns_a_word():
    rng = np.random.default_rng(2)
    labels = (np.arange(400) % 2).astype(float)
    rows = [np.append(rng.integers(1, 10**6, 30), 77 if y else 78) for y in labels]
    found = ftrl(rows, labels)
    w = np.zeros(BUCKETS)
    w[found["bucket"]] = found["weight"]
    score = lambda word: sigmoid(features(np.array([word]), np.zeros(1, np.int64), 1)[2] @ w[features(np.array([word]), np.zeros(1, np.int64), 1)[1]] + w[-1])  # noqa: E731, E501
    assert score(77) > 0.8
    assert score(78) < 0.2


def test_machine_learns_a_pair_that_weights_cannot():
    """Positive only if both words are there, in a corpus in which each alone is as often negative."""
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(4000):
        a, b = i % 2, i // 2 % 2
        words = rng.integers(1000, 1200, 5).tolist() + [1] * a + [2] * b
        rows.append(np.unique(words))
        labels.append(float(a and b))
    machine = Machine(fit_machine(rows, np.array(labels)), 1)
    linear = Machine(fit_machine(rows, np.array(labels)).assign(v0=0.0, v1=0.0, v2=0.0, v3=0.0), 1)
    scores = [m.scores(np.array([1, 2, 1, 2]), np.array([0, 0, 1, 2]), 4) for m in (machine, linear)]
    assert scores[0][0] > 0.5 > max(scores[0][1:])
    assert (machine.vectors != 0).any()


@pytest.mark.parametrize("order", ["random", "alternating", "sorted"])
@pytest.mark.parametrize("law", ["xor", "both or neither", "both"])
def test_pairs_are_learnt_in_any_order_of_the_rows(order, law):
    """Each word alone says nothing; only the pair decides."""
    for seed in range(3):
        rng = np.random.default_rng(seed)
        kinds = np.arange(4000) % 4
        if order != "alternating":
            kinds = np.sort(kinds) if order == "sorted" else rng.permutation(kinds)
        if order == "sorted":  # whole blocks of a kind, over and over
            kinds = np.concatenate([np.repeat(np.arange(4), 25)] * 40)
        a, b = kinds % 2, kinds // 2
        labels = {"xor": a ^ b, "both or neither": 1 - (a ^ b), "both": a & b}[law].astype(float)
        rows = [np.array(rng.integers(1000, 1200, 5).tolist() + [1] * x + [2] * y) for x, y in zip(a, b, strict=True)]
        machine = Machine(fit_machine(rows, labels), 1)
        scores = machine.scores(np.array([1, 2, 1, 2]), np.array([1, 2, 3, 3]), 4)  # neither, 1, 2, both
        expected = {"xor": [0, 1, 1, 0], "both or neither": [1, 0, 0, 1], "both": [0, 0, 0, 1]}[law]
        assert [int(s > 0.5) for s in scores] == expected, (seed, scores)


def test_scores_are_the_sum_over_all_pairs():
    rng = np.random.default_rng(8)
    terms = np.sort(rng.choice(10**6, 40, replace=False)) + 1
    found = pd.DataFrame({"term": np.append(terms, 0), "weight": rng.standard_normal(41), **{f"v{i}": rng.standard_normal(41) for i in range(FACTORS)}})
    machine = Machine(found, 2)
    texts = [rng.choice(np.append(terms, [5_000_000, 7]), rng.integers(0, 30)).tolist() for _ in range(50)] + [[]]
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    got = machine.scores(np.concatenate([np.array(t, np.int64) for t in texts]), row, len(texts))
    model = {int(r.term): (r.weight / 2, [getattr(r, f"v{i}") / 2 for i in range(FACTORS)]) for r in found.itertuples()}
    for text, score in zip(texts, got, strict=True):
        x = {t: math.log2(1 + text.count(t)) for t in set(text) if t in model}
        total = model[0][0] + sum(model[t][0] * x[t] for t in x)
        for t in x:
            for u in x:
                if t < u:
                    total += sum(p * q for p, q in zip(model[t][1], model[u][1], strict=True)) * x[t] * x[u]
        assert score == pytest.approx(1 / (1 + math.exp(-max(-35, min(35, total)))), rel=1e-9)


def test_ftrl_against_a_plain_loop():
    """Weights after all passes, and scores, one number at a time from the definition."""
    rng = np.random.default_rng(11)
    rows = [rng.integers(-50, 50, rng.integers(0, 12)) for _ in range(60)]
    labels = (np.arange(60) % 3 == 0).astype(float)
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= quality_module.L1:
            return 0.0
        sign = 1.0 if z[i] > 0 else -1.0
        return -(z[i] - sign * quality_module.L1) / ((quality_module.BETA + math.sqrt(n[i])) / quality_module.ALPHA + quality_module.L2)

    def values(tokens):
        counts = {}
        _, bucket, _ = features(tokens, np.zeros(len(tokens), np.int64), 1)
        singles = [int(t) % (BUCKETS - 1) for t in tokens]
        for s in singles:
            counts[s] = counts.get(s, 0) + 1
        for a, b in zip(tokens[:-1], tokens[1:], strict=True):
            pair = 12345
            if a != b:
                pair = (int(a) * -7046029254386353131 + int(b) * -4417276706812531889 + 2**63) % 2**64 - 2**63
                pair ^= (pair >> 31) & 0xFFFFFFFF
            counts[pair % (BUCKETS - 1)] = counts.get(pair % (BUCKETS - 1), 0) + 1
        assert sorted(counts) == sorted(bucket.tolist())
        logs = {k: math.log(1 + c) for k, c in counts.items()}
        norm = math.sqrt(sum(v * v for v in logs.values()))
        return {**{k: float(np.float32(v / norm)) for k, v in logs.items()}, BUCKETS - 1: 1.0}

    xs = [values(t) for t in rows]
    for _ in range(quality_module.EPOCHS):
        for x, y in zip(xs, labels, strict=True):
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - y) * v
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / quality_module.ALPHA * w[i]
                n[i] = n.get(i, 0.0) + g * g
    found = ftrl(rows, labels)
    got = dict(zip(found["bucket"].tolist(), found["weight"].tolist(), strict=True))
    expected = {i: weight(i) for i in z if weight(i)}
    assert set(got) == set(expected)
    assert all(got[i] == pytest.approx(expected[i], rel=1e-4, abs=1e-6) for i in got)
    w = np.zeros(BUCKETS)
    w[found["bucket"]] = found["weight"]
    for tokens, x in zip(rows, xs, strict=True):
        of, bucket, value = features(tokens, np.zeros(len(tokens), np.int64), 1)
        score = sigmoid(value @ w[bucket] + w[-1])
        assert score == pytest.approx(1 / (1 + math.exp(-sum(expected.get(i, 0.0) * v for i, v in x.items()))), rel=1e-4)


def test_machine_without_rows_and_terms():
    empty = Machine(fit_machine([], np.empty(0)), 1)
    assert empty.scores(np.array([5]), np.array([0]), 2).tolist() == [0.5, 0.5]
    assert np.abs(first_vectors(np.array([1 << 50]))).max() <= 0.01


@pytest.mark.parametrize("classify, label", [(quality, "quality"), (toxicity, "toxic")])
def test_edge_cases(spark, classify, label):
    rng = random.Random(4)
    rows = DOCUMENTS + [
        (100 + i, " ".join(rng.choices(["idiot", "scum"] if i % 2 else ["good", "fine", "text"], k=20)), "en", "s", 1)
        for i in range(120)
    ]
    docs = documents(spark, rows, clashing=True)
    marks = [(100 + i, i % 2 if label == "toxic" else 1 - i % 2) for i in range(120)]
    marks += [(None, 1), (1, None), (2, 7), (9999, 1), (100, marks[0][1])]
    labels = spark.createDataFrame(marks, f"doc_id long, {label} int")
    got = classify(docs, labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(d[0]) for d in rows)
    assert all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert len({r.score for r in got if r.doc_id == 14}) == 1
    right = sum((r.score > 0.5) == bool(dict(marks)[r.doc_id]) for r in got if r.doc_id and r.doc_id >= 100)
    assert right >= 118
    assert {r.score for r in classify(docs, labels.where("false")).collect()} == {0.5}
    assert classify(docs.where("false"), labels).count() == 0


def test_shards_are_averaged(spark, monkeypatch):
    from promolens.llm import learning

    monkeypatch.setattr(learning, "SHARD_ROWS", 10)
    docs = documents(spark, [(i, "good text" if i % 2 else "bad***", "en", "s", 1) for i in range(80)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality(docs, labels).collect()}
    assert min(got[1], got[3]) > 0.5 > max(got[0], got[2])


@pytest.mark.parametrize("most", [1, 10, 52, 1000])
def test_chunks_of_lists(most):
    lists = [[], [1, 2, 3], [], list(range(50)), [7, 7], []]
    column = pa.array([[9], *lists, [9]]).slice(1, len(lists))
    got = {}
    for values, row, first, last in list_chunks(column, most):
        assert len(values) <= most or last == first + 1
        for i in range(first, last):
            got[i] = values[row == i - first].tolist()
    assert got == dict(enumerate(lists))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="generated tables not present")
@pytest.mark.parametrize(
    "name, label, rare, recall, precision", [("op4_quality", "quality", 0, 0.9, 0.9), ("op7_toxicity", "toxic", 1, 0.9, 0.9)]
)
def test_held_out_recall_and_precision(spark, name, label, rare, recall, precision):
    """Of the rarer label, which always answering the commoner one would never find; on the larger tables."""
    data = DATA.replace("sf0.01", "sf0.1") if os.path.isdir(DATA.replace("sf0.01", "sf0.1")) else DATA
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    rows = [r for r in QUERIES[name](spark, data).collect() if r.held_out and r.doc_id in labels]
    found = sum(r.predicted == rare == labels[r.doc_id] for r in rows)
    assert found >= recall * sum(labels[r.doc_id] == rare for r in rows)
    assert found >= precision * sum(r.predicted == rare for r in rows)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="generated tables not present")
@pytest.mark.parametrize("name, label, least", [("op4_quality", "quality", 0.9), ("op7_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    rows = [r for r in QUERIES[name](spark, DATA).collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in rows) >= least * len(rows)

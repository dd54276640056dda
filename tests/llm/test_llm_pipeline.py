"""The corpus pipeline and the registered queries as a whole."""

import os
import re

import duckdb
import numpy as np
import pytest
from edge_cases import COLUMNS, DOCUMENTS, LINE
from tokenizers import Tokenizer

import __spark_entry__ as registered
import corpus_pipeline
from promolens.llm.common import vocabulary_path
from promolens.llm.queries import ORACLE_SQL, QUERIES

DATA = os.environ.get("PROMOLENS_STAR_DATA", "/root/testdata/sf0.001")


def stages(spark, folder, out):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{out}/{name}")
        docs = spark.read.parquet(f"{out}/{name}")
        frames.append(docs)
    return frames


def test_all_are_registered():
    assert set(QUERIES) <= set(registered.queries())
    assert "pipeline" in registered.queries()
    assert set(ORACLE_SQL) <= set(registered.oracle_sql())
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="generated tables not present")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_against_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    df = registered.queries()[name](spark, DATA)
    expected = connection.execute(ORACLE_SQL[name])
    places = [[c[0] for c in expected.description].index(c) for c in df.columns]
    wanted = sorted([str(tuple(r[i] for i in places)) for r in expected.fetchall()])
    assert sorted(str(tuple(r)) for r in df.collect()) == wanted


NATIVE = ("op1_url_filter", "op5_line_dedup", "op8_secrets", "op9_fingerprints")


@pytest.mark.skipif(not os.path.isdir(DATA), reason="generated tables not present")
@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_run_no_python(spark, name):
    plan = registered.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


@pytest.mark.skipif(not os.path.isdir(DATA), reason="generated tables not present")
def test_stages_on_the_generated_tables(spark, tmp_path):
    first, good, lined, unique, clean, tokens = stages(spark, DATA, tmp_path)
    for frame in (good, lined, unique, clean):
        assert frame.columns == first.columns
    ids = [{r.doc_id for r in f.select("doc_id").collect()} for f in (first, good, lined, unique, clean, tokens)]
    assert ids[1] == ids[2]
    assert all(b <= a for a, b in zip(ids, ids[1:]))
    assert ids[4] == ids[5]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    rejected = ids[0] - ids[1]
    assert all(labels.get(i, 0) == 0 for i in rejected)
    # exact copies: one of each text, the one with the smallest id
    texts = {}
    for r in lined.collect():
        texts.setdefault(" ".join(re.findall(r"[^\W_]+", r.text.lower())), []).append(r.doc_id)
    for same in texts.values():
        assert not (set(same) - {min(same)}) & ids[3]
    items = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    for r in unique.collect():
        if any(item in r.text for item in items):
            assert r.doc_id not in ids[4]
    tokenizer = Tokenizer.from_file(vocabulary_path())
    kept = {r.doc_id: r.text for r in clean.collect()}
    for r in tokens.collect():
        assert r.ids == tokenizer.encode(kept[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(r.ids)


def test_pipeline_on_edge_cases(spark, tmp_path):
    rng = np.random.default_rng(1)
    words = [f"word{i}" for i in range(300)]
    good = [(100 + i, " ".join(rng.choice(words, 40)) + f"\n{LINE}", "en", "s", 1) for i in range(60)]
    bad = [(200 + i, "*** ".join(rng.choice(words, 40)), "en", "s", 1) for i in range(60)]
    item = " ".join(rng.choice(words, 30))
    leak = [(300, f"before {item} after", "en", "s", 1)]
    rows = DOCUMENTS + good + bad + leak
    clash = [(*r, "kept", 5) for r in rows]
    columns = f"{COLUMNS}, score string, n_lines int"
    spark.createDataFrame(clash, columns).write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(r[0], 1) for r in good + leak] + [(r[0], 0) for r in bad]
    spark.createDataFrame(marks, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    first, *_, clean, tokens = frames = stages(spark, str(tmp_path), tmp_path / "out")
    for frame in frames[1:-1]:
        assert frame.columns == first.columns
        assert {(r.score, r.n_lines) for r in frame.collect()} == {("kept", 5)}
    ids = [r.doc_id for r in tokens.collect()]
    assert not set(ids) & {r[0] for r in bad + leak}
    assert set(ids) >= {r[0] for r in good}
    shared = [r.doc_id for r in clean.collect() if LINE in r.text]
    assert shared == [159]
    assert all(r.n_chars == len(r.text) for r in clean.collect())


@pytest.mark.parametrize("marks", [[], [(1, None), (None, 1), (4, 2), (999, 1), (998, 0)]])
def test_without_usable_labels_no_document_is_rejected(spark, tmp_path, marks):
    docs = spark.createDataFrame(DOCUMENTS, COLUMNS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = corpus_pipeline.keep_quality(spark, docs, str(tmp_path))
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    assert corpus_pipeline.run(spark, str(tmp_path), f"{tmp_path}/stages").count() > 0
    assert {name for name, _ in corpus_pipeline.STAGES} <= set(os.listdir(tmp_path / "stages"))


def test_pipeline_on_empty_tables(spark, tmp_path):
    for name, columns in (("documents", COLUMNS), ("labels", "doc_id long, quality int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], columns).write.parquet(f"{tmp_path}/{name}.parquet")
    for name, columns in (("pages", "page_id long, url string, html string"), ("embeddings", "vec_id long, embedding array<float>")):
        spark.createDataFrame([], columns).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    for name in QUERIES:
        if name == "op7_toxicity":
            spark.createDataFrame([], "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
        assert registered.queries()[name](spark, str(tmp_path)).count() == 0, name

"""Registered queries against SQL, and the pipeline against what its stages promise."""

import os
from collections import Counter

import pytest

import corpus_pipeline
from check_oracle import connect, differences
from crowdtide.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    kinds = {"boolean"}
    df = QUERIES[name](spark, FOLDER)
    df = df.select(*[df[f.name].cast("int").alias(f.name) if f.dataType.simpleString() in kinds else df[f.name] for f in df.schema])
    sql = SQL[name]
    if name == "op3_exact_dedup":
        sql = f"SELECT * REPLACE (CAST(kept AS INTEGER) AS kept) FROM ({sql})"
    assert differences(df, connect(FOLDER), sql) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_one_row_or_more_for_each_document(spark, name):
    docs = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()}
    assert {r.doc_id for r in QUERIES[name](spark, FOLDER).select("doc_id").collect()} == docs


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = stage(spark, docs, FOLDER)
        after = docs.collect()
        if name != "packing":
            assert docs.columns == columns
        if name in ("language_id", "exact_dedup", "jaccard_join"):
            assert not Counter(after) - Counter(before)
        if name == "language_id":
            assert len(after) == len(before)  # every text here has letters
        if name == "exact_dedup":
            kept = {" ".join(r.text.split(" ")) for r in after}
            assert len(after) == len({__import__("re").sub(r"[\x20\x09-\x0D]+", " ", r.text) for r in before}) and kept
        docs = spark.createDataFrame(after, docs.schema)
    assert sum(r.length for r in after) >= len({r.doc_id for r in before})
    assert {r.doc_id for r in after} == {r.doc_id for r in before}


CLEAN = {
    "en": "the cat sat on the mat and then the dog ran over the green hill to the old house by the sea",
    "de": "der hund lief ueber die strasse und dann ging die katze in das alte haus am see zurueck",
}
STAGES = dict(corpus_pipeline.STAGES)


def documents(spark, rows):
    """(doc_id, text, lang) rows with columns whose names clash with those used inside."""
    kinds = "doc_id long, text string, lang string, source string, n_chars long, node string, __key string, __language string, root int"
    return spark.createDataFrame([(i, t, g, "s", len(t or ""), "n", "k", "l", 1) for i, t, g in rows], kinds)


def stage(spark, name, rows):
    df = documents(spark, rows)
    out = STAGES[name](spark, df, FOLDER)
    assert out.columns == df.columns
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)


def test_language_stage(spark):
    clean = [(i, f"{CLEAN[g]} {i}", g) for i, g in enumerate(["en", "de"] * 4)]
    odd = [(20, None, "en"), (21, "", None), (22, "1234 !!", None), (23, "фыва олдж " * 30, None), (24, "zxqj vkwq xjzq " * 40, None), (None, CLEAN["en"], None)]
    kept = stage(spark, "language_id", clean + odd)
    assert kept == sorted([(i, t) for i, t, _ in clean] + [(None, CLEAN["en"])], key=str)
    # no row names a language: whatever has letters stays
    kept = stage(spark, "language_id", [(i, t, None) for i, t, _ in clean + odd])
    assert kept == sorted([(i, t) for i, t, _ in clean + odd if any(c.isalpha() for c in t or "")], key=str)
    assert stage(spark, "language_id", []) == []


def test_near_copies_stage(spark):
    base = " ".join(f"w{i}" for i in range(60))
    near, other = base + " end", " ".join(f"x{i}" for i in range(30))
    rows = [(1, base), (2, base), (2, other), (3, near), (None, near + " more"), (None, None), (None, None), (5, ""), (6, "lone"), (6, "lone"), (7, "LONE")]
    kept = stage(spark, "jaccard_join", [(i, t, "en") for i, t in rows])
    # (2, other) stays though (2, base) goes; of two equal rows one stays; texts without words all stay
    assert kept == sorted([(1, base), (2, other), (None, None), (None, None), (5, ""), (6, "lone")], key=str)
    kept = stage(spark, "jaccard_join", [(None, base, "en"), (None, base, "en"), (None, near, "en")])
    assert len(kept) == 1
    assert stage(spark, "jaccard_join", []) == []


def test_exact_mixing_and_packing_stages_of_odd_rows(spark):
    rows = [(1, "a  b", "en"), (2, "a b", "en"), (None, "a b", "en"), (3, None, None), (4, "", None), (5, "c", "en"), (5, "c", "en")]
    assert stage(spark, "exact_dedup", rows) == sorted([(1, "a  b"), (3, None), (5, "c")], key=str)
    assert stage(spark, "exact_dedup", []) == [] and stage(spark, "mixing", []) == []
    mixed = Counter(stage(spark, "mixing", rows))
    assert set(mixed) <= {(i, t) for i, t, _ in rows} and max(mixed.values()) <= 4
    out = STAGES["packing"](spark, documents(spark, rows), FOLDER).collect()
    assert Counter(r.doc_id for r in out if r.start == 0) == Counter(i for i, _, _ in rows)
    assert STAGES["packing"](spark, documents(spark, []), FOLDER).collect() == []


def test_pipeline_of_nothing(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []

"""What grows with the tables: files, batches, rows that move and bytes in a worker."""

import random

import pytest
from pyspark.sql import functions as F

from crowdtide.operators import features as fx
from crowdtide.plans import queries
from crowdtide.session import BATCH_BYTES, changed_settings

WORDS = "the der la market, dip buy sell rally und von avec pour chart volume trend".split()


@pytest.fixture
def tables(spark, tmp_path, monkeypatch):
    """Documents in four files; the queries' own files go to ``run``."""
    r = random.Random(7)
    docs = [
        (i, " ".join(r.choice(WORDS) for _ in range(r.randrange(1, 40))), r.choice(["en", "de"]), r.choice(["web", "news"]), i)
        for i in range(120)
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    df.repartition(4, "doc_id").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries, "_scratch", lambda spark: f"{tmp_path}/run")
    return str(tmp_path), docs


def test_csv_is_written_in_as_many_files_as_the_table_is_read_in(spark, tables, tmp_path):
    got = queries.csv_round_trip(spark, tables[0])
    assert sorted(int(r["id"]) for r in got.collect()) == [d[0] for d in tables[1]]
    assert len(list((tmp_path / "run/csv").glob("part-*"))) == spark.read.parquet(f"{tables[0]}/documents.parquet").rdd.getNumPartitions() == 4


def test_a_clean_batch_takes_more_files_of_a_larger_stream(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "STREAM_FILE_BYTES", 500, raising=False)
    got = queries.stream_dedupe(spark, tables[0])
    assert got.count() == got.distinct().count() == len({d[1] for d in tables[1]})
    assert len(list((tmp_path / "run/posts").glob("batch_id=*"))) == 6
    assert len(list((tmp_path / "run/in").glob("part-*"))) > 12


def test_files_written_at_once_are_a_batch_of_features(spark, tables, tmp_path):
    got = queries.stream_damaged_lines(spark, tables[0])
    assert got.filter("kind = 'good'").count() == sum(d[0] % 11 not in (1, 2, 3, 4) for d in tables[1])
    assert got.filter("id = 'lines_read'").first()["value"] == "120"
    assert len(list((tmp_path / "run/features").glob("batch_id=*"))) == 3


def test_rarer_terms_are_joined_and_others_sent(spark, tables):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet").withColumn("text", F.concat("text", F.lit(" only"), "doc_id"))

    def weights(scope, **options):
        counts = fx.term_counts(fx.by_document(docs, "doc_id", "text"), "doc_id", "text", scope)
        out = fx.tfidf(docs, "doc_id", counts, scope, **options)
        return out, {(r["doc_id"], r["term"]): (r["tf"], r["df"], round(r["weight"], 9)) for r in out.collect()}

    for scope in ([], ["source"]):
        (all_sent, want), (_, got) = weights(scope), weights(scope, sent=5)
        assert got == want and len(want) > 500
        # a row goes to its document once, and to no term
        assert all_sent._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1


def test_terms_are_counted_where_their_document_is(spark, tables):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    counts = fx.term_counts(fx.by_document(docs, "doc_id", "text"), "doc_id", "text")
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(doc_id#" in plan and "term#" not in plan.split("Exchange hash")[1]
    frequency = counts.groupBy("term").agg(F.count("*").alias("df"))
    assert [fx.least_sent(frequency, n) for n in (0, 10**6)] == [frequency.agg(F.max("df")).first()[0], 0]
    least = fx.least_sent(frequency, 4)
    assert frequency.filter(F.col("df") > least).count() <= 4 < frequency.filter(F.col("df") >= least).count()


def test_sparse_rows_are_packed_where_the_text_is(spark, tables):
    out = queries.sparse_roundtrip(spark, tables[0])
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert out.agg(F.sum("tf")).first()[0] == sum(len(d[1].split()) for d in tables[1])


def test_batches_for_an_encoder_are_cut_by_bytes(spark):
    with changed_settings(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": "64m"}):
        df = spark.range(64, numPartitions=1).select("id", F.repeat(F.lit("ab "), 1 << 18).alias("t"))
        out = fx.embed(df, "t", fx.hash_projection_encoder(4))
        assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(BATCH_BYTES)
        rows = df.select(F.pandas_udf(lambda t: t.map(lambda _: len(t)), "long")("t").alias("n")).agg(F.max("n")).first()[0]
        assert rows <= 8 and out.filter(F.size("embedding") == 4).count() == 64

import math
import random
import re
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from crowdtide.fixed_values import KEYWORDS
from crowdtide.operators import clean, dedupe, features as fx, merge, pages, ranking, scoring
from crowdtide.operators import skew, summary, windows
from crowdtide.session import changed_settings, spread

DAY = datetime(2024, 3, 1)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


# ---- joins ----
def skewed_sides(spark):
    left = [(k, i) for i, k in enumerate(["hot"] * 60 + ["left hot"] * 40 + ["a", "b", None, None])]
    right = [(k, -i) for i, k in enumerate(["hot"] * 30 + ["right hot"] * 40 + ["a", "a", "c", None])]
    # several partitions, so that copies get several salts
    return (
        spark.createDataFrame(left, "k string, l int").repartition(3),
        spark.createDataFrame(right, "k string, r int").repartition(3),
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("heavy", [True, False])
def test_skew_join_equals_a_join(spark, how, heavy):
    left, right = skewed_sides(spark)
    got = skew.skew_join(left, right, ["k"], how, share=10 if heavy else 10**6, min_rows=5 if heavy else 10**9)
    want = left.join(right, "k", how)
    assert got.columns == want.columns
    as_text = lambda df: sorted(map(str, df.collect()))
    assert as_text(got) == as_text(want)


def test_a_row_is_copied_only_for_a_heavy_partner(spark):
    left, right = skewed_sides(spark)
    cells = skew.heavy_cells(left, right, ["k"], 10, 15)
    assert rows(cells) == [("hot", 4, 2), ("left hot", 3, 1), ("right hot", 1, 3)]
    assert rows(skew.heavy_cells(left, None, ["k"], 10, 15)) == [("hot", 4, 1), ("left hot", 3, 1)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_with_two_keys_and_hot_nulls(spark, how):
    r = random.Random(1)
    key = lambda: (r.choice([None, None, 1, 2, 3]), r.choice(["x", None, "y"]))
    left = spark.createDataFrame([(*key(), i) for i in range(300)], "a int, b string, l int").repartition(4)
    right = spark.createDataFrame([(*key(), i) for i in range(60)], "a int, b string, r int").repartition(3)
    got = skew.skew_join(left, right, ["a", "b"], how, share=100, min_rows=4)
    want = left.join(right, ["a", "b"], how)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_skew_join_reads_each_side_once(spark, tmp_path):
    for name in "lr":
        spark.createDataFrame([(str(i % 9), i) for i in range(500)], f"k string, {name} int").write.parquet(f"{tmp_path}/{name}")
    left, right = spark.read.parquet(f"{tmp_path}/l"), spark.read.parquet(f"{tmp_path}/r")
    plan = skew.skew_join(left, right, ["k"], "left", share=100, min_rows=10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") <= 2

def test_heavy_keys_are_bounded(spark):
    counts = spark.createDataFrame([(i, 1) for i in range(50)] + [(99, 50)], "k int, n long")
    assert rows(skew.heavy_keys(counts, "n", share=3, min_rows=0)) == [(99, 50)]
    assert skew.heavy_keys(counts, "n", share=60, min_rows=0).count() < 60


# ---- order ----
@pytest.mark.parametrize("slices", [1, 3, 7])
def test_row_index(spark, slices):
    values = random.Random(1).sample(range(10**6), 300)
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(5)
    got = rows(ranking.with_row_index(df, "v", slices=slices))
    assert got == [(v, i) for i, v in enumerate(sorted(values))]


def test_row_index_breaks_ties(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (0, "z"), (2, "y")], "v long, t string")
    got = rows(ranking.with_row_index(df, "v", ["t"]), "row_index")
    assert [r[1] for r in got] == ["z", "a", "b", "y"]


def test_a_key_with_half_the_rows_is_cut(spark):
    r = random.Random(3)
    data = [(7 if i % 2 else r.randrange(1000), r.randrange(10**6)) for i in range(20_000)]
    df = spark.createDataFrame(data, "k int, t int").repartition(6)
    placed = ranking.sorted_slices(df, ["k"], slices=20)
    sizes = [r["count"] for r in placed.groupBy("_slice", "_part").count().collect()]
    assert max(sizes) <= 2 * 1000 and sum(sizes) == 20_000
    got = rows(ranking.with_row_index(df, "k", ["t"], slices=20), "row_index")
    assert [r[:2] for r in got] == sorted(data) and [r[2] for r in got] == list(range(20_000))


def test_equal_rows_are_cut_and_overfull_slices_too(spark, monkeypatch):
    same = spark.createDataFrame([(1, "x")] * 5000, "k int, t string").repartition(3)
    sizes = [r["count"] for r in ranking.sorted_slices(same, ["k"], slices=10).groupBy("_slice", "_part").count().collect()]
    assert max(sizes) <= 1000
    assert sorted(r["row_index"] for r in ranking.with_row_index(same, "k", slices=10).collect()) == list(range(5000))
    # a sample that misses most of the rows leaves a slice far over its share
    df = spark.range(8000).select(F.col("id").alias("k"))
    with changed_settings(spark, {"spark.sql.execution.rangeExchange.sampleSizePerPartition": 1}):
        placed = ranking.sorted_slices(df.coalesce(1), ["k"], slices=16)
        got = rows(ranking.with_row_index(df.coalesce(1), "k", slices=16))
    parts = placed.groupBy("_slice", "_part").count().collect()
    assert len(parts) > 8 and sum(r["count"] for r in parts) == 8000
    assert got == [(i, i) for i in range(8000)]


def test_row_index_of_text_and_of_nothing(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "v string")
    assert rows(ranking.with_row_index(df, "v"), "row_index") == [(None, 0), ("a", 1), ("b", 2)]
    assert ranking.with_row_index(df.limit(0), "v").count() == 0


@pytest.mark.parametrize("sent", [10**6, 2])
def test_chunks_without_moving_the_rows(spark, sent):
    ids = random.Random(5).sample(range(-10**6, 10**6), 1203)
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "id long, text string").repartition(3)
    got = ranking.with_chunks(df, "id", 100, sent_borders=sent)
    want = {i: n // 100 + 1 for n, i in enumerate(sorted(ids))}
    assert {r["id"]: r["chunk_id"] for r in got.collect()} == want and got.columns == ["id", "text", "chunk_id"]
    moved = got._jdf.queryExecution().executedPlan().toString().count("Join")
    assert (moved == 0) == (sent == 10**6)
    few = ranking.with_chunks(df.filter("id > 999990"), "id", 100)
    assert {r["chunk_id"] for r in few.collect()} <= {1}
    large = spark.createDataFrame([(2**60 + i,) for i in range(5)], "id long")
    assert rows(ranking.with_chunks(large, "id", 2), "id") == [(2**60 + i, i // 2 + 1) for i in range(5)]


def test_index_in_read_order(spark):
    df = spark.range(100, numPartitions=7).filter("id % 3 > 0").withColumn("text", F.col("id").cast("string"))
    got = rows(ranking.with_read_index(df).select("id", "row_index"))
    assert got == [(i, n) for n, i in enumerate(i for i in range(100) if i % 3)]


def test_chunks(spark):
    df = spark.range(1203)
    numbered = ranking.chunk_numbers(df, "id").withColumn("n", ranking.chunk_rows(df))
    assert rows(numbered.groupBy("chunk_id", "n").count()) == [(1, 500, 500), (2, 500, 500), (3, 203, 203)]


def test_first_and_last_per_key(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, None), ("b", 3, "z")], "k string, o int, v string")
    assert rows(ranking.first_per_key(df, ["k"], ["o"])) == [("a", 1, None), ("b", 3, "z")]
    assert rows(ranking.last_per_key(df, ["k"], ["o"])) == [("a", 2, "x"), ("b", 3, "z")]


def test_round_robin(spark):
    sizes, per_visit, cap = {"a": 9, "b": 2, "c": 20}, 3, 17
    data = [(t, 100 * i + j) for i, t in enumerate(sizes) for j in range(sizes[t])]
    queues = {t: [o for tag, o in data if tag == t] for t in sizes}
    want = []
    while any(queues.values()) and len(want) < cap:
        for tag in sizes:
            taken, queues[tag] = queues[tag][:per_visit], queues[tag][per_visit:]
            want += [(tag, o) for o in taken]
    got = ranking.round_robin_cap(spark.createDataFrame(data, "t string, o int"), "t", "o", per_visit=per_visit, cap=cap)
    assert [(r["t"], r["o"]) for r in got.collect()] == want[:cap]


# ---- posts ----
def raw_posts(spark):
    data = [
        (0, "1", " bob ", "2024-01-01T10:00:00Z", "Same  text", "3", ""),
        (1, "", None, "junk", "Same text", "abc", "7"),
        (2, "3", "x", None, "   ", None, None),
        (3, None, "x", "2024-01-02T00:00:00+02:00", "other", "3.0", None),
        (4, "5", "x", "", "Same\ntext", None, None),
    ]
    return spark.createDataFrame(data, "row_pos long, id string, username string, date string, content string, likeCount string, replyCount string")


def test_clean_posts(spark):
    out = clean.clean_posts(clean.candidates(raw_posts(spark)), DAY)
    got = {r["content_hash"] + str(r["username"]): r for r in out.collect()}
    assert out.count() == 4
    first = next(r for r in got.values() if r["id"] == "1")
    assert (first["username"], first["content"], first["likeCount"], first["replyCount"]) == ("bob", "Same text", 3, None)
    assert (first["date"], first["event_date"]) == ("2024-01-01T10:00:00+00:00", "2024-01-01")
    hashed = next(r for r in got.values() if r["id"] == r["content_hash"] and r["content"] == "Same text")
    assert (hashed["username"], hashed["likeCount"], hashed["replyCount"]) == ("", None, 7)
    assert hashed["ts"] == DAY and hashed["event_date"] == "2024-03-01"
    other = next(r for r in got.values() if r["content"] == "other")
    assert (other["date"], other["likeCount"]) == ("2024-01-01T22:00:00+00:00", 3)
    assert clean.candidates(raw_posts(spark), drop_empty=False).count() == 5


def test_dedupe_modes(spark):
    cand = clean.candidates(raw_posts(spark))
    assert rows(dedupe.dedupe(cand).select("row_pos")) == [(0,), (3,)]
    batched = dedupe.number_batches(raw_posts(spark), "row_pos", 2)
    keep = dedupe.dedupe(clean.candidates(batched), intra_batch="keep")
    assert rows(keep.select("row_pos")) == [(0,), (1,), (3,)]
    with pytest.raises(ValueError):
        dedupe.dedupe(cand, intra_batch="some")


def test_dedupe_against_seen(spark):
    cand = clean.candidates(raw_posts(spark))
    none = spark.createDataFrame([], "content_hash string, seen_at timestamp")
    marked = dedupe.mark_seen(none, dedupe.dedupe(cand), DAY)
    assert marked.count() == 2 and marked.first()["seen_at"] == DAY
    assert dedupe.dedupe(cand, marked).isEmpty()  # a second run finds nothing new
    assert dedupe.mark_seen(marked, cand, DAY).isEmpty()
    other = marked.filter(F.col("content_hash") == cand.filter("content = 'other'").first()["content_hash"])
    unique = dedupe.dedupe(cand)
    for small in (0, 100):
        assert rows(dedupe.drop_seen(unique, other).select("row_pos")) == [(0,)]
    old, new = dedupe.already_seen(cand, other), dedupe.unseen(cand, other)
    assert old.count() == 1 and rows(new.select("row_pos")) == [(0,), (1,), (4,)]


def test_feature_meta(spark):
    data = [("1", None, " a ", None, "5", None, "#x"), (None, "b", "", "2024", None, "#s", "#x"), ("3", " ", None, None, "z", None, None)]
    df = spark.createDataFrame(data, "id string, text string, content string, ts string, likeCount string, source_hashtag string, hashtags string")
    meta = clean.feature_meta(df)
    assert rows(meta) == [("", "2024", 0, 0, "#s", "b"), ("1", "", 5, 0, "#x", "a")]
    strict = clean.feature_meta(df, drop_empty=False, aliases=False)
    assert rows(strict.select("id", "source_hashtag", "content")) == [("", "#s", ""), ("1", "", "a"), ("3", "", "")]


# ---- text features ----
DOCS = ["the cat the dog", "a cat", "", "the THE bird of_1 é ée", "dog dog dog cat"]


def tfidf_by_hand(docs):
    counts = [Counter(re.findall(r"\w\w+", d.lower())) for d in docs]
    n, df = len(docs), Counter(t for c in counts for t in c)
    out = {}
    for i, c in enumerate(counts):
        w = {t: k * (math.log((1 + n) / (1 + df[t])) + 1) for t, k in c.items()}
        length = math.sqrt(sum(x * x for x in w.values()))
        out |= {(i, t): x / length for t, x in w.items()}
    return out


def doc_frame(spark):
    return spark.createDataFrame([(i, t, i // 3) for i, t in enumerate(DOCS)], "d int, t string, s int")


@pytest.mark.parametrize("min_rows", [0, 10**6])
def test_tfidf(spark, min_rows):
    docs = doc_frame(spark)
    weights = fx.tfidf(docs, "d", fx.term_counts(docs, "d", "t"), share=20, min_rows=min_rows)
    got = {(r["d"], r["term"]): r["weight"] for r in weights.collect()}
    assert got == pytest.approx(tfidf_by_hand(DOCS))


def test_tfidf_by_scope(spark):
    docs = doc_frame(spark)
    want = tfidf_by_hand(DOCS[:3]) | {(i + 3, t): w for (i, t), w in tfidf_by_hand(DOCS[3:]).items()}
    for counts in (fx.term_counts(docs, "d", "t", ["s"]), fx.bucket_counts(docs, "d", "t", ["s"])):
        weights = fx.tfidf(docs, "d", counts, ["s"])
        got = sorted(r["weight"] for r in weights.collect())
        assert got == pytest.approx(sorted(want.values()))


def test_tfidf_in_small_scopes(spark):
    docs = doc_frame(spark)
    numbered = ranking.with_chunks(docs.select("d", "t"), "d", 3)
    counts = fx.term_counts(numbered, "d", "t", ["chunk_id"]).repartition("chunk_id")
    out = fx.tfidf_in_small_scopes(counts, "d", ["chunk_id"], ranking.chunk_rows(docs, "chunk_id", 3))
    want = tfidf_by_hand(DOCS[:3]) | {(i + 3, t): w for (i, t), w in tfidf_by_hand(DOCS[3:]).items()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(chunk_id#\d+L, \d+\)", plan)) == 1  # the counts move to their chunk
    assert not re.search(r"Exchange.*\n.*Project \[d#\d+L?, t#", plan)  # no text does
    assert {(r["d"], r["term"]): r["weight"] for r in out.collect()} == pytest.approx(want)


def test_hashed_tfidf_has_the_same_weights(spark):
    out = fx.sparse_arrays(fx.hashed_tfidf(doc_frame(spark), "t"), "tfidf")
    want = defaultdict(list)
    for (i, _), w in tfidf_by_hand(DOCS).items():
        want[i].append(w)
    for r in out.collect():
        assert sorted(r["tf_values"]) == pytest.approx(sorted(want[r["d"]]), rel=1e-6)
        assert r["tf_width"] == 2**18 and r["tf_indices"] == sorted(r["tf_indices"])


def test_hash_width(spark):
    out = fx.sparse_arrays(fx.hashing_tf(doc_frame(spark), "t", 16), "tf").collect()
    assert all(r["tf_width"] == 16 and max(r["tf_indices"], default=0) < 16 for r in out)
    assert sum(sum(r["tf_values"]) for r in out) == sum(len(re.findall(r"\w\w+", d)) for d in DOCS)


def test_pack_and_unpack(spark):
    df = spark.createDataFrame([("a", 5, 1.0), ("a", 2, 3.0), ("b", 9, 1.0)], "d string, i int, v double")
    packed = fx.pack_sparse(df, ["d"], "i", "v")
    assert rows(packed) == [("a", [2, 5], [3.0, 1.0]), ("b", [9], [1.0])]
    assert rows(fx.unpack_sparse(packed, ["d"], "i", "v")) == rows(df)


def test_embedding(spark):
    out = fx.embed(doc_frame(spark), "t", fx.hash_projection_encoder(8), batch=2).collect()
    assert all(len(r["embedding"]) == 8 for r in out)
    lengths = {r["d"]: math.hypot(*r["embedding"]) for r in out}
    assert lengths == pytest.approx({0: 1, 1: 1, 2: 0, 3: 1, 4: 1})


# ---- scores ----
def test_contrast_model(spark):
    seeds = spark.createDataFrame([(0, [1.0, 0.0]), (0, [3.0, 2.0]), (1, [0.0, 4.0]), (2, [9.0, 9.0])], "s int, v array<float>")
    model = scoring.ContrastModel.fit(seeds, F.col("s") == 0, F.col("s") == 1, "v")
    assert model == scoring.ContrastModel((2.0, 1.0), (0.0, 4.0))
    with pytest.raises(ValueError):
        scoring.ContrastModel.fit(seeds, F.col("s") == 0, F.col("s") == 7, "v")
    words = scoring.ContrastModel.from_words(fx.hash_projection_encoder(8))
    assert len(words.positive) == len(words.negative) == 8


def test_standardize(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert rows(scoring.standardize(df, ["a", "b"]).select("a_z", "b_z")) == [(-1.0, 0.0), (1.0, 0.0)]


def score_tables(spark):
    features = [("1", DAY, 0.5, DAY), ("1", DAY, 0.9, DAY + timedelta(1)), ("2", None, 0.1, DAY), ("3", None, 0.2, DAY)]
    texts = [("1", DAY + timedelta(5), 2.0), ("2", DAY + timedelta(2), 1.0), ("2", None, 7.0), ("9", DAY, 3.0)]
    return (
        spark.createDataFrame(features, "id string, date timestamp, emb_score double, run_ts timestamp"),
        spark.createDataFrame(texts, "id string, date timestamp, lex_score double"),
    )


def test_join_scores_once_per_id(spark):
    joined = scoring.join_scores(*score_tables(spark), now=DAY + timedelta(9))
    assert rows(joined) == [("1", DAY, 0.9, 2.0), ("2", DAY + timedelta(2), 0.1, 1.0), ("3", DAY + timedelta(9), 0.2, 0.0)]


def test_join_scores_with_repeats(spark):
    joined = scoring.join_scores(*score_tables(spark), now=DAY, dedupe_keys=False)
    assert sorted((r["id"], r["emb_score"], r["lex_score"]) for r in joined.collect()) == [
        ("1", 0.5, 2.0), ("1", 0.9, 2.0), ("2", 0.1, 1.0), ("2", 0.1, 7.0), ("3", 0.2, 0.0),
    ]


def test_features_without_vector_are_left_out(spark):
    df = spark.createDataFrame([("1", None, [1.0, 0.0]), ("2", None, None)], "id string, date timestamp, embedding array<float>")
    model = scoring.ContrastModel((1.0, 0.0), (0.0, 1.0))
    assert rows(scoring.score_features(df, model).select("id", "emb_score")) == [("1", 1.0)]
    empty = scoring.score_features(df.filter("id = '2'"), model).withColumn("lex_score", F.lit(0.0))
    with pytest.raises(ValueError, match="no joined records"):
        scoring.ScoreScaler.fit(empty)


def test_row_ids(spark):
    df = spark.createDataFrame([("a", 0), ("", 1), (None, 2)], "id string, p int")
    got = scoring.row_ids(df, F.lit("part-0"), F.col("p")).orderBy("p").select("id").collect()
    assert [r[0] for r in got] == ["a", "row_part-0_1", "row_part-0_2"]


# ---- windows ----
def series(spark, *points):
    data = [(DAY + timedelta(minutes=m), v) for m, v in points]
    return spark.createDataFrame(data, "ts timestamp, v double")


def test_window_measures(spark):
    df = series(spark, (0, 1.0), (1, 2.0), (4.99, -3.0), (5, 0.0), (10, 2.0), (11, 2.0), (12, None))
    out = [r.asDict() for r in windows.window_signals(df, "ts", "v", min_posts=1).orderBy("window_start").collect()]
    a, b, c = out
    assert (a["n"], a["count"], a["mean_signal"], a["trade_action"]) == (3, 3, 0.0, "SHORT")
    assert a["sem"] == pytest.approx(math.sqrt(7.0 / 3)) and a["ci95_half"] == pytest.approx(4.302652729911275 * a["sem"])
    assert (b["n"], b["sem"], b["ci95_half"], b["proportion_positive"], b["proportion_negative"], b["trade_action"]) == (1, 0.0, 0.0, 0.0, 0.0, "HOLD")
    assert (c["n"], c["count"], c["sem"], c["proportion_positive"]) == (3, 2, 0.0, pytest.approx(2 / 3))
    assert c["window_start_iso"] == "2024-03-01T00:10:00Z"
    assert windows.window_signals(df, "ts", "v").count() == 1  # three posts with a value


def test_gaps(spark):
    df = series(spark, (1, 1.0), (21, -1.0))
    out = windows.window_signals(df, "ts", "v", min_posts=0).orderBy("window_start").collect()
    assert [r["n"] for r in out] == [1, 0, 0, 0, 1]
    assert [r["trade_action"] for r in out] == ["SHORT", "HOLD", "HOLD", "HOLD", "LONG"]
    assert windows.window_signals(df.limit(0), "ts", "v", min_posts=0).isEmpty()


def test_gap_blocks(spark, monkeypatch):
    monkeypatch.setattr(windows, "FILL_BLOCK", 4)
    for last in (0, 3, 4, 5, 9):
        df = series(spark, (0, 1.0), (last * 5, 1.0))
        out = windows.window_signals(df, "ts", "v", min_posts=0)
        assert [r[0] for r in rows(out.select("window_start"))] == [DAY + timedelta(minutes=5 * i) for i in range(last + 1)]


def test_windows_count_from_the_first_midnight(spark):
    df = series(spark, (23 * 60 + 58, 1.0), (24 * 60 + 1, 1.0), (24 * 60 + 6, 1.0))
    starts = [r[0] for r in rows(windows.with_window(df, "ts", "7min").select("window_start"))]
    # 205 whole windows of 7 minutes fit in a day; the 206th starts at 23:55
    first = DAY + timedelta(minutes=7 * 205)
    assert starts == [first, first, first + timedelta(minutes=7)]


def test_lookup_and_plot(spark):
    df = series(spark, *[(i, (-1.0) ** i if i < 10 else 1.0) for i in range(30)])
    out = windows.window_signals(df, "ts", "v", min_posts=1)
    plot = windows.plot_series(out, points=4).orderBy("window_start").collect()
    assert [r["window_start"].minute for r in plot] == [0, 10, 20]
    assert plot[1]["trade_action"] == "SHORT" and plot[1]["marker"] == pytest.approx(1.05)
    assert plot[0]["upper"] - plot[0]["lower"] == pytest.approx(2 * out.filter("window_start_iso like '%00:00Z'").first()["ci95_half"])
    extra = out.select("window_start", F.lit(4).alias("x")).limit(2)
    assert sorted(r["x"] for r in windows.lookup_measures(out, extra).collect()) == [0, 0, 0, 0, 4, 4]


# ---- counts ----
def test_summary(spark):
    df = series(spark, *[(i, 1.0) for i in range(10)], *[(i, -1.0) for i in range(10, 15)])
    signals = windows.window_signals(df, "ts", "v")
    row = summary.run_summary(signals, 15).first()
    assert (row["total_windows"], row["total_posts_used"], row["last_window"]) == (3, 15, "2024-03-01T00:10:00Z")
    assert row["trade_action_summary"] == {"SHORT": 2, "LONG": 1}
    assert summary.action_histogram(signals).first()[0] == {"SHORT": 2, "LONG": 1}
    nothing = summary.run_summary(signals.limit(0), 0).first()
    assert (nothing["total_windows"], nothing["last_window"], nothing["trade_action_summary"]) == (0, None, {})


def test_tag_counts(spark):
    from crowdtide.sources.read import keyword_dimension

    posts = spark.createDataFrame([("#ipo",), ("#ipo",), ("#market",)], "source_hashtag string")
    assert rows(summary.tag_counts(posts, "source_hashtag")) == [("#ipo", 2), ("#market", 1), ("TOTAL", 3)]
    dimension = keyword_dimension(spark)
    got = dict(r[0:3:2] for r in rows(summary.counts_for_all(dimension, posts, "source_hashtag")))
    assert got == {k: {"#ipo": 2, "#market": 1}.get(k, 0) for k in KEYWORDS}


def test_concat(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3, "c")], "x int, z string")
    assert rows(merge.concat([a, b]), "x") == [(1, 2, None), (3, None, "c")]


def test_watch_and_spread(spark):
    df, seen = summary.watch(spark.range(10), "w", n=F.count("*"), big=F.count_if(F.col("id") > 6))
    df.collect()
    assert seen.get == {"n": 10, "big": 3}
    assert spread(spark.range(10, numPartitions=1), "id").rdd.getNumPartitions() == 4
    assert spread(spark.range(10, numPartitions=9)).rdd.getNumPartitions() == 9


# ---- pages ----
PAGE = """<html><nav><a href="/outside">o</a></nav>
<article><script>var x="</p>";</script><a href="/i/ad">ad</a><a class="c" href="/bob/status/9">t</a>
<time datetime="2024-01-05T01:02:03.000Z"></time><p>Bob @Bob_1</p>
<div dir="x" data-testid="tweetText">Buy &amp; hold #Nifty50<br>now @amy</div>
<div role="group"><span aria-label="1,200 Likes. Like"></span><span aria-label="7 reply"></span></div>
<p>15 quotes</p></article>
<article><div lang="en">second one</div>tail</article><article> <b></b> </article>
<article>plain &lt;text&gt; @zed</article></html>"""


def test_page_records(spark):
    df = spark.createDataFrame([(1, PAGE)], "page_id int, html string")
    first, second, third = pages.page_records(df, source_hashtag=F.lit("#ipo"), now=DAY).orderBy("article_no").collect()
    assert first.asDict() == {
        "page_id": 1, "article_no": 0, "id": "https://x.com/bob/status/9", "username": "bob",
        "date": "2024-01-05T01:02:03.000Z", "content": "Buy & hold #Nifty50 now @amy", "replyCount": 7,
        "retweetCount": None, "likeCount": 1200, "quoteCount": 15, "mentions": "amy", "hashtags": "nifty50",
        "url": "https://x.com/bob/status/9", "source_hashtag": "#ipo",
    }
    assert (second["content"], second["username"], second["url"], len(second["id"])) == ("second one", "", "", 40)
    assert (third["article_no"], third["content"], third["username"]) == (3, "plain <text> @zed", "zed")
    assert third["date"] == "2024-03-01T00:00:00+00:00"
    linked = pages.page_records(df, links_of_page=True, now=DAY).orderBy("article_no").collect()
    assert [r["username"] for r in linked] == ["outside"] * 3


NESTED = """<article><span>A @bob</span><a href='/carol/status/5'>t</a>
<div data-testid='tweetText'><div>line one</div><div>line two #tag &#65;&#x1F600;</div></div><div lang="en">quoted</div>
<div role="group"><div aria-label="12 Replies. Reply"></div><div aria-label='7 reply'></div>
<div><div aria-label="34 Retweets"></div></div><div aria-label="56 Likes. Like"></div></div><div aria-label="9 quotes"></div></article>
<article><div lang="en"><div>never closed</div> tail</article>"""


def test_page_records_of_nested_markup(spark):
    df = spark.createDataFrame([(1, NESTED)], "page_id int, html string")
    first, second = pages.page_records(df, now=DAY).orderBy("article_no").collect()
    assert first["content"] == "line one line two #tag A\U0001F600"
    assert (first["replyCount"], first["retweetCount"], first["likeCount"], first["quoteCount"]) == (7, 34, 56, None)
    assert (first["url"], first["username"], first["hashtags"]) == ("https://x.com/carol/status/5", "carol", "tag")
    assert second["content"] == "never closed  tail"


QUOTING = """<ARTICLE><p>outer</p><article class='q'><p>inner @amy</p><script>"</article>"</script></article>
<!-- <article> --><div role="group"><i aria-label="7 likes"></i></div><a href="/bob/status/1">t</a></ARTICLE></article>
<article>one <article>two <article>three</article> after"""


def test_articles_inside_articles_are_records_of_their_own(spark):
    df = spark.createDataFrame([(1, QUOTING), (2, None), (3, "</article>"), (4, "<article>"), (5, "")], "page_id int, html string")
    rows = pages.page_records(df, now=DAY).orderBy("page_id", "article_no").collect()
    outer, inner, *rest = rows
    assert (outer["likeCount"], outer["url"], outer["username"]) == (7, "https://x.com/bob/status/1", "bob")
    assert (outer["content"].split(), outer["mentions"]) == (["outer", "inner", "@amy", "t"], "amy")
    assert (inner["article_no"], inner["likeCount"], inner["url"], inner["username"]) == (1, None, "", "amy")
    assert inner["content"] == "inner @amy"
    # the close goes to the article opened last; the others go to the end of the page
    assert [(r["article_no"], " ".join(r["content"].split())) for r in rest] == [(2, "one two three after"), (3, "two three after"), (4, "three")]


def test_deep_and_many_articles(spark):
    html = "<article>" * 60 + "x" + "</article>" * 60 + "".join(f"<article>n{i}</article>" for i in range(300))
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    rows = pages.page_records(df, now=DAY).orderBy("article_no").collect()
    assert [r["content"] for r in rows] == ["x"] * 60 + [f"n{i}" for i in range(300)]


def test_posts_alike_in_their_opening_are_two(spark):
    pair = [(1, "<article>" + "x" * 500 + end + "</article>") for end in "ab"]
    df = spark.createDataFrame(pair, "page_id int, html string")
    assert pages.page_records(df, now=DAY).select("id").distinct().count() == 2


def test_hashed_tfidf_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fx.hashed_tfidf(empty, "text", 64).count() == 0


def test_wide_rows_are_cut_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SLICE_BYTES", 100_000, raising=False)
    wide = spark.range(300, numPartitions=3).select("id", F.repeat(F.lit("x"), 4000).alias("t"))
    # long texts side by side: a fair share of the rows, not of the bytes
    uneven = spark.range(2000, numPartitions=3).select(
        "id", F.repeat(F.lit("x"), F.when(F.col("id") < 100, 10_000).otherwise(1)).alias("t"))
    for df in (wide, uneven):
        placed = ranking.sorted_slices(df, ["id"])
        sizes = [r["b"] for r in placed.groupBy("_slice", "_part").agg(F.sum(F.length("t")).alias("b")).collect()]
        assert max(sizes) <= 300_000
        got = dedupe.number_batches(df, "id", 7).select("id", "batch_id").collect()
        assert sorted((r["id"], r["batch_id"]) for r in got) == [(i, i // 7 + 1) for i in range(df.count())]

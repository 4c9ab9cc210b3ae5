"""The operators over the shared test tables: one query per operator or job.

Each query reads whole tables. Times leave as ISO text and doubles rounded to six
digits, so that another engine's result can be compared value by value.
"""

from __future__ import annotations

import math
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from crowdtide.functions import casts, extract, stats, text as tx, times, vectors
from crowdtide.operators import clean, dedupe, features as fx, merge, pages as pg
from crowdtide.operators import ranking, scoring, skew, summary, windows
from crowdtide.plans.clean_job import new_posts
from crowdtide.plans.merge_job import run_merge_job, run_table_copy
from crowdtide.plans.signal_job import trade_signals
from crowdtide.schemas import STORED_POST
from crowdtide.session import changed_settings, cut_lineage, ensure_checkpoint_dir, spread, use_utc
from crowdtide.sources import intake, read, write
from crowdtide.streaming.dedupe_stream import start_clean_stream
from crowdtide.streaming.feature_stream import post_file_stream, start_feature_stream
from crowdtide.streaming.signal_stream import late_counts, stream_signals

NOW = datetime(2024, 6, 1)
#: Text in a file of a stream: a file is written by one task and read by few.
STREAM_FILE_BYTES = 8 << 20
# The default lexicon does not occur in the test texts; these words do.
POSITIVE = ["the", "and", "to"]
NEGATIVE = ["der", "die", "la"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, timestamps to ISO text."""
    out = []
    for field in df.schema:
        column = F.col(field.name)
        kind = field.dataType.simpleString()
        if kind in ("double", "float"):
            # adding zero turns a negative zero into a plain one
            column = F.round(column.cast("double"), 6) + F.lit(0.0)
        elif kind.startswith("timestamp"):
            column = times.window_iso(column.cast("timestamp"))
        out.append(column.alias(field.name))
    return df.select(*out)


def documents(spark, sf_dir) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def document_posts(spark, sf_dir) -> DataFrame:
    """Documents in the raw post columns."""
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("row_pos"),
        F.col("doc_id").cast("string").alias("id"),
        F.concat(F.lit("  "), "source", F.lit("\t")).alias("username"),
        F.lit(None).cast("string").alias("date"),
        F.when(F.col("lang") != "en", F.col("text")).alias("content"),
        F.when(F.col("lang") == "en", F.col("text")).alias("text"),
        F.col("n_chars").cast("string").alias("likeCount"),
        F.lit("").alias("retweetCount"),
        F.concat(F.col("n_chars").cast("string"), F.lit(".0")).alias("replyCount"),
        F.col("lang").alias("quoteCount"),
        F.col("source").alias("source_hashtag"),
    )


def earlier_hashes(spark, sf_dir) -> DataFrame:
    """The seen table of an earlier run: hashes of the documents that have labels."""
    labelled = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_pos")).distinct()
    return (
        clean.candidates(document_posts(spark, sf_dir).join(labelled, "row_pos", "left_semi"))
        .select("content_hash")
        .distinct()
        .withColumn("seen_at", F.lit(datetime(2024, 1, 1)).cast("timestamp"))
    )


def document_texts(spark, sf_dir) -> DataFrame:
    return documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("id"),
        F.lit(None).cast("timestamp").alias("date"),
        tx.strip(F.col("text")).alias("content"),
    )


def vector_features(spark, sf_dir) -> DataFrame:
    """Embeddings dated by the event of the same number."""
    dated = events(spark, sf_dir).select(F.col("event_id").alias("vec_id"), F.col("ts").alias("date"))
    return (
        table(spark, sf_dir, "embeddings")
        .join(dated, "vec_id", "left")
        .select(F.col("vec_id").cast("string").alias("id"), "date", "embedding")
    )


def contrast_model(spark, sf_dir) -> scoring.ContrastModel:
    label = F.col("label")
    return scoring.ContrastModel.fit(
        table(spark, sf_dir, "embeddings"), label == 0, label == 1, "embedding"
    )


def signals_flagship(spark, sf_dir):
    return rounded(
        trade_signals(
            vector_features(spark, sf_dir),
            document_texts(spark, sf_dir),
            contrast_model(spark, sf_dir),
            POSITIVE,
            NEGATIVE,
            now=NOW,
            frequency="1h",
        ).drop("window_start")
    )


def event_signals(spark, sf_dir, **options) -> DataFrame:
    scored = scoring.standardize(events(spark, sf_dir).select("ts", "value"), ["value"])
    return windows.window_signals(scored, "ts", "value_z", **options)


def signals_event_windows(spark, sf_dir):
    return rounded(event_signals(spark, sf_dir).drop("window_start"))


def signals_hourly(spark, sf_dir):
    return rounded(event_signals(spark, sf_dir, frequency="1h").drop("window_start"))


def signals_gap_filled(spark, sf_dir):
    return rounded(event_signals(spark, sf_dir, min_posts=0).drop("window_start"))


def signals_anchored_7min(spark, sf_dir):
    return rounded(event_signals(spark, sf_dir, frequency="7min", min_posts=1).drop("window_start"))


def signals_summary(spark, sf_dir):
    posts = events(spark, sf_dir).agg(F.count("*")).scalar()
    row = summary.run_summary(event_signals(spark, sf_dir), posts)
    entries = F.transform(
        F.map_entries("trade_action_summary"),
        lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")),
    )
    return row.withColumn("trade_action_summary", F.array_join(F.array_sort(entries), ","))


def signals_plot_series(spark, sf_dir):
    return rounded(windows.plot_series(event_signals(spark, sf_dir), 200))


def window_lookup(spark, sf_dir):
    """Errors per hour attached to all hours that have events."""
    hourly = windows.with_window(events(spark, sf_dir), "ts", "1h")
    all_hours = hourly.groupBy("window_start").agg(F.count("*").alias("n"))
    errors = (
        hourly.filter("event_type = 'error'")
        .groupBy("window_start")
        .agg(F.count("*").alias("errors"), F.max("value").alias("worst"))
    )
    return rounded(windows.lookup_measures(all_hours, errors))


def clean_documents(spark, sf_dir):
    rows = clean.candidates(document_posts(spark, sf_dir))
    return clean.clean_posts(rows, NOW).drop("ts")


def _survivors(df: DataFrame) -> DataFrame:
    return df.select("id", "username", "content_hash", "event_date")


def dedupe_documents(spark, sf_dir):
    return _survivors(new_posts(document_posts(spark, sf_dir), now=NOW))


def dedupe_keep_intra(spark, sf_dir):
    return _survivors(new_posts(document_posts(spark, sf_dir), intra_batch="keep", now=NOW))


def dedupe_second_run(spark, sf_dir):
    raw, seen = document_posts(spark, sf_dir), earlier_hashes(spark, sf_dir)
    return _survivors(new_posts(raw, seen, now=NOW))


def dedupe_incremental_anti(spark, sf_dir):
    rows = clean.candidates(document_posts(spark, sf_dir)).select("id", "content_hash")
    return dedupe.unseen(rows, earlier_hashes(spark, sf_dir))


def dedupe_incremental_semi(spark, sf_dir):
    rows = clean.candidates(document_posts(spark, sf_dir))
    return dedupe.already_seen(rows, earlier_hashes(spark, sf_dir))


def seen_after_run(spark, sf_dir):
    seen = earlier_hashes(spark, sf_dir)
    new = dedupe.mark_seen(seen, clean.candidates(document_posts(spark, sf_dir)), NOW)
    return rounded(merge.concat([seen, new]))


def first_event_per_user(spark, sf_dir):
    first = ranking.first_per_key(events(spark, sf_dir), ["user_id"], ["ts", "event_id"])
    return rounded(first.select("user_id", "event_id", "event_type", "ts", "value"))


def _written_times(spark, sf_dir) -> DataFrame:
    """Event times spelled as the producers of posts spell them, or not at all."""
    ts, kind = F.col("ts"), F.col("event_type")
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    spelled = (
        F.when(kind == "click", F.concat(iso, F.lit("Z")))
        .when(kind == "view", F.concat(iso, F.lit("+05:30")))
        .when(kind == "signup", F.concat(iso, F.lit(".250000")))
        .when(kind == "purchase", F.unix_millis(ts).cast("string"))
        .otherwise(F.lit("yesterday"))
    )
    return events(spark, sf_dir).select("event_id", spelled.alias("date"))


def parsed_times(spark, sf_dir):
    ts = times.parse_time(F.col("date"))
    return _written_times(spark, sf_dir).select(
        "event_id",
        times.post_iso(times.time_or_now(ts, NOW)).alias("date"),
        times.event_day(ts).alias("event_date"),
    )


def posts_per_day(spark, sf_dir):
    dated = _written_times(spark, sf_dir).withColumn(
        "event_date", times.event_day(times.parse_time(F.col("date")))
    )
    return summary.rows_per_day(dated)


def safe_casts(spark, sf_dir):
    k, kind = F.get_json_object("props", "$.k"), F.col("event_type")
    spelled = (
        F.when(kind == "click", k)
        .when(kind == "view", F.concat(k, F.lit(".0")))
        .when(kind == "signup", F.lit(""))
        .when(kind == "purchase", F.concat(k, F.lit(" likes")))
    )
    raw = events(spark, sf_dir).select("event_id", spelled.alias("raw"))
    return raw.select(
        "event_id",
        casts.optional_int(F.col("raw")).alias("optional_count"),
        casts.int_or_zero(F.col("raw")).alias("count_or_zero"),
    )


def feature_meta(spark, sf_dir):
    posts = document_posts(spark, sf_dir).withColumn("hashtags", F.col("quoteCount"))
    posts = posts.withColumn("source_hashtag", F.nullif("source_hashtag", F.lit("web")))
    meta = clean.feature_meta(posts)
    return meta.withColumn("content", tx.content_hash(F.col("content")))


def lexical_score(spark, sf_dir):
    tokens = F.col("_words")
    return rounded(
        documents(spark, sf_dir)
        .select("doc_id", tx.words(F.col("text")).alias("_words"))
        .select(
            "doc_id",
            F.size(tokens).alias("words"),
            tx.lexicon_hits(tokens, POSITIVE).alias("positive"),
            tx.lexicon_hits(tokens, NEGATIVE).alias("negative"),
            tx.score_words(tokens, POSITIVE, NEGATIVE).alias("score"),
        )
    )


def _tfidf(docs: DataFrame, scope=()) -> DataFrame:
    counts = fx.term_counts(fx.by_document(docs, "doc_id", "text"), "doc_id", "text", scope)
    return rounded(fx.tfidf(docs, "doc_id", counts, scope))


def tfidf_corpus(spark, sf_dir):
    return _tfidf(documents(spark, sf_dir))


def tfidf_chunk(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    # terms are counted where the texts are; the counts move to their chunk
    counts = fx.term_counts(ranking.with_chunks(docs, "doc_id"), "doc_id", "text", ["chunk_id"])
    sizes = ranking.chunk_rows(table(spark, sf_dir, "documents"), "chunk_id")
    return rounded(fx.tfidf_in_small_scopes(counts.repartition("chunk_id"), "doc_id", ["chunk_id"], sizes))


def tfidf_source(spark, sf_dir):
    """The source stands for the file a post came in."""
    return _tfidf(documents(spark, sf_dir), ["source"])


def document_frequency(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return fx.document_frequency(fx.term_counts(fx.by_document(docs, "doc_id", "text"), "doc_id", "text"))


def sparse_roundtrip(spark, sf_dir):
    docs = documents(spark, sf_dir)
    bucket = F.pmod(
        F.conv(F.substring(F.md5(F.col("term").cast("binary")), 1, 8), 16, 10).cast("bigint"),
        F.lit(2**18),
    )
    entries = (
        fx.term_counts(fx.by_document(docs, "doc_id", "text"), "doc_id", "text")
        .groupBy("doc_id", bucket.alias("bucket"))
        .agg(F.sum("tf").alias("tf"))
    )
    packed = fx.pack_sparse(entries, ["doc_id"], "bucket", "tf")
    return fx.unpack_sparse(packed, ["doc_id"], "bucket", "tf")


def _buckets(rows: DataFrame, vector: str) -> DataFrame:
    """One row per document and bucket of a sparse vector column."""
    inner = F.unwrap_udt(vector)
    entries = F.arrays_zip(inner["indices"].alias("bucket"), inner["values"].alias("value"))
    return rows.select("doc_id", F.explode(entries).alias("x")).select("doc_id", "x.bucket", "x.value")


def hashing_tf(spark, sf_dir):
    rows = _buckets(fx.hashing_tf(documents(spark, sf_dir), "text"), "tf")
    return rows.select("doc_id", "bucket", F.col("value").cast("bigint").alias("tf"))


def hashed_tfidf(spark, sf_dir):
    rows = _buckets(fx.hashed_tfidf(documents(spark, sf_dir), "text"), "tfidf")
    return rounded(rows.withColumnRenamed("value", "weight"))


def embed_documents(spark, sf_dir):
    """Components of the stand-in encoder's vectors, less those that are zero."""
    rows = fx.embed(documents(spark, sf_dir), "text", fx.hash_projection_encoder(64))
    return rounded(rows.select("doc_id", F.posexplode("embedding").alias("position", "value")).filter("value <> 0"))


def centroids(spark, sf_dir):
    return rounded(scoring.centroids(table(spark, sf_dir, "embeddings"), "label", "embedding"))


def embedding_contrast(spark, sf_dir):
    model, vector = contrast_model(spark, sf_dir), F.col("embedding")
    return rounded(
        table(spark, sf_dir, "embeddings").select(
            "vec_id",
            vectors.cosine(vector, F.lit(list(model.positive))).alias("to_positive"),
            vectors.cosine(vector, F.lit(list(model.negative))).alias("to_negative"),
            model.score(vector).alias("contrast"),
        )
    )


def standardize(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "value", F.lit(7.0).alias("constant"))
    return rounded(scoring.standardize(rows, ["value", "constant"]))


def feature_text_join(spark, sf_dir):
    joined = scoring.join_texts(
        vector_features(spark, sf_dir), document_texts(spark, sf_dir), NOW
    )
    return rounded(joined.select("id", tx.content_hash(F.col("content")).alias("content"), "ts"))


def feature_text_join_hot(spark, sf_dir):
    """The same where half of the features and a few texts share one id: its rows are dealt
    into cells of a thousandth of all rows, and each meets each text once."""
    hot = F.when(F.col("id").cast("bigint") % 2 == 0, "hot").otherwise(F.col("id")).alias("key")
    features = vector_features(spark, sf_dir).select(hot, F.col("id").alias("vec_id"))
    few = F.when(F.col("id").cast("bigint") < 3, "hot").otherwise(F.col("id")).alias("key")
    texts = document_texts(spark, sf_dir).select(few, F.col("id").alias("doc_id"), tx.content_hash(F.col("content")).alias("content"))
    return skew.skew_join(features, texts, ["key"], "left", share=1000, min_rows=20)


def mentions_hashtags(spark, sf_dir):
    """Texts with some plain words turned into tags and names."""
    texts = documents(spark, sf_dir).select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "text"
    )
    turns = table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("c"), F.concat_ws("-", "conv_id", "turn")).alias("id"), "text"
    )
    marked = F.replace(F.replace("text", F.lit(" the "), F.lit(" #The")), F.lit(" de "), F.lit(" @de_"))
    return texts.union(turns).withColumn("text", marked).select(
        "id",
        extract.joined(extract.mention_list(F.col("text"))).alias("mentions"),
        extract.joined(extract.hashtag_list(F.col("text"))).alias("hashtags"),
    )


def page_records(spark, sf_dir):
    return pg.page_records(
        spread(table(spark, sf_dir, "pages").drop("url"), "page_id"),
        source_hashtag=F.lit("#market"),
        links_of_page=True,
        now=NOW,
    )


def nested_pages(spark, sf_dir) -> DataFrame:
    """Pages whose post quotes another, which quotes a third; the own page is the post's text."""
    def text(name):
        escaped = F.coalesce(F.col(name), F.lit(""))
        for char, escape in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            escaped = F.replace(escaped, F.lit(char), F.lit(escape))
        return escaped

    p = F.col("page_id").cast("string")
    html = F.concat(
        F.lit("<main><!-- <article>no post</article> --><script>var a = '</article>';</script>"
              '<article class="post"><a href="/i/flow">skip</a><a href="/bob'), p, F.lit('">b</a><a href="/bob'), p,
        F.lit("/status/"), p, F.lit('">permalink</a><div data-testid="tweetText">'), text("html"),
        F.lit('</div><ARTICLE><article><div lang="de">third '), p, F.lit("</div></article><div>quoted "), text("url"),
        F.lit('</div><a href="https://x.com/ann'), p, F.lit("/status/9"), p,
        F.lit('">more</a></article>after<div role="group"><div><button aria-label="'), p,
        F.lit(' likes"></button></div><i aria-label="1,'), F.lpad(F.pmod("page_id", F.lit(1000)).cast("string"), 3, "0"),
        F.lit(' Retweets"></i><i aria-label="3 reply"></i><i aria-label="4 quotes"></i></div></article>'
              '</article><p aria-label="9 likes">no post</p><article><h1>last '), p, F.lit("</h1>never closed"))
    return spread(table(spark, sf_dir, "pages"), "page_id").select("page_id", html.alias("html"))


def page_articles_nested(spark, sf_dir):
    """Every article of a page, inner ones too, each with its own links, labels and body."""
    records = pg.page_records(nested_pages(spark, sf_dir), now=NOW)
    return records.select(
        "page_id", "article_no", F.when(F.col("url") != "", F.col("id")).alias("id"), "username", F.sha1(F.col("content").cast("binary")).alias("content"),
        "likeCount", "retweetCount", "replyCount", "quoteCount", "url")


def label_counts(spark, sf_dir):
    """Labels and text written from line items: overriding, unusable and text-only counts."""

    def number(name):
        return F.col(name).cast("bigint").cast("string")

    line = F.col("l_linenumber")
    labels = F.array(
        F.concat(number("l_quantity"), F.lit(" Likes. Like")),
        F.when(line == 1, F.concat(number("l_suppkey"), F.lit(" liked"))),
        F.when(line == 2, F.concat(number("l_suppkey"), F.lit(".9 reply"))),
        F.concat(F.lit("1,"), F.lpad(number("l_linenumber"), 3, "0"), F.lit(" Retweets")),
        F.lit("1.2K quotes"),
        F.lit(", likes"),
    )
    text = F.concat(
        number("l_partkey"), F.lit(" Replies and 2,"), F.lpad(number("l_suppkey"), 3, "0"), F.lit(" quotes")
    )
    counted = extract.with_label_counts(
        spread(table(spark, sf_dir, "lineitem")),
        F.filter(labels, lambda x: x.isNotNull()),
        text,
        {kind: f"{kind}_count" for kind in ("like", "retweet", "reply", "quote")},
    )
    return counted.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "like_count", "retweet_count", "reply_count", "quote_count",
    )


def roundrobin_cap(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return ranking.round_robin_cap(docs, "source", "doc_id", cap=400)


def per_tag_counts(spark, sf_dir):
    return summary.tag_counts(table(spark, sf_dir, "documents").select("source"), "source")


def counts_for_all(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select("n_nationkey")
    owing = table(spark, sf_dir, "supplier").filter("s_acctbal < 0").select(
        F.col("s_nationkey").alias("n_nationkey")
    )
    return summary.counts_for_all(nations, owing, "n_nationkey")


def merge_mixed_schema(spark, sf_dir):
    def plain(name, prefix):
        df = table(spark, sf_dir, name)
        return df.select(*[F.col(c).alias(c.removeprefix(prefix)) for c in df.columns])

    return merge.concat([plain("customer", "c_"), plain("supplier", "s_")]).withColumnsRenamed(
        {"custkey": "customer_key", "suppkey": "supplier_key"}
    )


def row_chunks(spark, sf_dir):
    return ranking.chunk_numbers(events(spark, sf_dir).select("event_id"), "event_id")


def job_metrics(spark, sf_dir):
    raw, seen = document_posts(spark, sf_dir), earlier_hashes(spark, sf_dir)
    rows = clean.candidates(raw, drop_empty=False).select(
        F.when(F.col("content") != "", F.col(dedupe.HASH)).alias(dedupe.HASH)
    )
    per_hash = rows.groupBy(dedupe.HASH).count().join(
        seen.select(dedupe.HASH).distinct().withColumn("_seen", F.lit(1)), dedupe.HASH, "left"
    )
    filled = F.col(dedupe.HASH).isNotNull()
    total = per_hash.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("rows_read"),
        F.coalesce(F.sum(F.when(filled, F.col("count"))), F.lit(0)).alias("candidates"),
        F.count("_seen").alias("already_seen"),
        F.count(F.when(filled & F.col("_seen").isNull(), 1)).alias("cleaned"),
    )
    return total.unpivot([], total.columns, "metric", "value")


def t_confidence(spark, sf_dir):
    """Band per user and event type, whose sizes run from one to many."""
    grouped = events(spark, sf_dir).groupBy(F.pmod("user_id", F.lit(97)).alias("bucket")).agg(
        *windows.window_measures("value")
    )
    small = events(spark, sf_dir).groupBy("user_id").agg(*windows.window_measures("value"))
    both = small.withColumnRenamed("user_id", "bucket").unionByName(
        grouped.withColumn("bucket", -F.col("bucket") - 1)
    )
    banded = both.withColumn("ci95_half", stats.half_width(F.col("n"), F.col("sem")))
    return rounded(banded.select("bucket", "n", "mean_signal", "sem", "ci95_half"))


def _scratch(spark) -> str:
    return f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"


def _run(stream, root: str, write=None):
    """A stream to its end, over what is there."""
    writer = stream.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
    query = (writer.foreachBatch(write).start() if write else writer.format("parquet").outputMode("append").start(f"{root}/out"))
    query.awaitTermination()
    return query


def _plain_posts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("lang").alias("username"),
        F.col("text").alias("content"),
        F.col("n_chars").cast("string").alias("likeCount"),
    )


def _text_bytes(df: DataFrame, text: str) -> int:
    return df.agg(F.sum(F.octet_length(text))).first()[0] or 0


def _hashed_content(df: DataFrame) -> DataFrame:
    return df.withColumn("content", F.sha1(F.coalesce("content", F.lit("")).cast("binary")))


def csv_round_trip(spark, sf_dir):
    """Documents with quotes and line ends in them, written to a CSV file for each piece that
    the table is read in, and read back by the reader of raw posts, which cuts the files every
    256 KB, or into about a thousand splits."""
    path = f"{_scratch(spark)}/csv"
    text = F.replace(F.replace("content", F.lit(" the "), F.lit('"the"\n')), F.lit(", "), F.lit('\r\n",""'))
    posts = _plain_posts(spark, sf_dir).withColumn("content", text)
    write.write_csv(posts, path)
    small = {"spark.sql.files.maxPartitionBytes": max(1 << 18, _text_bytes(posts, "content") // 1000), "spark.sql.files.openCostInBytes": 0}
    with changed_settings(spark, small):
        return cut_lineage(_hashed_content(read.read_raw_posts(spark, path).select("id", "username", "content")))


def csv_typed_copy(spark, sf_dir):
    """Orders written as CSV, read with guessed types and copied to plain Parquet."""
    root = _scratch(spark)
    write.write_csv(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority"), f"{root}/csv")
    run_table_copy(spark, f"{root}/csv", f"{root}/copy")
    return rounded(spark.read.parquet(f"{root}/copy").withColumn("o_orderkey", F.col("o_orderkey").cast("bigint")))


def _damaged_lines(spark, sf_dir) -> DataFrame:
    """Documents as JSON lines, some broken off, some no object, some blank."""
    body = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("content")))
    digest, kind = F.sha1(F.coalesce("text", F.lit("")).cast("binary")), F.pmod("doc_id", F.lit(11))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(kind == 1, F.concat(F.lit('{"content": "'), digest))
        .when(kind == 2, F.concat(F.lit('[{"id": "'), digest, F.lit('"}]')))
        .when(kind == 3, F.concat(F.lit('"'), digest, F.lit('"')))
        .when(kind == 4, F.lit("  \t")).otherwise(body).alias("value"))


def _intake_rows(good: DataFrame, bad: DataFrame, counters: dict) -> DataFrame:
    """What was read, set aside and counted, in one table."""
    counted = good.sparkSession.createDataFrame([("counter", k, str(v)) for k, v in counters.items()], "kind string, id string, value string")
    good = good.select(F.lit("good").alias("kind"), "id", F.sha1(F.coalesce("content", F.lit("")).cast("binary")).alias("value"))
    return good.unionByName(bad.select(F.lit("bad").alias("kind"), F.lit("").alias("id"), "value")).unionByName(counted)


def damaged_lines(spark, sf_dir):
    """Good posts, the lines set aside and the counters of a batch."""
    root = _scratch(spark)
    _damaged_lines(spark, sf_dir).select("value").write.text(f"{root}/in")
    got = intake.read_jsonl_setting_aside(spark, f"{root}/in", f"{root}/aside")
    return _intake_rows(got.posts, spark.read.parquet(got.quarantine), got.counters)


def stream_damaged_lines(spark, sf_dir):
    """The same of a stream of files, a batch for as many as are written at once; the counters
    are from its progress. Features are made of the good lines, finished files move away, and a
    second run reads only new files."""
    root, keep = _scratch(spark), []
    lines = _damaged_lines(spark, sf_dir)
    files_at_once = max(1, lines.rdd.getNumPartitions())
    for name, part in (("batch_a", "doc_id % 3 = 0"), ("idle_batch_b", "doc_id % 3 = 1")):
        lines.filter(part).select("value").write.text(f"{root}/in/{name}.jsonl")

    def run():
        files = post_file_stream(spark, f"{root}/in/*", "part-*", files_at_once, archive=f"{root}/done", set_aside=True)
        query = start_feature_stream(
            files, f"{root}/features", f"{root}/checkpoint", fx.hash_projection_encoder(4), quarantine_root=f"{root}/aside")
        query.awaitTermination()
        keep.extend(p.observedMetrics["intake"].asDict() for p in query.recentProgress if p.observedMetrics.get("intake"))

    run()
    lines.filter("doc_id % 3 = 2").select("value").write.text(f"{root}/in/batch_c.jsonl")
    run()
    rows = read.read_features(spark, f"{root}/features").select("id", F.size("embedding").cast("string").alias("content"))
    counters = {k: sum(m[k] for m in keep) for k in intake.COUNTERS}
    return _intake_rows(rows, spark.read.parquet(f"{root}/aside"), counters)


def broken_files(spark, sf_dir):
    """Stored posts with a file that is no table among them: rows per day, and the file's day."""
    root = _scratch(spark)
    posts = clean.clean_posts(clean.candidates(document_posts(spark, sf_dir)), NOW)
    write.write_stored_posts(posts, f"{root}/posts")
    posts.select(F.col("content").alias("value")).write.text(f"{root}/posts/event_date=2024-06-02")
    result = run_merge_job(spark, f"{root}/posts", f"{root}/merged", report_root=f"{root}/report")
    merged = summary.rows_per_day(spark.read.schema(STORED_POST).json(f"{root}/merged"))
    day = F.regexp_extract("file_path", "event_date=([^/]*)/", 1)
    bad = spark.read.parquet(f"{root}/report").filter("problem is not null").groupBy(day.alias("event_date")).agg(F.lit(-1).cast("bigint").alias("rows"))
    counted = spark.createDataFrame([("rows", result["rows"])], "event_date string, rows long")
    return merged.unionByName(bad).unionByName(counted)


def jsonl_round_trip(spark, sf_dir):
    """Documents written as JSON lines and read back as posts."""
    path = f"{_scratch(spark)}/jsonl"
    write.write_jsonl(_plain_posts(spark, sf_dir), path)
    posts = read.read_jsonl(spark, path)
    return _hashed_content(posts.select("id", "username", "content", "likeCount"))


def stored_posts_round_trip(spark, sf_dir):
    """Clean posts written by day and read back."""
    path = f"{_scratch(spark)}/posts"
    posts = clean.clean_posts(clean.candidates(document_posts(spark, sf_dir)), NOW)
    write.write_stored_posts(posts, path)
    stored = read.read_stored_posts(spark, path)
    return rounded(_hashed_content(stored.select("id", "content", "likeCount", "ts", "event_date")))


def features_round_trip(spark, sf_dir):
    """Embeddings written as a feature table and read back, one row per component."""
    path = f"{_scratch(spark)}/features"
    vectors_ = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("id"), "embedding")
    write.write_features(vectors_, path)
    rows = read.read_features(spark, path)
    return rounded(rows.select("id", F.posexplode("embedding").alias("position", "value")))


def feature_row_ids(spark, sf_dir):
    """Ids given to feature rows without one, read whole and in small splits: the same."""
    path = f"{_scratch(spark)}/features"
    vectors_ = table(spark, sf_dir, "embeddings").orderBy("vec_id").coalesce(1)
    vectors_.select(F.lit("").alias("id"), "embedding", "vec_id").write.option("parquet.block.size", 1 << 15).parquet(path)

    def named(size):
        with changed_settings(spark, {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": 0}):
            return cut_lineage(read.read_features(spark, path).select("vec_id", F.substring_index("id", "_", -1).alias("id")))

    return named(1 << 27).join(named(1 << 15).withColumnRenamed("id", "in_splits"), "vec_id")


def signal_files(spark, sf_dir):
    """Signal windows written as CSV, JSON lines and one JSON document, read back in time order."""
    root = _scratch(spark)
    signals = cut_lineage(event_signals(spark, sf_dir, frequency="1h"))
    write.write_csv(signals.orderBy("window_start"), f"{root}/csv")
    write.write_signals_json(signals, f"{root}/json")
    write.write_signals_json(signals, f"{root}/document", document=True)
    kinds = "window_start_iso string, n long, mean_signal double, trade_action string"
    fields = ["window_start_iso", "n", "mean_signal", "trade_action"]
    in_csv = spark.read.option("header", True).csv(f"{root}/csv").select(*[F.col(f).cast(t) for f, t in (x.split() for x in kinds.split(", "))])
    in_json = spark.read.schema(kinds).json(f"{root}/json")
    document = spark.read.text(f"{root}/document", wholetext=True).select(F.from_json("value", f"array<struct<{kinds.replace(' ', ':').replace(',:', ',')}>>").alias("a"))
    parts = [("csv", in_csv, F.lit(None)), ("json", in_json, F.lit(None))]
    rows = [df.select(F.lit(kind).alias("form"), place.cast("int").alias("place"), *fields) for kind, df, place in parts]
    rows.append(document.select(F.posexplode("a").alias("place", "w")).select(F.lit("document").alias("form"), "place", *[f"w.{f}" for f in fields]))
    return rounded(rows[0].unionByName(rows[1]).unionByName(rows[2]))


def pending_input(spark, sf_dir):
    """Posts by language in the files that a feature run would take; German ones lie elsewhere."""
    root = _scratch(spark)
    folder = F.when(F.col("username") == "de", "other_de").when(F.col("username") == "fr", "idle_batch_fr").otherwise(F.concat(F.lit("batch_"), "username"))
    _plain_posts(spark, sf_dir).withColumn("folder", folder).write.partitionBy("folder").json(f"{root}/in")
    files = read.pending_files(spark, f"{root}/in/folder=*batch_*", "part-*")
    posts = read.read_jsonl(spark, [r["file_path"] for r in files.collect()])
    return posts.groupBy("username").agg(F.count("*").alias("posts"))


def keyword_counts(spark, sf_dir):
    """Documents by keyword, for the fixed list of keywords: each stands for a thirteenth of the ids."""
    dimension = read.keyword_dimension(spark)
    tagged = table(spark, sf_dir, "documents").select(F.pmod("doc_id", F.lit(26)).cast("int").alias("tag_index"))
    counts = summary.counts_for_all(dimension, tagged, "tag_index")
    return counts.select("source_hashtag", "tag_index", "rows")


def stream_event_windows(spark, sf_dir):
    """A stream over the events, run to its end; the windows it closed."""
    use_utc(spark)
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    source = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )
    root = _scratch(spark)
    query = (
        stream_signals(source, value="value", frequency="1h", delay="10 minutes", min_posts=1)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{root}/out")
    )
    query.awaitTermination()
    return rounded(spark.read.parquet(f"{root}/out").drop("window_start"))


def _scores_of_events(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("emb_score"),
        F.pmod("user_id", F.lit(11)).cast("double").alias("lex_score"))


def stream_signals_scaled(spark, sf_dir):
    """A stream of two scores on a scale that a batch run stored, weighted; its closed windows."""
    use_utc(spark)
    root, schema = _scratch(spark), spark.read.parquet(f"{sf_dir}/events.parquet").schema
    scoring.ScoreScaler.fit(_scores_of_events(table(spark, sf_dir, "events"))).save(spark, f"{root}/scale")
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    scale = scoring.read_scale(spark, f"{root}/scale")
    _run(stream_signals(_scores_of_events(source), scale, frequency="1h", min_posts=3, weight_emb=0.6, weight_lex=0.4), root)
    return rounded(spark.read.parquet(f"{root}/out").drop("window_start"))


def stream_late_rows(spark, sf_dir):
    """Events in six files, each a sixth of the time, one in twenty of them three files late:
    the hours that the stream closed, the rows in them, and how many came too late."""
    use_utc(spark)
    root = _scratch(spark)
    rows = events(spark, sf_dir).select("event_id", "ts", "value")
    ends = rows.agg(F.min(F.unix_micros("ts")).alias("a"), F.max(F.unix_micros("ts")).alias("b")).first()
    sixth = F.expr(f"cast((unix_micros(ts) - {ends['a']}) * 6 div {ends['b'] - ends['a'] + 1} as int)")
    late = F.when(F.pmod("event_id", F.lit(20)) == 0, 3).otherwise(0)
    # a marker far ahead closes every window at the end
    marker = rows.limit(1).select(F.lit(-1).cast("bigint").alias("event_id"), F.timestamp_micros(F.lit(ends["b"] + 10**12)).alias("ts"), F.lit(0.0).alias("value"))
    batches = cut_lineage(rows.withColumn("batch", F.least(sixth + late, F.lit(5)))).unionByName(marker.withColumn("batch", F.lit(6)))
    for number in range(7):
        batches.filter(F.col("batch") == number).drop("batch").coalesce(1).write.parquet(f"{root}/in/batch={number}")
    source = spark.readStream.schema(rows.schema.add("batch", "integer")).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    query = _run(stream_signals(source.drop("batch"), value="value", frequency="1h", delay="1 hour", min_posts=1), root)
    counts, closed = late_counts(query), spark.read.parquet(f"{root}/out")
    dropped = closed.agg(
        F.lit("late").alias("window_start_iso"),
        (F.lit(counts["rows_read"] - 1) - F.coalesce(F.sum("n"), F.lit(0))).cast("bigint").alias("n"),
        F.lit(counts["late_groups"]).cast("double").alias("mean_signal"))
    return rounded(closed.select("window_start_iso", "n", "mean_signal").unionByName(dropped))


def stream_dedupe(spark, sf_dir):
    """Documents arriving as a stream of files, in six batches; each content is kept once. The
    state is compacted twice on the way."""
    root = _scratch(spark)
    posts = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("content"))
    files = max(1, math.ceil(_text_bytes(posts, "content") / 6 / STREAM_FILE_BYTES))
    posts.repartition(6 * files, "id").write.parquet(f"{root}/in")
    source = spark.readStream.schema(posts.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/in")
    start_clean_stream(
        source, f"{root}/posts", f"{root}/seen", f"{root}/checkpoint", NOW, digits=1, every=2
    ).awaitTermination()
    kept = spark.read.parquet(f"{root}/posts")
    return kept.select(tx.content_hash(F.col("content")).alias("content_hash"))


QUERIES = {
    f.__name__: f
    for f in (
        signals_flagship, signals_event_windows, signals_hourly, signals_gap_filled,
        signals_anchored_7min, signals_summary, signals_plot_series, window_lookup,
        clean_documents, dedupe_documents, dedupe_keep_intra, dedupe_second_run,
        dedupe_incremental_anti, dedupe_incremental_semi, seen_after_run, first_event_per_user,
        parsed_times, posts_per_day, safe_casts, feature_meta, lexical_score, tfidf_corpus,
        tfidf_chunk, tfidf_source, document_frequency, sparse_roundtrip, hashing_tf, hashed_tfidf,
        embed_documents, centroids, embedding_contrast, standardize, feature_text_join,
        mentions_hashtags, page_records, page_articles_nested, label_counts, roundrobin_cap, per_tag_counts,
        counts_for_all, merge_mixed_schema, row_chunks, job_metrics, t_confidence,
        csv_round_trip, jsonl_round_trip, stored_posts_round_trip, features_round_trip,
        stream_event_windows, stream_dedupe, stream_signals_scaled, stream_late_rows,
        feature_text_join_hot, csv_typed_copy, damaged_lines, stream_damaged_lines, broken_files,
        feature_row_ids, signal_files, pending_input, keyword_counts,
    )
}

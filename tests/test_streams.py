import hashlib
import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from crowdtide.operators.features import hash_projection_encoder
from crowdtide.operators.scoring import ScoreScaler
from crowdtide.operators.seen_state import SeenState
from crowdtide.operators.windows import window_signals
from crowdtide.schemas import RAW_POST
from crowdtide.sources.read import read_features
from crowdtide.streaming.dedupe_stream import recent_first, start_clean_stream
from crowdtide.streaming.feature_stream import post_file_stream, start_feature_stream
from crowdtide.streaming.signal_stream import stream_signals

ENCODER = hash_projection_encoder(8)
START = datetime(2024, 5, 1, 12)


def drop(folder, name, *posts):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(p) for p in posts) + "\n{bad\n")


def post(i, text="word"):
    return {"id": str(i), "content": f"{text} {i}", "date": "2024-05-01", "likeCount": i}


def features(spark, source, root, **options):
    stream = post_file_stream(spark, str(source), archive=options.pop("archive", None))
    query = start_feature_stream(stream, f"{root}/features", f"{root}/checkpoint", ENCODER, **options)
    query.awaitTermination()
    return query


def test_feature_stream(spark, tmp_path):
    source, archive = tmp_path / "in", tmp_path / "done"
    drop(source, "batch_1.jsonl", post(1), post(2))
    drop(source, "idle_batch_1.jsonl", post(3), {"id": "4", "text": "an alias is not read here"})
    drop(source, "other.jsonl", post(99))
    query = features(spark, source, tmp_path, archive=str(archive))
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) == 2  # a file at a time
    got = {r["id"]: r for r in read_features(spark, f"{tmp_path}/features").collect()}
    assert sorted(got) == ["1", "2", "3", "4"] and got["2"]["likeCount"] == 2
    assert got["4"]["tf_values"] == [] and not any(got["4"]["embedding"])
    # only the new file is read by the next run
    drop(source, "batch_2.jsonl", post(5))
    features(spark, source, tmp_path, archive=str(archive))
    table = read_features(spark, f"{tmp_path}/features")
    assert sorted(r["id"] for r in table.collect()) == ["1", "2", "3", "4", "5"]
    assert (source / "other.jsonl").exists()
    assert [p.name for p in archive.rglob("*.jsonl")]


def test_failed_batch_is_put_aside(spark, tmp_path):
    def broken():
        def encode(texts):
            if any("poison" in t for t in texts):
                raise ValueError("cannot encode")
            return ENCODER()(texts)

        return encode

    source = tmp_path / "in"
    drop(source, "batch_1.jsonl", post(1, "poison"))
    drop(source, "batch_2.jsonl", post(2))
    stream = post_file_stream(spark, str(source))
    root = f"{tmp_path}/features"
    start_feature_stream(stream, root, f"{tmp_path}/c", broken, failed_root=f"{tmp_path}/failed").awaitTermination()
    assert [r["id"] for r in read_features(spark, root).collect()] == ["2"]
    assert [r["content"] for r in spark.read.parquet(f"{tmp_path}/failed").collect()] == ["poison 1"]
    with pytest.raises(Exception, match="cannot encode"):
        start_feature_stream(stream, f"{root}2", f"{tmp_path}/c2", broken).awaitTermination()


def csv_stream(spark, folder):
    return spark.readStream.schema(RAW_POST).option("header", True).option("maxFilesPerTrigger", 1).csv(str(folder))


def test_clean_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    header = ",".join(RAW_POST.names)

    def write(name, *contents):
        lines = [f"{name}{i},u,2024-05-0{i + 1},{c},,,,,,,," for i, c in enumerate(contents)]
        (source / f"{name}.csv").write_text("\n".join([header, *lines]) + "\n")

    def run():
        start_clean_stream(
            csv_stream(spark, source), f"{tmp_path}/posts", f"{tmp_path}/seen", f"{tmp_path}/check", START
        ).awaitTermination()
        kept = spark.read.parquet(f"{tmp_path}/posts")
        return sorted(r["content"] for r in kept.collect())

    write("a", "one", "two", "one")
    assert run() == ["one", "two"]
    write("b", "two", "three")
    assert run() == ["one", "three", "two"]
    assert run() == ["one", "three", "two"]
    assert SeenState(spark, f"{tmp_path}/seen").rows().count() == 3
    days = spark.read.parquet(f"{tmp_path}/posts").select(F.col("event_date").cast("string")).distinct()
    assert days.count() == 2


def hashes(spark, *names):
    return spark.createDataFrame([(hashlib.sha1(n.encode()).hexdigest(),) for n in names], "content_hash string")


def test_seen_state_over_many_batches(spark, tmp_path):
    state, seen, files, last = SeenState(spark, f"{tmp_path}/seen", digits=1, every=3), set(), [], -1
    for number in range(17):
        assert last < state.next_number() <= number  # a batch without a new hash leaves its number free
        compacted = state.compact(number)
        assert compacted == (number > 0 and number % 3 == 0)
        names = {f"n{number * 5 % 23 + i}" for i in range(6)}
        keys = hashes(spark, *sorted(names))
        for _ in range(2):  # a replay finds the state as it was
            new = state.unseen(keys, number, 6)
            assert {r[0] for r in new.collect()} == {hashlib.sha1(n.encode()).hexdigest() for n in names - seen}
            state.record(new, number, START)
        last = number if names - seen else last
        seen |= names
        files.append(len(state.rows(number + 1).inputFiles()))
        assert state.rows(number + 1).count() == len(seen)
    # a base of 16 prefixes at most and fewer than two rounds of recent batches, however many there have been
    assert max(files[9:]) <= 16 + 5 * 4 and max(files[13:]) <= max(files[6:13]) + 2


def test_seen_state_reads_only_the_prefixes_held(spark, tmp_path):
    state = SeenState(spark, f"{tmp_path}/seen", digits=1, every=1)
    state.record(hashes(spark, *map(str, range(200))), 0)
    state.compact(1)
    one = hashes(spark, "7")
    plan = state.unseen(one, 1, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(prefix" in plan or "PartitionFilters: [prefix" in plan
    assert state.unseen(one, 1, 1).isEmpty()
    assert state.unseen(hashes(spark, "new"), 1, 10**9).count() == 1  # many keys: both sides are shuffled
    assert state.unseen(hashes(spark), 1, 0).isEmpty()


def test_a_slot_without_a_mark_is_not_read(spark, tmp_path):
    state = SeenState(spark, f"{tmp_path}/seen", digits=1, every=2)
    for number in range(5):
        state.compact(number)
        state.record(hashes(spark, f"a{number}"), number)
    slot, upto = state.base(5)
    state._mark(1 - slot, None)  # as if a compaction had died after its first step
    assert state.base(5) == (slot, upto) and state.rows(5).count() == 5


def test_recent_first(spark, tmp_path):
    spark.createDataFrame(
        [(START, "h"), (START, "h"), (START, "g")], "ts timestamp, content_hash string"
    ).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("ts timestamp, content_hash string").parquet(f"{tmp_path}/in")
    query = (
        recent_first(stream, "ts", "1 hour").writeStream.format("parquet")
        .option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start(f"{tmp_path}/out")
    )
    query.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2


def test_signal_stream_equals_batch(spark, tmp_path):
    def save(name, *minutes):
        data = [(START + timedelta(minutes=m), (m % 3) - 0.5, 0.1 * m) for m in minutes]
        df = spark.createDataFrame(data, "ts timestamp_ntz, emb_score double, lex_score double")
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
        return df

    def run():
        source = spark.readStream.schema(first.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        (
            stream_signals(source, scaler, delay="5 minutes", min_posts=1)
            .writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c")
            .trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()
        )
        return spark.read.parquet(f"{tmp_path}/out")

    first = save("in", *range(30))
    scaler = ScoreScaler(0.5, 0.8, 1.4, 0.9)
    streamed = run().orderBy("window_start")
    timed = first.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("composite", scaler.composite())
    batch = window_signals(timed, "ts", "composite", min_posts=1).orderBy("window_start")
    closed = streamed.collect()
    assert 0 < len(closed) < 6  # the last windows are still open
    for got, want in zip(closed, batch.collect()):
        assert got["n"] == want["n"]
        assert got["mean_signal"] == pytest.approx(want["mean_signal"])
        assert got["ci95_half"] == pytest.approx(want["ci95_half"])
        assert got["trade_action"] == want["trade_action"]
    # a post behind the watermark changes nothing that was closed
    save("in", 2, 50)
    late = run()
    assert late.filter(F.col("window_start") == START).first()["n"] == 5
    assert late.count() == 6


def test_stream_refuses_windows_without_a_mark(spark):
    with pytest.raises(ValueError, match="divide a day"):
        stream_signals(spark.readStream.format("rate").load(), ts="timestamp", frequency="7min")

import csv
import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from crowdtide.fixed_values import POST_COLUMNS
from crowdtide.operators.clean import text_rows
from crowdtide.operators.features import hash_projection_encoder
from crowdtide.operators.scoring import ContrastModel
from crowdtide.operators.seen_state import SeenState
from crowdtide.plans.clean_job import run_clean_job
from crowdtide.plans.feature_job import run_feature_job
from crowdtide.plans.merge_job import run_merge_job, run_table_copy
from crowdtide.plans.page_job import run_page_job
from crowdtide.plans.signal_job import run_signal_job
from crowdtide.session import changed_settings, ensure_checkpoint_dir
from crowdtide.sources import csv_records, intake, read, write

NOW = datetime(2025, 9, 9)
ENCODER = hash_projection_encoder(8)
HEADER = ",".join(POST_COLUMNS)
CSV = (
    HEADER
    + '\n1, ann ,2025-09-08T12:00:00Z,"Buy, the ""dip""\nnow",1,2,3,4,,nifty50,,#ipo'
    + "\n2,bob,2025-09-08T18:00:00+05:30,sell it,,,3.0,abc,,,,#ipo"
    + "\n3,cy,junk,   ,,,,,,,,#ipo"
    + "\n4,di,,sell  it,,,,,,,,#market"
    + "\n5,ed,2025-09-07T01:00:00.250000Z,हिन्दी ½,0,,,,,,,#market\n"
)


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(CSV, encoding="utf-8")
    return str(path)


def clean(spark, csv_file, tmp_path, **options):
    return run_clean_job(
        spark, csv_file, f"{tmp_path}/parquet", f"{tmp_path}/jsonl", f"{tmp_path}/seen", now=NOW, **options
    )


def json_rows(folder):
    return [json.loads(line) for p in sorted(folder.rglob("*.json")) for line in p.read_text("utf-8").splitlines()]


def test_clean_job(spark, csv_file, tmp_path):
    assert clean(spark, csv_file, tmp_path) == {"rows_read": 5, "already_seen": 0, "cleaned": 3}
    posts = read.read_stored_posts(spark, f"{tmp_path}/parquet")
    got = {r["id"]: r for r in posts.collect()}
    assert sorted(got) == ["1", "2", "5"]
    assert got["1"]["content"] == 'Buy, the "dip" now' and got["1"]["username"] == "ann"
    assert (got["2"]["likeCount"], got["2"]["quoteCount"], got["2"]["ts"].hour) == (3, None, 12)
    assert got["5"]["event_date"] == "2025-09-07" and got["5"]["date"].endswith(".250000+00:00")
    lines = json_rows(tmp_path / "jsonl")
    assert len(lines) == 3 and all(list(line) == POST_COLUMNS for line in lines)
    assert any("हिन्दी" in line["content"] for line in lines)
    assert "हिन्दी" in "".join(p.read_text("utf-8") for p in (tmp_path / "jsonl").glob("*.json"))
    # nothing is new the second time
    assert clean(spark, csv_file, tmp_path) == {"rows_read": 5, "already_seen": 3, "cleaned": 0}
    assert SeenState(spark, f"{tmp_path}/seen").rows().count() == 3


def test_clean_job_keeping_copies_of_a_batch(spark, csv_file, tmp_path):
    assert clean(spark, csv_file, tmp_path, intra_batch="keep")["cleaned"] == 4
    assert SeenState(spark, f"{tmp_path}/seen").rows().count() == 3


def test_clean_job_with_batches_of_two(spark, csv_file, tmp_path):
    assert clean(spark, csv_file, tmp_path, intra_batch="keep", batch_rows=2)["cleaned"] == 3


def test_clean_job_without_input(spark, tmp_path):
    assert clean(spark, f"{tmp_path}/none.csv", tmp_path) == {"rows_read": 0, "already_seen": 0, "cleaned": 0}


def test_csv_round_trip(spark, csv_file, tmp_path):
    raw = read.read_raw_posts(spark, csv_file)
    write.write_csv(raw, f"{tmp_path}/out")
    write.write_csv(raw.limit(1), f"{tmp_path}/out")
    again = read.read_raw_posts(spark, f"{tmp_path}/out")
    assert again.count() == 6 and again.filter("username = ' ann '").count() == 2
    assert read.read_csv_typed(spark, csv_file).schema["id"].dataType.simpleString() in ("int", "string")


def split_small(spark, size):
    """Settings under which files are cut every ``size`` bytes."""
    return changed_settings(spark, {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": 0, "spark.sql.files.minPartitionNum": 1})


def hostile_csv(r, n):
    fields = ["plain", "", "a,b", 'say "hi"', '""', "two\nlines", "\n", 'x\r\ny', '"', "é" * 30, " pad ", "end\n\n", 'q"\n"q', "long " * 40]
    return [[f"{i}", r.choice(fields), r.choice(fields) + str(i)] for i in range(n)]


@pytest.mark.parametrize("size", [17, 64, 300, 5000, 10**6])
@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_csv_records_equal_those_of_pythons_reader(spark, tmp_path, size, ending):
    rows = hostile_csv(random.Random(size), 120)
    path = tmp_path / "a.csv"
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator=ending, quoting=csv.QUOTE_ALL if size == 64 else csv.QUOTE_MINIMAL)
        writer.writerows([["id", "head\ning", "z"], *rows])
    with open(path, newline="", encoding="utf-8") as back:
        want = sorted([r[0], r[1], r[2]] for r in csv.reader(back))
    with split_small(spark, size):
        lines = csv_records.split_lines(spark, str(path))
        tasks = lines.select(F.spark_partition_id().alias("p"), "_start").distinct().count()
        df = csv_records.read_csv_records(spark, str(path))
        got = sorted([x or "" for x in r] for r in df.collect())
    assert df.columns == ["id", "head\ning", "z"]
    assert got == [r for r in want if r[0] != "id"]
    assert tasks > 1 if size <= 5000 else tasks == 1


def test_csv_of_odd_files(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    files = {"a": 'id,text\n1,x\n\n2,"open\nend\n', "b": "id,text\n", "c": "", "d": '\ufeffid,text\n3,y', "e": "id,text\n4\n5,p,q\n"}
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    df = read.read_raw_posts(spark, str(folder))
    got = {r["id"]: r["text"] for r in df.collect()}
    assert df.columns == ["id", "text"] and sorted(got) == ["1", "2", "3", "4", "5"]
    assert (got["1"], got["3"], got["4"], got["5"]) == ("x", "y", None, "p") and got["2"].startswith("open\nend")
    (tmp_path / "empty.csv").write_text("")
    assert read.read_raw_posts(spark, f"{tmp_path}/empty.csv").columns == POST_COLUMNS
    names = csv_records._names('a,A,,"x""y"')
    assert names == ["a0", "A1", "_c2", 'x"y']


def test_csv_in_splits_that_change_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text\n" + "".join(f"{i},t{i}\n" for i in range(500)))
    with split_small(spark, 1000):
        df = read.read_raw_posts(spark, f"{tmp_path}/a.csv")
    with split_small(spark, 700), pytest.raises(Exception, match="splits of the input changed"):
        df.collect()


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("text,id,ts\nhello there,9,2025-09-08\n")
    assert clean(spark, f"{tmp_path}/a.csv", tmp_path)["cleaned"] == 1
    row = read.read_stored_posts(spark, f"{tmp_path}/parquet").first()
    assert (row["id"], row["content"], row["event_date"], row["likeCount"]) == ("9", "hello there", "2025-09-08", None)
    (tmp_path / "b.csv").write_text("id,text,ts\n8,other,2025-09-08\n")
    with pytest.raises(Exception, match="header"):
        read.read_raw_posts(spark, f"{tmp_path}/*.csv").collect()


def test_merge_job(spark, csv_file, tmp_path):
    clean(spark, csv_file, tmp_path)
    result = run_merge_job(spark, f"{tmp_path}/parquet", f"{tmp_path}/merged", single_file=True)
    assert (result["rows"], result["broken_files"], result["broken_names"]) == (3, 0, []) and result["files"] >= 1
    lines = json_rows(tmp_path / "merged")
    assert sorted(line["id"] for line in lines) == ["1", "2", "5"] and "replyCount" in lines[0]
    assert not run_merge_job(spark, f"{tmp_path}/nowhere", f"{tmp_path}/merged2")


def test_merge_of_unlike_files(spark, tmp_path):
    root = f"{tmp_path}/posts"
    spark.createDataFrame([("1", "a")], "id string, content string").write.parquet(f"{root}/event_date=2024-01-01")
    spark.createDataFrame([("2", 5)], "id string, likeCount long").write.parquet(f"{root}/event_date=2024-01-02")
    (tmp_path / "posts/event_date=2024-01-02/broken.parquet").write_bytes(b"PAR1 not a table")
    merged = read.read_stored_posts(spark, root, schema=None)
    assert sorted(map(tuple, merged.select("id", "content", "likeCount", "event_date").collect())) == [
        ("1", "a", None, "2024-01-01"), ("2", None, 5, "2024-01-02"),
    ]
    fixed = read.read_stored_posts(spark, root)
    assert fixed.count() == 2 and fixed.schema["event_date"].dataType.simpleString() == "string"
    spark.createDataFrame([("3", "x")], "id string, content string").write.parquet(f"{root}/event_date=unknown")
    assert read.read_stored_posts(spark, root).filter("event_date = 'unknown'").count() == 1


def test_broken_files_are_named(spark, tmp_path):
    root = f"{tmp_path}/posts"
    for day, i in (("2024-01-01", 1), ("2024-01-02", 2)):
        spark.createDataFrame([(str(i), "text")], "id string, content string").coalesce(1).write.parquet(f"{root}/event_date={day}")
    (tmp_path / "posts/event_date=2024-01-02/broken.parquet").write_bytes(b"PAR1 not a table")
    sound = next((tmp_path / "posts/event_date=2024-01-01").glob("part-*"))
    data = bytearray(sound.read_bytes())
    data[4:24] = b"\xff" * 20  # the footer is whole, the page is not
    (tmp_path / "posts/event_date=2024-01-01/inside.parquet").write_bytes(bytes(data))
    result = run_merge_job(spark, root, f"{tmp_path}/merged", report_root=f"{tmp_path}/report")
    assert (result["files"], result["broken_files"]) == (4, 1)
    assert [name.rsplit("/", 1)[1] for name in result["broken_names"]] == ["broken.parquet"]
    report = {r["file_path"].rsplit("/", 1)[1]: r for r in spark.read.parquet(f"{tmp_path}/report").collect()}
    assert report["broken.parquet"]["problem"].startswith("unreadable") and report["inside.parquet"]["rows"] == 1
    deep = {r["file_path"].rsplit("/", 1)[1] for r in intake.probe_parquet(spark, root, deep=True).filter("problem is not null").collect()}
    assert deep == {"broken.parquet", "inside.parquet"}


def test_table_copy(spark, csv_file, tmp_path):
    run_table_copy(spark, csv_file, f"{tmp_path}/copy")
    assert spark.read.parquet(f"{tmp_path}/copy").count() >= 5
    write.write_table_copy(spark.range(0), f"{tmp_path}/none")
    assert not (tmp_path / "none").exists()


LINES = [
    '{"id": 7, "content": "buy buy rally", "likeCount": 3.0, "date": "2025-09-08T12:01:00Z"}',
    "", "   ", "{broken", "[{\"id\": \"x\", \"content\": \"array\"}]", "17", "null", '"text"',
    '{"id": "8", "text": "sell the crash", "ts": 1757332860000, "hashtags": "h"}',
    '{"id": "9", "content": null, "text": " "}',
    '{"id": "10", "content": "up up", "date": "2025-09-08T12:02:00+00:00", "source_hashtag": "#ipo"}',
]


@pytest.fixture
def jsonl(tmp_path):
    folder = tmp_path / "posts_jsonl"
    folder.mkdir()
    (folder / "batch_1.jsonl").write_text("\n".join(LINES) + "\n", encoding="utf-8")
    return str(folder)


def test_read_jsonl(spark, jsonl):
    rows = read.read_jsonl(spark, jsonl)
    assert sorted(r["id"] for r in rows.collect()) == ["10", "7", "8", "9"]
    kept = read.read_jsonl(spark, jsonl, quarantine=True).filter("_corrupt_record is not null")
    assert sorted(r["_corrupt_record"] for r in kept.collect()) == sorted(LINES[3:8])
    texts = {r["id"]: r for r in text_rows(rows).collect()}
    assert texts["8"]["content"] == "sell the crash" and texts["8"]["date"] == datetime(2025, 9, 8, 12, 1)
    assert texts["9"]["content"] == "" and texts["9"]["date"] is None


@pytest.mark.parametrize("scope", ["corpus", "chunk", "file"])
def test_feature_job(spark, jsonl, tmp_path, scope):
    root = f"{tmp_path}/features"
    counts = run_feature_job(spark, jsonl, root, ENCODER, scope=scope, chunk_size=2, width=2**18, run_ts=NOW)
    assert counts == {"rows_written": 3, "lines_read": 11, "blank_lines": 2, "malformed_lines": 5}
    aside = spark.read.parquet(f"{root}_set_aside")
    assert sorted(r["value"] for r in aside.collect()) == sorted(LINES[3:8])
    assert all(r["file_path"].endswith("batch_1.jsonl") for r in aside.collect())
    got = {r["id"]: r for r in read.read_features(spark, root).collect()}
    assert (got["7"]["likeCount"], got["7"]["date"]) == (3, "2025-09-08T12:01:00Z")
    assert (got["8"]["date"], got["8"]["source_hashtag"], got["8"]["run_ts"]) == ("1757332860000", "h", NOW)
    assert all(len(r["embedding"]) == 8 and r["tf_width"] == 2**18 for r in got.values())
    assert got["10"]["tf_values"] == [1.0] and len(got["8"]["tf_values"]) == 3
    assert all(r["tf_indices"] == sorted(r["tf_indices"]) for r in got.values())
    assert sum(v * v for v in got["7"]["tf_values"]) == pytest.approx(1, abs=1e-6)
    if scope == "chunk":
        assert [got[i]["chunk_id"] for i in ("7", "8", "10")] == [1, 1, 2]


def test_features_without_id_stay_apart(spark, tmp_path):
    data = [("a", [1.0]), ("", [2.0]), (None, [3.0])]
    spark.createDataFrame(data, "id string, embedding array<float>").write.parquet(f"{tmp_path}/f")
    ids = [r["id"] for r in read.read_features(spark, f"{tmp_path}/f").collect()]
    assert len(set(ids)) == 3 and "a" in ids and sum(i.startswith("row_part-") for i in ids) == 2


def test_features_keep_their_names_in_other_splits(spark, tmp_path):
    data = [(None if i % 3 else "", [float(i)] * 50) for i in range(3000)]
    spark.createDataFrame(data, "id string, embedding array<float>").coalesce(1).write.option("parquet.block.size", 20_000).parquet(f"{tmp_path}/f")

    def names():
        return {r["embedding"][0]: r["id"] for r in read.read_features(spark, f"{tmp_path}/f").collect()}

    whole = names()
    with split_small(spark, 30_000):
        assert read.read_features(spark, f"{tmp_path}/f").rdd.getNumPartitions() > 1
        assert names() == whole
    assert len(set(whole.values())) == 3000 and all(v.endswith(f"_{int(k)}") for k, v in whole.items())


def test_feature_table_is_checked(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/x")
    with pytest.raises(ValueError, match="embedding"):
        read.read_features(spark, f"{tmp_path}/x")


def test_signal_job(spark, tmp_path):
    posts = tmp_path / "many"
    posts.mkdir()
    start = datetime(2025, 9, 8, 12)
    lines = []
    for i in range(60):
        text = "buy rally bull" if i % 10 < 7 else "sell crash bear"
        when = (start + timedelta(minutes=i)).isoformat()
        lines.append(json.dumps({"id": f"p{i}", "content": f"{text} {i}", "date": when}))
    (posts / "a.jsonl").write_text("\n".join(lines))
    root = f"{tmp_path}/features"
    # two runs over the same posts: each post still counts once
    for day in (1, 2):
        run_feature_job(spark, str(posts), root, ENCODER, run_ts=datetime(2025, 9, day))
    model = ContrastModel.from_words(ENCODER)
    out = f"{tmp_path}/signals"
    result = run_signal_job(spark, root, str(posts), out, model, now=NOW, frequency="10min", json_document=True)
    assert (result["total_windows"], result["total_posts_used"]) == (6, 60)
    assert result["last_window"] == "2025-09-08T12:50:00Z"
    assert result["trade_action_summary"] == {"SHORT": 6}
    table = spark.read.option("header", True).csv(f"{out}/csv")
    assert table.count() == 6 and table.columns[0] == "window_start"
    text = "".join(p.read_text() for p in (tmp_path / "signals/json").rglob("part-*"))
    document = json.loads(text)
    assert [d["window_start_iso"] for d in document] == sorted(d["window_start_iso"] for d in document)
    assert len(document) == 6 and "window_start" not in document[0] and document[0]["n"] == 10
    assert spark.read.parquet(f"{out}/plot").count() == 6
    doubled = run_signal_job(spark, root, str(posts), f"{out}2", model, now=NOW, dedupe_keys=False, frequency="10min")
    assert doubled["total_posts_used"] == 120
    assert len(json_rows(tmp_path / "signals2/json")) == 6
    assert (result["lines_read"], result["malformed_lines"]) == (60, 0)
    # another run stands beside the first, and one repeated by its name replaces itself
    for _ in range(2):
        run_signal_job(spark, root, str(posts), out, model, now=NOW, frequency="10min", run_id="again")
    by_run = spark.read.parquet(f"{out}/plot").groupBy("run_id").count().collect()
    assert sorted((r["run_id"] == "again", r["count"]) for r in by_run) == [(False, 6), (True, 6)]


def test_page_job(spark, tmp_path):
    pages = spark.createDataFrame(
        [(i, "#ipo" if i % 2 else "#market", f"<article>post {i // 2 if i < 4 else i}</article>") for i in range(8)],
        "page_id int, tag string, html string",
    )
    dimension = read.keyword_dimension(spark)
    counts = run_page_job(pages, F.col("tag"), dimension, f"{tmp_path}/csv", cap=4, per_visit=2, now=NOW)
    got = {r["source_hashtag"]: r["rows"] for r in counts.collect()}
    assert len(got) == 13 and got["#market"] == 4 - got["#ipo"] == 2
    back = read.read_raw_posts(spark, f"{tmp_path}/csv")
    assert back.columns == POST_COLUMNS and back.count() == 4
    assert back.select("id").distinct().count() == 4


def test_pending_files(spark, tmp_path):
    for name in ("idle_batch_1.jsonl", "batch_2.jsonl", "batch_1.jsonl", "other.jsonl"):
        (tmp_path / name).write_text("{}")
    got = [r["file_path"].rsplit("/", 1)[1] for r in read.pending_files(spark, str(tmp_path)).collect()]
    assert got == ["batch_1.jsonl", "batch_2.jsonl", "idle_batch_1.jsonl"]


def test_checkpoint_folder_is_set_once(spark):
    assert ensure_checkpoint_dir(spark) == ensure_checkpoint_dir(spark)


def test_page_job_has_no_cap_of_its_own(spark, tmp_path):
    articles = "".join(f"<article>post {i}</article>" for i in range(1000))
    pages = spark.createDataFrame([(i, "#a" if i else "#other", articles.replace("post", f"post{i}")) for i in range(5)], "page_id int, tag string, html string")
    dimension = spark.createDataFrame([("#a", 0)], "source_hashtag string, tag_index int")
    run_page_job(pages, F.col("tag"), dimension, f"{tmp_path}/csv", now=NOW)
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").count() == 5000
    run_page_job(pages, F.col("tag"), dimension, f"{tmp_path}/capped", cap=4100, now=NOW)
    assert spark.read.option("header", True).csv(f"{tmp_path}/capped").filter("source_hashtag = '#other'").count() == 1000

"""Spelling variants, vector codes and archives against plain versions, and odd rows."""

import base64
import gzip
import hashlib
import io
import itertools
import math
import random
import re
import uuid
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from crowdtide.llm import spelling, vector_codes, warc

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# spelling variants

def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(rows, least_chars=7, least_count=2, noise=31):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if noise and h % noise == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= least_chars and c >= least_count}
    out = {}
    for w in n:
        found = [v for v in n if near(v, w)]
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form = best if best is not None and n[best] >= 10 * n[w] else None
        out[w] = (n[w], len(found), form, n[form] if form else None)
    roots = {}
    for w in out:
        end = w
        while out[end][2] is not None:
            end = out[end][2]
        roots[w] = end
    return {w: (form, roots[w], n, k, fn) for w, (n, k, form, fn) in out.items()}


def variants(df, **options):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_variants(df, **options).collect()}


def test_variants_are_those_of_all_pairs(make):
    r, rows = random.Random(3), []
    bases = ["aaabbbccc", "aabbcc", "Straßenname", "éléphants", "mississippi", "zzzzzzz", "abcdefg"]

    def edit(w):
        i = r.randrange(len(w) + 1)
        return r.choice([w[:i] + r.choice("abÿz÷é") + w[i:], w[:i] + w[i + 1:], w[:i] + r.choice("abÿzé") + w[i + 1:]])

    forms = [edit(edit(b)) if r.random() < 0.5 else edit(b) for b in bases for _ in range(40)] + bases
    for i in range(300):
        words = r.choices(bases, k=r.randrange(12)) + r.choices(forms, k=r.randrange(12))
        rows.append((i, " ".join(w.upper() if r.random() < 0.2 else w for w in words) + r.choice(["", ".", "1", "\n"])))
    rows += [(None, "mississippi mississippi"), (7, None), (8, ""), (9, "mississippi " * 4000), (9, "mississippi " * 4000)]
    want = plain_variants(rows)
    assert variants(make(rows)) == want and any(v[0] for v in want.values())
    assert variants(make(rows), noise=0) == plain_variants(rows, noise=0)


def test_chains_of_forms_lead_to_the_last(make):
    # each step changes one letter and has ten times the count
    chain = ["abcdefg" + "x" * 0, "abcdefh", "abcdeih", "abcjeih", "abkjeih"]
    rows = [(0, " ".join(w for i, w in enumerate(chain) for _ in range(2 * 10 ** i)))]
    got = variants(make(rows), noise=0)
    assert {w: v[1] for w, v in got.items()} == dict.fromkeys(chain, chain[-1])
    assert got["abcdefg"] == ("abcdefh", "abkjeih", 2, 1, 20) and got["abkjeih"] == (None, "abkjeih", 20000, 1, None)


def test_ties_go_to_the_smallest_form_and_both_sides_count(make):
    words = ["bbbbbbb"] * 2 + ["bbbbbbc"] * 20 + ["bbbbbba"] * 20 + ["bbbbbbÿ"] * 20 + ["bbbbbbbb"] * 20
    got = variants(make([(1, " ".join(words))]), noise=0)
    assert got["bbbbbbb"][:1] == ("bbbbbba",) and got["bbbbbbb"][3] == 4
    assert got["bbbbbbbb"][3] == 1  # any of eight letters may go, and the word left is one neighbour


def test_variants_of_odd_rows(make, spark):
    assert variants(make([])) == {} and variants(make([(1, None), (2, ""), (None, "12 34")])) == {}
    clash = spark.createDataFrame([(1, "abcdefg abcdefg", "x", 5)], "doc_id long, text string, word string, n int")
    assert spelling.spelling_variants(clash, noise=0).columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert variants(clash, noise=0) == {"abcdefg": (None, "abcdefg", 2, 0, None)}


def test_ranges_go_over_batches(make, spark):
    rows = [(i, " ".join(f"abcdef{c}" for c in "ghijklmnopqrstuv")) for i in range(3)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert variants(make(rows), noise=0) == plain_variants(rows, noise=0)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


# vector codes

def plain_codes(rows, parts=16, entries=64, rounds=2):
    """Full search of every part at every round; rows are (id, vector, label)."""
    kept = [(i, v, g) for i, v, g in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.floor(np.array([v for _, v, _ in kept]) * 256).astype(np.int64).reshape(len(kept), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()
    for i in range(rounds + 1):
        d = ((x[:, :, None, :] - books[None]) ** 2).sum(3)
        code = d.argmin(2)
        if i < rounds:
            for p, e in itertools.product(range(parts), range(books.shape[1])):
                own = x[code[:, p] == e, p]
                if len(own):
                    books[p, e] = own.sum(0) // len(own)
    error = d.min(2).sum(1)
    by = Counter()
    for (_, _, g), e in zip(kept, error):
        by[g] += int(e)
    digest = hashlib.sha256(",".join(str(v) for v in books.ravel().tolist()).encode()).hexdigest()
    return sorted(((i, "".join(f"{c:02x}" for c in cs), int(e), by[g], digest) for (i, _, g), cs, e in zip(kept, code, error)), key=str)


def coded(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, code string, error int")
    return sorted((tuple(r) for r in vector_codes.vector_codes(df, **options).collect()), key=str)


def vectors(seed, n, dim, centres=12, spread=0.05):
    r = np.random.default_rng(seed)
    c = r.normal(size=(centres, dim))
    return [[float(np.float32(v)) for v in c[r.integers(centres)] + spread * r.normal(size=dim)] for _ in range(n)]


@pytest.mark.parametrize("n, dim, parts, entries, rounds, slots", [
    (400, 64, 16, 64, 2, None), (400, 32, 8, 16, 5, None), (300, 32, 16, 64, 3, 1), (200, 16, 4, 200, 2, 199), (300, 16, 16, 8, 4, 3), (40, 32, 16, 64, 2, None),
])
def test_codes_are_those_of_a_full_search(spark, n, dim, parts, entries, rounds, slots):
    rows = [(i * 3 % 1009, v, i % 4 or None) for i, v in enumerate(vectors(n, n, dim, spread=0.3))]
    assert coded(spark, rows, parts=parts, entries=entries, rounds=rounds, slots=slots) == plain_codes(rows, parts, entries, rounds)


def test_equal_distances_go_to_the_lower_entry(spark):
    r = random.Random(2)
    rows = [(i, [r.choice([-0.01, 0.0, 0.004]) for _ in range(16)], None) for i in range(300)]
    assert coded(spark, rows, rounds=3) == plain_codes(rows, rounds=3)


def test_codes_of_odd_rows(spark):
    good = vectors(1, 90, 16)
    rows = [(i, v, None if i % 3 else 1) for i, v in enumerate(good)]
    rows += [(5, good[5], 1), (5, good[5], 1), (None, good[7], 2), (200, [0.0] * 16, 2)]
    odd = [(300, None, 1), (301, [None] * 16, 1), (302, [float("nan")] * 16, 1), (303, [float("inf")] * 16, 1)]
    assert coded(spark, rows + odd, parts=4) == plain_codes(rows, 4)
    # other lengths than that of the smallest id take no part; a length not divided is filled
    assert coded(spark, rows + [(400, [1.0], 1), (401, [], 1)], parts=4) == plain_codes(rows, 4)
    filled = [(i, v[:14] + [0.0, 0.0], g) for i, v, g in rows]
    assert coded(spark, [(i, v[:14], g) for i, v, g in rows], parts=4) == plain_codes(filled, 4)
    assert coded(spark, []) == [] and coded(spark, odd) == []
    assert coded(spark, [(1, [], None)]) == [(1, "00" * 16, 0, 0, hashlib.sha256(b"").hexdigest())]


def test_bounds_spare_most_of_the_search(spark):
    rows = [(i, v, 0) for i, v in enumerate(vectors(4, 2000, 32, centres=64))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    state, _ = vector_codes.fit(df, parts=8, entries=64, rounds=3)
    usable = vector_codes.usable(df, "vec_id", "embedding", "label")
    assert state.count() == usable.count() == 2000
    books = np.array([r["vector"] for r in usable.orderBy("vec_id").limit(64).collect()])
    books = np.floor(books * 256).astype(np.int64).reshape(64, 8, 4).transpose(1, 0, 2)
    one = vector_codes.stored(vector_codes.assigned(usable, vector_codes.Coder(books, keep=16), True, 256, 1 << 20), "t")
    sums, counts, _ = vector_codes.totals(one, 8, 64, 4, 16)
    moved = np.where(counts > 0, sums // np.maximum(counts, 1), books)
    two = vector_codes.stored(vector_codes.assigned(one, vector_codes.Coder(moved, books, 16, 16), False, 256, 1 << 20), "t")
    tests = vector_codes.totals(two, 8, 64, 4, 16)[2]
    assert tests.sum() == 16000 and tests[17] < 0.2 * tests.sum()


def test_the_number_of_bounds_adapts():
    assert vector_codes.fewer(np.array([1000, 0, 0, 0, 0, 0]), 4, 64) == 1
    assert vector_codes.fewer(np.array([500, 0, 500, 0, 0, 0]), 4, 64) == 2
    assert vector_codes.fewer(np.array([500, 0, 0, 0, 500, 3]), 4, 64) == 4


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="does not fit"):
        coded(spark, [(1, [0.0] * 16, 1), (2, [1e9] * 16, 1)])


# archives

def b32(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def plain_pages(rows, least=0):
    out = []
    for i, _, html in rows:
        payload = (html or "").encode()
        ids = [j for j, _, other in rows if (other or "").encode() == payload]
        last = max((j for j in ids if j is not None), default=None)
        again = len(payload) >= least and last is not None and i != last
        out.append((i, len(payload), b32(payload), "revisit" if again else "response", last if again else None))
    return sorted(out, key=str)


@pytest.fixture
def folder(spark, tmp_path):
    warc.use_warc(spark)
    return f"file://{tmp_path}/{uuid.uuid4().hex}"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", b"y") for r in rows], "page_id long, url string, html string, record_type string, payload binary")


ROWS = [(i, f"http://h/{i}", "body %d " % (i % 7) * (i % 5) + "é\r\n\r\nWARC/1.1\r\n") for i in range(60)]
ROWS += [(100, None, None), (101, "http://h/\r\nWARC-Type: fake\r\n", ""), (None, "http://h/n", "alone"), (None, "http://h/n", ROWS[3][2]),
         (102, "http://h/b", "x" * 3_000_000), (102, "http://h/b", "x" * 3_000_000), (103, "u", "null\x00byte\U0001f600")]


@pytest.mark.parametrize("least", [0, 30])
def test_pages_come_back_as_written(spark, folder, least):
    warc.page_records(pages(spark, ROWS), least_bytes=least).repartition(5).write.format("warc").mode("append").save(folder)
    assert sorted(map(tuple, warc.archived(spark, folder).collect()), key=str) == plain_pages(ROWS, least)


def test_payloads_and_fields_come_back(spark, folder):
    warc.page_records(pages(spark, ROWS)).write.format("warc").mode("append").save(folder)
    rows = spark.read.format("warc").option("verify", "true").load(folder).collect()
    want = Counter((html or "").encode() for html in {r[2] or "" for r in ROWS})
    assert set(bytes(r.payload) for r in rows if r.record_type == "response") == set(want)
    assert all(r.payload is None for r in rows if r.record_type == "revisit")
    assert {r.target_uri for r in rows if r.record_id == "<urn:x-page:101>"} == {"http://h/%0D%0AWARC-Type: fake%0D%0A"}
    assert all(r.headers["warc-type"] == r.record_type for r in rows)


def test_no_pages(spark, folder):
    warc.page_records(pages(spark, [])).write.format("warc").mode("append").save(folder)
    assert warc.archived(spark, folder).collect() == []


def test_any_gzip_reader_reads_the_members(spark, folder):
    warc.page_records(pages(spark, ROWS[:5])).coalesce(1).write.format("warc").mode("append").save(folder)
    import glob

    (path,) = glob.glob(folder.removeprefix("file://") + "/*.warc.gz")
    data = gzip.open(path).read()
    assert data.count(b"\r\nWARC-Record-ID: ") == 5 and data.startswith(b"WARC/1.1\r\n")


def test_predicates_are_pushed_and_decided_like_spark(spark, folder):
    warc.page_records(pages(spark, ROWS)).write.format("warc").mode("append").save(folder)
    df = spark.read.format("warc").load(folder)
    every = df.collect()
    ids = lambda rows: Counter(x.record_id for x in rows)
    tests = [
        ([("record_type", "=", "revisit")], lambda r: r.record_type == "revisit"),
        ([("record_type", "!=", "revisit")], lambda r: r.record_type != "revisit"),
        ([("refers_to", "is null", None)], lambda r: r.refers_to is None),
        ([("refers_to", "!=", "x")], lambda r: r.refers_to is not None),
        ([("refers_to", "is not null", None), ("content_length", "<", 100)], lambda r: r.refers_to is not None and r.content_length < 100),
        ([("content_length", ">", 100), ("content_length", "<=", 500)], lambda r: 100 < r.content_length <= 500),
        ([("content_length", ">=", 500)], lambda r: r.content_length >= 500),
        ([("target_uri", "starts", "http://h/1")], lambda r: (r.target_uri or "").startswith("http://h/1")),
        ([("target_uri", "ends", "9"), ("target_uri", "contains", "/4")], lambda r: (r.target_uri or "") == "http://h/49"),
        ([("target_uri", "in", ["http://h/3", "http://h/2"])], lambda r: r.target_uri in ("http://h/2", "http://h/3")),
        ([], lambda r: True),
    ]
    for where, test in tests:
        want = ids(x for x in every if test(x))
        assert want and ids(warc.records(spark, folder, where).collect()) == want, where
        # a column that is not asked for can be a predicate too
        assert ids(warc.records(spark, folder, where, "record_id string").collect()) == want, where
    with pytest.raises(ValueError):
        warc.records(spark, folder, [("payload", "=", "x")])
    # filters of Spark on the same frame, one after the other and together
    one = warc.records(spark, folder, [("record_type", "=", "revisit")])
    small, large = one.filter("content_length < 90"), one.filter("content_length >= 90")
    assert small.count() + large.count() == one.count() == small.union(large).count() == ids(every and [x for x in every if x.record_type == "revisit"]).total()
    assert df.filter("record_type = 'revisit'").count() + df.filter("record_type <> 'revisit'").count() == df.count() == len(ROWS)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan  # the scan has decided


def test_unwanted_payloads_are_not_inflated(tmp_path):
    body = random.Random(1).randbytes(5_000_000)
    data = warc.member(warc.record("response", "<urn:a>", body)) + warc.member(warc.record("response", "<urn:b>", b"small"))

    class File(io.BytesIO):
        def read_at(self, n, at):
            reads.append((at, n))
            return self.getvalue()[at:at + n]

    reads = []
    rows = list(warc.Scan(lambda r: r["record_id"] == "<urn:b>", True, True).records(File(data), "f", 0, len(data)))
    assert [r["payload"] for r in rows] == [b"small"]
    assert sum(n for _, n in reads) < len(data)  # what the window had not read yet is skipped


def test_foreign_archives(spark, folder, tmp_path):
    """Plain files, members without their length, folded fields and other record types."""
    top = tmp_path / "foreign"
    top.mkdir()
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:i>\r\nX-Long: one\r\n two\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    answer = warc.record("response", "<urn:r>", b"payload")
    (top / "a.warc").write_bytes(info + answer)
    (top / "b.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(answer))
    (top / "_ignored.warc").write_bytes(b"junk")
    rows = spark.read.format("warc").load(f"file://{top}").collect()
    assert Counter((r.record_type, bytes(r.payload), r.payload_length) for r in rows) == {("warcinfo", b"abcd", 4): 2, ("response", b"payload", 7): 2}
    assert {r.headers.get("x-long") for r in rows} == {"one two", None}
    one = spark.read.format("warc").load(f"file://{top}/a.warc").filter("record_type = 'response'").collect()
    assert [r.record_id for r in one] == ["<urn:r>"]


def test_damage_is_reported_with_its_place(spark, tmp_path):
    warc.use_warc(spark)
    (tmp_path / "cut.warc.gz").write_bytes(warc.member(warc.record("response", "<urn:a>", b"x" * 1000))[:-30])
    with pytest.raises(Exception, match=r"cut.warc.gz at 0"):
        spark.read.format("warc").load(f"file://{tmp_path}").collect()
    bad = warc.record("response", "<urn:a>", b"x" * 1000).replace(b"xxxx", b"xxyx")
    (tmp_path / "cut.warc.gz").write_bytes(warc.member(bad))
    assert spark.read.format("warc").load(f"file://{tmp_path}").count() == 1
    with pytest.raises(Exception, match="another digest"):
        spark.read.format("warc").option("verify", "true").load(f"file://{tmp_path}").collect()


def test_large_files_are_cut_and_uncommitted_ones_unread(spark, folder):
    use = warc.page_records(pages(spark, [(i, "u", f"{random.Random(i).random()}" * 50) for i in range(200)])).coalesce(1)
    use.write.format("warc").option("cutBytes", 2000).option("fileBytes", 20000).mode("append").save(folder)
    df = spark.read.format("warc").option("splitBytes", 5000).load(folder)
    assert df.rdd.getNumPartitions() > 5 and df.count() == 200 == df.select("record_id").distinct().count()
    open(folder.removeprefix("file://") + "/part-lost.warc.gz", "wb").write(b"what a lost task left")
    assert df.count() == 200
    use.write.format("warc").mode("append").save(folder)
    assert spark.read.format("warc").load(folder).count() == 400

"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from crowdtide.llm.components import connected
from crowdtide.llm import exact_dedup, jaccard_join, language_id, language_model, mixing, neighbours, packing, pii, sharding, toxicity

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"w{i % 977}" for i in range(60_000))
ODD = [(1, None, "a", "en"), (2, "", None, None), (3, " \n ", "a", "en"), (None, "lone words here", None, "en"),
       (5, LONG, "b", "en"), (6, "Same  text here", "b", "en"), (7, "Same text here", "b", "en"), (7, "Same text here", "b", "en")]


@pytest.fixture(scope="module")
def odd(make):
    return make(ODD)


@pytest.fixture(scope="module")
def none(make):
    return make([])


def texts(seed, n, words=40, alphabet=60):
    r = random.Random(seed)
    return [" ".join(f"t{r.randrange(alphabet)}" for _ in range(r.randrange(words))) for _ in range(n)]


# near copies

def brute_components(rows, n, percent):
    sets = {}
    for i, text in rows:
        w = WORDS.findall((text or "").translate(LOW))
        k = min(n, len(w))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80), (1, 100)])
def test_components_are_those_of_all_pairs(make, n, percent):
    r, rows = random.Random(n), []
    for base in range(12):
        words = [f"b{base}x{r.randrange(50)}" for _ in range(r.choice([1, 2, 9, 10, 11, 19, 20, 60, 200]))]
        for _ in range(12):
            own = list(words)
            for _ in range(r.randrange(4)):
                own[r.randrange(len(own))] = f"e{r.randrange(9)}"
            rows.append((len(rows), (" " if r.random() < 0.5 else "\n").join(own).upper() if r.random() < 0.2 else " ".join(own)))
    r.shuffle(rows)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_join.jaccard_components(make(rows), n, percent).collect()}
    assert got == brute_components(rows, n, percent)


def test_blocks_in_pieces_lose_no_link(make, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 3)
    base = [f"q{i}" for i in range(80)]
    rows = [(i, " ".join(base[:i % 20] + [f"z{i}"] + base[i % 20 + 1:])) for i in range(20)]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_join.jaccard_components(make(rows), 1, 95).collect()}
    assert got == brute_components(rows, 1, 95)


@pytest.mark.parametrize("few", [0, 10**6])
def test_components_in_rounds_and_in_one_task(spark, few):
    r = random.Random(4)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(70)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    want = {x: find(x) for x in root}
    plain = spark.createDataFrame(links, "a long, b long").repartition(3)
    assert {x.node: x.root for x in connected(plain, few).collect()} == want
    named = plain.select(*[F.struct((F.col(c) % 2 == 1).alias("none"), F.col(c).alias("id")).alias(c) for c in "ab"])
    least = {}
    for x in want:
        least[want[x]] = min(least.get(want[x], (9, 0)), (x % 2, x))
    assert {x.node.id: (int(x.root.none), x.root.id) for x in connected(named, few).collect()} == {x: least[want[x]] for x in want}
    assert connected(plain.limit(0), few).count() == 0


@pytest.mark.parametrize("block", [3, 2048])
def test_pairs_are_all_pairs(make, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    r, rows = random.Random(8), []
    for base in range(8):
        words = [f"b{base}x{i}" for i in range(r.choice([9, 20, 60]))]
        for _ in range(9):
            own = list(words)
            for _ in range(r.randrange(4)):
                own[r.randrange(len(own))] = f"e{r.randrange(9)}"
            rows.append((len(rows), " ".join(own)))
    pairs, members = jaccard_join.jaccard_pairs(make(rows), 3, 60)
    node = {x.doc_id: x.node for x in members.collect()}
    sets = {i: {tuple(t.split()[j:j + 3]) for j in range(len(t.split()) - 2)} for i, t in rows}
    want = {tuple(sorted((node[a], node[b]))) for a in sets for b in sets
            if node[a] != node[b] and 100 * len(sets[a] & sets[b]) >= 60 * len(sets[a] | sets[b])}
    found = [(x.a, x.b) for x in pairs.collect()]
    assert len(found) == len(set(found)) and set(found) == want and len(want) > 50


def test_components_of_odd_rows(odd, none):
    got = sorted((x.doc_id or 0, x.n_shingles, x.component_id) for x in jaccard_join.jaccard_components(odd).collect())
    assert [(i, c) for i, n, c in got] == [(0, None), (1, 1), (2, 2), (3, 3), (5, 5), (6, 6), (7, 6), (7, 6)]
    assert [n for i, n, c in got] == [1, 0, 0, 0, 977, 1, 1, 1]
    assert jaccard_join.jaccard_components(none).count() == 0
    kept = jaccard_join.one_of_each(odd)
    assert kept.columns == odd.columns and sorted(x.doc_id or 0 for x in kept.collect()) == [0, 1, 2, 3, 5, 6]


# toxicity

def test_toxicity_finds_held_out_toxic_texts(spark, make):
    r = random.Random(5)
    word = lambda: "".join(r.choice(["ba", "ko", "mi", "tu", "re", "sa"]) for _ in range(r.randrange(1, 4)))
    rows, labels = [], []
    for i in range(400):
        words, toxic = [word() for _ in range(r.randrange(20, 80))], i % 4 == 0
        for _ in range(5 * toxic):
            words[r.randrange(len(words))] = r.choice(["zxqv", "wretchling", "foulbeast", "grimesack"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(900, None), (901, ""), (901, ""), (902, LONG)]
    labels = spark.createDataFrame([*labels, (None, 1), (3, None), (5, 0), (5, 0)], "doc_id long, toxic int")
    docs = make(rows)
    model = toxicity.learn(docs.filter("doc_id % 3 <> 1"), labels.filter("doc_id % 3 <> 1"))
    got = {x.doc_id: x.s for x in docs.select("doc_id", toxicity.toxicity(F.col("text"), model).alias("s")).collect()}
    held = [i for i in range(400) if i % 3 == 1]
    assert sum(got[i] >= 0.7 for i in held if i % 4 == 0) >= 0.9 * sum(i % 4 == 0 for i in held)
    assert sum(got[i] >= 0.7 for i in held if i % 4) <= 0.03 * len(held)
    assert all(0 <= got[i] < 0.7 for i in (900, 901, 902))


def test_toxic_words_that_are_each_rare_are_learned():
    r = random.Random(7)
    name = lambda n: "".join(r.choice("abcdefghijklmnop") for _ in range(n))
    usual, bad = [name(r.randrange(3, 9)) for _ in range(500)], ["q" + name(8) for _ in range(50)]

    def text(i, toxic):
        words = [r.choice(usual) for _ in range(30)]
        if toxic:
            words[3] = words[20] = bad[i % len(bad)]
        return " ".join(words)

    model = toxicity.ToxicityModel.fit([text(i, True) for i in range(1800)], [text(i, False) for i in range(1800)], 0.2)
    assert all(w.encode() in model.toxic for w in bad)  # each is in 2% of toxic texts
    assert sum(model.score(text(i, True)) >= toxicity.THRESHOLD for i in range(200)) >= 180
    assert sum(model.score(text(i, False)) >= toxicity.THRESHOLD for i in range(200)) <= 6


def test_a_very_long_document_leaves_the_others_in_the_sample(spark, make, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_CHARS", (200_000, 200_000))
    fill, r = texts(5, 120), random.Random(2)
    rows = [(i, f"{t} grimesack {t} wretchling {r.random()}" if i % 2 else f"{t} {r.random()}") for i, t in enumerate(fill)]
    first = make(rows).filter("doc_id % 2 = 1").orderBy(F.xxhash64(F.lit(2), "doc_id")).first().doc_id
    rows[first] = (first, "so long " * 40_000)
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.learn(make(rows), labels)
    assert model.weights and model.score("t1 t2 grimesack t3 wretchling") > model.score("t1 t2 t3 t4")


def test_toxicity_without_toxic_rows(spark, odd):
    labels = spark.createDataFrame([(5, 0)], "doc_id long, toxic int")
    model = toxicity.learn(odd, labels)
    assert {x[0] for x in odd.select(toxicity.toxicity(F.col("text"), model)).collect()} == {0.0}


# exact copies

def test_digest_index_grows_and_rejects_what_it_has(spark, make, tmp_path):
    path = str(tmp_path / "index")
    index = exact_dedup.DigestIndex(spark, path, 4)
    first = sorted((x.doc_id, x.keep_id, x.group_size, x.kept) for x in index.deduplicate(make([(4, "a  b"), (2, "a\tb"), (9, None), (8, "")])).collect())
    assert first == [(2, 2, 2, True), (4, 2, 2, False), (8, 8, 2, True), (9, 8, 2, False)]
    again = exact_dedup.DigestIndex(spark, path, 4)  # as a later session opens it
    second = sorted((x.doc_id, x.keep_id, x.kept) for x in again.deduplicate(make([(1, "a b"), (3, "new"), (5, " a b")])).collect())
    assert second == [(1, 2, False), (3, 3, True), (5, 5, True)]
    assert again.rows().count() == 4
    plan = make([(1, "x")]).select(exact_dedup.digest(F.col("text")).alias("digest")).join(again.rows().hint("merge"), "digest", "left_anti")
    assert "Bucketed: true" in plan._jdf.queryExecution().explainString(plan._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_a_batch_run_again_gives_the_same_answer(spark, make, tmp_path):
    def run(batch, rows):
        index = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), 4)
        kept = sorted((x.doc_id, x.keep_id, x.kept) for x in index.deduplicate(make(rows), batch=batch).collect())
        return kept, index.rows().count()

    first = run("monday", [(1, "a"), (2, "b"), (3, "a")])
    assert first == ([(1, 1, True), (2, 2, True), (3, 1, False)], 2) == run("monday", [(1, "a"), (2, "b"), (3, "a")])
    second = run("tuesday", [(4, "a"), (5, "c")])
    assert second == ([(4, 1, False), (5, 5, True)], 3) == run("tuesday", [(4, "a"), (5, "c")])


def test_exact_copies_of_odd_rows(spark, odd, none, tmp_path):
    index = exact_dedup.DigestIndex(spark, str(tmp_path / "a"), 4)
    got = index.deduplicate(odd).collect()
    assert len(got) == len(ODD) and Counter(x.kept for x in got) == {True: 5, False: 3}
    kept = exact_dedup.drop_copies(odd, exact_dedup.DigestIndex(spark, str(tmp_path / "b"), 4))
    assert kept.columns == odd.columns and sorted(x.doc_id or 0 for x in kept.collect()) == [0, 1, 3, 5, 6]
    assert exact_dedup.DigestIndex(spark, str(tmp_path / "c"), 4).deduplicate(none).count() == 0
    twice = exact_dedup.drop_copies(odd.filter("doc_id = 7"), exact_dedup.DigestIndex(spark, str(tmp_path / "d"), 4))
    assert twice.count() == 1


# nearest neighbours

def test_neighbours_are_those_of_brute_force(spark):
    import numpy as np

    r = np.random.default_rng(2)
    x = r.normal(size=(300, 12)).astype(np.float32)
    x[40:60] = x[40]  # ties
    rows = [(i, x[i].tolist(), "q") for i in range(300)]
    rows += [(300, None, ""), (301, [0.0] * 12, ""), (302, [float("nan")] * 12, ""), (303, [1.0, None], ""), (304, [1.0, 2.0], ""), (None, [1.0] * 12, ""), (7, x[7].tolist(), "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, dim string")
    got = defaultdict(list)
    for row in neighbours.nearest(df.filter("vec_id % 20 = 0"), df, 5, cells=6).orderBy("query_id", "rank").collect():
        got[row.query_id].append((row.vec_id, row.score))
    y = x.astype(float)
    for q in range(0, 300, 20):
        score = [(-neighbours.exact(y[q:q + 1], y[i:i + 1])[0], i) for i in range(300) if i != q]
        assert got[q] == [(i, -s) for s, i in sorted(score)[:5]]
    assert set(got) == set(range(0, 300, 20))
    assert neighbours.nearest(df.filter("false"), df.filter("false"), 5).count() == 0


# shards

def test_shards_are_even_and_slots_gapless(make, odd, none):
    rows = [(i, "x" * ((i * 37) % 200)) for i in range(3000)]
    got = sharding.shard(make(rows), 7).collect()
    by = defaultdict(list)
    for x in got:
        by[x.shard].append(x)
    sizes = [sum(x["size"] for x in by[s]) for s in range(7)]
    assert max(sizes) - min(sizes) <= 2 * 216
    assert all(sorted(x.slot for x in by[s]) == list(range(len(by[s]))) for s in by)
    assert all(x["size"] == len("x" * ((x.doc_id * 37) % 200)) + 16 and x.text_crc32 == zlib.crc32(b"x" * ((x.doc_id * 37) % 200)) for x in got)
    assert sharding.shard(odd, 3).count() == len(ODD) and sharding.shard(none, 3).count() == 0


def test_a_hot_key_is_subdivided(make):
    df = make([(i, "y", "hot" if i % 3 else f"s{i}") for i in range(4000)])
    rows = df.select(F.col("source").alias("key"), F.xxhash64("doc_id").alias("tie"), F.lit(17).alias("size"))
    bounds = sharding.splitters(rows, 2)
    held = [x["n"] for x in sharding.placed(rows, bounds).groupBy("range").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(held) <= 2 * 2 * 4000 / (2 * sharding.RANGES_PER_SHARD) + 60
    assert Counter(x.shard for x in sharding.shard(df, 2, key_col="source").collect()) == {0: 2000, 1: 2000}


# language model

def test_base_score_is_exact_and_pairs_help(make):
    import math

    rows = [(i, t) for i, t in enumerate(texts(1, 60))] + [(100, None), (101, ""), (102, "never Seen words")]
    train = [r for r in rows if r[0] % 7 != 2]
    model = language_model.learn(make(train))
    got = {x.doc_id: x for x in language_model.scored(make(rows), model, {"doc_id": F.col("doc_id")}).collect()}
    tokens = {i: [*WORDS.findall((t or "").translate(LOW)), "\n"] for i, t in rows}
    c = Counter(w for i, _ in train for w in tokens[i])
    n, v = sum(c.values()), len(c)
    assert model.n == n and model.v == v
    for i, t in tokens.items():
        assert got[i].base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t))
        assert (got[i].n_tokens, got[i].n_known) == (len(t), sum(c[w] > 0 for w in t)) and got[i].score < 0


def test_filter_reads_back_levels():
    import numpy as np

    h = language_model.mixed(np.arange(1, 5001, dtype=np.uint64))
    n = np.arange(1, 5001) % 900 + 1
    f = language_model.CountFilter([language_model.CountFilter.segment(h, n)])
    read = f.read(h)
    assert (read >= (2.0 ** (language_model.level(n) - 1) + 2.0 ** language_model.level(n) - 1) / 2).all()  # never too low
    assert (f.read(language_model.mixed(np.arange(10_001, 20_001, dtype=np.uint64))) > 0).mean() < 0.02


def test_rare_words_are_asked_for(make, monkeypatch):
    monkeypatch.setattr(language_model, "HOT_WORDS", 3)
    test_base_score_is_exact_and_pairs_help(make)


@pytest.mark.parametrize("part_bytes", [16 << 20, 64])
def test_scores_read_every_pair_and_word_at_any_size(make, monkeypatch, part_bytes):
    """Against a plain model that holds all n-grams; a bound on the filter's size has no effect."""
    import math

    monkeypatch.setattr(language_model, "FILTER_BYTES", 64, raising=False)
    monkeypatch.setattr(language_model, "PART_BYTES", part_bytes)
    rows = list(enumerate([*texts(3, 60, 40, 400), None, "never seen words"]))
    train = [r for r in rows if r[0] % 7 != 2]
    model = language_model.learn(make(train))
    got = {x.doc_id: x.score for x in language_model.scored(make(rows).repartition(5), model, {"doc_id": F.col("doc_id")}).collect()}
    tokens = {i: [None, *WORDS.findall((t or "").translate(LOW)), "\n"] for i, t in rows}
    words = Counter(w for i, _ in train for w in tokens[i][1:])
    pairs = Counter(p for i, _ in train for p in zip(tokens[i], tokens[i][1:]))
    assert sum(n == 1 for n in pairs.values()) > 300
    total = sum(words.values()) + len(words) + 1
    read = lambda n: (1.5 * 2 ** n.bit_length() - 1) / 2 if n else 0.0
    apart = []
    for i, t in tokens.items():
        want = 0.0
        for before, w in zip(t, t[1:]):
            context, count = len(train) if before is None else read(words[before]), read(words[w])
            p = (min(read(pairs[before, w]), count, context) + language_model.PRIOR * (count + 1) / total) / (context + language_model.PRIOR)
            want += math.log10(min(p, 1.0))
        apart.append(abs(got[i] - want))
    # a Bloom filter reads few n-grams a level too high
    assert sorted(apart)[len(apart) // 2] < 1e-9 and max(apart) < 1, sorted(apart)


def test_numbers_come_back():
    import numpy as np

    x = np.sort(np.random.default_rng(1).integers(0, 1 << 32, 999, dtype=np.uint64))
    for some in (x, x[:0], x[:1], np.asarray([0, 127, 128, 16383, 16384, (1 << 32) - 1], np.uint64)):
        assert (language_model.ungaps(language_model.gaps(some)) == some).all()
        assert (language_model.long_numbers(language_model.short_numbers(some.astype(np.int64))) == some).all()
        assert (language_model.unplanes(language_model.planes(some[::-1])) == some[::-1]).all()


@pytest.mark.parametrize("chars", [1, 50, 1 << 21])
def test_scores_are_the_same_in_blocks_of_any_size(make, monkeypatch, chars):
    rows = list(enumerate([*texts(9, 80, 30, 200), None, ""]))
    model = language_model.learn(make(rows))
    want = {x.doc_id: x for x in language_model.scored(make(rows).coalesce(1), model, {"doc_id": F.col("doc_id")}).collect()}
    monkeypatch.setattr(language_model, "BLOCK_CHARS", chars)
    monkeypatch.setattr(language_model, "groups", lambda t: ((i, i + 1) for i in range(len(t))))
    got = {x.doc_id: x for x in language_model.scored(make(rows).repartition(3), model, {"doc_id": F.col("doc_id")}).collect()}
    for i, x in want.items():
        assert (got[i].n_tokens, got[i].n_known) == (x.n_tokens, x.n_known)
        assert (got[i].base_score, got[i].score) == pytest.approx((x.base_score, x.score))


def test_language_model_of_odd_rows(odd, none):
    model = language_model.learn(odd)
    assert language_model.scored(odd, model, {"doc_id": F.col("doc_id")}).count() == len(ODD)
    model = language_model.learn(none)
    got = language_model.scored(odd, model, {"doc_id": F.col("doc_id")}).collect()
    assert {x.n_known for x in got} == {0} and model.n == 0


# disclosing terms

def plain_disclosing(texts_, disclosure=0.9, support=2, by_chance=0.001):
    """Pointwise mutual information over texts, and the bound on chance, pair by pair."""
    import math

    held = {}
    for t in set(texts_):
        mails = {f"email:{m.lower()}" for m in re.findall(r"[A-Za-z0-9.]+@[a-z]+(?:[.][a-z]+)+", t)}
        held[t] = (mails | ({"email"} if mails else set()), {w.lower() for w in re.findall(r"[^\W\d_]{3,}", t)})
    n = len(held)
    n_entity = Counter(e for es, _ in held.values() for e in es)
    n_term = Counter(w for _, ws in held.values() for w in ws)
    n_pair = Counter((e, w) for es, ws in held.values() for e in es for w in ws if n_entity[e] >= support)
    tested = {p: k for p, k in n_pair.items() if k >= support}
    out = set()
    for (e, w), k in tested.items():
        information = math.log(n / n_entity[e])
        pmi = math.log(k * n / (n_term[w] * n_entity[e]))
        part, chance = k / n_term[w], n_entity[e] / n
        divergence = part * math.log(part / chance) + ((1 - part) * math.log((1 - part) / (1 - chance)) if part < 1 else 0.0)
        if information > 0 and pmi >= disclosure * information and n_term[w] * divergence >= math.log(len(tested) / by_chance):
            out.add((e, w))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_disclosing_terms_are_those_of_plain_information(make, seed):
    r, rows = random.Random(seed), []
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 6)))
    usual = [word() for _ in range(80)]
    for i in range(260):
        words = r.choices(usual, k=r.randrange(4, 20))
        if i % 9 == 0:
            words += [f"Person{'xyzabcdef'[i % 5]}name", f"u{i % 5}@ex.org"]
        elif i % 13 == 0:
            words += ["callme", f"q{i}@ex.org"]
        r.shuffle(words)
        rows.append((i, " ".join(words)))
    rows += [(900, rows[0][1]), (901, None), (902, ""), (903, "Person nobody")]
    docs = pii.with_identifiers(make(rows).selectExpr("doc_id", "coalesce(text, '') as text"))
    got = {(x.entity, x.term) for x in pii.disclosing(docs).collect()}
    want = plain_disclosing([t or "" for _, t in rows])
    assert got == want and len(want) >= 5


# languages

def test_languages_and_odd_rows(make, odd, none):
    r, rows = random.Random(4), []
    for i in range(120):
        lang, parts = [("aa", ["ba", "ko", "mi"]), ("bb", ["zu", "xe", "vy"])][i % 2]
        rows.append((i, " ".join("".join(r.choice(parts) for _ in range(3)) for _ in range(15)), None, lang if i % 5 else None))
    train = make(rows)
    model = language_id.LanguageModel.learn(train)
    got = {x.doc_id: x.p for x in train.select("doc_id", model.predict(F.col("text")).alias("p")).collect()}
    assert all(got[i].lang == ("aa", "bb")[i % 2] and 0 < got[i].score <= 1 for i in got)
    ends = make([(1, None), (2, ""), (3, "12 !?"), (4, "BAKOMI " * 300_000)]).select("doc_id", model.predict(F.col("text")).alias("p")).collect()
    assert {x.doc_id: x.p.lang for x in ends} == {1: "und", 2: "und", 3: "und", 4: "aa"}
    empty = language_id.identify(odd, none)
    assert {x["__language"].lang for x in empty.collect()} == {"und"} and empty.columns[:-1] == odd.columns


def plain_grams(text):
    """Letters, and pairs and triples that a word's edges, as blanks, belong to."""
    low = lambda c: c.lower() if len(c.lower()) == 1 else c
    for word in re.findall(r"[^\W\d_]+", "".join(c if c.isalpha() else " " for c in text)):
        padded = f" {''.join(map(low, word))} "
        yield from padded[1:-1]
        for n in (2, 3):
            yield from (padded[i:i + n] for i in range(len(padded) - n + 1))


def plain_profile(texts_, size=400):
    counts = Counter(g for t in texts_ for g in plain_grams(t or ""))
    number = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    return {g: i for i, g in enumerate(sorted(counts, key=lambda g: (-counts[g], number(g)))[:size])}


def test_languages_are_those_of_plain_out_of_place_distances(spark):
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("test tables are not here")
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in docs}
    profiles = {}
    for lang in sorted({r.lang for r in docs if r.lang and not held[r.doc_id]}):
        profiles[lang] = plain_profile([r.text for r in docs if r.lang == lang and not held[r.doc_id]])
    got = {r.doc_id: r for r in language_id.op7_language_id(spark, folder).collect()}
    for r in docs:
        own = plain_profile([r.text])
        apart = {lang: sum(abs(p[g] - i) if g in p else 400 for g, i in own.items()) for lang, p in profiles.items()}
        lang = min(apart, key=lambda k: (apart[k], k)) if own else "und"
        x = got[r.doc_id]
        assert (x.held_out, x.lang_pred) == (held[r.doc_id], lang)
        assert x.score == pytest.approx(1 - apart[lang] / (400 * len(own)) if own else 0.0)


def test_grams():
    def shown(text):
        return sorted("".join(chr(x >> s & 0x1FFFFF) for s in (42, 21, 0)).strip("\0") for x in language_id.grams(text).tolist())

    assert shown("Ab, c") == sorted(["a", "b", "c", " a", "ab", "b ", " c", "c ", " ab", "ab ", " c "])
    assert shown("") == shown("1 2") == []


# packing

def test_pieces_are_binary_and_give_the_text_back(make, odd, none):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    rows = [(i, t) for i, t in enumerate(["", "a", "it's  two   spaces \n\n x", " lead", "tail ", "é ß 12 <|endoftext|>", LONG, *texts(9, 30)])] + [(99, None)]
    by = defaultdict(list)
    for x in packing.pack(make(rows), path, max_length=64).collect():
        by[x.doc_id].append(x)
        assert x.length & (x.length - 1) == 0 and x.length <= 64 and x.offset == 0 and 1 << x.bucket == x.length
    for i, text in rows:
        pieces = sorted(by[i], key=lambda x: x.start)
        ids = np.frombuffer(b"".join(x.ids for x in pieces), "<u4").tolist()
        assert ids == [*plain.encode(text or "", add_special_tokens=False).ids, 1]
        assert {x.doc_tokens for x in pieces} == {len(ids)} and [x.start for x in pieces] == [sum(y.length for y in pieces[:j]) for j in range(len(pieces))]
    numbers = [x.sequence_id for v in by.values() for x in v]
    assert len(set(numbers)) == len(numbers)
    assert packing.pack(odd, path).select("doc_id").distinct().count() == 7 and packing.pack(none, path).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json"])
def test_other_tokenizers_are_read_whole(name):
    import public_tokenizers

    ids = packing.TokenIds(public_tokenizers.path(name))
    assert ids.merge is None and ids("Two words") == ids._whole("Two words")


# mixing

def test_targets_are_those_of_resharing(spark):
    sizes = {"a": 100, "b": 3, "c": 900, "d": 10, "e": 0, None: 40}
    weights, total = dict(zip([*sorted(k for k in sizes if k), None], [5, 2, 1, 5, 2, 1])), 1.5 * sum(sizes.values())
    want, full = {}, set()
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        want = {s: 2 * sizes[s] if s in full else left * weights[s] / sum(weights[o] for o in sizes if o not in full) for s in sizes}
        over = {s for s in sizes if s not in full and want[s] > 2 * sizes[s]}
        if not over:
            break
        full |= over
    got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    assert {x.source: x.target for x in got.collect()} == pytest.approx(want)


def test_mix_meets_targets(make, odd, none):
    r = random.Random(8)
    rows = [(i, "w " * r.randrange(30), r.choice("abc") if i % 3 else "hot") for i in range(3000)]
    df = make(rows)
    got = mixing.mix(df).collect()
    taken, goal = Counter(), {}
    for x in got:
        taken[x.source] += x.taken
        goal[x.source] = x.target
        assert x.taken in (0, x["size"], 2 * x["size"])
    assert all(abs(taken[s] - goal[s]) <= 30 for s in goal)
    made = mixing.mixed_documents(df)
    assert made.columns == df.columns
    assert Counter(x.doc_id for x in made.collect()) == Counter({x.doc_id: x.taken // x["size"] for x in got if x["size"] and x.taken}) + Counter(
        x.doc_id for x in made.filter("trim(text) = ''").collect())
    small = {x.doc_id for x in mixing.mix(df, budget=0.4).collect() if x.taken}
    assert small <= {x.doc_id for x in got if x.taken}  # budgets are nested
    assert mixing.mix(odd).count() == len(ODD) and mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0


# personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, hit):
    d = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(x) <= 255 for x in hit.split("."))
    if kind == "phone":
        return 9 <= len(d) <= 15
    if kind == "card":
        return 13 <= len(d) <= 19 and sum((lambda v: v if i % 2 == 0 else v * 2 - 9 * (v > 4))(int(c)) for i, c in enumerate(reversed(d))) % 10 == 0
    return True


def test_identifiers_are_those_of_the_patterns(make):
    r = random.Random(6)
    parts = ["a@b.c", "@", ".", "x.y@z-1.de.", "1.2.3.4", "01.300.2.3", "4111 1111 1111 1111", "4111-1111", "+49 (30) 123-456", "+1", " ", "é", "𝄞", "_q@w.e@r.t", "9" * 21, "-", "\n"]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randrange(12)))) for i in range(400)]
    rows += [(900, None), (901, "a" * 50_000), (902, "a@" + "b." * 20_000 + "c"), (903, "1 " * 20_000), (904, "1." * 20_000 + "1")]
    got = {x.doc_id: x.s for x in pii.detect(make(rows)).select("doc_id", pii.listed(pii.KINDS).alias("s")).collect()}
    for i, text in rows:
        want = [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(k, m[0])]
        assert got[i] == ",".join(want), text


def test_terms_that_disclose_are_generalised(make, none):
    fill = texts(3, 80, 30)
    rows = [(i, f"{t} Moonbeam bob@x.org said" if i % 10 == 0 else f"{t} said") for i, t in enumerate(fill)]
    got = {x.doc_id: x.text for x in pii.sanitise(make(rows)).collect()}
    assert all(got[i] == (f"{t} [TERM] [EMAIL] said" if i % 10 == 0 else f"{t} said") for i, t in enumerate(fill))
    assert pii.sanitise(none).count() == 0
    # two texts are too few to tell, copies of one count once
    few = [(0, "Moonbeam bob@x.org"), *[(i, "Moonbeam bob@x.org there") for i in range(1, 9)], *[(i + 20, t) for i, t in enumerate(fill)]]
    assert all("[TERM]" not in x.text for x in pii.sanitise(make(few)).collect())


def test_identifiers_of_one_or_two_texts_have_terms(make):
    r = random.Random(4)
    name = lambda: "".join(r.choice("abcdefghijklm") for _ in range(9))
    fill = [f"{name()} plain {name()}" for _ in range(600)]
    # the same name and address in two texts only, and a word beside addresses of one text each
    rows = [*enumerate(fill), *[(1000 + i, f"{name()} Moonbeam bob@x.org") for i in range(2)], *[(2000 + i, f"{name()} mailbox a{i}@y.org plain") for i in range(6)]]
    got = {x.doc_id: x.text.split(" ", 1)[1] for x in pii.sanitise(make(rows)).collect()}
    assert {got[1000], got[1001]} == {"[TERM] [EMAIL]"} and {got[2000 + i] for i in range(6)} == {"[TERM] [EMAIL] plain"}
    assert all("[TERM]" not in got[i] for i in range(600))


def test_terms_are_found_beside_letters_that_grow_in_lower_case(make):
    fill = texts(3, 80, 30)
    rows = [(i, f"\u0130 {t} MOONBEAM \u0130zmir bob@x.org said" if i % 10 == 0 else f"{t} said") for i, t in enumerate(fill)]
    got = {x.doc_id: x.text for x in pii.sanitise(make(rows)).collect()}
    assert all(got[i] == f"\u0130 {fill[i]} [TERM] [TERM] [EMAIL] said" for i in range(0, 80, 10))


def test_digest_matches_python(make):
    x = pii.detect(make([(1, "mail a@b.c or +49 123 456 789")])).select(F.sha2(pii.listed(pii.KINDS).cast("binary"), 256).alias("h")).first()
    assert x.h == hashlib.sha256(b"email:5:10,phone:14:29").hexdigest()

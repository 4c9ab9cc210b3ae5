import math
import re
import unicodedata
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from crowdtide.fixed_values import NEGATIVE_WORDS, POSITIVE_WORDS, WHITESPACE
from crowdtide.functions import casts, extract, stats, text as tx, times, vectors

TEXTS = [
    None, "", "   ", " a  b\n\nc ", "x y z", "\x1cfs\x1d gs\x1f", "　wide line ",
    "plain text", "tab\there\x0b\x0cend\x85", "zero​width", "été 한",
    "हिन्दी buy_now", "½ x² BUY", "bullish bull", "!!! ...",
]


def test_whitespace_is_pythons(column):
    assert sorted(WHITESPACE) == [chr(c) for c in range(0x110000) if chr(c).isspace()]
    present = TEXTS[1:]
    assert column(tx.collapse_whitespace, present) == [" ".join(t.split()) for t in present]
    assert column(tx.strip, present) == [t.strip() for t in present]
    assert column(tx.has_text, present) == [bool(t.strip()) for t in present]


def test_normalize_text(column):
    want = ["" if t is None else " ".join(unicodedata.normalize("NFC", t).split()) for t in TEXTS]
    assert column(tx.normalize_text, TEXTS) == want


def test_nfc_over_all_characters(column):
    chars = [chr(c) for c in range(0x20, 0x30000) if not 0xD800 <= c < 0xE000]
    # code points newer than either Unicode table may differ: leave unassigned ones out
    chars = [c for c in chars if unicodedata.category(c) != "Cn"]
    texts = ["".join(f"a{c} " for c in chars[i : i + 500]) for i in range(0, len(chars), 500)]
    assert column(tx.nfc, texts) == [unicodedata.normalize("NFC", t) for t in texts]


def test_words_are_pythons(column):
    present = TEXTS[1:]
    assert column(tx.words, present) == [re.findall(r"\w+", t) for t in present]
    assert column(tx.terms, ["A bc DEF x_1 1"]) == [["bc", "def", "x_1"]]


def test_repair_changes_text_before_the_rest(column):
    upper = lambda c: F.upper(c)
    assert column(lambda c: tx.normalize_text(c, upper), ["a  b"]) == ["A B"]


LEXICAL = [
    None, "", "  ", "...", "Buy the rally, SELL nothing", "bull bullish bulls", "up-up/down",
    "stop loss stoploss", "ſell reſiſtance", "profıt PROFİT", "linK",
    "buy_now buy", "long " * 50,
]


def test_lexical_score_ignores_case_as_python_does(column):
    def hits(words, text):
        return sum(bool(re.fullmatch("|".join(words), w, re.I)) for w in re.findall(r"\w+", text))

    want = []
    for text in LEXICAL:
        balance = hits(POSITIVE_WORDS, text or "") - hits(NEGATIVE_WORDS, text or "")
        want.append(balance / math.sqrt(len(re.findall(r"\w+", text or "")) or 1))
    assert column(tx.lexical_score, LEXICAL) == pytest.approx(want)
    assert want[8] == pytest.approx(-2 / math.sqrt(2)) and want[9] == pytest.approx(2 / math.sqrt(2))


def test_lexicon_entries_are_single_words():
    with pytest.raises(ValueError):
        tx.lexical_score(F.lit("x"), ["stop loss"], [])


def test_first_filled_passes_over_empty_not_blank(spark):
    rows = [(None, "b"), ("", "b"), (" ", "b"), ("", None)]
    df = spark.createDataFrame(rows, "a string, b string")
    got = [r[0] for r in df.select(tx.first_filled(F.col("a"), F.col("b"))).collect()]
    assert got == ["b", "b", " ", ""]


def test_content_hash(column):
    assert column(tx.content_hash, ["abc"]) == ["a9993e364706816aba3e25717850c26c9cd0d89d"]


def test_optional_int(column):
    values = [None, "", "0", "12", " 7 ", "3.0", "3.9", "-2", "1e3", "abc", "1,000", "9" * 30, "2147483648"]
    want = [None, None, 0, 12, 7, 3, 3, -2, 1000, None, None, None, 2147483648]
    assert column(casts.optional_int, values) == want
    assert column(casts.int_or_zero, values) == [v or 0 for v in want]


def test_parse_time(column):
    values = [
        "2025-09-08T12:00:00Z", "2025-09-08T17:30:00+05:30", "2025-09-08T12:00:00.123456", "2025-09-08 12:00:00",
        "2025-09-08", "1757332800000", "junk", "", None, "12",
    ]
    got = column(lambda c: times.post_iso(times.parse_time(c)), values)
    noon = "2025-09-08T12:00:00+00:00"
    assert got == [
        noon, noon, "2025-09-08T12:00:00.123456+00:00", noon, "2025-09-08T00:00:00+00:00", noon, None, None, None, None,
    ]
    assert column(lambda c: times.event_day(times.parse_time(c)), ["2025-09-08T23:59:59Z", "?"]) == ["2025-09-08", "unknown"]
    fixed = column(lambda c: times.window_iso(times.time_or_now(times.parse_time(c), datetime(2024, 1, 2))), ["", None])
    assert fixed == ["2024-01-02T00:00:00Z"] * 2


@pytest.mark.parametrize("text,micros", [("5min", 300e6), ("1m", 60e6), ("15T", 900e6), ("1h", 3600e6), ("D", 86400e6), ("30s", 30e6)])
def test_frequency(text, micros):
    assert times.frequency_micros(text) == micros


@pytest.mark.parametrize("text", ["", "5", "0min", "1 month", "W"])
def test_frequency_refused(text):
    with pytest.raises(ValueError):
        times.frequency_micros(text)


LABELS = [
    (["1,234 Likes"], "", (1234, None, None, None)),
    (["5 replies"], "", (None, None, None, None)),
    (["3 reply"], "12 replies", (None, None, 3, None)),
    (["1.2K likes", "1.5 likes"], "", (1, None, None, None)),
    ([", likes", ". likes"], "", (None, None, None, None)),
    (["4 likes", "9 likes"], "7 likes", (9, None, None, None)),
    ([], "12 Replies, 3,001 retweets\n8 quotes", (None, 3001, 12, 8)),
    (["2 Quote posts", "6 Retweets"], "", (None, 6, None, 2)),
    (["7 likeretweet"], "", (7, None, None, None)),
    (["see 10 likes now"], "", (10, None, None, None)),
    (None, "none", (None, None, None, None)),
]


def test_label_counts(spark):
    df = spark.createDataFrame([(i, a, t) for i, (a, t, _) in enumerate(LABELS)], "i int, a array<string>, t string")
    names = {"like": "like", "retweet": "retweet", "reply": "reply", "quote": "quote"}
    out = extract.with_label_counts(df, F.col("a"), F.col("t"), names).orderBy("i")
    got = [tuple(r) for r in out.select("like", "retweet", "reply", "quote").collect()]
    assert got == [want for *_, want in LABELS]


HANDLES = [
    ("a\nb\nc\nd\ne\nby @six", [], "six"),
    ("a\n\nb\nc\nd\ne\nf\nby @seven", [], None),
    ("@text", ["/i/x", "/status/1", "https://a/b", "/name/status/1"], "name"),
    ("@text", ["/sixteen_chars_xx"], "text"),
    ("", ["/", "/Search/x", "/ok"], "ok"),
    (None, None, None),
]


def test_author_handle(spark):
    df = spark.createDataFrame([(i, t, h) for i, (t, h, _) in enumerate(HANDLES)], "i int, t string, h array<string>")
    out = df.orderBy("i").select(extract.author_handle(F.col("t"), F.col("h")))
    assert [r[0] for r in out.collect()] == [want for *_, want in HANDLES]


def test_tags(column):
    texts = ["#Nifty50 #nifty50 #हि #a_b @z @y @abcdefghijklmnopq", "none", ""]
    want = [",".join(sorted({t.lower() for t in re.findall(r"#(\w+)", x)})) for x in texts]
    assert column(lambda c: extract.joined(extract.hashtag_list(c)), texts) == want
    assert column(lambda c: extract.joined(extract.mention_list(c)), texts) == ["abcdefghijklmno,y,z", "", ""]


def test_keys_and_links(column):
    assert column(extract.absolute_url, ["/a/1", "https://b", None]) == ["https://x.com/a/1", "https://b", None]
    long = "é" * 500
    keys = column(lambda c: extract.pseudo_key(F.lit(""), c), [long, long[:400], long[:399]])
    assert len(set(keys)) == 3  # the whole text is the key
    keys = column(lambda c: extract.pseudo_key(F.lit(""), c, chars=400), [long, long[:400], long[:399]])
    assert keys[0] == keys[1] != keys[2]
    assert column(lambda c: extract.pseudo_key(c, F.lit("t")), ["u"]) == ["u"]
    assert column(lambda c: extract.first_text(c, F.lit("\n"), F.lit(" z ")), ["a", " ", None]) == ["a", "z", "z"]
    assert column(tx.single_line, ["a\nb"]) == ["a b"]


def test_vectors(spark):
    rows = [(0, [0.0, 0.0]), (1, [3.0, 4.0]), (2, [-3.0, -4.0]), (3, None), (4, [4.0, 3.0])]
    df = spark.createDataFrame(rows, "i int, v array<float>")
    pos, neg = [3.0, 4.0], [0.0, 2.0]
    score = vectors.contrast_score(pos, neg)(F.col("v"))
    a, b = (vectors.cosine(F.col("v"), F.lit(c)) for c in (pos, neg))
    got = df.orderBy("i").select(score, a - b, a).collect()
    assert [r[0] for r in got] == pytest.approx([0.0, 0.2, -0.2, None, 0.36])
    assert [r[1] for r in got] == pytest.approx([0.0, 0.2, -0.2, None, 0.36])
    assert [r[2] for r in got] == pytest.approx([0.0, 1.0, -1.0, None, 0.96])
    with pytest.raises(Exception, match="2 dimensions"):
        spark.createDataFrame([([1.0],)], "v array<float>").select(vectors.contrast_score(pos, neg)("v")).collect()


def test_zero_centroid_counts_as_zero(spark):
    df = spark.createDataFrame([([1.0, 0.0],)], "v array<float>")
    assert df.select(vectors.contrast_score([0.0, 0.0], [2.0, 0.0])("v")).first()[0] == -1.0


def test_t_quantiles():
    table = stats.t_quantiles()
    # closed forms for df = 1 and 2, printed tables beyond
    assert table[0] == pytest.approx(math.tan(math.pi * 0.475), rel=1e-12)
    assert table[1] == pytest.approx(0.95 * math.sqrt(2 / (4 * 0.975 * 0.025)), rel=1e-12)
    for df, value in {5: 2.570581836, 30: 2.042272456, 100: 1.983971519}.items():
        assert table[df - 1] == pytest.approx(value, rel=1e-8)


def test_t_critical_is_smooth_past_the_table(column):
    got = column(stats.t_critical, [200, 201, 1000, 10**6], "bigint")
    assert got[0] == pytest.approx(1.9718962236316089, rel=1e-11)
    assert got[1] == pytest.approx(1.971836507, rel=1e-8)
    assert got[2] == pytest.approx(1.9623390808, rel=1e-9)
    assert got[3] == pytest.approx(1.959966, rel=1e-6)


# Windows of a published run: n, sem, band, shares, action.
GOLDEN = [
    (4, 0.4048616290092468, 1.2884503953918456, 0.5, 0.5, "HOLD"),
    (6, 0.41648268699645996, 1.0706028300501045, 0.3333333333333333, 0.6666666666666666, "LONG"),
    (4, 0.0446346141397953, 0.14204726285698027, 1.0, 0.0, "SHORT"),
    (16, 0.02138386107981205, 0.04557862098086909, 1.0, 0.0, "SHORT"),
    (4, 0.2850915193557739, 0.9072884524416597, 0.0, 1.0, "LONG"),
    (10, 0.22969640791416168, 0.5196093744448779, 0.4, 0.6, "LONG"),
    (10, 0.24698813259601593, 0.5587259732920354, 0.6, 0.4, "SHORT"),
    (8, 0.0, 0.0, 0.0, 1.0, "LONG"),
]


def test_golden_windows(spark):
    df = spark.createDataFrame(GOLDEN, "n bigint, sem double, ci double, p double, q double, a string")
    rows = df.select(
        stats.half_width(F.col("n"), F.col("sem")).alias("got"), "ci",
        stats.trade_action(F.col("p"), F.col("q")).alias("action"), "a",
    ).collect()
    for row in rows:
        assert row["got"] == pytest.approx(row["ci"], abs=1e-10)
        assert row["action"] == row["a"]


def test_decision_edges(spark):
    shares = [(0.6, 0.4), (0.4, 0.6), (0.59, 0.41), (0.0, 0.0), (0.6, 0.6)]
    df = spark.createDataFrame(shares, "p double, q double")
    got = [r[0] for r in df.select(stats.trade_action(F.col("p"), F.col("q"))).collect()]
    assert got == ["SHORT", "LONG", "HOLD", "HOLD", "HOLD"]
    low = df.select(stats.trade_action(F.col("p"), F.col("q"), 0.5)).collect()
    assert low[2][0] == "SHORT" and low[4][0] == "HOLD"

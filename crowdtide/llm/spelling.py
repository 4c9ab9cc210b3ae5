"""Spelling variants by permuterm rotations.

A word of L code points is marked with a terminator and turned into its L + 1 rotations.
Two words that differ in one replaced character have rotations that agree in all but
their last character; where one has a character more, its rotation without the last
character is a whole rotation of the other. So each rotation is sorted under the prefix
that skips its last character, and once under itself as the word that may lack one. All
rows under one key are a prefix range: at most one word for each letter, and one that
lacks it. A scan of the sorted rows gives every member of a range its neighbours there,
as one row: how many, and the best. Ranges are as small as the alphabet, whatever the
corpus, and no pair is written out.

A doubled letter can be dropped at several places with the same result; only the first
place of a run counts as an indel, so each pair of words meets in exactly one range.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from crowdtide.llm.common import plain_text, stored, table

END = "$"  # sorts before every letter and is in no word
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = r"a-zÀ-ÿ"


def corpus_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 7, least_count: int = 2, noise: int = 31
) -> DataFrame:
    """``word, n``: words of at least ``least_chars`` code points that occur ``least_count`` times.

    Words are maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower
    case. Where crc32 of ``<id>:<run>`` is divisible by ``noise``, the run loses the code
    point at that number modulo its length; ``noise`` 0 leaves all runs as they are. Null
    text has no words, a null id counts as the empty text. Rows that repeat count each
    time. Other columns are not read.
    """
    text = F.translate(plain_text(F.col(text_col)), UPPER, LOWER)
    run = F.explode(F.regexp_extract_all(text, F.lit(f"[{LETTERS}]{{{least_chars},}}"), F.lit(0))).alias("run")
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), run)
    word = F.col("run")
    if noise:
        runs = runs.withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
        at = (F.col("h") % F.char_length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
        word = F.when(F.col("h") % noise == 0, cut).otherwise(word)
    words = runs.select(word.alias("word")).filter(F.char_length("word") >= least_chars)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def rotations(words: DataFrame) -> DataFrame:
    """``key, letter, first, n``: each word under its L skipping prefixes and its L + 1 rotations.

    ``letter`` is the skipped one, empty for the rotation as it is; ``first`` tells whether
    it begins a run of equal letters. The word is found again as the part of the key after
    the terminator, the letter, and the part before.
    """
    length = F.char_length("word")
    places = words.select("word", "n", F.explode(F.sequence(F.lit(0), length)).alias("i"))
    rest = lambda skip: F.concat(F.substring("word", F.col("i") + 1 + skip, length), F.lit(END), F.substring("word", F.lit(1), F.col("i")))
    letter = F.substring("word", F.col("i") + 1, F.lit(1))
    before = F.when(F.col("i") > 0, F.substring("word", F.col("i"), F.lit(1))).otherwise(F.lit(""))
    return places.select(
        "n",
        F.explode(F.array(
            F.struct(rest(0).alias("key"), F.lit("").alias("letter"), F.lit(False).alias("first")),
            F.struct(F.when(letter != "", rest(1)).alias("key"), letter.alias("letter"), (letter != before).alias("first")),
        )).alias("r"),
    ).select("r.key", "r.letter", "r.first", "n").filter(F.col("key").isNotNull())


def best_of(members: list[tuple[str, bool, int, str]], ratio: int):
    """Rows ``word, near, best_n, best`` for the members ``(letter, first, n, word)`` of one range."""
    whole = next((m for m in members if not m[0]), None)
    edited = [m for m in members if m[0]]
    rank = lambda m: (-m[2], m[3])
    top = sorted(edited, key=rank)[:2]
    for m in edited:
        rivals = [t for t in top if t is not m][:1]
        near = len(edited) - 1
        if whole and m[1]:
            rivals, near = [*rivals, whole], near + 1
        if near:
            best = min(rivals, key=rank)
            yield (m[3], near, best[2], best[3]) if best[2] >= ratio * m[2] else (m[3], near, None, None)
    shorter = [m for m in edited if m[1]]
    if whole and shorter:
        best = min(shorter, key=rank)
        yield (whole[3], len(shorter), best[2], best[3]) if best[2] >= ratio * whole[2] else (whole[3], len(shorter), None, None)


def scan(ratio: int):
    """A function over Arrow batches sorted by key; a range may go over into the next batch."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        names = ["word", "near", "best_n", "best"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]

        def found(rows):
            # rows of ranges with two members or more, in order
            out, members, at = [], [], None
            for key, letter, first, n in rows:
                if key != at:
                    out += best_of(members, ratio)
                    members, at = [], key
                    tail, _, head = key.partition(END)
                members.append((letter, first, n, head + letter + tail))
            out += best_of(members, ratio)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 4, kinds)], names)

        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]) if held is not None else rows
            key = rows.column("key").combine_chunks()
            if not len(key):
                continue
            same = np.asarray(pc.equal(key.slice(1), key.slice(0, len(key) - 1)))
            starts = np.flatnonzero(~same) + 1
            last = int(starts[-1]) if len(starts) else 0
            held = rows.slice(last)
            shared = np.zeros(len(key) + 1, bool)
            shared[1:len(key)] = same
            shared = (shared[:-1] | shared[1:])[:last]
            take = rows.slice(0, last).filter(pa.array(shared))
            yield found(zip(*[c.to_pylist() for c in take.columns]))
        if held is not None:
            yield found(zip(*[c.to_pylist() for c in held.columns]))

    return run


def near_words(words: DataFrame, ratio: int = 10) -> DataFrame:
    """``word, n, n_near, form, form_n`` for each row of ``word, n``; words are distinct.

    ``n_near`` counts the words at one inserted, deleted or replaced code point. ``form``
    is the one with the largest ``n``, the smallest of equals, if that is at least
    ``ratio`` times the word's own. The empty word counts as a word.
    """
    # every rotation goes to the task of its key; the sort spills, ranges are tiny
    ranges = rotations(words).repartition("key").sortWithinPartitions("key", "letter")
    hits = ranges.mapInArrow(scan(ratio), "word string, near long, best_n long, best string")
    rows = words.select("word", "n", F.lit(0).cast("long").alias("near"), F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("string").alias("best")) \
        .unionByName(hits.withColumn("n", F.lit(None).cast("long")))
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("form"))))
    return rows.groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), best.alias("best")).select(
        "word", "n", "n_near", "best.form", (-F.col("best.less")).alias("form_n"))


def rooted(forms: DataFrame, ratio: int = 10) -> DataFrame:
    """Adds ``root``: from each word along its forms to the last, the word itself if none.

    Counts grow by ``ratio`` at each step, so the largest count bounds the steps, and each
    round of following doubles them. Only words that have a form take part in the joins.
    """
    links = forms.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    ends = forms.agg(F.min("n").alias("least"), F.max("n").alias("most")).first()
    if ends["least"] is not None:
        steps = math.floor(math.log(max(ends["most"] / max(ends["least"], 1), 1), ratio) + 1e-9)
        for _ in range(max(steps - 1, 0).bit_length()):
            on = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
            links = stored(links.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    rest = forms.filter(F.col("form").isNull()).withColumn("root", F.col("word"))
    return forms.join(links, "word").unionByName(rest)


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 7, least_count: int = 2,
    ratio: int = 10, noise: int = 31,
) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for the words of a corpus; no rows without words."""
    words = stored(corpus_words(docs, id_col, text_col, least_chars, least_count, noise), "words")
    forms = stored(near_words(words, ratio), "forms")
    return rooted(forms, ratio).select("word", "form", "root", "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


# crc32 is not in DuckDB: its table comes from the rule, and the bytes are folded.
OP11_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS steps
  FROM (SELECT unnest(range(256)) AS i)),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
  FROM documents),
distinct_runs AS (SELECT doc_id, run, count(*) AS times FROM runs WHERE length(run) >= 7 GROUP BY ALL),
bytes AS (
  SELECT run, times, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM distinct_runs),
hashed AS (
  SELECT run, times, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) AS h
  FROM bytes, crc),
changed AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times
  FROM hashed),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM changed WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
cuts AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, b.n, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
near AS (
  SELECT word, count(*) AS n_near, min({'less': -other_n, 'form': other}) AS best FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -best.less >= 10 * w.n THEN best.form END AS form,
         CASE WHEN -best.less >= 10 * w.n THEN -best.less END AS form_n
  FROM words w LEFT JOIN near USING (word)),
followed AS (
  SELECT word, word AS root, 0 AS step FROM forms
  UNION ALL
  SELECT f.word, g.form, f.step + 1 FROM followed f JOIN forms g ON f.root = g.word WHERE g.form IS NOT NULL)
SELECT word, form, (SELECT arg_max(root, step) FROM followed f WHERE f.word = forms.word) AS root, n, n_near, form_n FROM forms
"""

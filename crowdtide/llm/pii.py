"""Personal data, and terms that disclose it.

Direct identifiers (e-mail, IP, card and phone numbers) are found by pattern and check.
A term discloses an identifier of its document if the corpus says that who reads the term
knows the identifier: with p(e) the part of texts that hold identifier e, and PMI(t, e)
the pointwise mutual information of term and identifier over texts, a term whose PMI
reaches ``DISCLOSURE`` of the information -log p(e) is generalised too. PMI / -log p(e)
is 1 for a term that never occurs without e and 0 for one that is independent of it.
The kinds of identifiers are treated as identifiers are, so that identifiers of one text
count as well: a term may disclose that its text holds an e-mail address.

What is seen together by chance doesn't count: if term and identifier were independent,
n texts with the term had k or more with the identifier with probability exp(-n KL) at
most, KL being the divergence of k/n from p(e) (Chernoff's bound, which holds for draws
without return). Times the number of pairs that are tested it must be ``CHANCE`` or less.
So how many texts are needed follows from the corpus; a pair in one text is never tested,
as all words of that text would be alike.

All is DataFrame functions. Positions are code points, ends are exclusive.
"""

from __future__ import annotations

import math
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crowdtide.llm.common import bitmap, maybe_in, plain_text, stored, table

KINDS = ("email", "ip", "card", "phone")
# The contract's patterns. Groups repeat possessively, so that a long match needs no
# stack, and a run that fails from its first character isn't tried from each later one;
# both leave the matches as they are.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Cheap conditions that every match of a kind that can pass implies.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
WORDS = r"\p{L}{3,}+"
DISCLOSURE = 0.9
CHANCE = 0.001  # probability that any pair of independent term and identifier is taken
SUPPORT = 2
SPANS = "array<struct<start:int,end:int>>"


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the check sum: from the right, every second is doubled."""
    places = F.sequence(F.lit(1), F.length(number))
    reverse = F.reverse(number)

    def add(total, i):
        d = F.substring(reverse, i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, doubled).otherwise(d)

    return F.aggregate(places, F.lit(0), add) % 10 == 0


def passes(kind: str, hit: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        # long parts are over 255 unless they begin with zeros
        parts = F.transform(F.split(hit, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(F.try_to_number(p, F.lit("999")), F.lit(0)) <= 255))
    n = F.length(digits(hit))
    if kind == "phone":
        return (n >= 9) & (n <= 15)
    return F.when((n >= 13) & (n <= 19), luhn(digits(hit))).otherwise(False)


def positions(hits: Column, gaps: Column, keep) -> Column:
    """Spans of the hits that ``keep`` says, from the hits and the texts between them."""
    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda g, h: F.struct(F.length(g).alias("gap"), h.alias("hit")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

    def step(acc, x):
        begin = acc["at"] + x["gap"]
        end = begin + F.length(x["hit"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(keep(x["hit"]), F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(pairs, start, step, lambda acc: acc["spans"])


def with_identifiers(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``__email, __ip, __card, __phone``: spans in the whole text, in order."""
    text = F.col(text_col)
    for kind in KINDS:
        hint = text.contains("@") if kind == "email" else text.rlike(HINTS[kind])
        pattern = F.lit(PATTERNS[kind])
        df = df.withColumn("__hits", F.when(hint, F.regexp_extract_all(text, pattern, 0)).otherwise(F.array().cast("array<string>")))
        df = df.withColumn("__gaps", F.when(F.size("__hits") > 0, F.split(text, pattern, -1)).otherwise(F.array().cast("array<string>")))
        df = df.withColumn(f"__{kind}", positions(F.col("__hits"), F.col("__gaps"), partial(passes, kind)))
    return df.drop("__hits", "__gaps")


def identifiers(text: Column) -> Column:
    """The distinct identifiers in a text, as kind and value in one string."""

    def values(kind):
        def value(s):
            v = F.substring(text, s["start"] + 1, s["end"] - s["start"])
            return F.concat(F.lit(f"{kind}:"), F.lower(v) if kind in ("email", "ip") else digits(v))

        return F.transform(F.col(f"__{kind}"), value)

    return F.array_distinct(F.concat(*map(values, KINDS)))


def entities(text: Column) -> Column:
    """The distinct identifiers in a text, and their kinds."""
    kinds = F.filter(F.array(*[F.when(F.size(f"__{kind}") > 0, F.lit(kind)) for kind in KINDS]), lambda k: k.isNotNull())
    return F.concat(identifiers(text), kinds)


def terms(text: Column) -> Column:
    # a word's lower case may have more code points: words are those of the text as it is
    return F.transform(F.regexp_extract_all(text, F.lit(WORDS), 0), F.lower)


def disclosing(docs: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """``entity, term`` pairs of ``docs`` (``text`` and the spans of ``with_identifiers``).

    Texts that are equal count once. Entities are identifiers and kinds. Only those in
    ``support`` texts can have pairs: the words of those texts are paired with them, pairs
    with support are tested. The texts that
    hold their terms are counted among texts with identifiers, which bounds PMI from above,
    and for the pairs that are left over the whole corpus. A bitmap of fixed size keeps
    words that are surely in no pair out of that count, the rest are counted exactly.
    """
    held = docs.filter(F.size(identifiers(F.col("text"))) > 0).select(
        F.xxhash64("text").alias("key"), "text", entities(F.col("text")).alias("entities"))
    # an identifier in very many texts is spread over tasks by its texts, never by itself
    mentions = stored(held.select("key", "text", F.explode("entities").alias("entity")), "mentions")
    n_entity = mentions.groupBy("entity", "key").agg(F.lit(1)).groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")) \
        .filter(F.col("n_entity") >= support)
    shared = mentions.join(n_entity, "entity", "left_semi")
    pairs = shared.select("entity", "key", F.explode(F.array_distinct(terms(F.col("text")))).alias("term")).groupBy("entity", "key", "term").agg(F.lit(1)) \
        .groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_pair")).filter(F.col("n_pair") >= support)
    n = max(1, docs.groupBy(F.xxhash64("text").alias("key")).agg(F.lit(1)).count())
    information = F.log(F.lit(float(n)) / F.col("n_entity"))
    pmi = F.log(F.col("n_pair") * F.lit(float(n)) / (F.col("n_term") * F.col("n_entity")))
    enough = (information > 0) & (pmi >= disclosure * information)
    part, chance = F.col("n_pair") / F.col("n_term"), F.col("n_entity") / F.lit(float(n))
    divergence = part * F.log(part / chance) + F.when(part < 1, (1 - part) * F.log((1 - part) / F.greatest(1 - chance, F.lit(1e-12)))).otherwise(0.0)

    def spread(texts, some=None):
        """In how many different texts the terms are, at least those of ``some``."""
        found = terms(F.col("text"))
        if some is not None:
            found = F.filter(found, partial(maybe_in, bitmap(some.select(F.col("term").alias("key")))))
        used = texts.select(F.xxhash64("text").alias("key"), F.explode(F.array_distinct(found)).alias("term"))
        return used.groupBy("term", "key").agg(F.lit(1)).groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))

    # a term is in no fewer texts than in those with identifiers: common words go here
    pairs = stored(pairs.join(n_entity, "entity"), "pairs")
    tested = max(1, pairs.count())
    pairs = stored(pairs.join(spread(held), "term").filter(enough).drop("n_term"), "pairs")
    no_chance = F.col("n_term") * divergence >= F.lit(math.log(tested / CHANCE))
    return pairs.join(spread(docs, pairs), "term").filter(enough & no_chance).select("entity", "term")


def detect(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """``doc_id, text, __email, __ip, __card, __phone, __term``: spans for each row of ``df``.

    A null text is empty and has no spans. Term spans are words of at least three letters
    that disclose an identifier of the same text and don't overlap one. Rows with equal
    texts get equal spans; a null id is kept. An empty table gives no rows.
    """
    docs = with_identifiers(df.select(F.col(id_col).cast("long").alias("doc_id"), plain_text(F.col(text_col)).alias("text")))
    docs = docs.withColumn("__key", F.monotonically_increasing_id())
    docs = stored(docs, "identified")
    pairs = stored(disclosing(docs, disclosure, support), "disclosing")
    entity = docs.filter(F.size(identifiers(F.col("text"))) > 0).select("__key", F.explode(entities(F.col("text"))).alias("entity"))
    told = entity.join(pairs, "entity").groupBy("__key").agg(F.collect_set("term").alias("__told"))
    told = stored(told.withColumnRenamed("__key", "__k"), "told")
    # texts that surely have no such term aren't shuffled
    touched = maybe_in(bitmap(told.select(F.col("__k").alias("key"))), F.col("__key"))
    rest = docs.filter(~touched).withColumns({"__k": F.lit(None).cast("long"), "__told": F.array().cast("array<string>")})
    docs = docs.filter(touched).join(told, docs["__key"] == told["__k"], "left").unionByName(rest)
    none = F.array().cast("array<string>")
    docs = docs.withColumn("__hits", F.when(F.size("__told") > 0, F.regexp_extract_all("text", F.lit(WORDS), 0)).otherwise(none))
    docs = docs.withColumn("__gaps", F.when(F.size("__hits") > 0, F.split("text", WORDS, -1)).otherwise(none))
    docs = docs.withColumn("__all", positions(F.col("__hits"), F.col("__gaps"), lambda h: F.array_contains("__told", F.lower(h))))
    base = F.concat(*[F.col(f"__{k}") for k in KINDS])
    free = F.filter("__all", lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return docs.withColumn("__term", free).drop("__hits", "__gaps", "__all", "__told", "__key", "__k")


def listed(kinds) -> Column:
    """``kind:start:end`` of the spans, kinds in the order given, comma-joined."""

    def shown(kind):
        return F.transform(f"__{kind}", lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))

    return F.array_join(F.concat(*map(shown, kinds)), ",")


def sanitised(text: Column) -> Column:
    """The text with identifiers and disclosing terms generalised to their kind."""

    def named(kind):
        return F.transform(f"__{kind}", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(f"[{kind.upper()}]").alias("kind")))

    spans = F.array_sort(F.concat(*map(named, (*KINDS, "term"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        # where spans overlap, the first one's name stands for both
        gap = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        name = F.when(s["start"] < acc["at"], F.lit("")).otherwise(s["kind"])
        return F.struct(F.greatest(s["end"], acc["at"]).alias("at"), F.concat(acc["out"], gap, name).alias("out"))

    return F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def sanitise(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``doc_id, text``: each row's text, sanitised."""
    return detect(df, id_col, text_col, **how).select("doc_id", sanitised(F.col("text")).alias("text"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect(table(spark, sf_dir, "documents"))
    counts = [F.size(f"__{kind}").cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(KINDS).cast("binary"), 256).alias("base_sha256"), listed((*KINDS, "term")).alias("spans"))

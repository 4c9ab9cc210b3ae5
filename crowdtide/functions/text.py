"""Text columns: fallback, normalisation, tokens, lexicon polarity."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import product

from pyspark.sql import Column, functions as F

from crowdtide.fixed_values import NEGATIVE_WORDS, POSITIVE_WORDS, WHITESPACE

# Letters, numbers and the underscore, in any script: Python's \w. Java's own \w
# is ASCII, is tried first and settles most characters.
WORD_CHARS = r"\w\p{L}\p{N}"
# The same set as WHITESPACE, as the inside of a character class. The separator
# category measured twice as fast as its characters listed.
SPACE_CHARS = r"\s\x1c-\x1f\x85\p{Z}"


def first_filled(*columns: Column) -> Column:
    """The first column that is neither NULL nor empty; blanks count as filled."""
    empty = F.lit("")
    return F.coalesce(*[F.nullif(c, empty) for c in columns], empty)


def strip(text: Column) -> Column:
    """Cut white space, in the Unicode sense, from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def collapse_whitespace(text: Column) -> Column:
    """Single blanks between words, none at the ends."""
    return F.trim(F.regexp_replace(text, rf"[{SPACE_CHARS}]++", " "))


def has_text(text: Column) -> Column:
    """Whether any character is not white space; stops at the first that is not."""
    return text.rlike(rf"[^{SPACE_CHARS}]")


def nfc(text: Column) -> Column:
    """Unicode NFC, which Spark has no built-in for.

    A text without any character from U+0300 up is in NFC already and stays in
    the JVM: the Arrow function sees NULL for it.
    """
    needs = text.rlike(r"[\x{0300}-\x{10ffff}]")
    return F.coalesce(_nfc_arrow()(F.when(needs, text)), text)


def _nfc_arrow() -> Callable[[Column], Column]:
    @F.arrow_udf("string")
    def normalize(texts):
        import unicodedata

        import pyarrow as pa

        # Arrow's own normalisation leaves decomposed accents as they are
        return pa.array(
            [t if t is None else unicodedata.normalize("NFC", t) for t in texts.to_pylist()],
            pa.string(),
        )

    return normalize


def normalize_text(text: Column, repair: Callable[[Column], Column] | None = None) -> Column:
    """NULL to empty, optional mojibake repair, NFC, white space collapsed."""
    text = F.coalesce(text, F.lit(""))
    if repair is not None:
        text = repair(text)
    return collapse_whitespace(nfc(text))


def content_hash(text: Column) -> Column:
    return F.sha1(text.cast("binary"))


def single_line(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(" "))


def words(text: Column) -> Column:
    """Runs of word characters, as written."""
    return F.regexp_extract_all(text, F.lit(rf"[{WORD_CHARS}]++"), F.lit(0))


def terms(text: Column) -> Column:
    """Lower-cased runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(rf"[{WORD_CHARS}]{{2,}}+"), F.lit(0))


def _spellings(lexicon: Sequence[str]) -> list[str]:
    """Every lower-case token that equals a lexicon word when case is ignored.

    Ignoring case also equates the long s, the dotless i and the dotted capital
    I (which lower-cases to two characters), so those spellings are listed.
    """
    for word in lexicon:
        if not word or not all(ch.isalnum() or ch == "_" for ch in word):
            raise ValueError(f"lexicon entries have to be single words: {word!r}")
    same = {"s": ["s", "ſ"], "i": ["i", "ı", "i̇"]}
    return sorted(
        {"".join(p) for w in lexicon for p in product(*(same.get(ch, [ch]) for ch in w.lower()))}
    )


def lexicon_hits(tokens: Column, lexicon: Sequence[str]) -> Column:
    """Words of a text that one lexicon lists, case ignored."""
    listed = _spellings(lexicon)
    return F.size(F.filter(tokens, lambda token: F.lower(token).isin(listed)))


def score_words(
    tokens: Column,
    positive: Sequence[str] = POSITIVE_WORDS,
    negative: Sequence[str] = NEGATIVE_WORDS,
) -> Column:
    """Positive less negative words, over the root of the number of words."""
    good, bad = _spellings(positive), _spellings(negative)

    def read(state, token):
        word = F.lower(token)
        balance = state["balance"] + word.isin(good).cast("int") - word.isin(bad).cast("int")
        return F.struct((state["words"] + 1).alias("words"), balance.alias("balance"))

    def finish(state):
        return state["balance"] / F.sqrt(F.greatest(state["words"], F.lit(1)).cast("double"))

    none = F.struct(F.lit(0).alias("words"), F.lit(0).alias("balance"))
    return F.aggregate(tokens, none, read, finish)


def lexical_score(
    text: Column,
    positive: Sequence[str] = POSITIVE_WORDS,
    negative: Sequence[str] = NEGATIVE_WORDS,
) -> Column:
    """Polarity of a text, in one pass over its words; 0 for missing or blank text."""
    return score_words(words(F.coalesce(text, F.lit(""))), positive, negative)

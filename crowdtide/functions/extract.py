"""Facts read out of post text, labels and links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crowdtide.fixed_values import (
    HANDLE,
    HANDLE_LINES,
    LABEL_NUMBER,
    LABEL_WORD,
    LABEL_KINDS,
    PERMALINK_BASE,
    RESERVED_HANDLES,
    TEXT_KINDS,
)
from crowdtide.functions.text import SPACE_CHARS, WORD_CHARS, strip


def sorted_set(values: Column) -> Column:
    """Distinct values of an array, in order."""
    return F.array_sort(F.array_distinct(values))


def mention_list(text: Column) -> Column:
    return sorted_set(F.regexp_extract_all(text, F.lit(f"@({HANDLE})"), F.lit(1)))


def hashtag_list(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(rf"#([{WORD_CHARS}]+)"), F.lit(1))
    return sorted_set(F.transform(found, F.lower))


def joined(values: Column) -> Column:
    return F.array_join(values, ",")


def absolute_url(url: Column, base: str = PERMALINK_BASE) -> Column:
    return F.when(url.startswith("/"), F.concat(F.lit(base), url)).otherwise(url)


def pseudo_key(url: Column, text: Column, chars: int | None = None) -> Column:
    """The permalink where there is one, else a hash of the text, or of its first ``chars``."""
    opening = text if chars is None else F.substring(text, 1, chars)
    return F.coalesce(F.nullif(url, F.lit("")), F.sha1(opening.cast("binary")))


def _digits(number: Column) -> Column:
    """``1,234.5`` to 1234; NULL where no digits stand before the point."""
    whole = F.substring_index(F.replace(number, F.lit(","), F.lit("")), ".", 1)
    # a failing cast costs an exception, so it is not tried on what has no digits
    return F.when(whole.rlike("^[0-9]+$"), whole.try_cast("bigint"))


def label_values(labels: Column) -> Column:
    """Engagement counts of labels, as a struct with a field per kind.

    A label counts for the first kind its word contains, and a later label of
    the same kind replaces an earlier one.
    """
    pattern = f"({LABEL_NUMBER})[{SPACE_CHARS}]+({LABEL_WORD})"
    read = F.transform(
        labels,
        lambda label: F.struct(
            F.lower(F.regexp_extract(label, pattern, 2)).alias("word"),
            _digits(F.regexp_extract(label, pattern, 1)).alias("value"),
        ),
    )
    usable = F.filter(read, lambda x: x["value"].isNotNull())

    def take(counts, label):
        fields, earlier = [], F.lit(False)
        for kind in LABEL_KINDS:
            named = label["word"].contains(kind)
            value = F.when(named & ~earlier, label["value"]).otherwise(counts[kind])
            fields.append(value.alias(kind))
            earlier = earlier | named
        return F.struct(*fields)

    none = F.struct(*[F.lit(None).cast("bigint").alias(kind) for kind in LABEL_KINDS])
    return F.coalesce(F.aggregate(usable, none, take), none)


def with_label_counts(
    df: DataFrame, labels: Column, text: Column, names: dict[str, str]
) -> DataFrame:
    """Add a count column per kind, named by ``names``.

    Kinds no label gave are looked up in the text as ``N <plural>``, first hit
    only. The labels are read once, into a column of their own.
    """
    out = df.withColumn("_label_values", label_values(labels))
    counts = {}
    for kind, name in names.items():
        in_text = F.regexp_extract(text, rf"(?i)([0-9,]+)[{SPACE_CHARS}]+{TEXT_KINDS[kind]}", 1)
        counts[name] = F.coalesce(F.col("_label_values")[kind], _digits(in_text))
    return out.withColumns(counts).drop("_label_values")


def author_handle(text: Column, hrefs: Column) -> Column:
    """The first profile link's handle, else the first ``@name`` in the opening lines."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85\u2028\u2029]"), strip)
    opening = F.slice(F.filter(lines, lambda line: line != ""), 1, HANDLE_LINES)
    named = F.transform(opening, lambda line: F.regexp_extract(line, f"@({HANDLE})", 1))
    from_text = F.get(F.filter(named, lambda name: name != ""), F.lit(0))

    paths = F.filter(
        F.coalesce(hrefs, F.array().cast("array<string>")),
        lambda h: h.startswith("/") & ~h.startswith("/i/"),
    )
    segments = F.transform(paths, lambda h: F.get(F.split(h, "/"), F.lit(1)))
    profiles = F.filter(
        segments,
        lambda s: s.rlike(f"^{HANDLE}$") & ~F.lower(s).isin(RESERVED_HANDLES),
    )
    return F.coalesce(F.get(profiles, F.lit(0)), from_text)


def first_text(*candidates: Column) -> Column:
    """The first candidate that is not blank."""
    return F.coalesce(*[F.nullif(strip(c), F.lit("")) for c in candidates], F.lit(""))

"""Web pages to post records, by pattern."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from crowdtide.fixed_values import BODY_MARK, COUNT_COLUMNS, COUNT_OF_KIND, PERMALINK_BASE, PERMALINK_MARK
from crowdtide.functions import extract
from crowdtide.functions.text import single_line, strip
from crowdtide.functions.times import post_iso, time_or_now

ARTICLE_TAG, OPEN_ARTICLE, CLOSE_ARTICLE = r"(?i)(?=</?article\b)", r"(?i)^<article\b", r"(?i)^</article\b"
QUOTED = r"""["']((?<=")[^"]*|(?<=')[^']*)"""
HREF = rf"(?is)<a\b[^>]*?\bhref={QUOTED}"
ARIA_LABEL = rf"(?is)\baria-label={QUOTED}"
TIME = rf"(?is)<time\b[^>]*\bdatetime={QUOTED}"
# an article without any of these has no block or group to look for
MARKED = rf"""(?is)<div\b[^>]*(?:\brole=["']group["']|\bdata-testid=["']{BODY_MARK}["']|\blang=)"""
GROUP = r"""(?is)^<div\b[^>]*\brole=["']group["']"""
BODY = rf"""(?is)^<div\b[^>]*\bdata-testid=["']{BODY_MARK}["']"""
LANGUAGE_BLOCK = r"(?is)^<div\b[^>]*\blang="
TOKEN = r"(?s)<[^>]*>|[^<]+|<"
OPEN_BLOCK, CLOSE_BLOCK = r"(?i)^<div\b(?![^>]*/>$)", r"(?i)^</div\b"
UNSHOWN = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
LINE_END = r"(?i)(?:<br\b[^>]*>|</?(?:p|h[1-6]|div|li|article)\b[^>]*>)+"
TAG = r"<[^>]*>"
NUMBERED = r"&#([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"
# The escapes that are undone, the ampersand last.
ESCAPES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&",
}


def character(code: Column) -> Column:
    """The character of a numeric escape's number (decimal, or hexadecimal after x)."""
    hexed = F.when(code.rlike("^[xX]"), F.substring(code, 2, 6)).otherwise(F.hex(code.try_cast("bigint")))
    number = F.conv(hexed, 16, 10).cast("bigint")
    valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(hexed, 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))


def visible_text(html: Column) -> Column:
    """Text of a fragment: block starts and ends break lines, tags go, escapes are undone."""
    return shown_text(F.regexp_replace(html, UNSHOWN, ""))


def shown_text(html: Column) -> Column:
    """The same of a fragment without scripts, styles and comments."""
    text = F.regexp_replace(html, LINE_END, "\n")
    text = F.regexp_replace(text, TAG, "")
    codes = F.array_distinct(F.regexp_extract_all(text, F.lit(NUMBERED), F.lit(1)))
    text = F.aggregate(codes, text, lambda t, c: F.replace(t, F.concat(F.lit("&#"), c, F.lit(";")), character(c)))
    for escape, char in ESCAPES.items():
        text = F.replace(text, F.lit(escape), F.lit(char))
    return strip(text)


def _depth(depth: Column, token: Column) -> Column:
    """How many blocks are open after a token, inside one."""
    return depth + F.when(token.rlike(OPEN_BLOCK), 1).when(token.rlike(CLOSE_BLOCK), -1).otherwise(0)


def first_block(tokens: Column, opening: str) -> Column:
    """Markup of the first block that ``opening`` starts, to its own close; else empty."""
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("depth"), F.lit(0).alias("from"), F.lit(0).alias("to"))

    def step(acc, token):
        i, inside = acc["i"] + 1, (acc["from"] > 0) & (acc["to"] == 0)
        begins = (acc["from"] == 0) & token.rlike(opening)
        depth = F.when(begins, 1).when(inside, _depth(acc["depth"], token)).otherwise(acc["depth"])
        return F.struct(
            i.alias("i"), depth.alias("depth"), F.when(begins, i).otherwise(acc["from"]).alias("from"),
            F.when(inside & (depth == 0), i).otherwise(acc["to"]).alias("to"))

    def cut(acc):
        # a block that is never closed goes to the end
        last = F.when(acc["to"] > 0, acc["to"]).otherwise(acc["i"] + 1)
        return F.when(acc["from"] > 0, F.array_join(F.slice(tokens, acc["from"] + 1, last - acc["from"] - 1), "")).otherwise("")

    return F.aggregate(tokens, start, step, cut)


def group_labels(tokens: Column) -> Column:
    """The labels of all elements inside the groups of a fragment, in order."""
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("labels"))

    def step(acc, token):
        inside = acc["depth"] > 0
        depth = F.when(inside, _depth(acc["depth"], token)).when(token.rlike(GROUP), 1).otherwise(0)
        labels = F.when(inside & token.startswith("<"), F.concat(acc["labels"], all_groups(token, ARIA_LABEL))).otherwise(acc["labels"])
        return F.struct(depth.alias("depth"), labels.alias("labels"))

    return F.aggregate(tokens, start, step, lambda acc: acc["labels"])


def article_pieces(html: Column) -> Column:
    """A page without scripts, styles and comments, cut before each article tag."""
    return F.split(F.regexp_replace(html, UNSHOWN, ""), ARTICLE_TAG)


def article_ranges(pieces: Column) -> Column:
    """``from, to`` of every article among the pieces, inner ones too, in the order they begin.

    A closing tag closes the article opened last and no other; one without an open article
    counts for nothing, and an article that is never closed goes to the end of the page.
    """
    start = F.struct(
        F.lit(0).alias("i"), F.array().cast("array<int>").alias("open"),
        F.array().cast("array<struct<from:int,to:int>>").alias("found"))

    def ended(first, last):
        return F.struct(first.alias("from"), last.alias("to"))

    def step(acc, piece):
        i, stack = acc["i"] + 1, acc["open"]
        closes = piece.rlike(CLOSE_ARTICLE) & (F.size(stack) > 0)
        return F.struct(
            i.alias("i"),
            F.when(piece.rlike(OPEN_ARTICLE), F.concat(F.array(i), stack))
            .when(closes, F.slice(stack, 2, F.greatest(F.size(stack), F.lit(1)))).otherwise(stack).alias("open"),
            F.when(closes, F.concat(acc["found"], F.array(ended(F.get(stack, F.lit(0)), i)))).otherwise(acc["found"]).alias("found"))

    def finish(acc):
        return F.array_sort(F.concat(acc["found"], F.transform(acc["open"], lambda first: ended(first, acc["i"] + 1))))

    return F.aggregate(pieces, start, step, finish)


def article_markup(pieces: Column, ranges: Column) -> Column:
    """What stands inside each article, tags of inner articles included."""
    def inside(r):
        return F.regexp_replace(F.array_join(F.slice(pieces, r["from"], r["to"] - r["from"]), ""), r"(?s)^<[^>]*>", "")

    return F.transform(ranges, inside)


def all_groups(html: Column, pattern: str) -> Column:
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(1))


def page_records(
    pages: DataFrame,
    html: str = "html",
    source_hashtag: Column | None = None,
    links_of_page: bool = False,
    base: str = PERMALINK_BASE,
    now: datetime | Column | None = None,
) -> DataFrame:
    """One record per article with text, in the raw post columns, by page.

    An article inside another is a record of its own, and part of the outer one as well:
    its text, links and labels count for both. ``article_no`` numbers the articles of a
    page from 0 in the order they begin. ``links_of_page`` looks for the author among all links of the page and not
    only the article's. Other columns of ``pages`` are kept in front.
    """
    kept = [c for c in pages.columns if c != html]
    page_links = all_groups(F.col(html), HREF)
    # the pieces are cut once; the fold sees one for each article tag, not the tokens of the page
    cut = pages.select(
        *kept,
        *([page_links.alias("_page_links")] if links_of_page else []),
        article_pieces(F.col(html)).alias("_pieces"),
    ).withColumn("_ranges", article_ranges(F.col("_pieces")))
    markup = article_markup(F.col("_pieces"), F.col("_ranges"))
    # the text is made before the rows are: a filter on it would else make it twice
    both = F.transform(markup, lambda m: F.struct(m.alias("markup"), shown_text(m).alias("text")))
    articles = cut.select(
        *[c for c in cut.columns if c not in ("_pieces", "_ranges")],
        F.posexplode(both).alias("article_no", "_both"),
    ).filter(F.col("_both.text") != "")
    articles = articles.withColumn("_article", F.col("_both.markup")).withColumn("_text", F.col("_both.text")).drop("_both")
    article = F.col("_article")
    hrefs = F.col("_page_links") if links_of_page else F.col("_links")
    tokens = F.when(article.rlike(MARKED), F.regexp_extract_all(article, F.lit(TOKEN), F.lit(0)))
    found = (
        articles.withColumn("_links", all_groups(article, HREF))
        .withColumn("_tokens", F.coalesce(tokens, F.array().cast("array<string>")))
        .withColumn("_labels", group_labels(F.col("_tokens")))
        .withColumn(
            "_url",
            extract.absolute_url(
                F.get(F.filter("_links", lambda h: h.contains(PERMALINK_MARK)), F.lit(0)), base
            ),
        )
    )
    text = F.col("_text")
    content = extract.first_text(
        shown_text(F.nullif(first_block(F.col("_tokens"), BODY), F.lit(""))),
        shown_text(F.nullif(first_block(F.col("_tokens"), LANGUAGE_BLOCK), F.lit(""))),
        text,
    )
    posted = F.nullif(F.regexp_extract(article, TIME, 1), F.lit(""))
    tag = source_hashtag if source_hashtag is not None else F.lit("")
    body = F.col("_content")
    counted = extract.with_label_counts(
        found.withColumn("_content", content), F.col("_labels"), text, COUNT_OF_KIND
    )
    return counted.select(
        *kept,
        "article_no",
        extract.pseudo_key(F.col("_url"), text).alias("id"),
        F.coalesce(extract.author_handle(text, hrefs), F.lit("")).alias("username"),
        F.coalesce(posted, post_iso(time_or_now(F.lit(None), now))).alias("date"),
        single_line(body).alias("content"),
        *COUNT_COLUMNS,
        extract.joined(extract.mention_list(body)).alias("mentions"),
        extract.joined(extract.hashtag_list(body)).alias("hashtags"),
        F.coalesce("_url", F.lit("")).alias("url"),
        tag.alias("source_hashtag"),
    )

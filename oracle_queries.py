"""DuckDB SQL for the registered queries, written against the same tables."""

from __future__ import annotations

import math

import numpy as np

from crowdtide.fixed_values import KEYWORDS

WORD = r"[\w\p{L}\p{N}]"
SPACE = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# the white space characters themselves, for trim()
BLANKS = "||".join(
    f"chr({c})"
    for c in (
        *range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288,
    )
)


def strip(text: str) -> str:
    return f"trim({text}, {BLANKS})"


def iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%SZ')"


def r6(expr: str, name: str) -> str:
    return f"round(({expr})::DOUBLE, 6) + 0.0::DOUBLE AS {name}"


def t_table(size: int = 200) -> list[float]:
    """Points that a Student t variable of 1, 2, ... degrees exceeds, on both sides, in 5 of
    100 cases: the density over the angle atan(t / sqrt(df)), integrated by Gauss-Legendre
    points, which are exact here to the last digits of a double."""
    at, weight = np.polynomial.legendre.leggauss(80)
    out, angle = [], math.pi / 2 - 0.05
    for df in range(1, size + 1):
        goal = 0.95 * math.exp(math.lgamma(df / 2) - math.lgamma((df + 1) / 2)) * math.sqrt(math.pi) / 2
        for _ in range(40):
            area = angle / 2 * float(weight @ np.cos(angle / 2 * (at + 1)) ** (df - 1))
            step = (area - goal) / math.cos(angle) ** (df - 1)
            angle = min(max(angle - step, angle / 2), math.pi / 2 - 1e-6)
            if abs(step) < 1e-15:
                break
        out.append(math.sqrt(df) * math.tan(angle))
    return out


def t_value(df: str) -> str:
    table = "[" + ", ".join(f"{q!r}::DOUBLE" for q in T_TABLE) + "]"
    z, v = 1.959963984540054, f"({df})::DOUBLE"
    series = f"""{z}::DOUBLE + {(z**3 + z) / 4}::DOUBLE / {v} + {(5 * z**5 + 16 * z**3 + 3 * z) / 96}::DOUBLE / {v} ** 2
        + {(3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384}::DOUBLE / {v} ** 3"""
    return f"CASE WHEN {df} <= {len(T_TABLE)} THEN ({table})[({df})::BIGINT] ELSE {series} END"


T_TABLE = t_table()


def half_width(n: str = "n", sem: str = "sem") -> str:
    return f"CASE WHEN {n} > 1 THEN ({t_value(f'{n} - 1')}) * {sem} ELSE 0.0::DOUBLE END"


MEASURES = """count(*) AS n, count(v) AS cnt, avg(v) AS mean_signal,
    coalesce(stddev_samp(v) / sqrt(count(*)), 0.0::DOUBLE) AS sem,
    avg(CASE WHEN v > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS pp,
    avg(CASE WHEN v < 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS pn"""

ACTION = """CASE WHEN pp >= 0.6::DOUBLE AND pp > pn THEN 'SHORT'
    WHEN pn >= 0.6::DOUBLE AND pn > pp THEN 'LONG' ELSE 'HOLD' END"""


def signals(scored: str, micros: int, min_posts: int = 3, origin: str = "0", fill: bool = False) -> str:
    """CTEs ending in ``s``: signal windows of ``scored`` (columns ts, v)."""
    source = "w"
    gaps = ""
    if fill:
        source = "g"
        gaps = f""",
    ends AS (SELECT epoch_us(min(ws)) a, epoch_us(max(ws)) b FROM w),
    g AS (SELECT e.ws, coalesce(n, 0) n, coalesce(cnt, 0) cnt, coalesce(mean_signal, 0) mean_signal,
          coalesce(sem, 0) sem, coalesce(pp, 0) pp, coalesce(pn, 0) pn
          FROM (SELECT make_timestamp(unnest(range(a, b + 1, {micros}))) ws FROM ends) e
          LEFT JOIN w ON w.ws = e.ws)"""
    return f"""{scored},
    w AS (SELECT make_timestamp(epoch_us(ts) - (epoch_us(ts) - {origin}) % {micros}) AS ws, {MEASURES}
          FROM scored GROUP BY 1){gaps},
    s AS (SELECT *, {half_width()} AS ci, {ACTION} AS action FROM {source} WHERE cnt >= {min_posts})"""


SIGNAL_COLUMNS = f"""n, cnt AS "count", {r6('mean_signal', 'mean_signal')}, {r6('sem', 'sem')},
    {r6('ci', 'ci95_half')}, {r6('pp', 'proportion_positive')}, {r6('pn', 'proportion_negative')},
    action AS trade_action, {iso('ws')} AS window_start_iso"""

EVENT_SCORES = """WITH m AS (SELECT avg(value) mu, stddev_pop(value) sd FROM events),
    scored AS (SELECT ts, (value - mu) / CASE WHEN sd = 0 THEN 1 ELSE sd END AS v FROM events, m)"""
FIVE_MIN, HOUR = 300_000_000, 3_600_000_000


def balance(text: str) -> tuple[str, str, str]:
    words = f"regexp_extract_all({text}, '{WORD}+')"
    good = f"len(list_filter({words}, lambda x: lower(x) IN ('the', 'and', 'to')))"
    bad = f"len(list_filter({words}, lambda x: lower(x) IN ('der', 'die', 'la')))"
    return f"len({words})", good, bad


COUNT, GOOD, BAD = balance("content")
CENTROIDS = """side AS (SELECT label, pos, avg(val::DOUBLE) AS m FROM (
        SELECT label, unnest(embedding) AS val, generate_subscripts(embedding, 1) AS pos
        FROM embeddings WHERE label IN (0, 1)) GROUP BY 1, 2),
    seeds AS (SELECT list(m ORDER BY pos) FILTER (label = 0) AS p,
        list(m ORDER BY pos) FILTER (label = 1) AS q FROM side)"""


def cosine(a: str, b: str) -> str:
    return f"""CASE WHEN list_dot_product({a}, {a}) = 0 OR list_dot_product({b}, {b}) = 0 THEN 0.0::DOUBLE
        ELSE list_dot_product({a}, {b}) / (sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b}))) END"""


FLAGSHIP = f"""WITH {CENTROIDS},
    f AS (SELECT vec_id, ts, {cosine('embedding::DOUBLE[]', 'p')} - {cosine('embedding::DOUBLE[]', 'q')} AS emb
          FROM embeddings LEFT JOIN events ON event_id = vec_id, seeds),
    t AS (SELECT doc_id, {strip('text')} AS content FROM documents),
    raw AS (SELECT coalesce(ts, TIMESTAMP '2024-06-01') AS ts, emb,
          coalesce(({GOOD} - {BAD}) / sqrt(greatest({COUNT}, 1)::DOUBLE), 0.0::DOUBLE) AS lex
          FROM f LEFT JOIN t ON doc_id = vec_id),
    m AS (SELECT avg(emb) em, stddev_pop(emb) es, avg(lex) lm, stddev_pop(lex) ls FROM raw),
    scored AS (SELECT ts, 0.7::DOUBLE * (emb - em) / CASE WHEN es = 0 THEN 1 ELSE es END
          + 0.3::DOUBLE * (lex - lm) / CASE WHEN ls = 0 THEN 1 ELSE ls END AS v FROM raw, m)"""

# ---- posts ----
CLEAN = f"trim(regexp_replace(nfc_normalize(text), '{SPACE}+', ' ', 'g'), ' ')"
CANDIDATES = f"""cand AS (SELECT doc_id, source, lang, n_chars, {CLEAN} AS content,
    sha1({CLEAN}) AS h FROM documents WHERE {CLEAN} <> '')"""
SEEN = "seen AS (SELECT DISTINCT h FROM cand WHERE doc_id IN (SELECT doc_id FROM labels))"
SURVIVOR = """SELECT doc_id::VARCHAR AS id, source AS username, h AS content_hash,
    '2024-06-01' AS event_date"""

DAMAGED = """WITH d AS (SELECT doc_id::VARCHAR AS id, text, sha1(coalesce(text, '')) AS x, doc_id % 11 AS k FROM documents),
    aside AS (SELECT 'bad' AS kind, '' AS id, CASE k WHEN 1 THEN '{"content": "' || x WHEN 2 THEN '[{"id": "' || x || '"}]'
            ELSE '"' || x || '"' END AS value FROM d WHERE k IN (1, 2, 3)
        UNION ALL SELECT 'counter', 'lines_read', count(*)::VARCHAR FROM d
        UNION ALL SELECT 'counter', 'blank_lines', count(*)::VARCHAR FROM d WHERE k = 4
        UNION ALL SELECT 'counter', 'malformed_lines', count(*)::VARCHAR FROM d WHERE k IN (1, 2, 3))"""

# ---- times ----
# the spellings have whole seconds, .25 seconds or whole milliseconds
SPELLED = """SELECT event_id, CASE event_type WHEN 'click' THEN date_trunc('second', ts)
    WHEN 'view' THEN date_trunc('second', ts) - INTERVAL 330 MINUTE
    WHEN 'signup' THEN date_trunc('second', ts) + INTERVAL 250 MILLISECOND
    WHEN 'purchase' THEN date_trunc('millisecond', ts) END AS t FROM events"""


# ---- terms ----
def tfidf(scope: str, docs: str = "documents") -> str:
    key = f"{scope}, " if scope else ""
    same = f"{scope}, term" if scope else "term"
    sizes = f"SELECT {scope}, count(*) AS nd FROM d GROUP BY 1" if scope else "SELECT count(*) AS nd FROM d"
    with_size = f"JOIN sizes USING ({scope})" if scope else "CROSS JOIN sizes"
    return f"""WITH d AS (SELECT * FROM {docs}),
    tf AS (SELECT {key}doc_id, term, count(*) AS tf FROM (
        SELECT {key}doc_id, unnest(regexp_extract_all(lower(text), '{WORD}{{2,}}')) AS term FROM d)
        GROUP BY ALL),
    sizes AS ({sizes}),
    df AS (SELECT {key}term, count(*) AS df FROM tf GROUP BY ALL),
    x AS (SELECT *, tf * (ln((1 + nd)::DOUBLE / (1 + df)) + 1) AS w
        FROM tf JOIN df USING ({same}) {with_size})
    SELECT {key}doc_id, term, tf, df,
        {r6('w / sqrt(sum(w * w) OVER (PARTITION BY doc_id))', 'weight')} FROM x"""


def rotated(x: str, bits: int) -> str:
    return f"(((({x}) << {bits}) | (({x}) >> {32 - bits})) & 4294967295)"


def stirred(k: str) -> str:
    return f"(({rotated(f'(({k}) * 3432918353) & 4294967295', 15)} * 461845907) & 4294967295)"


# Murmur3 of the 32-bit kind with seed 42, by its published rule, over the bytes of a term: whole
# blocks of four, the bytes left, the length, and the final mixing.
BUCKETS = f"""
    x AS (SELECT term, regexp_extract_all(hex(encode(term)), '..') AS b FROM (SELECT DISTINCT term FROM tokens)),
    k AS (SELECT term, len(b)::HUGEINT AS n, list_transform(range(len(b) // 4), lambda i: CAST('0x' || b[4 * i + 4] || b[4 * i + 3] || b[4 * i + 2] || b[4 * i + 1] AS HUGEINT)) AS blocks,
        CAST('0x0' || array_to_string(list_reverse(b[len(b) // 4 * 4 + 1 : len(b)]), '') AS HUGEINT) AS rest FROM x),
    h0 AS (SELECT term, n, xor(xor(list_reduce(list_prepend(42::HUGEINT, list_transform(blocks, lambda q: {stirred('q')})),
        lambda h, q: ({rotated('xor(h, q)', 13)} * 5 + 3864292196) & 4294967295), {stirred('rest')}), n) AS h FROM k),
    h1 AS (SELECT term, (xor(h, h >> 16) * 2246822507) & 4294967295 AS h FROM h0),
    h2 AS (SELECT term, (xor(h, h >> 13) * 3266489909) & 4294967295 AS h FROM h1),
    hashed AS (SELECT term, (xor(h, h >> 16) & 262143)::INTEGER AS bucket FROM h2),
    tf AS (SELECT doc_id, bucket, count(*) AS tf FROM tokens JOIN hashed USING (term) GROUP BY ALL)"""
# crc32 by its rule, over the bytes of a term
CRC = """crc AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS steps
        FROM (SELECT unnest(range(256)) AS i)),
    coded AS (SELECT term, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(term)), '..'), lambda b: CAST('0x' || b AS BIGINT))),
        lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) AS code FROM (SELECT DISTINCT term FROM tokens), crc)"""

CHUNKED = "(SELECT (row_number() OVER (ORDER BY doc_id) - 1) // 500 + 1 AS chunk_id, * FROM documents)"
TERMS = f"regexp_extract_all(lower(text), '{WORD}{{2,}}')"

# ---- pages ----
VISIBLE = "article"
for pattern, filler in (
    (r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", "''"),
    (r"(?i)(?:<br\b[^>]*>|</?(?:p|h[1-6]|div|li|article)\b[^>]*>)+", "chr(10)"),
    (r"<[^>]*>", "''"),
):
    VISIBLE = f"regexp_replace({VISIBLE}, '{pattern}', {filler}, 'g')"
for escape, char in (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&"),
):
    VISIBLE = f"replace({VISIBLE}, '{escape}', '{char}')"
LINES = f"""list_filter(list_transform(string_split_regex(txt, '\\r\\n|[\\n\\x0b\\x0c\\r\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]'),
    lambda x: {strip('x')}), lambda x: x <> '')[1:6]"""
NAMED = f"list_filter(list_transform({LINES}, lambda x: regexp_extract(x, '@([A-Za-z0-9_]{{1,15}})', 1)), lambda x: x <> '')[1]"
LINKED = """list_filter(list_transform(list_filter(hrefs,
    lambda x: starts_with(x, '/') AND NOT starts_with(x, '/i/')), lambda x: split_part(x, '/', 2)),
    lambda x: regexp_full_match(x, '[A-Za-z0-9_]{1,15}') AND lower(x) NOT IN ('status', 'search', 'i'))[1]"""


def in_text(plural: str) -> str:
    return f"TRY_CAST(replace(regexp_extract(txt, '(?i)([0-9,]+){SPACE}+{plural}', 1), ',', '') AS BIGINT)"


def tags(pattern: str, text: str, lower: bool = False) -> str:
    found = f"regexp_extract_all({text}, '{pattern}', 1)"
    if lower:
        found = f"list_transform({found}, lambda x: lower(x))"
    return f"coalesce(array_to_string(list_sort(list_distinct({found})), ','), '')"


MENTIONS, HASHTAGS = r"@([A-Za-z0-9_]{1,15})", rf"#({WORD}+)"

ORACLE = {
    "signals_flagship": f"{signals(FLAGSHIP, HOUR)} SELECT {SIGNAL_COLUMNS} FROM s",
    "signals_event_windows": f"{signals(EVENT_SCORES, FIVE_MIN)} SELECT {SIGNAL_COLUMNS} FROM s",
    "signals_hourly": f"{signals(EVENT_SCORES, HOUR)} SELECT {SIGNAL_COLUMNS} FROM s",
    "signals_gap_filled": (
        f"{signals(EVENT_SCORES, FIVE_MIN, 0, fill=True)} SELECT {SIGNAL_COLUMNS} FROM s"
    ),
    "signals_anchored_7min": (
        signals(
            EVENT_SCORES, 420_000_000, 1,
            "(SELECT epoch_us(date_trunc('day', min(ts))) FROM events)",
        )
        + f" SELECT {SIGNAL_COLUMNS} FROM s"
    ),
    "signals_summary": f"""{signals(EVENT_SCORES, FIVE_MIN)},
        c AS (SELECT action, count(*) AS k, max({iso('ws')}) AS last FROM s GROUP BY 1)
        SELECT coalesce(sum(k), 0)::BIGINT AS total_windows, (SELECT count(*) FROM events) AS total_posts_used,
        max(last) AS last_window, string_agg(action || '=' || k, ',' ORDER BY action) AS trade_action_summary FROM c""",
    "signals_plot_series": f"""{signals(EVENT_SCORES, FIVE_MIN)},
        i AS (SELECT *, row_number() OVER (ORDER BY ws) - 1 AS rn, count(*) OVER () AS total FROM s)
        SELECT {iso('ws')} AS window_start, {r6('mean_signal', 'mean_signal')},
        {r6('mean_signal - ci', 'lower')}, {r6('mean_signal + ci', 'upper')},
        {r6("mean_signal + greatest(0.001::DOUBLE, abs(mean_signal) * 0.05::DOUBLE) * CASE action WHEN 'SHORT' THEN 1 WHEN 'LONG' THEN -1 ELSE 0 END", 'marker')},
        action AS trade_action, cnt AS "count" FROM i WHERE rn % greatest(1, ceil(total / 200.0)::BIGINT) = 0""",
    "window_lookup": f"""SELECT {iso("date_trunc('hour', ts)")} AS window_start, count(*) AS n,
        count(*) FILTER (event_type = 'error') AS errors,
        {r6("coalesce(max(value) FILTER (event_type = 'error'), 0)", 'worst')} FROM events GROUP BY 1""",
    "clean_documents": f"""WITH {CANDIDATES} SELECT doc_id::VARCHAR AS id, source AS username,
        '2024-06-01T00:00:00+00:00' AS date, content, n_chars AS "replyCount",
        NULL::BIGINT AS "retweetCount", n_chars AS "likeCount", NULL::BIGINT AS "quoteCount",
        '' AS mentions, '' AS hashtags, '' AS url, source AS source_hashtag,
        '2024-06-01' AS event_date, h AS content_hash FROM cand""",
    "dedupe_documents": f"""WITH {CANDIDATES} {SURVIVOR} FROM cand
        QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id) = 1""",
    "dedupe_keep_intra": f"""WITH {CANDIDATES},
        b AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 200 AS batch FROM documents),
        k AS (SELECT *, min(batch) OVER (PARTITION BY h) AS first_batch FROM cand JOIN b USING (doc_id))
        {SURVIVOR} FROM k WHERE batch = first_batch""",
    "dedupe_second_run": f"""WITH {CANDIDATES}, {SEEN} {SURVIVOR} FROM cand
        WHERE h NOT IN (SELECT h FROM seen)
        QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id) = 1""",
    "dedupe_incremental_anti": f"""WITH {CANDIDATES}, {SEEN} SELECT doc_id::VARCHAR AS id,
        h AS content_hash FROM cand WHERE h NOT IN (SELECT h FROM seen)""",
    "dedupe_incremental_semi": f"""WITH {CANDIDATES}, {SEEN}
        SELECT DISTINCT h AS content_hash FROM cand WHERE h IN (SELECT h FROM seen)""",
    "seen_after_run": f"""WITH {CANDIDATES}, {SEEN} SELECT DISTINCT h AS content_hash,
        CASE WHEN h IN (SELECT h FROM seen) THEN '2024-01-01T00:00:00Z' ELSE '2024-06-01T00:00:00Z' END
        AS seen_at FROM cand""",
    "first_event_per_user": f"""SELECT user_id, event_id, event_type, {iso('ts')} AS ts, {r6('value', 'value')}
        FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""",
    "parsed_times": f"""WITH p AS ({SPELLED}), q AS (SELECT *, coalesce(t, TIMESTAMP '2024-06-01') AS u FROM p)
        SELECT event_id, strftime(u, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(u) % 1000000 <> 0
        THEN strftime(u, '.%f') ELSE '' END || '+00:00' AS date,
        coalesce(strftime(t, '%Y-%m-%d'), 'unknown') AS event_date FROM q""",
    "posts_per_day": f"""WITH p AS ({SPELLED}) SELECT coalesce(strftime(t, '%Y-%m-%d'), 'unknown') AS event_date,
        count(*) AS "rows" FROM p GROUP BY 1""",
    "safe_casts": """WITH k AS (SELECT event_id, CASE WHEN event_type IN ('click', 'view')
        THEN regexp_extract(props, '"k": *(-?[0-9]+)', 1)::BIGINT END AS v FROM events)
        SELECT event_id, v AS optional_count, coalesce(v, 0) AS count_or_zero FROM k""",
    "feature_meta": f"""SELECT doc_id::VARCHAR AS id, '' AS date, n_chars AS "likeCount",
        0::BIGINT AS "retweetCount", CASE WHEN source = 'web' THEN lang ELSE source END AS source_hashtag,
        sha1({strip('text')}) AS content FROM documents WHERE {strip('text')} <> ''""",
    "lexical_score": """SELECT doc_id, {0} AS words, {1} AS positive, {2} AS negative, {3} FROM documents""".format(
        *balance("text"),
        r6("({1} - {2}) / sqrt(greatest({0}, 1)::DOUBLE)".format(*balance("text")), "score"),
    ),
    "tfidf_corpus": tfidf(""),
    "tfidf_chunk": tfidf("chunk_id", CHUNKED),
    "tfidf_source": tfidf("source"),
    "document_frequency": f"""SELECT term, count(*) AS df FROM (
        SELECT DISTINCT doc_id, unnest({TERMS}) AS term FROM documents) GROUP BY 1""",
    "sparse_roundtrip": f"""SELECT doc_id, ('0x' || substr(md5(term), 1, 8))::BIGINT % 262144 AS bucket,
        count(*) AS tf FROM (SELECT doc_id, unnest({TERMS}) AS term FROM documents) GROUP BY 1, 2""",
    "hashing_tf": f"""WITH tokens AS (SELECT doc_id, unnest({TERMS}) AS term FROM documents), {BUCKETS}
        SELECT doc_id, bucket, tf FROM tf""",
    "hashed_tfidf": f"""WITH tokens AS (SELECT doc_id, unnest({TERMS}) AS term FROM documents), {BUCKETS},
        df AS (SELECT bucket, count(*) AS df FROM tf GROUP BY bucket),
        w AS (SELECT doc_id, bucket, tf * (ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + df)) + 1) AS w FROM tf JOIN df USING (bucket))
        SELECT doc_id, bucket, {r6('w / sqrt(sum(w * w) OVER (PARTITION BY doc_id))', 'weight')} FROM w""",
    "embed_documents": f"""WITH tokens AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORD}+')) AS term FROM documents), {CRC},
        c AS (SELECT doc_id, ((code >> 1) % 64)::INTEGER AS position, sum(CASE WHEN code & 1 = 1 THEN 1 ELSE -1 END) AS n FROM tokens JOIN coded USING (term) GROUP BY ALL)
        SELECT doc_id, position, {r6('n::FLOAT / sqrt(sum(n * n) OVER (PARTITION BY doc_id))::FLOAT', 'value')} FROM c WHERE n <> 0""",
    "centroids": f"""SELECT label, (pos - 1)::INTEGER AS position, {r6('avg(val::DOUBLE)', 'value')} FROM (
        SELECT label, unnest(embedding) AS val, generate_subscripts(embedding, 1) AS pos FROM embeddings)
        GROUP BY label, pos""",
    "embedding_contrast": f"""WITH {CENTROIDS} SELECT vec_id, {r6(cosine('embedding::DOUBLE[]', 'p'), 'to_positive')},
        {r6(cosine('embedding::DOUBLE[]', 'q'), 'to_negative')},
        {r6(cosine('embedding::DOUBLE[]', 'p') + ' - ' + cosine('embedding::DOUBLE[]', 'q'), 'contrast')}
        FROM embeddings, seeds""",
    "standardize": f"""SELECT event_id, {r6('value', 'value')}, 7.0::DOUBLE AS constant,
        {r6('(value - avg(value) OVER ()) / stddev_pop(value) OVER ()', 'value_z')},
        0.0::DOUBLE AS constant_z FROM events""",
    "feature_text_join": f"""SELECT vec_id::VARCHAR AS id, sha1(coalesce({strip('text')}, '')) AS content,
        {iso("coalesce(ts, TIMESTAMP '2024-06-01')")} AS ts FROM embeddings
        LEFT JOIN events ON event_id = vec_id LEFT JOIN documents ON doc_id = vec_id""",
    "mentions_hashtags": f"""WITH t AS (SELECT 'd' || doc_id AS id, text FROM documents
        UNION ALL SELECT 'c' || conv_id || '-' || turn, text FROM conversations),
        u AS (SELECT id, replace(replace(text, ' the ', ' #The'), ' de ', ' @de_') AS text FROM t)
        SELECT id, {tags(MENTIONS, 'text')} AS mentions, {tags(HASHTAGS, 'text', True)} AS hashtags FROM u""",
    "page_records": f"""WITH a AS (SELECT page_id, html,
            unnest(regexp_extract_all(html, '(?is)<article\\b[^>]*>(.*?)</article>', 1)) AS article,
            generate_subscripts(regexp_extract_all(html, '(?is)<article\\b[^>]*>(.*?)</article>', 1), 1) - 1 AS article_no
            FROM pages),
        v AS (SELECT *, {strip(VISIBLE)} AS txt, regexp_extract_all(html, '(?is)<a\\b[^>]*?\\bhref="([^"]*)"', 1) AS hrefs,
            list_filter(regexp_extract_all(article, '(?is)<a\\b[^>]*?\\bhref="([^"]*)"', 1), lambda x: contains(x, '/status/'))[1] AS link FROM a),
        u AS (SELECT *, CASE WHEN starts_with(link, '/') THEN 'https://x.com' || link ELSE link END AS url_ FROM v WHERE txt <> '')
        SELECT page_id, article_no::INTEGER AS article_no, coalesce(nullif(url_, ''), sha1(txt)) AS id,
        coalesce({LINKED}, {NAMED}, '') AS username, '2024-06-01T00:00:00+00:00' AS date,
        replace(txt, chr(10), ' ') AS content, {in_text('replies')} AS "replyCount",
        {in_text('retweets')} AS "retweetCount", {in_text('likes')} AS "likeCount", {in_text('quotes')} AS "quoteCount",
        {tags(MENTIONS, 'txt')} AS mentions, {tags(HASHTAGS, 'txt', True)} AS hashtags,
        coalesce(url_, '') AS url, '#market' AS source_hashtag FROM u""",
    "page_articles_nested": f"""WITH p AS (SELECT page_id, page_id::VARCHAR AS p, {strip("coalesce(html, '')")} AS body, coalesce(url, '') AS url,
            lpad((page_id % 1000)::VARCHAR, 3, '0') AS r FROM pages),
        a AS (SELECT page_id, 0 AS article_no, 'https://x.com/bob' || p || '/status/' || p AS id, 'bob' || p AS username, body AS content,
            page_id AS likes, ('1' || r)::BIGINT AS retweets, 3::BIGINT AS replies, 4::BIGINT AS quotes FROM p
        UNION ALL SELECT page_id, 1, 'https://x.com/ann' || p || '/status/9' || p, '', 'third ' || p, NULL, NULL, NULL, NULL FROM p
        UNION ALL SELECT page_id, 2, NULL, '', 'third ' || p, NULL, NULL, NULL, NULL FROM p
        UNION ALL SELECT page_id, 3, NULL, '', 'last ' || p || ' never closed', NULL, NULL, NULL, NULL FROM p)
        SELECT page_id, article_no::INTEGER AS article_no, id, username, sha1(replace(content, chr(10), ' ')) AS content, likes AS "likeCount",
        retweets AS "retweetCount", replies AS "replyCount", quotes AS "quoteCount", coalesce(id, '') AS url FROM a""",
    "label_counts": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        CASE WHEN l_linenumber = 1 THEN l_suppkey ELSE l_quantity::BIGINT END AS like_count,
        (1000 + l_linenumber)::BIGINT AS retweet_count,
        CASE WHEN l_linenumber = 2 THEN l_suppkey ELSE l_partkey END AS reply_count,
        ('2' || lpad(l_suppkey::VARCHAR, 3, '0'))::BIGINT AS quote_count FROM lineitem""",
    "roundrobin_cap": """WITH r AS (SELECT doc_id, source,
        row_number() OVER (PARTITION BY source ORDER BY doc_id)::INTEGER AS tag_rank FROM documents)
        SELECT doc_id, source, tag_rank, ((tag_rank - 1) // 50 + 1)::BIGINT AS visit FROM r
        ORDER BY visit, source, tag_rank LIMIT 400""",
    "per_tag_counts": """SELECT coalesce(source, 'TOTAL') AS source, count(*) AS "rows" FROM documents
        GROUP BY ROLLUP (source)""",
    "counts_for_all": """SELECT n_nationkey, count(s_suppkey) AS "rows" FROM nation
        LEFT JOIN supplier ON s_nationkey = n_nationkey AND s_acctbal < 0 GROUP BY 1""",
    "merge_mixed_schema": """SELECT c_custkey AS customer_key, c_name AS name, c_nationkey AS nationkey,
        c_acctbal AS acctbal, c_mktsegment AS mktsegment, NULL::BIGINT AS supplier_key FROM customer
        UNION ALL SELECT NULL, s_name, s_nationkey, s_acctbal, NULL, s_suppkey FROM supplier""",
    "row_chunks": """SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 500 + 1 AS chunk_id
        FROM events""",
    "job_metrics": f"""WITH {CANDIDATES}, {SEEN},
        k AS (SELECT count(*) AS c, count(DISTINCT h) AS d,
              count(DISTINCT h) FILTER (h IN (SELECT h FROM seen)) AS s FROM cand)
        SELECT 'rows_read' AS metric, count(*) AS value FROM documents UNION ALL SELECT 'candidates', c FROM k
        UNION ALL SELECT 'already_seen', s FROM k UNION ALL SELECT 'cleaned', d - s FROM k""",
    "t_confidence": f"""WITH b AS (SELECT user_id AS bucket, {MEASURES} FROM (SELECT user_id, value AS v FROM events) GROUP BY 1
        UNION ALL SELECT -(user_id % 97) - 1, {MEASURES} FROM (SELECT user_id, value AS v FROM events) GROUP BY 1)
        SELECT bucket, n, {r6('mean_signal', 'mean_signal')}, {r6('sem', 'sem')}, {r6(half_width(), 'ci95_half')} FROM b""",
    "stream_event_windows": (
        signals("WITH scored AS (SELECT ts, value AS v FROM events)", HOUR, 1)
        + f""" SELECT {SIGNAL_COLUMNS} FROM s
        WHERE ws + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"""
    ),
    "csv_round_trip": """SELECT doc_id::VARCHAR AS id, lang AS username, sha1(replace(replace(coalesce(text, ''),
        ' the ', '"the"' || chr(10)), ', ', chr(13) || chr(10) || '",""')) AS content FROM documents""",
    "csv_typed_copy": f"""SELECT o_orderkey, {r6('o_totalprice', 'o_totalprice')}, o_orderpriority FROM orders""",
    "damaged_lines": f"""{DAMAGED}
        SELECT 'good' AS kind, id, sha1(coalesce(text, '')) AS value FROM d WHERE k NOT IN (1, 2, 3, 4) UNION ALL SELECT * FROM aside""",
    "stream_damaged_lines": f"""{DAMAGED}
        SELECT 'good' AS kind, id, sha1('4') AS value FROM d WHERE k NOT IN (1, 2, 3, 4) UNION ALL SELECT * FROM aside""",
    "broken_files": f"""WITH {CANDIDATES} SELECT '2024-06-01' AS event_date, count(*) AS "rows" FROM cand
        UNION ALL SELECT '2024-06-02', -1 UNION ALL SELECT 'rows', count(*) FROM cand""",
    "feature_row_ids": """SELECT vec_id, (row_number() OVER (ORDER BY vec_id) - 1)::VARCHAR AS id,
        (row_number() OVER (ORDER BY vec_id) - 1)::VARCHAR AS in_splits FROM embeddings""",
    "signal_files": f"""{signals(EVENT_SCORES, HOUR)},
        f AS (SELECT ws, {iso('ws')} AS window_start_iso, n, {r6('mean_signal', 'mean_signal')}, action AS trade_action FROM s)
        SELECT 'csv' AS form, NULL::INTEGER AS place, f.* EXCLUDE (ws) FROM f UNION ALL SELECT 'json', NULL, f.* EXCLUDE (ws) FROM f
        UNION ALL SELECT 'document', (row_number() OVER (ORDER BY ws) - 1)::INTEGER, f.* EXCLUDE (ws) FROM f""",
    "pending_input": "SELECT lang AS username, count(*) AS posts FROM documents WHERE lang <> 'de' GROUP BY lang",
    "keyword_counts": f"""SELECT k.source_hashtag, k.tag_index, count(doc_id) AS "rows" FROM
        (SELECT unnest({KEYWORDS!r}) AS source_hashtag, unnest(range({len(KEYWORDS)}))::INTEGER AS tag_index) k
        LEFT JOIN documents ON doc_id % 26 = k.tag_index GROUP BY ALL""",
    "stream_signals_scaled": (
        signals("""WITH m AS (SELECT avg(value) em, stddev_pop(value) es, avg((user_id % 11)::DOUBLE) lm,
            stddev_pop((user_id % 11)::DOUBLE) ls FROM events),
            scored AS (SELECT ts, 0.6::DOUBLE * (value - em) / es + 0.4::DOUBLE * (user_id % 11 - lm) / ls AS v FROM events, m)""", HOUR)
        + f""" SELECT {SIGNAL_COLUMNS} FROM s
        WHERE ws + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"""
    ),
    # a row is late if its hour had ended before the mark of the batch before last's newest row
    "stream_late_rows": f"""WITH ends AS (SELECT min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS b FROM events),
        e AS (SELECT event_id, value, epoch_us(ts) AS us, epoch_us(ts) - epoch_us(ts) % {HOUR} AS ws,
            least((epoch_us(ts) - a) * 6 // (b - a + 1) + CASE WHEN event_id % 20 = 0 THEN 3 ELSE 0 END, 5) AS batch FROM events, ends),
        mark AS (SELECT n.batch, max(us) - {HOUR} AS w FROM (SELECT unnest(range(7)) AS batch) n LEFT JOIN e ON e.batch < n.batch - 1 GROUP BY 1),
        r AS (SELECT e.*, coalesce(ws + {HOUR} <= w // 1000 * 1000, false) AS late FROM e JOIN mark USING (batch))
        SELECT {iso('make_timestamp(ws)')} AS window_start_iso, count(*) AS n, {r6('avg(value)', 'mean_signal')} FROM r WHERE NOT late GROUP BY ws
        UNION ALL SELECT 'late', count(*), count(DISTINCT (batch, ws))::DOUBLE FROM r WHERE late""",
    "feature_text_join_hot": f"""WITH f AS (SELECT CASE WHEN vec_id % 2 = 0 THEN 'hot' ELSE vec_id::VARCHAR END AS key, vec_id::VARCHAR AS vec_id
            FROM embeddings LEFT JOIN events ON event_id = vec_id),
        t AS (SELECT CASE WHEN doc_id < 3 THEN 'hot' ELSE doc_id::VARCHAR END AS key, doc_id::VARCHAR AS doc_id, sha1(coalesce({strip('text')}, '')) AS content
            FROM documents)
        SELECT key, vec_id, doc_id, content FROM f LEFT JOIN t USING (key)""",
    "jsonl_round_trip": """SELECT doc_id::VARCHAR AS id, lang AS username, sha1(coalesce(text, '')) AS content,
        n_chars::VARCHAR AS "likeCount" FROM documents""",
    "stored_posts_round_trip": f"""WITH {CANDIDATES} SELECT doc_id::VARCHAR AS id, h AS content, n_chars AS "likeCount",
        '2024-06-01T00:00:00Z' AS ts, '2024-06-01' AS event_date FROM cand""",
    "features_round_trip": f"""SELECT vec_id::VARCHAR AS id, (pos - 1)::INTEGER AS position, {r6('val', 'value')} FROM (
        SELECT vec_id, unnest(embedding) AS val, generate_subscripts(embedding, 1) AS pos FROM embeddings)""",
    "stream_dedupe": f"WITH {CANDIDATES} SELECT DISTINCT h AS content_hash FROM cand",
}

"""Language-model scores from a log-frequency Bloom filter.

Words and word pairs are counted over the whole training part. A pair's count c is held as
its level 1 + floor(log2 c): the pair is entered into the filter once for each level up to
its own, and is read by probing level after level until one is missing. A word's level is
that of its exact count, which the plain word score needs anyway. Levels of pair and words
give a smoothed probability (Dirichlet smoothing of the pair estimate towards the word
estimate). Words are 64-bit hashes.

The filter holds every pair that is seen, so it grows with the corpus, and no worker holds
the whole of it: it lies in parts by the hash's leading bits, each of about ``PART_BYTES``
of training text, beside the exact counts of the part's words. Only totals and the most
frequent words are broadcast. To score, the distinct pairs and rarer words of a block of
texts go to their parts, are probed there, and levels and counts come back to the block. A
pair is known in its part by the last 32 bits of its hash: as a part has a bounded number
of pairs, two of them are taken for one far less often than the filter reads a level too high.

Texts are cut into words twice for a score, once to ask and once to add up, so that tokens
cross one shuffle alone, and as short numbers. Both passes have to see the rows alike, as
those of files and written tables are; a block that differs is an error.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crowdtide.llm.common import held_out, lean, plain_text, release, small_batches, stored, table
from crowdtide.llm.hashing import groups, mixed, words

END, BEGIN = 0x5851F42D4C957F2D, 0x14057B7EF767814F
PART_BYTES = 16 << 20  # of training text for each part of the counts
FLUSH_TOKENS = 1 << 21  # that a task counts before it passes them on
BLOCK_CHARS = 1 << 21  # of texts whose n-grams are looked up together
BITS_PER_ENTRY, PROBES = 12, 5
HOT_WORDS = 1 << 19  # whose exact counts every worker holds, at most; the others are asked for
PRIOR = 200.0  # weight, in words, of the word estimate beside a pair's


def sequences(texts: list[str]):
    """Word hashes with an end after each text, and where each text's part begins."""
    import numpy as np

    found, counts = words(texts)
    begin = np.concatenate(([0], np.cumsum(counts + 1)))
    out = np.full(begin[-1], END, np.uint64)
    place = np.ones(len(out), bool)
    place[begin[1:] - 1] = False
    out[place] = found
    return out, begin


def pairs(tokens, begin):
    import numpy as np

    before = np.concatenate(([np.uint64(BEGIN)], tokens[:-1]))
    before[begin[:-1]] = BEGIN
    return mixed(before * np.uint64(3) + tokens), before


def part_of(h, parts: int):
    """The part of each hash, by its leading bits; ``parts`` is a power of two."""
    import numpy as np

    return (h >> np.uint64(64 - (parts - 1).bit_length())).astype(np.int64) if parts > 1 else np.zeros(len(h), np.int64)


def pair_keys(h, parts: int):
    """The part of a pair and, below, the 32 bits that name it there."""
    import numpy as np

    return part_of(h, parts).astype(np.uint64) << np.uint64(32) | h & np.uint64(0xFFFFFFFF)


def planes(x) -> bytes:
    """32-bit numbers, all first bytes, then all second bytes and so on: small numbers shrink in a shuffle."""
    import numpy as np

    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unplanes(data: bytes):
    import numpy as np

    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def gaps(x) -> bytes:
    """Rising 32-bit numbers by their differences."""
    import numpy as np

    return planes(np.diff(x.astype("<u4"), prepend=np.zeros(1, "<u4")))


def ungaps(data: bytes):
    import numpy as np

    return np.cumsum(unplanes(data), dtype=np.uint32)


def short_numbers(x) -> bytes:
    """Numbers below 2^35, 7 bits in a byte, as many bytes as each needs."""
    import numpy as np

    n = 1 + sum((x >= 1 << 7 * k).astype(np.int64) for k in range(1, 5))
    start = np.cumsum(n) - n
    out = np.zeros(int(n.sum()), np.uint8)
    for k in range(5):
        some = n > k
        out[start[some] + k] = (x[some] >> 7 * k) & 127 | np.where(n[some] > k + 1, 128, 0)
    return out.tobytes()


def long_numbers(data: bytes):
    import numpy as np

    b = np.frombuffer(data, np.uint8)
    last = np.flatnonzero(b < 128)
    start = np.concatenate(([0], last[:-1] + 1)) if len(last) else last
    out = np.zeros(len(last), np.int64)
    for k in range(5):
        some = start + k <= last
        out[some] |= (b[start[some] + k] & 127).astype(np.int64) << 7 * k
    return out


def counted(texts: DataFrame, parts: int) -> DataFrame:
    """``part, words, counts, bits``, written: the words of each part, rising, their counts, and
    the filter of its pairs.

    Both are counted before the shuffle and dealt by the leading bits of their hash: a
    frequent n-gram is one number of each task, so parts are even.
    """

    def count(batches):
        import numpy as np
        import pyarrow as pa

        names, held, size = ["part", "words", "counts", "pairs", "pair_counts"], [], 0

        def flush():
            tokens = np.concatenate([t for t, _ in held])
            w, n = np.unique(tokens, return_counts=True)
            del tokens
            k, m = np.unique(np.concatenate([p for _, p in held]), return_counts=True)
            held.clear()
            at = np.arange(parts + 1)
            edges = np.searchsorted(part_of(w, parts), at), np.searchsorted((k >> np.uint64(32)).astype(np.int64), at)
            rows = [(i, w[a:b].tobytes(), planes(n[a:b]), gaps(k[c:d]), planes(m[c:d]))
                    for i, a, b, c, d in zip(range(parts), edges[0], edges[0][1:], edges[1], edges[1][1:]) if b > a or d > c]
            for i in range(0, len(rows), 64):
                part, *rest = zip(*rows[i:i + 64])
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), *(pa.array(c, pa.binary()) for c in rest)], names)

        for batch in batches:
            texts_ = batch.column(0).to_pylist()
            for a, b in groups(texts_):
                tokens, begin = sequences(texts_[a:b])
                held.append((tokens, pair_keys(pairs(tokens, begin)[0], parts)))
                size += len(tokens)
                if size > FLUSH_TOKENS:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()

    def build(rows):
        import numpy as np
        import pyarrow as pa

        w = np.frombuffer(b"".join(rows.column("words").to_pylist()), "<u8")
        n = np.concatenate([unplanes(x) for x in rows.column("counts").to_pylist()]).astype(np.int64)
        w, n = summed(w, n)
        k = np.concatenate([ungaps(x) for x in rows.column("pairs").to_pylist()])
        m = np.concatenate([unplanes(x) for x in rows.column("pair_counts").to_pylist()]).astype(np.int64)
        k, m = summed(k, m)
        row = (rows.column("part")[0].as_py(), w.tobytes(), n.astype("<i8").tobytes(), CountFilter.segment(k.astype(np.uint64), m))
        kinds = pa.int64(), pa.binary(), pa.binary(), pa.binary()
        out = pa.table([pa.array([x], kind) for x, kind in zip(row, kinds)], ["part", "words", "counts", "bits"])
        del rows, w, n, k, m
        release()
        return out

    found = texts.mapInArrow(lean(count), "part long, words binary, counts binary, pairs binary, pair_counts binary")
    return stored(found.groupBy("part").applyInArrow(build, "part long, words binary, counts binary, bits binary"), "parts")


def summed(h, n):
    import numpy as np

    order = np.argsort(h, kind="stable")
    h, n = h[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.empty(0, np.int64)
    return h[first], np.add.reduceat(n, first) if len(first) else n


def level(n):
    """1 + floor(log2 n) of whole numbers."""
    import numpy as np

    return np.frexp(n.astype(np.float64))[1]


class CountFilter:
    """Bloom filter of (n-gram, level) entries in segments by the hash's leading bits."""

    def __init__(self, segments: list[bytes]):
        import numpy as np

        self.bits = np.frombuffer(b"".join(segments), np.uint8)
        self.ends = np.cumsum([0, *map(len, segments)])

    @staticmethod
    def keys(h, lev):
        """Two numbers of an entry, from which its probes come."""
        import numpy as np

        a = mixed(h + np.uint64(lev * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF))
        return a, (a >> np.uint64(17)) | np.uint64(1)

    @staticmethod
    def place(a, step, i, size):
        """Bit number of probe ``i`` in a segment of ``size`` bytes."""
        import numpy as np

        return (((a + np.uint64(i) * step) * np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(24)) % (size * np.uint64(8))

    @classmethod
    def segment(cls, h, n) -> bytes:
        import numpy as np

        lev = level(n)
        entries = int(lev.sum())
        size = max(8, -(-entries * BITS_PER_ENTRY // 8))
        bits = np.zeros(size * 8, bool)
        for k in range(1, int(lev.max(initial=0)) + 1):
            a, step = cls.keys(h[lev >= k], k)
            for i in range(PROBES):
                bits[cls.place(a, step, i, np.uint64(size)).astype(np.int64)] = True
        return np.packbits(bits, bitorder="little").tobytes()

    def levels(self, h):
        """The highest level of each n-gram that is there with all below, else 0."""
        import numpy as np

        out = np.zeros(len(h), np.uint8)
        if not len(self.bits):
            return out
        n = len(self.ends) - 1
        seg = np.zeros(len(h), np.int64) if n == 1 else (h >> np.uint64(64 - (n - 1).bit_length())).astype(np.int64)
        active, base, size = np.arange(len(h)), self.ends[seg], (self.ends[seg + 1] - self.ends[seg]).astype(np.uint64)
        for k in range(1, 65):
            a, step = self.keys(h[active], k)
            for i in range(PROBES):
                at = self.place(a, step, i, size)
                there = (self.bits[base + (at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
                active, a, step, base, size = active[there], a[there], step[there], base[there], size[there]
            if not len(active):
                break
            out[active] = k
        return out

    @staticmethod
    def middle(lev):
        """The middle of the counts of a level; 0 for level 0."""
        import numpy as np

        return np.where(lev > 0, (1.5 * 2.0 ** lev.astype(np.float64) - 1) / 2, 0.0)

    def read(self, h):
        """Counts of the n-grams: the middle of the highest level that is there, else 0."""
        return self.middle(self.levels(h))


class BloomLanguageModel:
    """The parts as a table, and what every worker gets: totals, and the exact counts of at
    most ``HOT_WORDS`` words, by hash and with their rank by count."""

    def __init__(self, n: int, v: int, n_texts: int, parts: int, table_: DataFrame | None, hot, hot_n):
        import numpy as np

        self.n, self.v, self.n_texts, self.parts, self.table = n, v, float(n_texts), parts, table_
        by_count = np.lexsort((hot, -hot_n))
        self.by_rank, self.rank_n = hot[by_count], hot_n[by_count]
        by_hash = np.argsort(self.by_rank)
        self.hot, self.rank = self.by_rank[by_hash], by_hash.astype(np.int32)

    def __getstate__(self):
        return self.__dict__ | {"table": None}

    def split(self, found):
        """Of distinct hashes the rank of hot ones, and which are hot."""
        import numpy as np

        if not len(self.hot):
            return np.zeros(len(found), np.int32), np.zeros(len(found), bool)
        at = np.minimum(np.searchsorted(self.hot, found), len(self.hot) - 1)
        return self.rank[at], self.hot[at] == found

    def score(self, begin, count, pair):
        """log10 probability of each text, from the quantised counts of its tokens and pairs."""
        import numpy as np

        context = np.concatenate(([0.0], count[:-1]))
        context[begin[:-1]] = self.n_texts
        word = (count + 1) / (self.n + self.v + 1)
        pair = np.minimum(pair, np.minimum(count, context))
        p = (pair + PRIOR * word) / (context + PRIOR)
        return np.add.reduceat(np.log10(np.minimum(p, 1.0)), begin[:-1])


def learn(train: DataFrame, text_col: str = "text") -> BloomLanguageModel:
    """The model of all rows.

    A null text is empty and still has its end. The parts grow with the corpus: all words
    and all pairs are held, also those seen once.
    """
    import numpy as np

    texts = small_batches(train).select(plain_text(F.col(text_col)).alias("text"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b"), F.count(F.lit(1)).alias("n")).first()
    parts = 1 << max(4, (size["b"] // PART_BYTES).bit_length())
    found = counted(texts, parts)

    def levels(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for data in batch.column(0).to_pylist():
                n = np.frombuffer(data, "<i8")
                lev = level(n)
                held = np.unique(lev)
                yield pa.RecordBatch.from_arrays([
                    pa.array(held, pa.int32()), pa.array(np.bincount(lev)[held], pa.int64()),
                    pa.array(np.bincount(lev, n)[held].astype(np.int64))], ["level", "words", "tokens"])

    rows = found.select("counts").mapInArrow(levels, "level int, words long, tokens long")         .groupBy("level").agg(F.sum("words").alias("words"), F.sum("tokens").alias("tokens")).collect()
    n, v = sum(r["tokens"] for r in rows), sum(r["words"] for r in rows)
    least = 1
    while sum(r["words"] for r in rows if 1 << r["level"] > least) > HOT_WORDS:
        least *= 2

    def frequent(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = np.frombuffer(n, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(w, "<i8")[n >= least]), pa.array(n[n >= least])], ["hash", "n"])

    hot = found.select("words", "counts").mapInArrow(lean(frequent), "hash long, n long").toArrow()
    hashes, counts = (hot.column(c).to_numpy() for c in ("hash", "n"))
    return BloomLanguageModel(n, v, size["n"], parts, found, hashes.view(np.uint64), counts)


def text_blocks(batches):
    """Blocks of about ``BLOCK_CHARS`` characters in the first column: rows, and their texts."""
    import pyarrow as pa

    held, texts, size = [], [], 0
    for batch in batches:
        found = batch.column(0).to_pylist()
        rest = batch.select(range(1, batch.num_columns)) if batch.num_columns > 1 else batch
        for a, b in groups(found):
            held.append(rest.slice(a, b - a))
            texts += found[a:b]
            size += sum(map(len, found[a:b]))
            if size >= BLOCK_CHARS:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0], texts
                held, texts, size = [], [], 0
    if texts:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0], texts


def numbered_blocks(batches):
    """``block, batch, texts, tokens, begin``; numbers depend on the input partition and the order in it."""
    from pyspark import TaskContext

    for block, (batch, texts) in enumerate(text_blocks(batches), TaskContext.get().partitionId() << 32):
        tokens, begin = sequences(texts)
        yield block, batch, len(texts), tokens, begin


def looked_up(asked: DataFrame, model: BloomLanguageModel, tokens: int) -> DataFrame:
    """``block, part, counts, levels`` of ``block, part, words, pairs`` rows: exact counts of
    words and the levels of pairs.

    A part goes to one task, or where more is scored than was learned from, to several, so
    that what a task reads is bounded.
    """
    copies = int(tokens * 8 // (4 * model.parts * PART_BYTES)) + 1

    def probe(questions, held):
        import numpy as np
        import pyarrow as pa

        known, n, bits = np.empty(0, np.uint64), np.empty(0, np.int64), []
        if held.num_rows:
            known, n = (np.frombuffer(held.column(c)[0].as_py(), kind) for c, kind in (("words", "<u8"), ("counts", "<i8")))
            bits = [held.column("bits")[0].as_py()]
        filter_, counts, levels = CountFilter(bits), [], []
        for w, k in zip(questions.column("words"), questions.column("pairs")):
            w = np.frombuffer(w.as_py(), "<u8")
            at = np.minimum(np.searchsorted(known, w), max(len(known) - 1, 0))
            found = np.where(known[at] == w, n[at], 0) if len(known) else np.zeros(len(w), np.int64)
            counts.append(short_numbers(found))
            levels.append(filter_.levels(ungaps(k.as_py()).astype(np.uint64)).tobytes())
        out = pa.table([questions.column("block"), questions.column("part"), pa.array(counts, pa.binary()), pa.array(levels, pa.binary())], ["block", "part", "counts", "levels"])
        del known, n, bits, filter_
        release()
        return out

    asked = asked.withColumn("copy", F.pmod(F.xxhash64("block"), F.lit(copies)).cast("int"))
    held = model.table.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return asked.groupBy("part", "copy").cogroup(held.groupBy("part", "copy")).applyInArrow(
        probe, "block long, part long, counts binary, levels binary")


def scored(df: DataFrame, model: BloomLanguageModel, keep: dict[str, Column], text_col: str = "text") -> DataFrame:
    """``keep``'s columns and ``n_tokens, n_known, base_score, score`` for each row of ``df``.

    ``base_score`` is exact. A null text is empty: one token, its end. Without training
    rows scores are those of a vocabulary of nothing. Rows that repeat are scored each.
    """
    names = list(keep)
    shared = df.sparkSession.sparkContext.broadcast(model)
    total, parts = math.log10(model.n + model.v + 1), model.parts
    wide = small_batches(df).select(plain_text(F.col(text_col)).alias("__text"), *[c.alias(name) for name, c in keep.items()])
    kept = [f for f in wide.schema if f.name != "__text"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def ask(batches):
        import numpy as np
        import pyarrow as pa

        for block, _, _, tokens, begin in numbered_blocks(batches):
            found = np.unique(tokens)
            rare = found[~shared.value.split(found)[1]]
            keys = np.unique(pair_keys(pairs(tokens, begin)[0], parts))
            at = np.arange(parts + 1)
            edges = np.searchsorted(part_of(rare, parts), at), np.searchsorted((keys >> np.uint64(32)).astype(np.int64), at)
            rows = [(i, rare[a:b].tobytes(), gaps(keys[c:d])) for i, a, b, c, d in zip(range(parts), edges[0], edges[0][1:], edges[1], edges[1][1:]) if b > a or d > c]
            for i in range(0, len(rows), 64):
                part, w, k = zip(*rows[i:i + 64])
                yield pa.RecordBatch.from_arrays([
                    pa.array([block] * len(part), pa.int64()), pa.array(part, pa.int64()), pa.array(w, pa.binary()), pa.array(k, pa.binary())],
                    ["block", "part", "words", "pairs"])

    def tell(batches):
        import numpy as np
        import pyarrow as pa

        columns = [*[f.name for f in kept], "n_tokens", "__at", "__block", "__tokens", "__rare"]
        for block, batch, n_texts, tokens, begin in numbered_blocks(batches):
            found, where = np.unique(tokens, return_inverse=True)
            rank, hot = shared.value.split(found)
            code = np.where(hot, rank, len(shared.value.hot) + np.cumsum(~hot) - 1)[where]
            # the first row of a block carries its tokens
            first = lambda data: pa.array([data] + [None] * (n_texts - 1), pa.binary())
            yield pa.RecordBatch.from_arrays([
                *(batch.column(f.name) for f in kept), pa.array(np.diff(begin)), pa.array(np.arange(n_texts, dtype=np.int32)),
                pa.array(np.full(n_texts, block)), first(short_numbers(code)), first(found[~hot].tobytes())], columns)

    def add_up(rows, answers):
        import numpy as np
        import pyarrow as pa

        m = shared.value
        rows, answers = rows.sort_by("__at"), answers.sort_by("part")
        begin = np.concatenate(([0], np.cumsum(rows.column("n_tokens").to_numpy())))
        code, rare = long_numbers(rows.column("__tokens")[0].as_py()), np.frombuffer(rows.column("__rare")[0].as_py(), "<u8")
        # in order of parts, answers are in the order of the block's rarer words and pairs
        rare_n = np.concatenate([np.empty(0, np.int64), *(long_numbers(x) for x in answers.column("counts").to_pylist())])
        lev = np.frombuffer(b"".join(answers.column("levels").to_pylist()), np.uint8)
        hashes, n = np.concatenate((m.by_rank, rare)), np.concatenate((m.rank_n, rare_n))
        tokens = hashes[code]
        keys, which = np.unique(pair_keys(pairs(tokens, begin)[0], parts), return_inverse=True)
        if len(rare_n) != len(rare) or len(lev) != len(keys):
            raise ValueError("the rows came in another order the second time: write them to a table first")
        n = n[code]
        count = CountFilter.middle(np.where(n > 0, level(n), 0))
        base = np.add.reduceat(np.log10(n + 1.0), begin[:-1]) - np.diff(begin) * total
        out = rows.select([*[f.name for f in kept], "n_tokens"])
        for name, values in (("n_known", np.add.reduceat((n > 0).astype(np.int64), begin[:-1])), ("base_score", base), ("score", m.score(begin, count, CountFilter.middle(lev)[which]))):
            out = out.append_column(name, pa.array(values))
        return out

    asked = wide.mapInArrow(lean(ask), "block long, part long, words binary, pairs binary")
    told = wide.mapInArrow(lean(tell), f"{kinds}, n_tokens long, __at int, __block long, __tokens binary, __rare binary")
    size = wide.agg(F.coalesce(F.sum(F.octet_length("__text")), F.lit(0))).first()[0]
    answers = looked_up(asked, model, size // 6)
    return told.groupBy("__block").cogroup(answers.groupBy("block")).applyInArrow(
        add_up, f"{kinds}, n_tokens long, n_known long, base_score double, score double")


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 7, 2)
    model = learn(docs.filter(~out))
    found = scored(docs, model, {"doc_id": F.col("doc_id").cast("long"), "held_out": out})
    return found.withColumn("train_tokens", F.lit(model.n).cast("long"))

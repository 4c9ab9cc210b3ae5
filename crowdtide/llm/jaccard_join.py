"""N-gram Jaccard join with prefix trees.

A document is the set of its word n-grams, as 64-bit hashes. Documents with equal sets are
one node. Two sets with a Jaccard similarity of t share an n-gram among the first
n - ceil(t n) + 1 of each in any one order of all n-grams (prefix filter). The order is:
n-grams with a hash in the leading ``SAMPLED`` part of all hashes first, among them by the
number of nodes that hold them, then the rest by hash. So most documents have a prefix of
n-grams that nobody shares and are done; the others meet the nodes with which they share
one, and sets of nodes that meet, directly or by others, form a block.

In a block sets are ordered alike, frequent n-grams first, and stored in a trie. A set is
looked up by walking the trie, sharing the overlap counted on common paths and leaving a
subtree when what remains of both sides cannot reach the needed overlap, or when it is
linked with the set already. Blocks of more than ``BLOCK`` nodes are cut into pieces, and
each pair of pieces is a task. For components tasks give links that span them; all similar
pairs come from the same walk without the last cut (``jaccard_pairs``).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from crowdtide.llm.common import bitmap, lean, maybe_in, plain_text, release, small_batches, stored, table, unused
from crowdtide.llm.components import connected
from crowdtide.llm.hashing import groups, mixed, words

BLOCK = 2048
HEAVY = 2000  # an n-gram is heavy if it is in more than one of so many nodes
LOOKED_AT = 16  # one of so many nodes is looked at to find heavy n-grams


def shingles(found, n: int):
    """Sorted distinct hashes of the n-grams of a row of word hashes."""
    import numpy as np

    if not len(found):
        return np.empty(0, np.uint64)
    n = min(n, len(found))
    h = np.full(len(found) - n + 1, n, np.uint64)
    for i in range(n):
        h = mixed(h * np.uint64(3) + found[i:len(found) - n + 1 + i])
    return np.unique(h)


def sets(texts: list[str], n: int):
    """The n-gram set of each text."""
    import numpy as np

    for a, b in groups(texts):
        found, counts = words(texts[a:b])
        at = np.concatenate(([0], np.cumsum(counts)))
        for i in range(b - a):
            yield shingles(found[at[i]:at[i + 1]], n)


def node_of(s) -> int:
    """One number for a set; sets with equal numbers are taken as equal."""
    import numpy as np

    return int(mixed(np.asarray([mixed(s).sum() + np.uint64(len(s))], np.uint64)).view(np.int64)[0])


def prefix_length(n, percent: int):
    """n - ceil(t n) + 1, for numbers and for columns."""
    return n - -(-n * percent // 100) + 1


def bound(percent: int) -> int:
    """Hashes whose leading 31 bits are below are the sampled part."""
    return int(min(1.0, 2 * (100 - percent) / 100 + 0.02) * (1 << 31))


NODE = "struct<none:boolean,id:long,node:long>"


def named(doc_id: str, node: str):
    """A node with its smallest id; nodes in this order are in that of their ids, null last."""
    return F.struct(F.col(doc_id).isNull().alias("none"), F.coalesce(F.col(doc_id), F.lit(0)).alias("id"), F.col(node).alias("node"))


def described(df: DataFrame, n: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, key, node, n, sampled, entries`` for each row; ``entries`` are the n-grams
    that can be in the prefix, and are given where a task sees a node for the first time."""
    limit = bound(percent)

    def describe(batches):
        import numpy as np
        import pyarrow as pa

        seen = set()
        names = ["doc_id", "key", "node", "n", "sampled", "entries"]
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                texts = batch.column(2).slice(start, 512).to_pylist()
                node, size, sampled, entries = [], [], [], []
                for s in sets(texts, n):
                    size.append(len(s))
                    if not len(s):
                        node.append(None), sampled.append(0), entries.append(None)
                        continue
                    node.append(node_of(s))
                    sampled.append(int(((s >> np.uint64(33)) < limit).sum()))
                    if node[-1] in seen:
                        entries.append(None)
                    else:
                        seen.add(node[-1])
                        entries.append(s[:max(sampled[-1], prefix_length(len(s), percent))].view(np.int64))
                m = len(size)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(start, m), batch.column(1).slice(start, m), pa.array(node, pa.int64()), pa.array(size, pa.int64()),
                    pa.array(sampled, pa.int64()), pa.array(entries, pa.list_(pa.int64()))], names)

    text = plain_text(F.col(text_col))
    rows = small_batches(df).select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))
    return stored(rows.mapInArrow(lean(describe), "doc_id long, key long, node long, n long, sampled long, entries array<long>"), "described")


def meetings(rows: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """``a, b``: links that connect the nodes whose prefixes share an n-gram."""
    entries = rows.filter(F.col("entries").isNotNull()).select("node", F.explode("entries").alias("hash"))
    some = rows.filter(F.col("entries").isNotNull() & (F.pmod(F.xxhash64("node"), F.lit(LOOKED_AT)) == 0))
    n_some = some.count()
    # at most HEAVY times a node's mean number of n-grams: a bounded list, which only moves
    # n-grams to the end of the order and keeps their rows out of the shuffle
    heavy = some.select(F.explode("entries").alias("hash")).groupBy("hash").agg(F.count(F.lit(1)).alias("df")) \
        .filter(F.col("df") > max(8, n_some // HEAVY)).withColumn("df", F.col("df") * LOOKED_AT)
    heavy = F.broadcast(stored(heavy, "heavy"))
    one = Window.partitionBy("hash")
    light = entries.join(heavy, "hash", "left_anti").select(
        "node", "hash", F.count(F.lit(1)).over(one).alias("df"), F.min("node").over(one).alias("lo"), F.max("node").over(one).alias("hi"))
    shared = light.filter("lo <> hi").select("node", "hash", "df").unionByName(entries.join(heavy, "hash").select("node", "hash", "df"))
    # a node seen by several tasks has its n-grams several times
    shared = shared.join(nodes.select("node", "n", "sampled"), "node") \
        .groupBy("node", "n", "sampled", "hash").agg(F.max("df").alias("df"))
    first = (F.shiftrightunsigned("hash", 33) < bound(percent)).alias("first")
    mine = Window.partitionBy("node")
    length = F.expr(f"n - (n * {percent} + 99) div 100 + 1")
    alone = F.col("sampled") - F.sum(F.col("first").cast("long")).over(mine)
    place = F.row_number().over(mine.orderBy(F.col("first").desc(), "df", "hash"))
    prefix = shared.select("*", first).select("node", "n", "hash", (~F.col("first") | (place + alone <= length)).alias("in"))
    # similar sets differ in size by one step of this scale at most: only they meet
    scale = F.floor(F.log("n") / F.lit(math.log(100 / percent)) + 1e-9) if percent < 100 else F.col("n")
    prefix = prefix.filter("in").select("node", "hash", F.explode(F.array(scale, scale + 1)).alias("scale"))
    prefix = stored(prefix, "prefix")
    least = prefix.groupBy("hash", "scale").agg(F.min("node").alias("b"), F.max("node").alias("hi")).filter("b <> hi").select("hash", "scale", "b")
    return prefix.join(stored(least, "least"), ["hash", "scale"]).filter("node <> b").select(F.col("node").alias("a"), "b").distinct()


class Trie:
    """Compressed prefix tree over sorted rows of ranks; a tree node is
    ``(from, to, lo, hi, shortest, longest, children)``: the depths of its path, the range
    of its rows and their lengths."""

    def __init__(self, rows: list):
        import numpy as np

        self.rows = rows
        size = np.asarray([len(r) for r in rows])
        same = [0]
        for a, b in zip(rows, rows[1:]):
            m = min(len(a), len(b))
            apart = np.flatnonzero(a[:m] != b[:m])
            same.append(int(apart[0]) if len(apart) else m)
        same = np.asarray(same)
        self.root = []
        todo = [(0, len(rows), 0, self.root)]
        while todo:
            lo, hi, depth, out = todo.pop()
            to = len(rows[lo]) if hi - lo == 1 else int(same[lo + 1:hi].min())
            children: list = []
            out.append((depth, to, lo, hi, int(size[lo:hi].min()), int(size[lo:hi].max()), children))
            if hi - lo > 1:
                cuts = [lo, *(np.flatnonzero(same[lo + 1:hi] == to) + lo + 1).tolist(), hi]
                todo += [(a, b, to, children) for a, b in zip(cuts, cuts[1:])]

    def links(self, percent: int, sides=None, every: bool = False):
        """Pairs of row numbers that span the components of similar rows, or with ``every``
        all pairs of similar rows; with ``sides``, only pairs of rows of different sides."""
        import numpy as np

        rows, label = self.rows, np.arange(len(self.rows))
        held = np.zeros(1 + max(int(r[-1]) for r in rows), bool)
        for i, own in enumerate(rows):
            held[own] = True
            n = len(own)
            todo = [(node, 0) for node in self.root]
            while todo:
                (depth, to, lo, hi, shortest, longest, children), overlap = todo.pop()
                if hi <= i + 1 or longest * 100 < n * percent or n * 100 < shortest * percent:
                    continue
                if not every and (label[max(lo, i):hi] == label[i]).all():
                    continue
                path = rows[lo][depth:to]
                if len(path):
                    overlap += int(np.count_nonzero(held[path]))
                left = n - int(np.searchsorted(own, path[-1], "right")) if len(path) else n - overlap
                if (100 + percent) * (overlap + min(left, longest - to)) < percent * (n + shortest):
                    continue
                if children:
                    todo += [(child, overlap) for child in children]
                elif lo > i and (every or label[lo] != label[i]) and (sides is None or sides[lo] != sides[i]):
                    yield i, lo
                    if not every:
                        label[label == label[lo]] = label[i]
            held[own] = False


def linked(nodes: list, found: list, percent: int, sides=None, every: bool = False) -> list[tuple]:
    """Links that span the components of similar sets, or all of them."""
    import numpy as np

    if len(found) < 2:
        return []
    values, where, counts = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int64)
    rank[np.lexsort((values, -counts))] = np.arange(len(values))
    ends = np.cumsum([len(s) for s in found])
    rows = [np.sort(r) for r in np.split(rank[where], ends[:-1])]
    order = sorted(range(len(rows)), key=lambda i: rows[i].astype(">u4").tobytes())
    trie = Trie([rows[i] for i in order])
    return [(nodes[order[a]], nodes[order[b]]) for a, b in trie.links(percent, None if sides is None else [sides[i] for i in order], every)]


def joined(df: DataFrame, nodes: DataFrame, blocks: DataFrame, n: int, percent: int, id_col: str, text_col: str, every: bool = False) -> DataFrame:
    """``a, b``: links between nodes that are similar indeed, as structs ``none, id, node``,
    whose order is that of the nodes' smallest ids, null last."""
    sizes = blocks.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    placed = blocks.join(sizes, "root").join(nodes.select("node", "key", "doc_id"), "node")
    pieces = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = stored(placed.select(
        F.col("key").alias("k"), F.col("doc_id").alias("d"), F.col("node"), F.col("root").alias("block"), pieces.alias("pieces"),
        F.pmod(F.xxhash64("node"), pieces).cast("int").alias("piece")), "placed")
    text = plain_text(F.col(text_col))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
    # a bitmap of fixed size keeps texts that are surely in no block out of the shuffle
    rows = rows.filter(maybe_in(bitmap(placed.select(F.col("k").alias("key"))), F.col("key")))
    rows = rows.join(placed, (rows["key"] == placed["k"]) & rows["id"].eqNullSafe(placed["d"]))
    rows = rows.select(named("d", "node").alias("node"), "block", "pieces", "piece", "text")

    def hashed(batches):
        import pyarrow as pa

        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                found = [s.tobytes() for s in sets(batch.column(4).slice(start, 512).to_pylist(), n)]
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(start, len(found)) for i in range(4)), pa.array(found, pa.binary())], ["node", "block", "pieces", "piece", "set"])

    rows = rows.mapInArrow(lean(hashed), f"node {NODE}, block long, pieces int, piece int, set binary")
    # each pair of a block's pieces is a task, a piece with itself too
    other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("other")
    rows = rows.select("*", other).select("node", "block", "piece", "set", F.least("piece", "other").alias("low"), F.greatest("piece", "other").alias("high"))

    def look(table_):
        import numpy as np
        import pyarrow as pa

        held = {tuple(i.values()): (s, p) for i, s, p in zip(*(table_.column(c).to_pylist() for c in ("node", "set", "piece")))}
        across = table_.column("low")[0].as_py() != table_.column("high")[0].as_py()
        found = linked(list(held), [np.frombuffer(s, "<u8") for s, _ in held.values()], percent, [p for _, p in held.values()] if across else None, every)
        kind = pa.struct([("none", pa.bool_()), ("id", pa.int64()), ("node", pa.int64())])
        ends = [pa.array([dict(zip(("none", "id", "node"), x)) for x in side], kind) for side in (zip(*found) if found else ((), ()))]
        if len(held) > BLOCK // 4:
            del held
            release()
        return pa.table(ends, ["a", "b"])

    return rows.groupBy("block", "low", "high").applyInArrow(look, f"a {NODE}, b {NODE}")


def node_table(rows: DataFrame) -> DataFrame:
    """``node, n, sampled, doc_id, key`` of described rows: each set, with the smallest row that has it."""
    nodes = rows.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.first("n").alias("n"), F.first("sampled").alias("sampled"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("least"))
    return stored(nodes.select("node", "n", "sampled", F.col("least.doc_id").alias("doc_id"), F.col("least.key").alias("key")), "nodes")


def components(df: DataFrame, n: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, key, n, node, root`` for each row: ``root`` is the first node, by smallest id,
    that the row's node reaches; null with the node for a text without words."""
    rows = described(df, n, percent, id_col, text_col)
    nodes = node_table(rows)
    blocks = connected(meetings(rows, nodes, percent))
    roots = connected(joined(df, nodes, blocks, n, percent, id_col, text_col)).select(F.col("node.node").alias("node"), "root")
    own = nodes.join(roots, "node", "left").select("node", F.coalesce("root", named("doc_id", "node")).alias("root"))
    return rows.select("doc_id", "key", "n", "node").join(stored(own, "components"), "node", "left").select("doc_id", "key", "n", "node", "root")


def jaccard_components(df: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``df``.

    Words are runs of other bytes than white space, A-Z as a-z; a text of fewer than ``n``
    words is one n-gram, a null, empty or blank text has none and is linked with nothing.
    Two rows link when 100 * intersection >= ``percent`` * union; ``component_id`` is the
    smallest id that is reached by links, the row's own for a text without words. Null ids
    are passed over unless all of a component are null. Rows that repeat an id are looked
    at each; an empty table gives no rows. Other columns are not read.
    """
    found = F.when(~F.col("root.none"), F.col("root.id"))
    return components(df, n, percent, id_col, text_col).select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(found).alias("component_id"))


def jaccard_pairs(df: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The join itself: ``(pairs, members)``.

    ``pairs`` has ``a, b``, every two similar sets of n-grams that differ, once; ``members`` has
    ``doc_id, n_shingles, node`` for each row, ``node`` null without words. Rows of one node are
    equal sets and link too, so copies add no pair. A block of similar sets that all differ
    gives as many pairs as there are: its cost is that of its result.
    """
    rows = described(df, n, percent, id_col, text_col)
    nodes = node_table(rows)
    blocks = connected(meetings(rows, nodes, percent))
    found = joined(df, nodes, blocks, n, percent, id_col, text_col, every=True)
    low, high = F.least("a.node", "b.node"), F.greatest("a.node", "b.node")
    return found.select(low.alias("a"), high.alias("b")).distinct(), rows.select("doc_id", F.col("n").alias("n_shingles"), "node")


def one_of_each(df: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, one of each component.

    That is the row with the smallest id, null last; of rows that share this id, one of the
    text whose hash is smallest. Rows are told apart by id and text, so a row whose id another
    text has is judged by its own text. Rows without words all stay.
    """
    rows = components(df, n, percent, id_col, text_col).filter(F.col("node").isNotNull())
    rows = stored(rows.select("doc_id", "key", (named("doc_id", "node") == F.col("root")).alias("first"), "root"), "judged")
    # few rows are the first of their component: those with its id and set
    first = rows.filter("first").groupBy("root").agg(F.min("key").alias("least"))
    first = rows.filter("first").join(first, "root").withColumn("stays", F.col("key") == F.col("least"))
    gone = rows.filter("not first").select("doc_id", "key").unionByName(first.filter("not stays").select("doc_id", "key"))
    gone = stored(gone.select(F.col("doc_id").alias("__id"), F.col("key").alias("__text")).distinct(), "gone")
    again = first.filter("stays").groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("__rows")).filter("__rows > 1")
    again = stored(again.select(F.col("doc_id").alias("__id"), F.col("key").alias("__text")), "again")
    hashed = unused(df, "__key")
    marked = df.withColumn(hashed, F.xxhash64(plain_text(F.col(text_col))))

    def same(rows, other):
        return rows[id_col].cast("long").eqNullSafe(other["__id"]) & (rows[hashed] == other["__text"])

    kept = marked.join(gone, same(marked, gone), "left_anti")
    if again.isEmpty():
        return kept.drop(hashed)
    once, copies = (kept.join(again, same(kept, again), how) for how in ("left_anti", "left_semi"))
    return once.unionByName(copies.dropDuplicates([id_col, hashed])).drop(hashed)


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), 3, 90)

"""Connected components of a link table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crowdtide.llm.common import stored

#: Links that one task joins up by itself: tens of megabytes.
FEW = 1 << 19


def connected(links: DataFrame, few: int = FEW) -> DataFrame:
    """``node, root``: each node of ``links`` (``a, b``) with the smallest node it reaches.

    Nodes are of any one type with an order, structs too. Every round a node takes the
    smallest root of its neighbours, then its root's root, so the way to the smallest node
    halves at least. Each round is written, so that a lost executor repeats one round. A
    node with very many links is one large key of a join of two written tables, which
    adaptive execution splits; minima are taken before shuffles. At most ``few`` links,
    which is a bounded table, are joined up in one task instead, with the same result.
    """
    links = stored(links.select("a", "b").filter("a <> b").distinct(), "links")
    if links.count() <= few:
        return stored(joined_up(links), "roots")
    both = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    root = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "roots")
    while True:
        near = both.join(root, both["b"] == root["node"]).groupBy("a").agg(F.min("root").alias("near"))
        step = stored(root.join(near, root["node"] == near["a"]).select("node", "root", F.least("root", "near").alias("next")), "step")
        jump = step.select(F.col("node").alias("n"), F.col("next").alias("beyond"))
        moved = stored(step.join(jump, step["next"] == jump["n"]).select(
            "node", F.least("next", "beyond").alias("root"), (F.least("next", "beyond") < F.col("root")).alias("changed")), "roots")
        root = moved.select("node", "root")
        if moved.filter("changed").isEmpty():
            return root


def joined_up(links: DataFrame) -> DataFrame:
    """The same for a table that fits one task."""
    kind = links.schema["a"].dataType.simpleString()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        found = [b for b in batches if b.num_rows]
        if not found:
            return
        whole = pa.Table.from_batches(found).combine_chunks()
        ends = pa.concat_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (whole.column("a"), whole.column("b"))])
        # the order of structs is that of their fields
        keys = [f.to_numpy(zero_copy_only=False) for f in ends.flatten()][::-1] if pa.types.is_struct(ends.type) else [ends.to_numpy(zero_copy_only=False)]
        order = np.lexsort(keys)
        new = np.zeros(len(order), bool)
        for k in keys:
            new[1:] |= k[order][1:] != k[order][:-1]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new)
        a, b = rank[:whole.num_rows], rank[whole.num_rows:]
        root = np.arange(rank.max() + 1)
        while True:
            low = np.minimum(root[a], root[b])
            before = root.copy()
            for side in (a, b):
                np.minimum.at(root, side, low)
                np.minimum.at(root, before[side], low)
            root = root[root]
            if (root == before).all():
                break
        first = order[np.concatenate(([True], new[1:]))]  # of each node, in order
        nodes = ends.take(pa.array(first))
        yield pa.RecordBatch.from_arrays([nodes, nodes.take(pa.array(root))], ["node", "root"])

    return links.repartition(1).mapInArrow(run, f"node {kind}, root {kind}")

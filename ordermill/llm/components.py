"""Connected components as a distributed union-find.

Every round contracts the graph: each task reduces its batches of edges to
spanning forests, each node then follows its best neighbour, and the edges
between different followers form the next, smaller graph. "Best" is by hash,
so a chain of nodes in sorted order shrinks as fast as any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.store import written

#: A graph of at most so many edges is finished in one task (about 10 MB there).
LAST_EDGES = 100_000


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node index reachable from each of ``n`` nodes over edges (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while True:  # shorten paths
            shorter = new[new]
            if np.array_equal(shorter, new):
                break
            new = shorter
        if np.array_equal(new, label):
            return label
        label = new


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            both = pa.concat_arrays([batch.column(0), batch.column(1)]).dictionary_encode()
            code = both.indices.to_numpy()
            n = len(both.dictionary)
            top = roots(code[:batch.num_rows], code[batch.num_rows:], n)
            own = np.flatnonzero(top != np.arange(n))
            yield pa.RecordBatch.from_arrays(
                [both.dictionary.take(pa.array(own)), both.dictionary.take(pa.array(top[own]))], schema=batch.schema)


def _one_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    got = [b for b in batches if b.num_rows]
    if got:
        yield from _forest(iter(pa.Table.from_batches(got).combine_chunks().to_batches()))


def connected_components(edges: DataFrame) -> DataFrame:
    """Component of every node that has an edge.

    ``edges``: two columns of one type, any direction, repeats and self-loops
    allowed; a null end means no edge. Returns ``node`` and ``root``, where two
    nodes have the same root exactly if a path joins them. An empty table of
    edges gives an empty result; nodes without edges (or with a self-loop
    only) are not returned.
    """
    a, b = edges.columns
    edges = (edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
             .filter("a is not null and b is not null and a <> b"))
    schema = edges.schema
    levels: list[DataFrame] = []
    graph = written(edges.mapInArrow(_forest, schema), "forest")
    while True:
        size = graph.count()
        if size <= LAST_EDGES:
            last = graph.coalesce(1).mapInArrow(_one_table, schema).select(F.col("a").alias("node"), F.col("b").alias("root"))
            last = written(last.unionByName(last.select(F.col("root").alias("node"), "root").distinct()), "roots")
            break
        both = graph.union(graph.select("b", "a")).toDF("node", "near")
        order = F.struct(F.xxhash64("near").alias("h"), F.col("near").alias("v"))
        # A node follows the best of itself and its neighbours.
        follow = both.groupBy("node").agg(F.min(order).alias("m")).select(
            "node", F.when(F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("v")) < F.col("m"),
                           F.col("node")).otherwise(F.col("m.v")).alias("root"))
        follow = written(follow, "follow")
        levels.append(follow)
        left = follow.toDF("a", "ra")
        right = follow.toDF("b", "rb")
        graph = written(
            graph.join(left, "a").join(right, "b").filter("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
            .distinct().mapInArrow(_forest, schema), "contracted")
    result = last
    for follow in reversed(levels):
        up = result.toDF("root", "top")
        result = follow.join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return written(result, "components") if levels else result

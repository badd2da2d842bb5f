"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors are rotated at random and split into blocks. A pair of cosine c
has the squared distance 2 - 2c; in one block at least its squared distance
is at most that block's proportional share. So each block is range-joined
under its own budget, on a grid over its first coordinates, and every
candidate is verified with the whole vectors in double precision. A pair counts
in the first block whose budget it meets, so none counts twice.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.components import connected_components, roots
from ordermill.llm.store import written

COSINE = 0.9
BLOCKS = 4
#: Coordinates of each block that make its grid.
GRID = 2
#: A tile compares at most about so many vectors with as many others.
TILE = 16_384
SEED = 5
#: Slack of the block distances, which are taken in single precision; the verification is exact.
SLACK = 1e-4
#: Rows that are compared at a time inside a tile.
STRIPE = 128


@functools.lru_cache(maxsize=8)
def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random rotation of ``dim`` coordinates."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def edges_of(dim: int, blocks: int) -> list[int]:
    """Where the blocks begin and the last ends."""
    return [round(b * dim / blocks) for b in range(blocks + 1)]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision, scaled first so that no square over- or underflows."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def usable(v: Column) -> Column:
    """A vector that is not null, empty or zero and whose components are numbers."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def _by_length(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, vectors of one length at a time."""
    size = pc.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
    for n in np.unique(size):
        yield batch.take(pa.array(np.flatnonzero(size == n)))


def _cells(cosine: float, blocks: int, grid: int):
    """Places every vector in its own cell of each block's grid, and as a guest in the later cells that its range reaches."""
    def run(batches):
        for batch in (part for b in batches for part in _by_length(b)):
            col = batch.column("v")
            dim = len(col[0])
            x = unit(col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), dim)) @ rotation(dim)
            at = edges_of(dim, min(blocks, dim))
            for b, (lo, hi) in enumerate(zip(at, at[1:], strict=False)):
                g = min(grid, hi - lo)
                reach = np.sqrt(max(2 - 2 * cosine, 0) * (hi - lo) / dim + SLACK) + SLACK  # farther than any pair that _compare counts
                side = 2 * reach
                y = x[:, lo:lo + g]
                cell = np.floor(y / side).astype(np.int64)
                for step in np.ndindex(*[3] * g):
                    d = np.array(step) - 1
                    gap = np.where(d > 0, (cell + 1) * side - y, np.where(d < 0, y - cell * side, 0.0))
                    here = (gap ** 2).sum(axis=1) <= reach ** 2
                    later = tuple(d) > (0,) * g
                    if not (later or not d.any()):
                        continue  # a pair meets in the later of its two cells
                    rows = np.flatnonzero(here)
                    code = np.zeros(len(rows), np.int64)
                    for k in range(g):
                        code = (code << 20) + (cell[rows, k] + d[k] + (1 << 19))
                    if len(rows):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(rows), dim, np.int32)), pa.array(np.full(len(rows), b, np.int32)), pa.array(code),
                             pa.array(np.full(len(rows), later)), batch.column("rep").take(pa.array(rows)), batch.column("copies").take(pa.array(rows)),
                             col.take(pa.array(rows))], ["dim", "block", "cell", "guest", "rep", "copies", "v"])
    return run


def _compare(cosine: float, blocks: int):
    """Verified links of one tile: for each vector its number of links, and a forest of them."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        block = key[1].as_py()
        side = table.column("side").to_numpy()
        v = table.column("v").combine_chunks()
        dim = len(v[0])
        x = unit(v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), dim))
        y = np.zeros(x.shape)
        for k, axis in enumerate(rotation(dim)):  # in this order for every row, so that all tiles see the same distances
            y += x[:, k:k + 1] * axis
        y = y.astype(np.float32)
        at = edges_of(dim, min(blocks, dim))
        # A pair counts in the first block within its limit; the grid and the search below reach farther than the limit.
        limit = [max(2 - 2 * cosine, 0) * (hi - lo) / dim + SLACK / 2 for lo, hi in zip(at, at[1:], strict=False)]
        budget = [max(2 - 2 * cosine, 0) * (hi - lo) / dim + SLACK for lo, hi in zip(at, at[1:], strict=False)]
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1)
        inner = key[3].as_py() == key[4].as_py()  # a chunk with itself
        if inner:
            right = left
        lo, hi = at[block], at[block + 1]
        z = y[right, lo:hi]
        norm = (z * z).sum(axis=1)
        found: list[np.ndarray] = []
        for i in range(0, len(left), STRIPE):
            own = left[i:i + STRIPE]
            w = y[own, lo:hi]
            near = (w * w).sum(axis=1)[:, None] + norm[None, :] - 2 * (w @ z.T) <= budget[block]
            a, b = np.nonzero(near)
            if inner:
                a, b = a[(keep := b > a + i)], b[keep]
            a, b = own[a], right[b]
            for j in range(0, len(a), 200_000):
                p, q = a[j:j + 200_000], b[j:j + 200_000]
                ok = np.einsum("ij,ij->i", x[p], x[q]) >= cosine
                p, q = p[ok], q[ok]
                d = (y[p] - y[q]) ** 2
                for e in range(block + 1):
                    counts = (d[:, at[e]:at[e + 1]].sum(axis=1) <= limit[e]) == (e == block)  # if earlier, it is counted there
                    p, q, d = p[counts], q[counts], d[counts]
                if len(p):
                    found.append(np.stack([p, q]))
        pair = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        copies = table.column("copies").to_numpy()
        links = np.bincount(pair[0], copies[pair[1]], minlength=len(v)) + np.bincount(pair[1], copies[pair[0]], minlength=len(v))
        top = roots(pair[0], pair[1], len(v))
        has = np.flatnonzero(links > 0)
        rep = table.column("rep").combine_chunks()
        return pa.table({"rep": rep.take(pa.array(has)), "links": pa.array(links[has].astype(np.int64)), "near": rep.take(pa.array(top[has]))})
    return run


def near_vectors(vectors: DataFrame, cosine: float = COSINE, blocks: int = BLOCKS, tile: int = TILE, grid: int = GRID) -> DataFrame:
    """Links and components: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    ``vectors`` needs ``vec_id`` (unique) and ``embedding`` (array of float or double). Two rows are
    linked if their cosine, in double precision, is at least ``cosine``. Equal
    vectors form one class that is compared once; its members count as linked with
    each other. Null, empty and zero vectors, those with null or non-finite
    components and vectors of different dimension link with nothing. A null ``vec_id`` is the smallest
    only where a component has no other id. Other columns are ignored; an empty table gives an empty result.
    """
    rows = vectors.select("vec_id", F.col("embedding").alias("v"), usable(F.col("embedding")).alias("ok"))
    good = rows.filter("ok")
    classes = written(good.groupBy("v").agg(F.min("vec_id").alias("rep_id"), F.count(F.lit(1)).alias("copies"))
                      .select(F.unhex(F.md5(F.to_json(F.struct("v")))).alias("rep"), "v", "rep_id", "copies"), "vector-classes")
    kind = classes.schema["v"].dataType.simpleString()
    cells = written(classes.select("rep", "copies", "v").mapInArrow(
        _cells(cosine, blocks, grid), f"dim int, block int, cell long, guest boolean, rep binary, copies long, v {kind}"), "cells")
    size = cells.groupBy("dim", "block", "cell").agg(
        F.ceil(F.count(F.when(~F.col("guest"), 1)) / tile).cast("int").alias("homes"), F.ceil(F.count(F.when(F.col("guest"), 1)) / (2 * tile)).cast("int").alias("guests"))
    at = cells.join(size.filter("homes > 0"), ["dim", "block", "cell"])
    mine = F.pmod(F.xxhash64("rep"), F.when(F.col("guest"), F.col("guests")).otherwise(F.col("homes"))).cast("int")
    # Chunk i of the homes meets itself, every later chunk, and every chunk of guests.
    up_to = lambda n: F.sequence(F.lit(0), n - 1)
    home = F.concat(
        F.transform(up_to(F.col("homes")), lambda j: F.struct(F.least(j, F.col("mine")).alias("i"), F.greatest(j, F.col("mine")).alias("j"), (j < F.col("mine")).cast("int").alias("side"))),
        F.transform(F.when(F.col("guests") > 0, up_to(F.col("guests"))).otherwise(F.array().cast("array<int>")),
                    lambda j: F.struct(F.col("mine").alias("i"), (-1 - j).alias("j"), F.lit(0).alias("side"))))
    guest = F.transform(up_to(F.col("homes")), lambda i: F.struct(i.alias("i"), (-1 - F.col("mine")).alias("j"), F.lit(1).alias("side")))
    placed = at.withColumn("mine", mine).select("dim", "block", "cell", "rep", "copies", "v", F.inline(F.when(F.col("guest"), guest).otherwise(home)))
    links = written(placed.groupBy("dim", "block", "cell", "i", "j").applyInArrow(_compare(cosine, blocks), "rep binary, links long, near binary"), "vector-links")
    label = connected_components(links.select("rep", "near")).toDF("rep", "root")
    count = links.groupBy("rep").agg(F.sum("links").alias("links"))
    place = classes.select("rep", "rep_id", "copies", "v").join(label, "rep", "left").join(count, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    smallest = place.groupBy("root").agg(F.min("rep_id").alias("component"))
    known = place.join(smallest, "root").select(F.col("v").alias("cv"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "component")
    out = rows.join(known, F.col("ok") & (F.col("v") == F.col("cv")), "left")
    component = F.when(F.col("ok"), F.col("component")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))

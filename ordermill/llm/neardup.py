"""MinHash near-duplicates by an inverted join over signature coordinates.

Documents with the same shingle set form a class. Every class is posted under
its (coordinate, value) pairs. Two sets that agree in at least ``MATCHES`` of the
``COORDINATES`` must share one of the rarest postings of each: of a class's m
postings that others share, the m - MATCHES + 1 rarest are its prefix, and the
longest lists are skipped. Classes with fewer shared postings than MATCHES drop out.

Candidates are confirmed on full sets. First each list compares its members
with one hub; then whatever is still unconnected inside a group of
candidates is compared in tiles of bounded size. Neither step writes out the
pairs of a group, only links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm import minhash, textkit
from ordermill.llm.components import connected_components, roots
from ordermill.llm.store import packed, row_name, written

COORDINATES = 32
#: Sets with similarity 0.75 agree in 24 coordinates on average, in under 12 with a probability of 1e-6.
MATCHES = 12
PERCENT = 75
#: A chunk of a candidate group has about so many members and shingles at most.
CHUNK_SETS = 512
CHUNK_SHINGLES = 200_000
#: Slots of the bitmap that preselects documents; it has a fixed size of 1 MB.
SLOTS = 1 << 23


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s in textkit.slices(batch.column("text")):
            size, key, sig = minhash.shingle_signatures(s, COORDINATES)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(s.lo, len(s)), pa.array(size), pa.array(key, pa.binary()), minhash.rows_of(sig.astype(np.int64), pa.int64())],
                ["doc_id", "n_shingles", "key", "sig"])


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``key`` (digest of the shingle set, null if empty), ``sig`` of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_sign, f"doc_id {kind}, n_shingles long, key binary, sig array<long>")


def prefix_postings(classes: DataFrame, matches: int = MATCHES) -> DataFrame:
    """``posting``, ``key``: every class under the rarest of the postings it shares with others."""
    post = classes.select("key", F.posexplode("sig").alias("c", "v")).select("key", (F.col("c") * F.lit(1 << 32) + F.col("v")).alias("posting"))
    shared = post.groupBy("posting").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    own = post.join(shared, "posting").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("n", "posting"))).alias("p"))  # COORDINATES entries at most
    own = own.filter(F.size("p") >= matches)
    return own.select("key", F.explode(F.slice("p", F.lit(1), F.size("p") - matches + 1)).alias("p")).select("p.posting", "key")


def hub_pairs(postings: DataFrame) -> DataFrame:
    """``a``, ``b``: in every list of two or more, the smallest key with each of the others."""
    hubs = postings.groupBy("posting").agg(F.min("key").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("posting", "a")
    return postings.join(hubs, "posting").filter("key <> a").select("a", F.col("key").alias("b")).distinct()


def bitmap(slots: DataFrame) -> np.ndarray:
    """A bitmap of SLOTS bits, set where the only column (a slot from 0) says; its size does not depend on the data."""
    slot = F.col(slots.columns[0]) + 1  # the functions count from 1
    rows = slots.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect()
    out = np.zeros(SLOTS // 8, np.uint8)
    for r in rows:
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        base = (r["bucket"] - 1) * len(part)
        out[base:base + len(part)] |= part
    return out


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``key`` and ``items`` (the shingle set) of the classes of the documents in ``wanted`` (a column of doc_id).

    A bitmap of fixed size lets most other documents go before any work; those it lets pass are exact all the same.
    """
    bits = bitmap(wanted.select(F.pmod(F.xxhash64(wanted.columns[0]), F.lit(SLOTS))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            on = np.flatnonzero(bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
            for s in textkit.slices(batch.column("text").take(pa.array(on))):
                got = [u for _, u in minhash.shingle_sets(s)]
                if got:
                    ends = np.concatenate([[0], np.cumsum([len(u) for u in got])]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([hashlib.blake2b(u.tobytes(), digest_size=16).digest() for u in got], pa.binary()),
                         pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(got).view(np.int64)))], ["key", "items"])

    slot = F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS)).alias("slot")
    return docs.select("text", slot).mapInArrow(run, "key binary, items array<long>")


def enough(both, size_a, size_b, percent: int):
    """Whether an intersection of ``both`` reaches the similarity."""
    return 100 * both >= percent * (size_a + size_b - both)


def confirm_pairs(pairs: DataFrame, classes: DataFrame, sets: DataFrame, matches: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose signatures match often enough and whose sets are similar enough."""
    lite = classes.select("key", "n", "sig")
    pairs = pairs.join(lite.toDF("a", "na", "sa"), "a").join(lite.toDF("b", "nb", "sb"), "b")
    same = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda t, x: t + x)
    pairs = pairs.filter((same >= matches) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))).select("a", "b", "na", "nb")
    pairs = pairs.join(sets.toDF("a", "ia"), "a").join(sets.toDF("b", "ib"), "b")
    return pairs.filter(enough(F.size(F.array_intersect("ia", "ib")), F.col("na"), F.col("nb"), percent)).select("a", "b")


def common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets on the left with all on the right.

    Elements are numbered and the sets laid out as 0/1 rows, some thousand elements at a time.
    """
    item = np.concatenate([*left, *right])
    row = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in [*left, *right]])
    _, number, times = np.unique(item, return_inverse=True, return_counts=True)
    both = times[number] > 1
    row, number = row[both], number[both]
    order = np.argsort(number, kind="stable")
    row, number = row[order], number[order]
    number = np.cumsum(np.diff(number, prepend=number[:1]) > 0) if len(number) else number
    out = np.zeros((len(left), len(right)), np.float32)
    step = 4096
    for lo in range(0, int(number[-1]) + 1 if len(number) else 0, step):
        a, b = np.searchsorted(number, [lo, lo + step])
        block = np.zeros((len(left) + len(right), step), np.float32)
        block[row[a:b], number[a:b] - lo] = 1
        out += block[:len(left)] @ block[len(left):].T
    return out.astype(np.int64)


def listed(col: pa.ListArray) -> list[np.ndarray]:
    """The entries of a list column."""
    off, flat = col.offsets.to_numpy(), col.values.to_numpy()
    return [flat[a:b] for a, b in zip(off[:-1], off[1:], strict=True)]


def _tile(percent: int, to_sets):
    def run(table: pa.Table) -> pa.Table:
        """Links inside one tile (between its chunks, or inside its only chunk), reduced to a forest."""
        side = table.column("side").to_numpy()
        sets = to_sets(table.column("items").combine_chunks())
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1) if (side == 1).any() else left
        size = np.array([len(x) for x in sets])
        both = common([sets[i] for i in left], [sets[i] for i in right])
        a, b = np.nonzero(enough(both, size[left][:, None], size[right][None, :], percent))
        a, b = left[a], right[b]
        top = roots(a, b, len(side))
        own = np.flatnonzero(top != np.arange(len(side)))
        key = table.column("key").combine_chunks()
        return pa.table({"a": key.take(pa.array(own)), "b": key.take(pa.array(top[own]))}, schema=pa.schema([("a", pa.binary()), ("b", pa.binary())]))
    return run


def tile_links(members: DataFrame, sets: DataFrame, percent: int, to_sets=listed) -> DataFrame:
    """Links between members of a group that are not connected yet.

    ``members``: ``key``, ``n``, ``group``, ``comp``; ``sets``: ``key`` and ``items``, whose column
    ``to_sets`` makes a list of sorted distinct numbers. Large components are cut in chunks of their own,
    the members of small ones share chunks; each pair of chunks is a tile, but
    for two of one component.
    """
    own = members.groupBy("group", "comp").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("total"))
    own = own.withColumn("lot", F.when((F.col("members") > CHUNK_SETS // 2) | (F.col("total") > CHUNK_SHINGLES // 2), F.col("comp")))
    lots = own.groupBy("group", "lot").agg(F.greatest(F.ceil(F.sum("members") / CHUNK_SETS), F.ceil(F.sum("total") / CHUNK_SHINGLES)).alias("chunks"))
    chunks = lots.select("group", "lot", F.explode(F.sequence(F.lit(0), F.col("chunks").cast("int") - 1)).alias("part"))
    name = F.struct(F.coalesce("lot", F.lit(b"")).alias("lot"), "part")
    left = chunks.select("group", name.alias("x"))
    right = chunks.select("group", name.alias("y"))
    pair = left.join(right, "group").filter("x <= y and (x.lot <> y.lot or x.lot = X'')")
    tiles = pair.select("group", "x", "y", F.posexplode(F.when(F.col("x") == F.col("y"), F.array("x")).otherwise(F.array("x", "y"))).alias("side", "chunk"))
    count = lots.toDF("g2", "l2", "chunks")
    placed = (members.join(own.select("group", "comp", "lot"), ["group", "comp"]).join(count, (F.col("group") == F.col("g2")) & F.col("lot").eqNullSafe(F.col("l2")))
              .select("key", "group", F.struct(F.coalesce("lot", F.lit(b"")).alias("lot"), F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int").alias("part")).alias("chunk")))
    rows = placed.join(tiles, ["group", "chunk"]).join(sets, "key").select(F.xxhash64("group", "x", "y").alias("tile"), "group", "x", "y", "side", "key", "items")
    return rows.groupBy("tile", "group", "x", "y").applyInArrow(_tile(percent, to_sets), "a binary, b binary")


def unconnected(pairs: DataFrame, links: DataFrame, sizes: DataFrame) -> DataFrame:
    """Members of the candidate groups that the links leave in several components: ``key``, ``n``, ``group``, ``comp``."""
    group = connected_components(pairs).toDF("key", "group")
    comp = connected_components(links).toDF("key", "comp")
    members = group.join(comp, "key", "left").join(sizes, "key").withColumn("comp", F.coalesce("comp", "key"))
    still = members.groupBy("group").agg((F.min("comp") != F.max("comp")).alias("still")).filter("still").select("group")
    return written(members.join(still, "group", "left_semi").select("key", "n", "group", "comp"), "members")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, matches: int = MATCHES) -> DataFrame:
    """Component of every document: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Documents are linked if the Jaccard similarity of their sets of distinct
    five-word shingles (A-Z folded) is at least ``percent``; a text of fewer
    words has its whole sequence as the only shingle. ``component_id`` is the
    smallest ``doc_id`` reachable over links.

    Null and empty texts and texts of white space have no shingles and stay
    alone. Rows that repeat a text are linked like copies under other ids. A null ``doc_id`` is
    never the smallest unless a component has no other. Other columns are ignored; an empty
    table gives an empty result; a text of any length is taken whole.
    """
    rows = written(signed(docs), "signatures")
    classes = written(rows.filter("key is not null").groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")), "classes")
    pairs = written(hub_pairs(written(prefix_postings(classes, matches), "prefixes")), "hub-pairs")
    nodes = written(pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct(), "candidates")
    sets = written(full_sets(docs, nodes.join(classes, "key").select("rep")).join(nodes, "key", "left_semi"), "sets")
    links = written(confirm_pairs(pairs, classes, sets, matches, percent), "links")
    members = unconnected(pairs, links, classes.select("key", "n"))
    more = written(tile_links(members, sets, percent), "tile-links")
    label = connected_components(links.union(more)).toDF("key", "root")
    place = classes.select("key", "rep").join(label, "key", "left").withColumn("root", F.coalesce("root", "key"))
    smallest = place.groupBy("root").agg(F.min("rep").alias("component_id"))
    ids = place.join(smallest, "root").select("key", "component_id")
    out = rows.select("doc_id", "n_shingles", "key").join(ids, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of ``docs`` of every component, and every row without shingles.

    Rows are told apart by ``doc_id`` and text: of a component the row with the smallest id stays (null ids last; of
    texts under one id the one with the smallest digest), so different texts under one id or without an id are judged each.
    Null, empty and blank texts stay, each row of them; rows repeated whole are one row of a component. All columns pass through whatever
    their names; an empty table gives an empty result; texts are compared whole at any length.
    """
    named = docs.select(packed(docs).alias("row"), row_name().alias("name"), "text")
    # The component step takes the name for the id.
    kept = near_duplicates(named.select(F.col("name").alias("doc_id"), "text"), **options).filter("kept and n_shingles > 0")
    one = named.join(kept.select(F.col("doc_id").alias("name")).distinct(), "name", "left_semi").dropDuplicates(["name"])
    blank = named.filter(~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    return one.select("row").unionByName(blank.select("row")).select("row.*")

"""Fuzzy line deduplication by MinHash over character shingles.

Every long enough line of every document takes part. Equal lines form a class;
the distinct lines are signed with MinHash over character shingles and banded.
Lines that share a band are candidates, are confirmed by the exact Jaccard
similarity of their shingle sets, and joined by a distributed union-find. Of
every component one line stays: the first by document and place.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm import neardup, textkit
from ordermill.llm.components import connected_components
from ordermill.llm.store import packed, written

#: Characters in a shingle, and in the shortest line that takes part (without white space around it).
SHINGLE = 8
MIN_CHARS = 10
PERCENT = 75
#: At similarity 0.75 a pair meets in some band with probability 0.9986, at 0.8 with 0.9998.
BANDS = 12
ROWS = 3
#: Bytes of text whose postings go to one group of the band exchange, and whose lines to one group of the class exchange.
GROUP_BYTES = 4 << 20
CLASS_BYTES = 6 * GROUP_BYTES
#: Bands of up to so many lines are compared pair by pair.
SMALL_BAND = 32

#: Texts are worked on in slices of so many bytes, whose values stay in a core's cache.
SLICE_BYTES = 1 << 17

_MUL = textkit._SLOT[:8]
_RNG = np.random.default_rng(4022)
#: Odd multipliers of the places in a shingle and of the hash functions (32 bits), and a value for each band.
_MUL32 = _RNG.integers(1, 1 << 32, 8, dtype=np.uint32) | np.uint32(1)
_HASH = _RNG.integers(1, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_BAND = _RNG.integers(1, 1 << 63, BANDS, dtype=np.uint64)


def _stripped(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans without outer white space; a span of nothing else is empty."""
    start, end = start.copy(), end.copy()
    for side, at, step in ((start, 0, 1), (end, -1, -1)):
        left = np.flatnonzero(start < end)
        for _ in range(8):
            left = left[textkit._SPACE[data[side[left] + at]]]
            if not len(left):
                break
            side[left] += step
            left = left[start[left] < end[left]]
        if len(left):  # long runs: by the places of all other bytes
            seen = np.flatnonzero(~textkit._SPACE[data])
            if at == 0:
                start[left] = np.minimum(np.append(seen, len(data))[np.searchsorted(seen, start[left])], end[left])
            else:
                end[left] = np.maximum(np.append(seen, -1)[np.searchsorted(seen, end[left]) - 1] + 1, start[left])
    return start, end


class Lines:
    """The lines of a slice that take part: text index, number, byte span without outer white space, digest."""

    def __init__(self, s: textkit.Slice):
        text, number, a, b = textkit.lines(s)
        start, end = _stripped(s.data, a, b)
        #: places of the bytes that begin no character
        self.inner = np.flatnonzero((s.data & 0xC0) == 0x80)
        long = self.char(end) - self.char(start) >= MIN_CHARS
        self.slice, self.text, self.number, self.start, self.end = s, text[long], number[long], start[long], end[long]

    def char(self, at: np.ndarray) -> np.ndarray:
        """Number of characters before some bytes."""
        return at - np.searchsorted(self.inner, at) if len(self.inner) else at

    @cached_property
    def digest(self) -> np.ndarray:
        """128 bits of each line, as two numbers."""
        raw = self.slice.data.tobytes()
        return np.frombuffer(b"".join([blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(self.start.tolist(), self.end.tolist(), strict=True)]),
                             np.uint64).reshape(-1, 2)

    @cached_property
    def h1(self) -> np.ndarray:
        return np.ascontiguousarray(self.digest[:, 0])

    @cached_property
    def h2(self) -> np.ndarray:
        return np.ascontiguousarray(self.digest[:, 1])

    def _windows(self, rows: np.ndarray, mul: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A number of every shingle of some lines one after another, in the type of ``mul``, and how many a line has."""
        code = np.frombuffer(self.slice.data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4") if len(self.inner) else self.slice.data
        g = code.astype(mul.dtype) + mul.dtype.type(1)
        for k, step in enumerate((1, 2, 4)):  # of 2, 4 and 8 characters
            g = g[:-step] * mul[2 * k] + g[step:] * mul[2 * k + 1]
        first = self.char(self.start[rows])
        n = self.char(self.end[rows]) - first - (SHINGLE - 1)
        at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return g[at], n

    def shingles(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shingle hashes (with repeats) of some lines one after another, and their numbers."""
        g, n = self._windows(rows, _MUL)
        return textkit.mix(g), n

    def signatures(self, rows: np.ndarray) -> np.ndarray:
        """MinHash signatures of some lines, a row each; there is at least one."""
        x, n = self._windows(rows, _MUL32)
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(13)
        x *= np.uint32(0xC2B2AE35)
        x ^= x >> np.uint32(16)
        begin, value, out = np.cumsum(n) - n, np.empty_like(x), np.empty((len(_HASH), len(n)), np.uint32)
        for c, m in enumerate(_HASH):
            np.multiply(x, m, out=value)
            np.minimum.reduceat(value, begin, out=out[c])
        return out.T


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band, BANDS in a row."""
    rows = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    out = np.broadcast_to(_BAND, rows.shape[:2])
    for r in range(ROWS):
        out = textkit.mix(out + rows[:, :, r])
    return out


def _parts(to: np.ndarray) -> list[tuple[int, int]]:
    """Ends of the runs of equal values."""
    cut = np.concatenate([[0], np.flatnonzero(to[1:] != to[:-1]) + 1, [len(to)]]) if len(to) else np.zeros(1, np.int64)
    return list(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True))


def _stars(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted postings without repeats: key, node, and the smallest node of the key."""
    order = np.argsort(key)
    key, node = key[order], node[order]
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[1:] == key[:-1]
    often = np.flatnonzero(same[1:] | same[:-1])  # only keys with several postings need their nodes in order
    node[often] = node[often[np.lexsort((node[often], key[often]))]]
    new = np.ones(len(key), bool)
    new[1:] = ~same[1:-1] | (node[1:] != node[:-1])
    key, node = key[new], node[new]
    begin = np.ones(len(key), bool)
    begin[1:] = key[1:] != key[:-1]
    return key, node, node[np.flatnonzero(begin)[np.cumsum(begin) - 1]]


def _post(groups: int):
    """Packed postings of each batch by group. Lines of one batch that share a band meet here: only their hub is sent on under the band's key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, nodes = [], []
            for s in textkit.slices(batch.column("text"), SLICE_BYTES):
                own = Lines(s)
                _, first = np.unique(own.h1, return_index=True)
                if len(first):
                    first.sort()
                    keys.append(band_keys(own.signatures(first)).ravel())
                    nodes.append(np.repeat(own.h1[first], BANDS))
            if not keys:
                continue
            key, node, hub = _stars(np.concatenate(keys), np.concatenate(nodes))
            pairs = node != hub
            # Hubs go to the group of their band's key, the lines that follow them to any.
            for kind, on, to in ((0, ~pairs, key), (1, pairs, node)):
                to, a, b = (to[on] % np.uint64(groups)).astype(np.min_scalar_type(groups)), key[on], node[on]
                order = np.argsort(to, kind="stable")
                to, a, b = to[order], a[order], b[order]
                c = hub[on][order] if kind else b[:0]
                part = _parts(to)
                if part:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(to[i]) for i, _ in part]), pa.array([kind] * len(part), pa.int32()),
                         *(pa.array([x[i:j].tobytes() for i, j in part], pa.binary()) for x in (a, b, c))],
                        ["grp", "kind", "posting", "node", "hub"])
    return run


def _meet(table: pa.Table) -> pa.Table:
    """Candidate pairs of a group with the band's key: hubs that share it, and the pairs found before."""
    kind = table.column("kind").to_numpy()

    def joined(name: str, k: int) -> np.ndarray:
        return np.frombuffer(b"".join(x for x, y in zip(table.column(name).to_pylist(), kind, strict=True) if y == k), np.uint64)

    key, node, hub = _stars(joined("posting", 0), joined("node", 0))
    far = node != hub
    cols = [np.concatenate(x) for x in ((key[far], joined("posting", 1)), (hub[far], joined("hub", 1)), (node[far], joined("node", 1)))]
    return pa.table([pa.array(x.view(np.int64)) for x in cols], ["posting", "a", "b"])


def candidate_stars(docs: DataFrame, text_bytes: int) -> DataFrame:
    """``posting``, ``a``, ``b``: every band that two or more distinct lines share, as pairs of a hub and a line that connect them."""
    groups = max(64, -(-text_bytes // GROUP_BYTES))
    packed = docs.select("text").mapInArrow(_post(groups), "grp long, kind int, posting binary, node binary, hub binary")
    return packed.groupBy("grp").applyInArrow(_meet, "posting long, a long, b long")


def _first_places(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Of rows with ``h1``, ``h2``, ``doc_id``, ``version``, ``line``: the first of each (h1, h2), and those that come after a first one."""
    h1 = rows.column("h1").to_numpy()
    order = np.argsort(h1)
    same = np.zeros(len(h1) + 1, bool)
    same[1:-1] = h1[order[1:]] == h1[order[:-1]]
    often = same[1:] | same[:-1]  # only these need to be put in order
    alone, often = order[~often], order[often]
    if not len(often):
        return alone, often
    some = rows.take(pa.array(often))
    at = pc.sort_indices(some, sort_keys=[(c, "ascending") for c in ("h1", "h2", "doc_id", "version", "line")], null_placement="at_start").to_numpy()
    some, often = some.take(pa.array(at)), often[at]
    h1, h2, version, line = (some.column(c).to_numpy() for c in ("h1", "h2", "version", "line"))
    doc = some.column("doc_id").dictionary_encode("encode").indices.to_numpy()
    new = np.ones(len(often), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    # A copy of the whole document has the same place and shares its fate.
    after = (doc != doc[first]) | (version != version[first]) | (line != line[first])
    return np.concatenate([alone, often[new]]), often[after]


def _class_group(h1: np.ndarray, groups: int) -> np.ndarray:
    return (h1.view(np.uint64) >> np.uint64(33)).astype(np.int64) % groups


def class_group(node: Column, groups: int) -> Column:
    """The group of a line's class, by its hash."""
    return F.shiftrightunsigned(node, 33) % groups


def read_lines(docs: DataFrame, wanted: DataFrame, groups: int) -> DataFrame:
    """What one more reading of the texts gives, in rows of three kinds.

    Packed lines, one of each class in a batch (``grp``, ``packed``: h1, h2, version and number, ``ids``: their documents);
    the places that come later in the batch (``doc_id``, ``version``, ``line``), which go in any case; texts of the wanted
    lines, ``key`` and ``items`` (the text). A bitmap of fixed size keeps most other lines from being
    unpacked. Texts, not sets, are moved: those are eight times as large.
    """
    bits = neardup.bitmap(wanted.select(F.col("key").bitwiseAND(F.lit(neardup.SLOTS - 1))))
    slots = np.uint64(neardup.SLOTS - 1)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"grp long, packed binary, ids array<{kind}>, key long, items string, doc_id {kind}, version long, line long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            types = {"grp": pa.int64(), "packed": pa.binary(), "ids": pa.list_(id_type), "key": pa.int64(), "items": pa.string(),
                     "doc_id": id_type, "version": pa.int64(), "line": pa.int64()}

            def rows(n: int, types=types, **given) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([given[c] if c in given else pa.nulls(n, t) for c, t in types.items()], list(types))

            h1, h2, text, number, keys, items = [], [], [], [], [], []
            for s in textkit.slices(batch.column("text"), SLICE_BYTES):
                own = Lines(s)
                h1.append(own.h1)
                h2.append(own.h2)
                text.append(own.text + s.lo)
                number.append(own.number)
                slot = (own.h1 & slots).astype(np.int64)
                on = np.flatnonzero(bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
                raw = s.data.tobytes()
                keys.append(own.h1[on])
                items += [raw[a:b] for a, b in zip(own.start[on].tolist(), own.end[on].tolist(), strict=True)]
            if not h1 or not sum(map(len, h1)):
                continue
            h1, text = np.concatenate(h1), pa.array(np.concatenate(text))
            places = pa.RecordBatch.from_arrays(
                [pa.array(h1), pa.array(np.concatenate(h2)), batch.column("doc_id").take(text), batch.column("version").take(text), pa.array(np.concatenate(number))],
                ["h1", "h2", "doc_id", "version", "line"])
            keep, after = _first_places(places)
            group = _class_group(h1[keep], groups)
            order = np.argsort(group, kind="stable")
            group, own = group[order], places.take(pa.array(keep[order]))
            part = _parts(group)
            flat = np.column_stack([own.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2", "version", "line")])
            yield rows(len(part), grp=pa.array([int(group[i]) for i, _ in part]), packed=pa.array([flat[i:j].tobytes() for i, j in part], pa.binary()),
                       ids=pa.ListArray.from_arrays(pa.array([0, *(j for _, j in part)], pa.int32()), own.column("doc_id")))
            gone = places.take(pa.array(after))
            yield rows(gone.num_rows, **{c: gone.column(c) for c in ("doc_id", "version", "line")})
            key, first = np.unique(np.concatenate(keys), return_index=True)
            yield rows(len(key), key=pa.array(key.view(np.int64)), items=pa.array([items[i] for i in first.tolist()], pa.binary()).cast(pa.string()))

    return docs.mapInArrow(run, schema)


def _settle(lines: pa.Table, label: pa.Table) -> pa.Table:
    """Of one group of classes: the first place of the component's lines here (with ``root``), and the places that go (without)."""
    lines = lines.combine_chunks()
    flat = np.frombuffer(b"".join(lines.column("packed").to_pylist()), np.uint64).reshape(-1, 4)
    h1, h2, version, line = (np.ascontiguousarray(flat[:, k]).view(np.int64) for k in range(4))
    names = ["h1", "h2", "doc_id", "version", "line"]
    doc_id = pc.list_flatten(lines.column("ids")).combine_chunks() if len(h1) else pa.array([], lines.schema.field("ids").type.value_type)
    rows = pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), doc_id, pa.array(version), pa.array(line)], names)
    keep, after = _first_places(rows)
    node, root = (label.column(c).to_numpy() for c in ("node", "root"))
    order = np.argsort(node)
    node, root = node[order], root[order]
    at = np.searchsorted(node, h1[keep])
    linked = np.zeros(len(keep), bool)
    linked[at < len(node)] = node[at[at < len(node)]] == h1[keep][at < len(node)]
    keep, root = keep[linked], root[at[linked]]
    own = rows.take(pa.array(keep)).set_column(0, "h1", pa.array(root)).set_column(1, "h2", pa.array(np.zeros(len(root), np.int64)))
    first, later = _first_places(own)
    stay, gone = own.take(pa.array(first)), [rows.take(pa.array(after)), own.take(pa.array(later))]
    gone = pa.Table.from_batches(gone).select(names[2:])
    out = pa.Table.from_batches([stay]).select(["h1", *names[2:]]).rename_columns(["root", *names[2:]])
    return pa.concat_tables([out, gone.add_column(0, "root", pa.nulls(gone.num_rows, pa.int64()))]).combine_chunks()


def dropped_places(found: DataFrame, label: DataFrame, groups: int) -> DataFrame:
    """``doc_id``, ``version``, ``line`` of the places that go: all of a class or a component but the first."""
    place = ["doc_id", "version", "line"]
    packed = found.filter("packed is not null").select("grp", "packed", "ids")
    label = label.select(class_group(F.col("node"), groups).alias("grp"), "node", "root")
    kind = found.schema["doc_id"].dataType.simpleString()
    settled = written(packed.groupBy("grp").cogroup(label.groupBy("grp")).applyInArrow(
        _settle, f"root long, doc_id {kind}, version long, line long"), "line-places")
    firsts = settled.filter("root is not null")
    stays = firsts.groupBy("root").agg(F.min(F.struct(*place)).alias("stays"), F.count(F.lit(1)).alias("all")).filter("all > 1").select("root", "stays")
    later = firsts.join(stays, "root").filter(~F.struct(*place).eqNullSafe(F.col("stays")))
    return found.filter("line is not null").select(*place).union(settled.filter("root is null").select(*place)).union(later.select(*place))


def _sets(flat: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    out = []
    ends = np.cumsum(n)
    for b, k in zip(ends.tolist(), n.tolist(), strict=True):
        x = flat[b - k:b]
        x.sort()
        new = x[1:] != x[:-1]
        out.append(x if new.all() else np.concatenate([x[:1], x[1:][new]]))
    return out


def sets_of(lines: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingles of each line."""
    out: list[np.ndarray] = []
    for s in textkit.slices(lines, SLICE_BYTES):
        own = Lines(s)
        out += _sets(*own.shingles(np.arange(len(own.text))))
    return out


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sets."""
    both = np.concatenate([x, y])
    both.sort()
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _similar(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A hub is in many pairs of a batch; its set is made once.
            both = pa.concat_arrays([batch.column("ia"), batch.column("ib")]).dictionary_encode()
            sets, code = sets_of(both.dictionary), both.indices.to_numpy()
            keep = []
            for i, j in zip(code[:batch.num_rows].tolist(), code[batch.num_rows:].tolist(), strict=True):
                x, y = sets[i], sets[j]
                # Sets whose sizes are too far apart need no comparison.
                keep.append(100 * min(len(x), len(y)) >= percent * max(len(x), len(y))
                            and neardup.enough(_common(x, y), len(x), len(y), percent))
            on = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(on), batch.column("b").filter(on)], ["a", "b"])
    return run


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets are similar enough."""
    near = pairs.join(texts.toDF("a", "ia"), "a").join(texts.toDF("b", "ib"), "b")
    return near.select("a", "b", "ia", "ib").mapInArrow(_similar(percent), "a long, b long")


def open_lists(stars: DataFrame, links: DataFrame) -> DataFrame:
    """Members of the bands of three or more lines that the links leave in several components:
    ``posting``, ``key``, ``comp``, ``members`` (of the band)."""
    comp = connected_components(links).toDF("key", "comp")
    # A band with one pair has two lines.
    often = stars.groupBy("posting").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("posting")
    stars = stars.join(often, "posting", "left_semi")
    lists = written(stars.select("posting", F.explode(F.array("a", "b")).alias("key")).distinct(), "band-lists")
    many = lists.groupBy("posting").agg(F.count(F.lit(1)).alias("members")).filter("members > 2")
    lists = lists.join(many, "posting").join(comp, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    still = lists.groupBy("posting").agg((F.min("comp") != F.max("comp")).alias("still")).filter("still").select("posting")
    return written(lists.join(still, "posting", "left_semi").select("posting", "key", "comp", "members"), "open-bands")


def _as_bytes(name: str) -> Column:
    return F.unhex(F.lpad(F.hex(name), 16, "0"))


def _as_long(name: str) -> Column:
    return F.conv(F.hex(name), 16, -10).cast("long")


def line_links(stars: DataFrame, pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Root of every line (by hash) that is linked with another one: ``node``, ``root``.

    First every band compares its lines with one hub. What that leaves unconnected inside a band is compared in full:
    in bands of up to SMALL_BAND lines pair by pair, in larger ones in tiles.
    """
    links = written(confirmed(pairs, texts, percent), "line-links")
    lists = open_lists(stars, links)
    small = lists.filter(F.col("members") <= SMALL_BAND)
    both = small.toDF("posting", "a", "ca", "ma").join(small.toDF("posting", "b", "cb", "mb"), "posting").filter("a < b and ca <> cb").select("a", "b").distinct()
    tested = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = links.union(written(confirmed(both.join(tested, ["a", "b"], "left_anti"), texts, percent), "line-links-in-bands"))
    # The tiles name their members by bytes.
    large = lists.filter(F.col("members") > SMALL_BAND).join(texts.select("key", F.length("items").alias("n")), "key")
    large = written(large.select(_as_bytes("key").alias("key"), "n", F.col("posting").alias("group"), _as_bytes("comp").alias("comp")), "large-bands")
    sets = texts.select(_as_bytes("key").alias("key"), "items").join(large.select("key").distinct(), "key", "left_semi")
    more = written(neardup.tile_links(large, sets, percent, sets_of), "line-tiles")
    return connected_components(links.union(more.select(_as_long("a").alias("a"), _as_long("b").alias("b"))))


def _without(s: textkit.Slice, drops: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts of a slice without some lines, and how many each text has."""
    text, _, start, end = textkit.lines(s)
    kept = np.ones(len(text), bool)
    of = np.repeat(np.arange(len(s)), drops.value_lengths().fill_null(0).to_numpy())
    kept[np.searchsorted(text, of) + drops.flatten().to_numpy()] = False
    # The \n after a line stays if the line and a later one of the text do.
    breaks, own = kept.copy(), np.flatnonzero(kept)
    breaks[own[np.append(text[own[1:]] != text[own[:-1]], True)] if len(own) else own] = False
    follows = np.append(text[1:] == text[:-1], False).astype(np.int64)
    data = s.data[np.repeat(np.column_stack([kept, breaks]).ravel(), np.column_stack([end - start, follows]).ravel())]
    return data, np.bincount(text, np.where(kept, end - start, 0) + breaks * follows, len(s)).astype(np.int64)


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        texts, drops = batch.column("text"), batch.column("dropped_lines")
        data, ends, at = np.empty(pc.sum(pc.binary_length(texts)).as_py() or 0, np.uint8), np.zeros(len(texts) + 1, np.int64), 0
        for s in textkit.slices(texts, SLICE_BYTES):
            left, n = _without(s, drops.slice(s.lo, len(s)))
            ends[s.lo + 1:s.hi + 1] = at + np.cumsum(n)
            data[at:at + len(left)] = left
            at += len(left)
        valid = pa.array(texts.is_valid()).buffers()[1] if texts.null_count else None
        got = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(ends), pa.py_buffer(data[:at]), valid).cast(texts.type)
        yield batch.set_column(names.index("text"), "text", got)


def deduplicate_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without the lines that equal or nearly equal an earlier one.

    Lines are split at \\n and compared without outer white space; lines of fewer than
    MIN_CHARS characters always stay. Two lines are linked if the Jaccard
    similarity of their sets of distinct character shingles is at least ``percent``.
    Of a component the line stays that is first by ``doc_id`` (null first), text hash and place.
    Returns all columns of ``docs``, with the new ``text``, and ``dropped_lines``
    (array of line numbers from 0, null if none).

    A null text stays null, an empty one empty. Rows that repeat a document
    whole count as one and all keep what that one keeps. Other columns pass through whatever their
    names, but for ``dropped_lines``, which is replaced. An empty table gives an empty result.
    """
    columns = [c for c in docs.columns if c != "dropped_lines"]
    docs = docs.select("doc_id", "text", packed(docs, ("text", "dropped_lines")).alias("row"))
    version = F.xxhash64("text")
    text_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    stars = written(candidate_stars(docs, text_bytes), "line-stars")
    pairs = written(stars.select("a", "b").distinct(), "line-pairs")
    nodes = written(pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct(), "line-nodes")
    groups = max(8, -(-text_bytes // CLASS_BYTES))
    found = written(read_lines(docs.select("doc_id", "text", version.alias("version")), nodes, groups), "lines")
    texts = found.filter("key is not null").select("key", "items").join(nodes, "key", "left_semi")
    texts = written(texts.groupBy("key").agg(F.first("items").alias("items")), "line-texts")
    places = dropped_places(found, line_links(stars, pairs, texts, percent), groups)
    drops = (places.groupBy("doc_id", "version").agg(F.sort_array(F.collect_set("line")).alias("dropped_lines"))
             .toDF("drop_doc_id", "drop_version", "dropped_lines"))
    both = docs.join(drops.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(F.col("drop_doc_id")) & (version == F.col("drop_version")), "left")
    both = both.select("text", "row", "dropped_lines")
    return both.mapInArrow(_rebuild, both.schema).select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in columns], "dropped_lines")


def without_copied_lines(docs: DataFrame, **options) -> DataFrame:
    """The documents after line deduplication, with the columns of ``docs``; ``n_chars``, if there is one, follows a changed text.

    A document that loses all its visible text this way goes: all of it stays elsewhere. Null and empty texts
    stay as they are; all other columns pass through whatever their names (a ``dropped_lines`` of ``docs`` too); an empty
    table gives an empty result; texts are read whole at any length.
    """
    got = deduplicate_lines(docs.select("doc_id", "text", packed(docs, ("text",)).alias("given")), **options)
    got = got.filter(F.col("dropped_lines").isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    given = {c: F.col("given")[c] for c in docs.columns if c != "text"} | {"text": F.col("text")}
    if "n_chars" in given:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        given["n_chars"] = F.when(F.col("dropped_lines").isNotNull(), size).otherwise(given["n_chars"])
    return got.select(*[given[c].alias(c) for c in docs.columns])

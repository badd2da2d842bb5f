"""Source divergence audit: how much the vocabularies of the sources of a language differ.

Terms of a language get numbers within blocks of bounded size. A pair task
co-groups the sorted (term number, count) arrays of the sources in one block
and merges them per unordered pair: the shorter array gallops through the
longer one, which prices the overlaps, the terms of only one side, and by their
number the terms of neither, in both directions. Sums over the blocks are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm import terms, textkit
from ordermill.llm.store import beside, written

#: Documents of a language that must hold a term.
MIN_DOCUMENTS = 3
#: Ranks of single terms that are reported for a group.
TOP_TERMS = 200
SCALE = 1_000_000_000
#: Texts are counted in slices of so many bytes.
COUNT_BYTES = 4 << 20
#: A block has about so many (term, source) counts, a tile about so many sources.
BLOCK_COUNTS = 1 << 15
TILE_SOURCES = 64
PAIRS = ["lang", "a", "b", "there", "back", "n_union", "p_a", "p_b", "v"]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["lang", "source", "term", "n_docs", "n"]
    for batch in batches:
        if not batch.num_rows:
            continue
        lang, source = (batch.column(c).fill_null("").dictionary_encode() for c in ("lang", "source"))
        code = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        groups, group = np.unique(code, return_inverse=True)

        def rows(group_of, term, n_docs, n):
            own = groups[group_of]
            return pa.RecordBatch.from_arrays(
                [lang.dictionary.take(pa.array(own // len(source.dictionary))).cast(pa.string()), source.dictionary.take(pa.array(own % len(source.dictionary))).cast(pa.string()),
                 term, pa.array(n_docs, pa.int64()), pa.array(n, pa.int64())], names)

        every = np.arange(len(groups))  # groups without terms count too
        yield rows(every, pa.nulls(len(every), pa.string()), 0 * every, 0 * every)
        for s in textkit.slices(batch.column("text"), COUNT_BYTES):
            text, word = terms.words(s, terms.LETTERS)
            coded = word.dictionary_encode()
            k = max(len(coded.dictionary), 1)
            pair, times = np.unique(text * k + coded.indices.to_numpy(), return_counts=True)  # a document's terms
            key = group[s.lo + pair // k] * k + pair % k
            own, at = np.unique(key, return_inverse=True)
            yield rows(own // k, coded.dictionary.take(pa.array(own % k)).cast(pa.string()), np.bincount(at, minlength=len(own)),
                       np.bincount(at, times, minlength=len(own)).astype(np.int64))


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n_docs``, ``n``: documents and occurrences of each term in each group; a row with a null term per group."""
    part = docs.select("lang", "source", "text").mapInArrow(_count, "lang string, source string, term string, n_docs long, n long")
    return part.groupBy("lang", "source", "term").agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("n"))


def kept_terms(counts: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Counts of the kept terms with ``block``, ``number`` (from 0 in a block, by term) and the language's count ``lang_n``; ``first`` marks one row of each term."""
    sizes = written(counts.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / BLOCK_COUNTS).alias("blocks")), "sizes")
    rows = (counts.filter("term is not null").join(beside(sizes), "lang")
            .withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks"))).repartition("lang", "block"))
    same = Window.partitionBy("lang", "block", "term")
    rows = rows.select("*", F.sum("n_docs").over(same).alias("lang_docs"), F.sum("n").over(same).alias("lang_n"), F.min("source").over(same).alias("least"))
    number = F.dense_rank().over(Window.partitionBy("lang", "block").orderBy("term")) - 1
    return (rows.filter(F.col("lang_docs") >= min_documents)
            .select("lang", "block", "source", "term", number.alias("number"), "n", "lang_n", (F.col("source") == F.col("least")).alias("first")))


def price(n: Column, total: Column) -> Column:
    """p of ``n`` occurrences, where ``total`` is the group's count and the number of kept terms."""
    wide = (n + 1).cast("decimal(20,0)") * F.lit(SCALE)
    return 1 + F.call_function("div", wide, total.cast("decimal(20,0)"))


def chi(p: Column, q: Column) -> Column:
    """Value of p against q; p is at most 1,000,000,001, so the square fits."""
    return F.call_function("div", (p - q) * (p - q), q)


def _merge(a: tuple, b: tuple) -> tuple[int, int, int]:
    """Both directions' values over the terms that either of two sources has in a block, and how many those are.

    A source is its sorted term numbers, their p, and the p of a term that it does not have.
    """
    swap = len(a[0]) > len(b[0])
    (x, p, p0), (y, q, q0) = (b, a) if swap else (a, b)
    at = np.searchsorted(y, x)  # the shorter gallops through the longer
    hit = np.zeros(len(x), bool)
    inside = at < len(y)
    hit[inside] = y[at[inside]] == x[inside]
    lone = np.ones(len(y), bool)
    lone[at[hit]] = False
    there, back = _value(p[hit], q[at[hit]])
    for own, other in ((p[~hit], np.full(len(x) - int(hit.sum()), q0)), (np.full(int(lone.sum()), p0), q[lone])):
        one, two = _value(own, other)
        there, back = there + one, back + two
    union = len(x) + int(lone.sum())
    return (back, there, union) if swap else (there, back, union)


def _value(p: np.ndarray, q: np.ndarray) -> tuple[int, int]:
    square = (p - q) * (p - q)
    return int((square // q).sum()), int((square // p).sum())


def prices(n: np.ndarray, total: int | np.ndarray) -> np.ndarray:
    """p of counts, by long division in steps of a thousand, so that nothing overflows below 9e15 words."""
    out, rest = np.divmod(n + 1, total)
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return out + 1


def _pairs(table: pa.Table) -> pa.Table:
    """Merges of one block: tile ``i`` with tile ``j`` of a language's sources."""
    got = []
    if table.num_rows:
        table = table.sort_by("source").combine_chunks()
        lang, i, j = (table.column(c)[0].as_py() for c in ("lang", "i", "j"))
        name, tile, total = table.column("source").to_pylist(), table.column("tile").to_pylist(), table.column("total").to_pylist()
        entries = table.column("entries").combine_chunks()
        offsets, flat = entries.offsets.to_numpy(), entries.values
        number, n = (flat.field(k).to_numpy() for k in ("number", "n"))
        v = table.column("v")[0].as_py()
        none = prices(np.zeros(len(name), np.int64), np.maximum(np.array(total), 1))
        side = [(number[a:b], prices(n[a:b], t), p0) for a, b, t, p0 in zip(offsets[:-1], offsets[1:], total, none, strict=True)]
        got = [(lang, name[x], name[y], *_merge(side[x], side[y]), int(none[x]), int(none[y]), v) for x in range(len(name)) for y in range(x + 1, len(name))
               if {tile[x], tile[y]} == {i, j}]
    columns = list(zip(*got, strict=True)) or [[]] * len(PAIRS)
    return pa.table([pa.array(c, t) for c, t in zip(columns, [pa.string()] * 3 + [pa.int64()] * 6, strict=True)], PAIRS)


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """Divergence of every (lang, source) group: ``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``.

    ``docs`` needs ``text``, ``lang``, ``source`` (strings, null counts as empty); other columns are ignored, so
    clashing names cannot occur. Terms are runs of letters (any character beyond ASCII is one), A-Z lower-cased;
    a language keeps those in at least ``min_documents`` of its documents, repeated rows counting each.
    Part ``pair`` has a row for each other source of the language with the value summed over all kept terms (0
    without any), part ``term`` the ``top`` kept terms that the group uses more than its language. Ties go to the smaller item in UTF-8
    order. A language of one source has no pairs; an empty table gives an empty result. Texts are read whole at any length.
    """
    counts = written(term_counts(docs), "counts")
    kept = written(kept_terms(counts, min_documents), "terms")
    langs = kept.groupBy("lang").agg(F.count_if("first").alias("v"), F.sum(F.when(F.col("first"), F.col("lang_n"))).alias("lang_total"),
                                     (F.max("block") + 1).alias("blocks"))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("own_total"))
    zero = F.lit(0).cast("long")
    groups = (counts.filter("term is null").select("lang", "source").join(own, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", F.coalesce("own_total", zero).alias("own_total"), F.coalesce("v", zero).alias("v"),
                      F.coalesce("lang_total", zero).alias("lang_total"), F.coalesce("blocks", F.lit(1).cast("long")).alias("blocks")))
    per_lang = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / TILE_SOURCES).alias("tiles"))
    groups = written(groups.join(per_lang, "lang").withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles"))), "groups")
    return pair_part(kept, groups).unionByName(term_part(kept, groups, top))


def pair_part(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of part ``pair``: merges per block and tile pair, summed over the blocks."""
    arrays = kept.groupBy("lang", "block", "source").agg(F.array_sort(F.collect_list(F.struct("number", "n"))).alias("entries"))  # a block's at most
    places = groups.select("lang", "source", "tile", "tiles", "v", (F.col("own_total") + F.col("v")).alias("total"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    none = F.array().cast("array<struct<number:int,n:bigint>>")
    full = (places.join(arrays, ["lang", "block", "source"], "left").withColumn("entries", F.coalesce("entries", none))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
            .select("lang", "block", "source", "tile", "v", "total", "entries", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j")))
    merged = full.groupBy("lang", "block", "i", "j").applyInArrow(_pairs, ", ".join(c + (" long" if k > 2 else " string") for k, c in enumerate(PAIRS)))
    sums = merged.groupBy("lang", "a", "b").agg(*[F.sum(c).alias(c) for c in ("there", "back", "n_union")], F.first("p_a").alias("p_a"), F.first("p_b").alias("p_b"), F.first("v").alias("v"))
    both = sums.select("lang", F.explode(F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item"), (F.col("there") + (F.col("v") - F.col("n_union")) * chi(F.col("p_a"), F.col("p_b"))).alias("value")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item"), (F.col("back") + (F.col("v") - F.col("n_union")) * chi(F.col("p_b"), F.col("p_a"))).alias("value")))).alias("x"))
    return _ranked(both.select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "x.value"))


def term_part(kept: DataFrame, groups: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """Rows of part ``term``."""
    p, q = price(F.col("n"), F.col("own_total") + F.col("v")), price(F.col("lang_n"), F.col("lang_total") + F.col("v"))
    rows = kept.select("lang", "source", "term", "n", "lang_n").join(beside(groups.select("lang", "source", "own_total", "v", "lang_total")), ["lang", "source"])
    rows = rows.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), p.alias("p"), q.alias("q")).filter("p > q")
    return _ranked(rows.select("lang", "source", "part", "item", chi(F.col("p"), F.col("q")).alias("value"))).filter(F.col("rank") <= top)


def _ranked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))

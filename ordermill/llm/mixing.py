"""Mixing sources to target weights with exact block quotas per output shard.

1. Each source gets a target size by weight, at most ``MAX_REPEAT`` times its
   own size; what that cuts off goes to the others by weight.
2. Each source is put in a random order and cut where its target is reached,
   so a document is taken 0 to 3 times.
3. What is taken is laid out in blocks. A splitting tree deals the block
   quotas of all sources out to the shards: every node sends a
   multivariate-hypergeometric draw of its blocks to its left half.
4. Every shard draws its own runs of blocks of the (already permuted) sources
   and shuffles them locally by hash.

Everything is DataFrame expressions; the tree has a row per node.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.store import packed, written

#: Largest number of times that a document may be taken.
MAX_REPEAT = 3
#: Weights of the sources by rank, repeating.
WEIGHTS = (1, 2, 3)
#: Java pattern of a word.
WORD = r"[^\x20\x09-\x0D]+"
#: A document of more than 1/COARSE of its source is placed before the small ones.
COARSE = 200
#: About so many documents share a bucket of the random order.
BUCKET_DOCS = 2000
SHARDS = 16
#: ``mix_documents`` deals to more shards where one would hold more than so many words of the input (about 200 MB).
SHARD_WORDS = 1 << 25
BLOCK_WORDS = 50_000
SEED = 7


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source`` and ``size`` (words of the whole text; null: 0) of every row."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Target of each source: ``source``, ``source_size``, ``target``.

    ``sizes`` has ``source`` and ``size``. The weights go to the sources by
    code point, null last. A source is capped if its cap over its weight is
    below what the uncapped ones get for a unit of weight.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.select("source", "source_size", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")).cast("long").alias("w"))
    by_room = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    room = (per.withColumn("rest", F.sum("source_size").over(every) - MAX_REPEAT * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
            .withColumn("rest_w", F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0))))
    # Uncapped from the first source on whose cap holds its share; the shares only grow until there.
    fits = F.col("rest") * F.col("w") <= MAX_REPEAT * F.col("source_size") * F.col("rest_w")
    first = room.filter(fits).agg(F.min(F.struct(F.col("source_size") / F.col("w"), F.col("source").isNull(), "source", "rest", "rest_w")).alias("l"))
    level = first.select(F.struct("l.rest", "l.rest_w")).scalar()
    share = F.col("w") * level["rest"]
    cap = MAX_REPEAT * F.col("source_size")
    return per.select("source", "source_size",
                      F.when(share >= cap * level["rest_w"], cap.cast("double")).otherwise(share.cast("double") / level["rest_w"].cast("double")).alias("target"))


def _running(units: DataFrame) -> DataFrame:
    """``before``: the size of all units of the same line (``source``, ``coarse``) that come earlier in the random order.

    The order is cut in buckets of a bounded number of units, so that no task gets a whole source.
    """
    line = ["source", "coarse"]
    count = units.groupBy(*line).agg(F.ceil(F.count(F.lit(1)) / BUCKET_DOCS).alias("n_buckets"))
    # 48 bits of the order's key pick the bucket.
    place = F.conv(F.substring("key", 1, 12), 16, 10).cast("long")
    at = units.join(count, [units.source.eqNullSafe(count.source), units.coarse == count.coarse]).select(
        units["*"], F.floor(place * F.col("n_buckets") / F.lit(2.0 ** 48)).alias("bucket"))
    at = written(at, "mix-buckets")
    totals = at.groupBy(*line, "bucket").agg(F.sum("weight").alias("total"))
    ahead = Window.partitionBy(*line).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*line, "bucket", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("bucket_before")).toDF("s2", "c2", "b2", "bucket_before")
    inside = Window.partitionBy(*line, "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    return (at.withColumn("inside", F.coalesce(F.sum("weight").over(inside), F.lit(0)))
            .join(totals, F.col("source").eqNullSafe(F.col("s2")) & (F.col("coarse") == F.col("c2")) & (F.col("bucket") == F.col("b2")))
            .select(*units.columns, (F.col("inside") + F.col("bucket_before")).alias("before")))


def plan(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """How often each document is taken.

    ``sizes``: ``doc_id``, ``source``, ``size``. Rows that agree in all three
    are one unit and are taken alike. Returns a row per unit: ``doc_id``,
    ``source``, ``size``, ``rows`` (of the unit), ``source_size``, ``target``,
    ``copies`` (0 to 3), ``before`` (position in the source's random order).
    """
    units = (sizes.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
             .withColumn("weight", F.col("size") * F.col("rows"))
             .withColumn("key", F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("size").cast("string")))))
    goal = written(targets(sizes, weights), "mix-targets")
    own = goal.toDF("gs", "source_size", "target")
    units = (units.join(own, F.col("source").eqNullSafe(F.col("gs"))).drop("gs")
             .withColumn("coarse", F.col("weight") * COARSE > F.col("source_size")))
    line = written(_running(units), "mix-order")

    def copies(goal_of_line: Column, line_size: Column) -> Column:
        """Whole passes over the line, and once more the units whose middle lies before the cut."""
        passes = F.when(line_size > 0, F.least(F.floor(goal_of_line / line_size), F.lit(MAX_REPEAT))).otherwise(F.lit(0))
        cut = goal_of_line - passes * line_size
        more = (F.col("before") + F.col("weight") / 2.0 < cut) & (passes < MAX_REPEAT)
        return (passes + more.cast("long")).cast("long")

    # Large documents first, by their share of the target; the small ones make up for what those miss.
    large = line.filter("coarse").groupBy("source").agg(F.sum("weight").alias("large_size")).toDF("ls", "large_size")
    big = (line.filter("coarse").join(large, F.col("source").eqNullSafe(F.col("ls"))).drop("ls")
           .withColumn("copies", copies(F.col("target") * F.col("large_size") / F.col("source_size"), F.col("large_size"))))
    got = big.groupBy("source").agg(F.sum(F.col("copies") * F.col("weight")).alias("large_taken"), F.max("large_size").alias("large_size")).toDF("ls", "large_taken", "large_size")
    small = (line.filter("not coarse").join(got, F.col("source").eqNullSafe(F.col("ls")), "left")
             .withColumn("copies", copies(F.greatest(F.col("target") - F.coalesce("large_taken", F.lit(0)), F.lit(0.0)),
                                          F.col("source_size") - F.coalesce("large_size", F.lit(0)))))
    # On the source's line the large documents lie first.
    small = small.withColumn("before", F.col("before") + F.coalesce("large_size", F.lit(0)))
    cols = ["doc_id", "source", "size", "rows", "source_size", "target", "copies", "before"]
    return big.select(*cols).unionByName(small.select(*cols))


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / F.lit(float(1 << 52))


def hypergeometric(u: Column, population: Column, marked: Column, draws: Column) -> Column:
    """Number of marked items among ``draws`` from ``population``, by inversion of ``u`` in [0, 1).

    The weights of the possible numbers follow from the ratio of neighbours;
    numbers over 12 standard deviations from the mean are left out. The result always lies in
    max(0, draws + marked - population) to min(marked, draws).
    """
    n, k, c = (x.cast("double") for x in (population, marked, draws))
    mean = F.when(n > 0, c * k / n).otherwise(F.lit(0.0))
    spread = F.when(n > 1, F.sqrt(mean * (1 - k / n) * (n - c) / (n - 1))).otherwise(F.lit(0.0)) * 12 + 8
    low = F.greatest(F.lit(0.0), c + k - n, F.floor(mean - spread)).cast("long")
    high = F.least(k, c, F.ceil(mean + spread)).cast("long")
    start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
    grow = lambda w, x: w * (k - x) * (c - x) / ((x + 1) * (n - k - c + x + 1))
    total = F.aggregate(F.sequence(low, high), start, lambda a, x: F.struct(
        F.coalesce(grow(a["w"], x.cast("double")), F.lit(0.0)).alias("w"), (a["sum"] + a["w"]).alias("sum")), lambda a: a["sum"])
    begin = F.struct(F.lit(1.0).alias("w"), (u * total).alias("left"), high.alias("pick"), F.lit(False).alias("found"))
    return F.aggregate(F.sequence(low, high), begin, lambda a, x: F.struct(
        F.coalesce(grow(a["w"], x.cast("double")), F.lit(0.0)).alias("w"), (a["left"] - a["w"]).alias("left"),
        F.when(~a["found"] & (a["left"] < a["w"]), x).otherwise(a["pick"]).alias("pick"),
        (a["found"] | (a["left"] < a["w"])).alias("found")), lambda a: a["pick"])


def split_quotas(quotas: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """Deal the blocks of every source out to shards: ``shard``, ``quotas`` (one entry per source).

    ``quotas``: one row, ``quotas`` array<long>. Shards differ by a block at
    most in their number of blocks; the quotas of a source add up exactly.
    """
    tree = quotas.select(F.lit(0).alias("first"), F.lit(shards).alias("n"), "quotas")
    for _ in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        # A node's blocks are dealt to its left half in proportion to its shards.
        n_left = F.floor(F.col("n") / 2).cast("int")
        blocks = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, x: a + x)
        node = tree.withColumn("n_left", n_left).withColumn("blocks", blocks).withColumn("want", F.floor(F.col("blocks") * F.col("n_left") / F.col("n")).cast("long"))
        begin = F.struct(F.col("want").alias("want"), F.col("blocks").alias("rest"), F.array().cast("array<bigint>").alias("left"))

        def draw(a: Column, q: Column) -> Column:
            x = hypergeometric(_uniform(F.lit(seed), F.col("first"), F.col("n"), F.size(a["left"])), a["rest"], q, a["want"])
            return F.struct((a["want"] - x).alias("want"), (a["rest"] - q).alias("rest"), F.concat(a["left"], F.array(x)).alias("left"))

        node = node.withColumn("left", F.aggregate("quotas", begin, draw, lambda a: a["left"]))
        right = F.zip_with("quotas", "left", lambda q, x: q - x)
        tree = node.select(F.inline(F.array(
            F.struct(F.col("first"), F.col("n_left").alias("n"), F.col("left").alias("quotas")),
            F.struct((F.col("first") + F.col("n_left")).alias("first"), (F.col("n") - F.col("n_left")).alias("n"), right.alias("quotas"))))).filter("n > 0")
    return tree.select(F.col("first").alias("shard"), "quotas")


def mix(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, shards: int = SHARDS, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """The mix: a row for each copy that is taken.

    ``sizes``: ``doc_id``, ``source``, ``size`` (see ``measured``). Returns
    ``doc_id``, ``source``, ``size``, ``rows``, ``source_size``, ``target``, ``copy`` (from 0; null
    with ``shard`` and ``place`` if the document is not taken), ``shard``, ``place`` (order by it
    within the shard). Rows that agree in doc_id, source and size are one unit of
    ``rows`` rows and go together. A null source is a source of its own, ranked last; a
    null doc_id is an ordinary value; empty texts have size 0, weigh nothing and are taken
    as often as their place in the order says; an empty table gives an empty result.
    """
    units = plan(written(sizes, "mix-sizes"), weights, seed)  # the texts are read once
    copies = written(units.withColumn("copy", F.explode_outer(F.when(F.col("copies") > 0, F.sequence(F.lit(0), F.col("copies").cast("int") - 1)))), "mix-copies")
    # Copy by copy, a source's line is laid out anew; block: place on that line.
    block = F.floor((F.col("copy") * F.col("source_size") + F.col("before")) / block_words)
    taken = copies.filter("copy is not null").withColumn("block", block)
    blocks = taken.select("source", "block").distinct()
    quota = blocks.groupBy("source").agg(F.count(F.lit(1)).alias("quota"))
    listed = quota.agg(F.sort_array(F.collect_list(F.struct(F.col("source").isNull().alias("last"), "source", "quota"))).alias("all"))
    listed = written(listed, "mix-quotas")  # one row
    tree = split_quotas(listed.select(F.col("all.quota").alias("quotas")).filter("size(quotas) > 0"), shards, seed)
    sources = listed.select(F.col("all.source")).scalar()
    dealt = tree.select("shard", F.inline(F.arrays_zip(sources.alias("sources"), "quotas")))
    upto = F.sum("quotas").over(Window.partitionBy("sources").orderBy("shard"))
    runs = dealt.select("shard", "sources", (upto - F.col("quotas")).alias("lo"), (upto - 1).alias("hi")).filter("hi >= lo")
    # The k-th block of a source (its line is in random order) goes to the shard whose run holds k.
    owner = runs.select("shard", F.col("sources").alias("os"), F.explode(F.sequence("lo", "hi")).alias("k"))
    nth = _numbered(blocks, block_words)
    home = nth.join(owner, F.col("source").eqNullSafe(F.col("os")) & (F.col("nth") == F.col("k"))).select(F.col("source").alias("hs"), F.col("block").alias("hb"), "shard")
    place = F.xxhash64(F.lit(seed), "shard", "doc_id", "copy", "size")
    out = taken.join(home, F.col("source").eqNullSafe(F.col("hs")) & (F.col("block") == F.col("hb"))).withColumn("place", place)
    cols = ["doc_id", "source", "size", "rows", "source_size", "target", "copy", "shard", "place"]
    left = copies.filter("copy is null").withColumns({"shard": F.lit(None).cast("int"), "place": F.lit(None).cast("long")})
    return out.select(*cols).unionByName(left.select(*cols))


def _numbered(blocks: DataFrame, block_words: int) -> DataFrame:
    """``nth``: number of a block among the blocks of its source that hold a start of a document."""
    group = F.floor(F.col("block") / 1000)
    count = blocks.groupBy("source", group.alias("g")).agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("source").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    count = count.select(F.col("source").alias("cs"), F.col("g").alias("cg"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "g").orderBy("block")
    own = blocks.withColumn("g", group).withColumn("r", F.row_number().over(inside) - 1)
    return own.join(count, F.col("source").eqNullSafe(F.col("cs")) & (F.col("g") == F.col("cg"))).select("source", "block", (F.col("base") + F.col("r")).alias("nth"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix: every row as often as the mix takes it, with the columns of ``docs``.

    Rows come as they were dealt: the rows of a shard lie in one partition, in the order of its local shuffle, copies apart from each other.
    All columns pass through untouched whatever their names. Null and empty texts have size 0 and are taken as their place in the
    order says; rows that agree in doc_id, source and size go together; an empty table gives an empty result; texts of any length count whole.
    """
    sizes = written(measured(docs), "mix-words")
    words = sizes.agg(F.sum("size")).first()[0] or 0
    copies = mix(sizes, **{"shards": max(SHARDS, -(-words // SHARD_WORDS)), **options}).filter("copy is not null").select(
        F.col("doc_id").alias("id"), F.col("source").alias("src"), F.col("size").alias("words"), "shard", "place")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select("doc_id", "source", size.alias("size"), packed(docs).alias("row"))
    met = F.col("doc_id").eqNullSafe(F.col("id")) & F.col("source").eqNullSafe(F.col("src")) & (F.col("size") == F.col("words"))
    return rows.join(copies, met).repartition("shard").sortWithinPartitions("shard", "place").select("row.*")

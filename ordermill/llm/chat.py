"""Chat formatting with collapse of cumulative snapshots.

Logs often hold a conversation several times, each time a few turns longer.
Rolling hashes of the turn prefixes tell which conversations are a prefix of a longer one; an
anti-join keeps the maximal ones, and those are rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.store import written

#: Turn numbers that a step of the running hash spans; a long conversation is many steps.
STEP_TURNS = 256
#: Turns in a rendered piece.
PIECE_TURNS = 64


def _turn_block() -> Column:
    return F.floor(F.col("turn") / STEP_TURNS)


def prefixes(turns: DataFrame) -> DataFrame:
    """Every turn with its place and the rolling hash of its conversation up to it.

    Returns ``conv_id``, ``turn``, ``h``, ``k`` (place from 1), ``x``, ``y`` (128 bits of hash).
    The hash of a prefix is the exclusive-or of hashes of its turns and their
    places, so that a long conversation is worked on in steps: the totals of
    earlier steps are added to the running value inside a step.
    """
    h = F.sha2(F.to_json(F.struct("role", "text")), 256)
    rows = written(turns.select("conv_id", "turn", h.alias("h")).distinct().withColumn("step", _turn_block()), "turns")
    ahead = Window.partitionBy("conv_id").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    steps = rows.groupBy("conv_id", "step").agg(F.count(F.lit(1)).alias("n"))
    steps = steps.select(F.col("conv_id").alias("c"), F.col("step").alias("s"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy("conv_id", "step").orderBy("turn", "h")
    same_step = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("step").eqNullSafe(F.col("s"))
    placed = rows.withColumn("r", F.row_number().over(inside)).join(steps, same_step).select("conv_id", "turn", "h", "step", (F.col("base") + F.col("r")).alias("k"))
    placed = placed.withColumn("gx", F.xxhash64("k", "h")).withColumn("gy", F.xxhash64("h", "k", F.lit("y")))
    placed = written(placed, "placed-turns")
    totals = placed.groupBy("conv_id", "step").agg(F.bit_xor("gx").alias("gx"), F.bit_xor("gy").alias("gy"))
    totals = _earlier(totals)
    running = Window.partitionBy("conv_id", "step").orderBy("k")
    return (placed.withColumn("rx", F.bit_xor("gx").over(running)).withColumn("ry", F.bit_xor("gy").over(running)).join(totals, same_step)
            .select("conv_id", "turn", "h", "k", F.col("rx").bitwiseXOR(F.col("bx")).alias("x"), F.col("ry").bitwiseXOR(F.col("by")).alias("y")))


def _earlier(totals: DataFrame) -> DataFrame:
    """Exclusive-or of the steps before each step of a conversation."""
    upto = Window.partitionBy("conv_id").orderBy("step")
    own = lambda g: F.bit_xor(g).over(upto).bitwiseXOR(F.col(g))
    return totals.select(F.col("conv_id").alias("c"), F.col("step").alias("s"), own("gx").alias("bx"), own("gy").alias("by"))


def maximal(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations that stay, and all turns with their places.

    Returns (``conv_id``, ``n_turns``, ``copies``) of each conversation that is no proper prefix
    of another; of equal ones the smallest ``conv_id`` stays and ``copies`` tells how many there are.
    """
    pre = written(prefixes(turns), "prefixes")
    length = pre.groupBy("conv_id").agg(F.max("k").alias("n")).select(F.col("conv_id").alias("c"), "n")
    known = pre.join(length, F.col("conv_id").eqNullSafe(F.col("c")))
    full = known.filter("k = n").groupBy("k", "x", "y").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    shorter = known.filter("k < n").select("k", "x", "y").distinct()
    kept = full.join(shorter, ["k", "x", "y"], "left_anti").select("conv_id", F.col("k").alias("n_turns"), "copies")
    return written(kept, "maximal"), pre


def rendered(role: Column, text: Column) -> Column:
    """One turn in the chat template."""
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("unknown")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("<|end|>\n"))


def format_chats(turns: DataFrame, piece_turns: int = PIECE_TURNS) -> DataFrame:
    """Rendered maximal conversations: ``conv_id``, ``piece`` (from 0), ``n_turns``, ``copies``, ``text``.

    ``turns`` needs ``conv_id``, ``turn``, ``role``, ``text``. A conversation is its distinct rows by ``turn``
    (null first, ties by content); the same row logged twice is one turn. A piece renders at
    most ``piece_turns`` turns, so that no conversation, however long, has to fit in
    one row; the text of a conversation is its pieces in order.

    Null and empty texts are turns without text, but differ when prefixes are
    compared; a null role renders as unknown; rows with a null ``conv_id`` form one
    conversation. Other columns are ignored; an empty table gives an empty result.
    """
    kept, pre = maximal(turns)
    h = F.sha2(F.to_json(F.struct("role", "text")), 256)
    text = turns.select("conv_id", "turn", "role", "text", h.alias("h")).dropDuplicates(["conv_id", "turn", "h"])
    stay = kept.select(F.col("conv_id").alias("kc"), "n_turns", "copies")
    place = pre.join(stay, F.col("conv_id").eqNullSafe(F.col("kc"))).select(F.col("conv_id").alias("pc"), F.col("turn").alias("pt"), F.col("h").alias("ph"), "k", "n_turns", "copies")
    rows = text.join(place, F.col("conv_id").eqNullSafe(F.col("pc")) & F.col("turn").eqNullSafe(F.col("pt")) & (F.col("h") == F.col("ph")))
    piece = F.floor((F.col("k") - 1) / piece_turns).cast("long")
    made = rows.groupBy("conv_id", piece.alias("piece"), "n_turns", "copies").agg(F.sort_array(F.collect_list(F.struct("k", rendered(F.col("role"), F.col("text")).alias("t")))).alias("all"))
    return made.select("conv_id", "piece", "n_turns", "copies", F.array_join(F.col("all.t"), "").alias("text"))

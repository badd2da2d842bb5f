"""Distributed LSD radix sort.

Rows have a place (at first any number) and lie in blocks of places. A pass
is a stable counting sort by one digit of the key: every block counts its
digits, prefix sums over (digit, block) give the place where each block's
rows of a digit begin, and a row goes there plus its rank among the rows of
its block and digit. Passes run from the least to the most significant
digit of a composite key; a pass moves each row once and no task holds more
than a block of a digit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.store import removed, written

#: Bits of a digit at most, so that the totals of a pass are at most 2,048 rows.
DIGIT_BITS = 11
_SIGN = -(1 << 63)
_WORD = (1 << 64) - 1


def key_digits(low: int | None, high: int | None, nulls: int, name: str, descending: bool) -> list[Column]:
    """Digits of a long column between ``low`` and ``high``, least significant first; nulls come last in either direction."""
    out = []
    value = F.coalesce(F.col(name), F.lit(0 if low is None else low))
    bits = 0 if low is None else ((low & _WORD) ^ (high & _WORD)).bit_length()
    if bits == 64:  # the sign counts
        value = value.bitwiseXOR(F.lit(_SIGN))
    if descending:
        value = F.bitwise_not(value)
    passes = -(-bits // DIGIT_BITS)
    at = 0
    for k in range(passes):
        width = (bits * (k + 1)) // passes - at
        out.append(F.shiftrightunsigned(value, at).bitwiseAND(F.lit((1 << width) - 1)).cast("int"))
        at += width
    if nulls:
        out.append(F.col(name).isNull().cast("int"))
    return out


def counting_pass(rows: DataFrame, digit: Column, block_rows: int) -> DataFrame:
    """One stable pass: new ``place`` and ``block`` of every row, places from 0 without gaps."""
    rows = rows.withColumn("digit", digit)
    counts = rows.groupBy("block", "digit").agg(F.count(F.lit(1)).alias("n"))
    earlier = (Window.unboundedPreceding, -1)
    totals = counts.groupBy("digit").agg(F.sum("n").alias("n"))  # 2,048 rows at most
    base = totals.select("digit", F.coalesce(F.sum("n").over(Window.orderBy("digit").rowsBetween(*earlier)), F.lit(0)).alias("base"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("digit").orderBy("block").rowsBetween(*earlier)), F.lit(0))
    begin = counts.withColumn("before", before).join(F.broadcast(base), "digit").select("block", "digit", (F.col("base") + F.col("before")).alias("begin"))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("block", "digit").orderBy("place")) - 1)
    moved = ranked.join(begin, ["block", "digit"]).withColumn("place", F.col("begin") + F.col("rank"))
    return moved.withColumn("block", F.floor(F.col("place") / block_rows)).drop("digit", "rank", "begin")


def radix_sort(rows: DataFrame, keys: list[tuple[str, bool]]) -> DataFrame:
    """``rows`` with ``place`` 0, 1, 2, ... in the order of ``keys``.

    ``keys`` are long columns, most significant first, each with whether it
    descends; nulls are last. ``rows`` must be a written table without columns named ``place``,
    ``block``, ``digit``, ``rank``, ``begin``. Equal keys get neighbouring places, in no
    promised order. An empty table gives an empty result.
    """
    spark = rows.sparkSession
    about = rows.agg(F.count(F.lit(1)).alias("n"), *[f(name).alias(f"{k}{i}") for i, (name, _) in enumerate(keys) for k, f in (("low", F.min), ("high", F.max))],
                     *[F.count_if(F.col(name).isNull()).alias(f"null{i}") for i, (name, _) in enumerate(keys)]).first()
    blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    block_rows = max(1, -(-about["n"] // blocks))
    digits = [d for i, (name, descending) in reversed(list(enumerate(keys)))
              for d in key_digits(about[f"low{i}"], about[f"high{i}"], about[f"null{i}"], name, descending)]
    number = F.monotonically_increasing_id()
    at = written(rows.withColumn("place", number).withColumn("block", F.shiftright("place", 33)), "radix")
    for digit in digits or [F.lit(0)]:
        after = written(counting_pass(at, digit, block_rows), "radix")
        removed(at)
        at = after
    return at.drop("block")

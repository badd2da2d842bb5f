"""Table change operators expressed as DataFrame transformations
(O-27, O-28, O-34, O-35, O-41, O-42, O-55..O-63).

Each operator returns the *new* table (or the rows to add) as a DataFrame;
writing it is a separate, explicit step (``ordermill.sources``). That keeps
every change a pure function of its inputs, so a retried task or a replayed
batch produces the same result.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.functions import touch, with_suffix
from ordermill.operators.shape import latest_per_key
from ordermill.schemas import LEGACY_SUFFIX, WATERMARK_FLOOR


# --- high-water mark and incremental append ------------------------------------

def high_watermark(items: DataFrame, orders: DataFrame, key: str = "order_id",
                   ts: str = "created_on", default: str = WATERMARK_FLOOR) -> DataFrame:
    """1-row DataFrame ``max_date``: latest ``ts`` of orders that have items,
    or ``default`` when there are none (O-41, O-33).

    ``orders LEFT SEMI items`` gives the same MAX as the inner join without its
    fan-out; the item keys are reduced map-side first, so an order holding a
    third of all items ships one key per task, not its group, into the join.
    The global MAX is a partial max per task plus one final row.
    """
    with_items = orders.select(key, ts).join(items.select(key).distinct(), key, "left_semi")
    ts_type = dict(orders.dtypes)[ts]
    floor = F.lit(default).cast(ts_type)
    return with_items.agg(F.coalesce(F.max(ts), floor).alias("max_date"))


def newer_than(df: DataFrame, mark: DataFrame | Column | str, ts: str = "created_on") -> DataFrame:
    """Rows strictly newer than the mark (O-27, D5). A 1-row DataFrame is used
    as a scalar subquery, so the plan stays lazy and no cross join appears."""
    if isinstance(mark, DataFrame):
        bound = mark.scalar()
    elif isinstance(mark, Column):
        bound = mark
    else:
        bound = F.lit(mark).cast(dict(df.dtypes)[ts])
    return df.filter(F.col(ts) > bound)


def append_since_watermark(new_items: DataFrame, items: DataFrame, orders: DataFrame,
                           key: str = "order_id", ts: str = "created_on",
                           carrier: str | None = "created_on") -> DataFrame:
    """Items to append: those created after the high-water mark of the target,
    with the carrier column dropped (O-55, O-20). Empty when nothing is new;
    appending an empty frame writes nothing."""
    mark = high_watermark(items, orders, key, ts)
    rows = newer_than(new_items, mark, ts)
    return rows.drop(carrier) if carrier else rows


class KeyCollision(Exception):
    pass


def require_unique(rows: DataFrame, keys: Sequence[str], what: str = "rows") -> None:
    """Raise if a key occurs twice (a grouped count; at most 20 keys reach the driver)."""
    twice = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(20).collect()
    if twice:
        raise KeyCollision(f"{what} repeat keys: {[tuple(r)[:-1] for r in twice]}")


# --- upsert -----------------------------------------------------------------------

def upsert(target: DataFrame, staged: DataFrame, keys: Sequence[str],
           newer_by: str | None = None) -> DataFrame:
    """New table: staged rows replace target rows with the same key, new keys
    are inserted, other target rows are kept (O-56, O-35).

    Faithful default: the staged row wins unconditionally (D18). With
    ``newer_by`` a staged row only replaces a target row that is not newer.
    ``staged`` must be unique on ``keys`` (reduce with ``latest_per_key``); a
    repeated key raises, as in a database.
    Plan: one shuffle of both sides on the key for the anti join, then a union.
    """
    keys = list(keys)
    require_unique(staged, keys, "staged rows")
    cols = target.columns
    staged = staged.select(*cols)
    if newer_by is None:
        kept = target.join(staged.select(*keys), keys, "left_anti")
        return kept.unionByName(staged)
    t = target.alias("t")
    s = staged.alias("s")
    cond = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    j = t.join(s, cond, "full_outer")
    take_s = F.col(f"s.{keys[0]}").isNotNull() & (
        F.col(f"t.{keys[0]}").isNull() | ~(F.col(f"t.{newer_by}") > F.col(f"s.{newer_by}")))
    return j.select(*[F.when(take_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in cols])


def upsert_counts(target: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``inserted``, ``updated``, ``affected`` of an upsert in one pass (O-57).
    ``affected = inserted + updated`` is the row count a database reports."""
    keys = list(keys)
    marked = staged.select(*keys).join(
        target.select(*keys).withColumn("_hit", F.lit(True)), keys, "left")
    return marked.agg(
        F.count_if(F.col("_hit").isNull()).alias("inserted"),
        F.count_if(F.col("_hit")).alias("updated"),
        F.count(F.lit(1)).alias("affected"))


# --- conditional update, insert with defaults, re-keying ---------------------------------

def update_where(df: DataFrame, cond: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """``UPDATE t SET c = e WHERE cond`` as a projection (O-59)."""
    out = df
    for c, e in assignments.items():
        out = out.withColumn(c, F.when(cond, e).otherwise(F.col(c)))
    return out


def mark_legacy(products: DataFrame, skus: DataFrame | Sequence[str], at: _dt.datetime | str | None = None,
                key: str = "product_sku", name_col: str = "product_name",
                stamp_col: str = "modified_at", suffix: str = LEGACY_SUFFIX) -> DataFrame:
    """Suffix the names of a key set and stamp them (O-59, O-24, O-25, O-28).

    A short literal key list is an ``isin``; a key table is joined (a left
    join with a marker column, so no row is duplicated and none dropped)."""
    if isinstance(skus, DataFrame):
        marks = skus.select(F.col(skus.columns[0]).alias(key)).distinct().withColumn("_m", F.lit(True))
        j = products.join(marks, key, "left")
        cond = F.col("_m").isNotNull()
        return update_where(j, cond, {name_col: with_suffix(name_col, suffix),
                                      stamp_col: touch(at)}).drop("_m")
    cond = F.col(key).isin(list(skus))
    return update_where(products, cond, {name_col: with_suffix(name_col, suffix), stamp_col: touch(at)})


def with_defaults(rows: DataFrame, target_schema: T.StructType,
                  defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Shape ``rows`` like the target: missing or null columns take their default."""
    defaults = defaults or {}
    cols = []
    for f in target_schema.fields:
        d = defaults.get(f.name)
        dv = d if isinstance(d, Column) else (F.lit(d) if d is not None else F.lit(None))
        if f.name in rows.columns:
            c = F.coalesce(F.col(f.name).cast(f.dataType), dv.cast(f.dataType)) if d is not None \
                else F.col(f.name).cast(f.dataType)
        else:
            c = dv.cast(f.dataType)
        cols.append(c.alias(f.name))
    return rows.select(*cols)


def insert_rows(target: DataFrame, rows: DataFrame, keys: Sequence[str],
                defaults: Mapping[str, object] | None = None, on_conflict: str = "error") -> DataFrame:
    """``INSERT`` with column defaults and a key-collision policy (O-60, D15).

    ``error``: raise naming the colliding keys (a key check is run);
    ``ignore``: keep the existing row; ``replace``: the new row wins. New rows
    that repeat a key raise under every policy: none of them says which to take.
    """
    keys = list(keys)
    shaped = with_defaults(rows, target.schema, defaults)
    require_unique(shaped, keys, "new rows")
    if on_conflict == "error":
        clash = shaped.select(*keys).join(target.select(*keys), keys, "left_semi")
        sample = clash.limit(20).collect()
        if sample:
            raise KeyCollision(f"keys already present: {[tuple(r) for r in sample]}")
        return target.unionByName(shaped)
    if on_conflict == "ignore":
        return target.unionByName(shaped.join(target.select(*keys), keys, "left_anti"))
    if on_conflict == "replace":
        return target.join(shaped.select(*keys), keys, "left_anti").unionByName(shaped)
    raise ValueError(f"unknown on_conflict {on_conflict!r}")


def latest_mapping(mapping: DataFrame, old: str = "old_sku", new: str = "new_sku",
                   order_by: Sequence[Column | str] = ("migration_date", "migration_id")) -> DataFrame:
    """One mapping row per old key: the latest entry wins (D14)."""
    present = [c for c in order_by if not isinstance(c, str) or c in mapping.columns]
    return latest_per_key(mapping.select(old, new, *[c for c in present if isinstance(c, str)]),
                          [old], present, tie_break=[F.col(new).desc()]).select(old, new)


def remap_keys(df: DataFrame, mapping: DataFrame, key: str = "product_sku", old: str = "old_sku",
               new: str = "new_sku", at: _dt.datetime | str | None = None,
               stamp_col: str | None = "modified_at", reduce: bool = True) -> DataFrame:
    """``UPDATE t SET key = m.new FROM m WHERE t.key = m.old`` (O-61, O-34).

    The mapping is first reduced to one row per old key, so the left join
    cannot fan out; matched rows are stamped even when old = new. One pass,
    no chains. The mapping is a log of key changes; the join lets AQE choose
    broadcast when its measured size is under the bound.
    """
    m = latest_mapping(mapping, old, new) if reduce else mapping.select(old, new)
    m = m.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
    j = df.join(m, F.col(key) == F.col("_old"), "left")
    hit = F.col("_old").isNotNull()
    out = j.withColumn(key, F.when(hit, F.col("_new")).otherwise(F.col(key)))
    if stamp_col:
        out = out.withColumn(stamp_col, F.when(hit, touch(at)).otherwise(F.col(stamp_col)))
    return out.drop("_old", "_new")


def class_counts(df: DataFrame, classes: Mapping[str, Column]) -> DataFrame:
    """One row per named class with its row count, from a single aggregate
    (O-42, O-63). A row whose predicate is null is in no class (SQL LIKE)."""
    agg = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(f"_c{i}") for i, c in enumerate(classes.values())])
    stack = ", ".join(f"'{n}', _c{i}" for i, n in enumerate(classes))
    return agg.selectExpr(f"stack({len(classes)}, {stack}) AS (category, count)")


def migration_counts(products: DataFrame, log: DataFrame, name_col: str = "product_name",
                     suffix: str = LEGACY_SUFFIX) -> DataFrame:
    """Validation counts of the catalog migration: legacy, new, log entries (O-63, O-29)."""
    like = F.col(name_col).endswith(suffix)
    # The names of the three classes.
    per_class = class_counts(products, {"Legacy products": like, "New products": ~like})
    entries = log.agg(F.count(F.lit(1)).alias("count")).select(F.lit("Migration entries").alias("category"), "count")
    return per_class.unionByName(entries)

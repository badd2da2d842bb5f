"""Catalog migration as one job: mark legacy products,
insert the new catalog rows, append the key-change log, re-key the bill of
materials through the log, validate the class counts (O-59..O-63).

Products, log and bill of materials are written to new folders and become visible together
by one pointer after the checks passed. A rejected or crashed run leaves the tables as they
were, and is simply run again.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.operators import tables
from ordermill.operators.shape import assign_ids
from ordermill.schemas import CATALOG_DEFAULT_COLOR, SKU_MIGRATION_LOG
from ordermill.sources import snapshots

_LOG_COLUMNS = [c for c in SKU_MIGRATION_LOG.columns if c.name != "migration_id"]
LOG_SCHEMA = T.StructType([T.StructField(c.name, c.dtype) for c in _LOG_COLUMNS])


def append_log(log: DataFrame | None, rows: DataFrame, at: _dt.datetime | str | None = None) -> DataFrame:
    """The mapping log with new entries (O-62): missing reasons and stamps take
    the column defaults, ids continue after the largest one."""
    defaults = {c.name: c.default for c in _LOG_COLUMNS if c.default is not None}
    defaults["migration_date"] = at if at is not None else F.current_timestamp()
    shaped = tables.with_defaults(rows, LOG_SCHEMA, defaults)
    last = 0 if log is None else log.agg(F.coalesce(F.max("migration_id"), F.lit(0))).first()[0]
    new = assign_ids(shaped, "migration_id", ["old_sku", "new_sku"], start=last + 1).select("migration_id", *LOG_SCHEMA.fieldNames())
    return new if log is None else log.unionByName(new)


def publish_seed(spark: SparkSession, root: str, products: DataFrame, bom: DataFrame, run_id: str = "seed") -> None:
    """First version of the tables."""
    paths = {"products": f"{root}/products/run={run_id}", "bom": f"{root}/bill_of_materials/run={run_id}"}
    products.write.mode("overwrite").parquet(paths["products"])
    bom.write.mode("overwrite").parquet(paths["bom"])
    snapshots.commit(spark, root, run_id, paths)


def run_migration(root: str, legacy_skus: DataFrame | Sequence[str], new_products: DataFrame,
                  mapping: DataFrame, expected: dict[str, int] | None, run_id: str,
                  at: _dt.datetime | str | None = None, on_conflict: str = "error") -> dict:
    """Run the migration on the tables below ``root``; ``expected`` are the validation
    counts (``Legacy products``, ``New products``, ``Migration entries``)."""
    spark: SparkSession = new_products.sparkSession

    def counts(products: DataFrame, log: DataFrame) -> dict:
        return {r["category"]: r["count"] for r in tables.migration_counts(products, log).collect()}

    done = snapshots.current(spark, root, run_id)
    if done is not None:
        return counts(done.read(spark, "products"), done.read(spark, "log"))
    before = snapshots.current(spark, root)
    paths = {"products": f"{root}/products/run={run_id}", "log": f"{root}/sku_migration_log/run={run_id}", "bom": f"{root}/bill_of_materials/run={run_id}"}

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(paths[name])
        return spark.read.parquet(paths[name])

    stamp = at if at is not None else F.current_timestamp()
    marked = tables.mark_legacy(before.read(spark, "products"), legacy_skus, at=at)
    defaults = {"product_color": CATALOG_DEFAULT_COLOR, "created_at": stamp, "modified_at": stamp}
    products = written(tables.insert_rows(marked, new_products, ["product_sku"], defaults=defaults, on_conflict=on_conflict), "products")
    log = written(append_log(before.read(spark, "log"), mapping, at), "log")
    written(tables.remap_keys(before.read(spark, "bom"), log, at=at), "bom")
    got = counts(products, log)
    problems = [f"{k}: expected {v}, got {got.get(k)}" for k, v in (expected or {}).items() if got.get(k) != v]
    if problems:
        raise snapshots.PublishRejected(problems)
    snapshots.commit(spark, root, run_id, before.paths | paths)
    return got

"""Table contracts checked by Spark jobs (O-36, O-64..O-68).

Parquet enforces no NOT NULL, length, key or reference constraints, so they
are checked here: all column checks of a table in one aggregate; key and
reference checks as one grouped aggregate / one anti join each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.schemas import Contract


_TYPE_CHECKS = {T.ShortType: "smallint", T.LongType: "bigint", T.BooleanType: "boolean", T.TimestampType: "timestamp"}


def column_checks(contract: Contract, columns: Sequence[str]) -> list[tuple[str, str]]:
    """(check, column) for every column rule of ``contract`` that applies to ``columns``."""
    out = []
    for c in contract.columns:
        if c.name not in columns:
            continue
        if not c.nullable:
            out.append(("not_null", c.name))
        if c.max_len is not None:
            out.append((f"max_length_{c.max_len}", c.name))
        if isinstance(c.dtype, T.DecimalType):
            out.append((f"numeric_{c.dtype.precision}_{c.dtype.scale}", c.name))
        elif type(c.dtype) in _TYPE_CHECKS:
            out.append((f"type_{_TYPE_CHECKS[type(c.dtype)]}", c.name))
    return out


def _bounds(dtype: T.DataType) -> tuple[int, int] | None:
    """Smallest and largest whole number of a declared type."""
    if isinstance(dtype, T.ShortType | T.IntegerType | T.LongType):
        top = 1 << {T.ShortType: 15, T.IntegerType: 31, T.LongType: 63}[type(dtype)]
        return -top, top - 1
    if isinstance(dtype, T.DecimalType):
        top = 10 ** (dtype.precision - dtype.scale)
        return 1 - top, top - 1
    return None


def violation(contract: Contract, check: str, column: str, kind: T.DataType | None = None) -> F.Column:
    """Row predicate: true where the row breaks ``check`` on ``column``.

    Types are checked against the declared type: a value that does
    not fit (after rounding to the declared scale) or cannot be read breaks it.
    Numbers are compared with the type's bounds; only other types, texts above all, go through ``try_cast``.
    ``kind`` is the column's actual type.
    """
    c = contract.column(column)
    col = F.col(column)
    if check == "not_null":
        return col.isNull()
    if check.startswith("max_length_"):
        return F.char_length(col.cast("string")) > c.max_len
    if check.startswith(("numeric_", "type_")):
        if kind == c.dtype or isinstance(kind, T.TimestampNTZType) and isinstance(c.dtype, T.TimestampType):
            return F.lit(False)
        bounds = _bounds(c.dtype)
        if bounds and isinstance(kind, T.IntegralType):
            low, high = bounds
            return F.lit(False) if high >= (1 << 63) - 1 else (col < low) | (col > high)
        if isinstance(c.dtype, T.DecimalType) and isinstance(kind, T.DecimalType):
            if kind.scale <= c.dtype.scale and kind.precision - kind.scale <= c.dtype.precision - c.dtype.scale:
                return F.lit(False)  # every value of the type fits
            return F.abs(F.round(col, c.dtype.scale)) >= F.lit(10 ** (c.dtype.precision - c.dtype.scale))
        # Through text: try_cast takes it to every declared type.
        return col.isNotNull() & col.cast("string").try_cast(c.dtype).isNull()
    raise ValueError(check)


def check_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Violations per (check, column), all in one aggregate (O-64, O-65).
    Columns of the contract absent from ``df`` are reported as ``missing_column``."""
    checks = column_checks(contract, df.columns)
    missing = [c.name for c in contract.columns if c.name not in df.columns]
    aggs = [F.count_if(F.coalesce(violation(contract, k, c, df.schema[c].dataType), F.lit(False))).alias(f"_v{i}")
            for i, (k, c) in enumerate(checks)]
    counted = df.agg(*aggs, F.count(F.lit(1)).alias("_rows"))
    rows = [F.struct(F.lit(contract.name).alias("table_name"), F.lit(k).alias("check"),
                     F.lit(c).alias("column_name"), F.col(f"_v{i}").alias("violations"))
            for i, (k, c) in enumerate(checks)]
    rows += [F.struct(F.lit(contract.name).alias("table_name"), F.lit("missing_column").alias("check"),
                      F.lit(c).alias("column_name"), F.lit(1).cast("bigint").alias("violations"))
             for c in missing]
    return counted.select(F.inline(F.array(*rows)))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count (O-66).
    Map-side partial counts keep a hot key to one row per task."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
            .filter(F.col("occurrences") > 1))


def fk_orphans(child: DataFrame, parent: DataFrame, child_keys: Sequence[str],
               parent_keys: Sequence[str] | None = None, distinct_parent: bool = False) -> DataFrame:
    """Child rows whose key has no parent row (O-36, O-67). Null child keys are
    not orphans (SQL foreign keys ignore nulls).

    ``distinct_parent``: the parent side repeats keys (e.g. which orders have
    items). Its keys are then reduced map-side first, so a key held by a third
    of the parent rows ships one row per task instead of its whole group into
    one join task (AQE can split only the child side of an anti join). A
    unique parent (a primary key) keeps the plain anti join."""
    parent_keys = list(parent_keys or child_keys)
    p = parent.select(*[F.col(pk).alias(ck) for pk, ck in zip(parent_keys, child_keys)])
    if distinct_parent:
        p = p.distinct()
    notnull = F.lit(True)
    for ck in child_keys:
        notnull = notnull & F.col(ck).isNotNull()
    return child.filter(notnull).join(p, list(child_keys), "left_anti")


def cascade_delete(children: DataFrame, deleted_parents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Children left after their parents were deleted (O-68): an anti join."""
    return children.join(deleted_parents.select(*keys), list(keys), "left_anti")


def key_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """Counts of duplicated key and unique-column values (O-66), one row per key set."""
    out = None
    for ks in [contract.key, *contract.unique]:
        if not ks or not all(k in df.columns for k in ks):
            continue
        dup = duplicate_keys(df, ks).agg(F.count(F.lit(1)).alias("violations"))
        row = dup.select(F.lit(contract.name).alias("table_name"), F.lit("unique").alias("check"),
                         F.lit(",".join(ks)).alias("column_name"), "violations")
        out = row if out is None else out.unionByName(row)
    return out

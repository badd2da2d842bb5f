"""Scalar column expressions (all JVM-side built-ins; no Python UDFs).

Every helper returns a ``Column`` so that it composes inside ``select`` /
``withColumn`` / ``agg`` and stays within whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.schemas import DEC, FLATTEN_DEFAULT_COLOR

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


_WIDE = T.DecimalType(38, 10)


def money(value: ColumnOrName, dtype: T.DecimalType = DEC) -> Column:
    """Money text -> decimal(10,2) (O-15, D1): null and malformed text -> 0, an
    amount beyond the type -> null, so that it cannot pass for an amount of 0.

    The zero literal carries the same type so ``coalesce`` does not widen the result.
    """
    v = _c(value)
    return F.when(v.try_cast(_WIDE).isNull(), F.lit(0).cast(dtype)).otherwise(v.try_cast(dtype))


def malformed_money(value: ColumnOrName) -> Column:
    """True where text is present but is no number."""
    v = _c(value)
    return v.isNotNull() & v.try_cast(_WIDE).isNull()


def out_of_range_money(value: ColumnOrName, dtype: T.DecimalType = DEC) -> Column:
    """True where the text is a number beyond the type."""
    v = _c(value)
    return v.try_cast(_WIDE).isNotNull() & v.try_cast(dtype).isNull()


def first_option(options: ColumnOrName, field: str = "value",
                 default: str = FLATTEN_DEFAULT_COLOR) -> Column:
    """First array element's field, or a default for null/empty arrays (O-16, D2)."""
    return F.coalesce(F.get(_c(options), 0).getField(field), F.lit(default))


def full_name(first: ColumnOrName, last: ColumnOrName) -> Column:
    """``first || ' ' || last``; null when either part is null, like SQL CONCAT (O-14, D23)."""
    return F.concat(_c(first), F.lit(" "), _c(last))


def parse_ts(text: ColumnOrName) -> Column:
    """ISO-8601 text -> timestamp; malformed text -> null instead of a failure (O-19)."""
    return F.try_to_timestamp(_c(text))


def status_is(status: ColumnOrName, value: str) -> Column:
    """Case-insensitive equality (O-22)."""
    return F.lower(_c(status)) == F.lit(value.lower())


def widen(c: ColumnOrName) -> Column:
    """Widen small integers to bigint before arithmetic (D11)."""
    return _c(c).cast(T.LongType())


def product(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Overflow-safe product of two small integers (O-23)."""
    return widen(a) * widen(b)


def with_suffix(c: ColumnOrName, suffix: str) -> Column:
    """Append a version suffix (O-24)."""
    return F.concat(_c(c), F.lit(suffix))


def touch(at: _dt.datetime | str | None = None) -> Column:
    """Modification stamp: ``current_timestamp()`` (constant per query) or a fixed time (O-25)."""
    if at is None:
        return F.current_timestamp()
    return F.lit(at).cast(T.TimestampType())


def calendar_date(ts: ColumnOrName, zone: str | None = None) -> Column:
    """Timestamp -> calendar date, optionally in a named zone (O-21, D16)."""
    c = _c(ts)
    if zone:
        c = F.from_utc_timestamp(c.cast(T.TimestampType()), zone)
    return F.to_date(c)


def ends_with_ci(c: ColumnOrName, suffix: str) -> Column:
    """Case-insensitive suffix test (O-74)."""
    return F.lower(_c(c)).endswith(suffix.lower())

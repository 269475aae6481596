"""Column-level helpers shared by all operators.

All of them return built-in Spark expressions (no UDFs), so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MART_MONEY = "decimal(18,2)"


def as_of_date(as_of=None) -> Column:
    """The evaluation day: a literal when given, else ``current_date()``.

    Every recency rule takes it as an argument so results are reproducible.
    """
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.strftime("%Y-%m-%d")
    return F.lit(str(as_of)).cast("date")


def as_of_timestamp(as_of=None) -> Column:
    """Evaluation instant as TIMESTAMP_NTZ (wall clock, no zone shifts)."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    if isinstance(as_of, _dt.datetime):
        return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    if isinstance(as_of, _dt.date):
        as_of = as_of.strftime("%Y-%m-%d")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def is_completed() -> Column:
    """The recognised-revenue rule: ``status = 'completed'``."""
    return F.col("status") == "completed"


def is_returned() -> Column:
    return F.col("status") == "returned"


def money_zero() -> Column:
    """Decimal zero, so ``coalesce(money, 0)`` keeps the decimal type."""
    return F.lit(0).cast(MART_MONEY)


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_ratio(num, den, scale: int, num_type: str = "decimal(22,2)") -> Column:
    """``round(num / den, scale)`` HALF_UP in decimal arithmetic; NULL when
    ``den`` is 0 or NULL.

    ``num`` is cast to ``num_type`` (money: decimal(22,2); counts: a scale-0
    decimal) and ``den`` to decimal(20,0), which leaves >= 14 fractional
    digits before the rounding — the result never depends on binary floating
    point, so any engine computing the exact quotient agrees.
    """
    n = col_of(num).cast(num_type)
    d = F.nullif(col_of(den), F.lit(0)).cast("decimal(20,0)")
    return F.round(n / d, scale)


def to_edge(df: DataFrame) -> DataFrame:
    """Normalise result types at the API edge: money (decimal) leaves as
    DOUBLE, small integers as BIGINT.  Column order is kept."""
    cols = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(field.name))
    return df.select(*cols)

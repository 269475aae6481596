"""Exact distinct counts without ``Expand``.

``count(DISTINCT order_id)``, ``count(DISTINCT CASE WHEN returned THEN
order_id END)`` and friends in one aggregate make Spark copy every input row
once per distinct aggregate (``Expand``) before shuffling.  Deduplicating to
(keys, order_id) first — with the status conditions kept as 0/1 flags and the
other measures as partial aggregates — gives the same numbers with one
shuffle of the fact: the distinct count is then ``count(order_id)`` and each
conditional distinct count is a sum of flags.  Rows with a NULL order id form
one group (map-side combined) that feeds sums but no distinct count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def order_grain(fct: DataFrame, keys=(), flags: dict[str, Column] | None = None,
                aggs: list[Column] | None = None, key: str = "order_id") -> DataFrame:
    """One row per (keys, key): each flag is ``max(cond)`` as 0/1; ``aggs``
    are extra (decomposable) aggregates the caller re-aggregates."""
    exprs = [F.max(F.coalesce(c, F.lit(False)).cast("int")).alias(n) for n, c in (flags or {}).items()]
    exprs += list(aggs or [])
    if not exprs:
        exprs = [F.count(F.lit(1)).alias("_rows")]
    return fct.groupBy(*keys, key).agg(*exprs)


def n_distinct(key: str = "order_id") -> Column:
    """``count(DISTINCT key)`` over an :func:`order_grain` frame."""
    return F.count(key)


def n_distinct_where(flag: str, key: str = "order_id") -> Column:
    """``count(DISTINCT CASE WHEN cond THEN key END)`` over the grain."""
    return F.coalesce(F.sum(F.when(F.col(key).isNotNull(), F.col(flag))), F.lit(0)).cast("bigint")

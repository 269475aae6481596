"""Joins of a fact with a dimension when one key holds a large part of the fact.

``hot_keys`` finds the keys that hold more rows than an average shuffle partition with
one mergeable sketch (``approx_top_k``: bounded memory, one result row, the only thing
that reaches the driver).  ``split_join`` deals the fact rows of these keys over
``salts`` values and copies the dimension rows of these keys, and of no others, once
for each value.  The keys are literals of the plan, so both sides agree on them
whatever the sketch missed or overrated: the result never depends on them.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys a sketch tracks, as a multiple of the keys asked for, and the least number.
TRACKED, LEAST_TRACKED = 20, 4096
MAX_SALTS = 1024
#: Rows that one task of an order-key join sorts and aggregates, about 600 bytes each.
ROWS_PER_TASK = 500_000


@dataclass(frozen=True)
class HotKeys:
    """Keys (never null) with the largest share first, whether null is hot too, and
    into how many parts the rows of one key are dealt."""

    keys: tuple = ()
    null: bool = False
    parts: int = 1

    def __bool__(self) -> bool:
        return bool(self.keys) or self.null

    def holds(self, key: Column) -> Column:
        """Never null."""
        inside = F.coalesce(key.isin(list(self.keys)), F.lit(False)) if self.keys else F.lit(False)
        return inside | key.isNull() if self.null else inside


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def parts_for(df: DataFrame, least: int) -> int:
    """Into how many partitions to deal ``df`` so that one holds about ``ROWS_PER_TASK``
    rows at any size, ``least`` or more.  Runs one count: give a frame that counts from
    its file footers."""
    return max(least, ceil(df.count() / ROWS_PER_TASK))


def hot_keys(df: DataFrame, key: str, over: float = 1.0) -> HotKeys:
    """Keys of ``df`` with more than ``over`` average partitions of rows.  Runs one
    aggregate over the key column: give the narrowest frame that holds it."""
    n = partitions(df)
    wanted = min(n, 1000)
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.count(key).alias("known"),
                 F.expr(f"approx_top_k(`{key}`, {wanted}, {max(LEAST_TRACKED, TRACKED * wanted)})").alias("top")).first()
    limit = over * row["rows"] / n
    top = [(r["item"], r["count"]) for r in row["top"] or [] if r["item"] is not None and r["count"] > limit]
    nulls = row["rows"] - row["known"]
    most = max([c for _, c in top] + [nulls if nulls > limit else 0])
    # a part holds half an average partition
    parts = min(MAX_SALTS, max(2, ceil(2 * n * most / row["rows"]))) if most else 1
    return HotKeys(tuple(k for k, _ in top), nulls > limit, parts)


def split_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner", hot: HotKeys | None = None) -> DataFrame:
    """``fact.join(dim, key, how)`` for an inner or left join; the fact rows of hot
    keys meet copies of their dimension rows in ``hot.parts`` tasks instead of one."""
    if how not in ("inner", "left"):
        raise ValueError(f"split_join does inner and left joins, not {how!r}")
    if not hot:
        return fact.join(dim, key, how)
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns]), F.lit(hot.parts)).cast("int")
    dealt = fact.withColumn("_salt", F.when(hot.holds(F.col(key)), salt).otherwise(0))
    every = F.sequence(F.lit(0), F.lit(hot.parts - 1))
    copied = dim.withColumn("_salt", F.explode(F.when(hot.holds(F.col(key)), every).otherwise(F.array(F.lit(0)))))
    return dealt.join(copied, [key, "_salt"], how).drop("_salt")

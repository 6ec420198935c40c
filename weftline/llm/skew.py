"""Joins whose keys may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import staging
from . import textkernel as K


def join_heavy(left: DataFrame, right: DataFrame, on: list[str], parts: int = 1000) -> DataFrame:
    """The inner join of left with right, which has one row for a key; no task gets all rows of a heavy key.

    A key is heavy if it holds over one in ``parts`` of left's rows. Its rows are dealt to as many parts as it has such
    shares, and right's row is copied to each. There are at most 2 * ``parts`` heavy keys and copies whatever the size of
    the data, so the table of them may be broadcast. left is read several times and should be a stored table.
    """
    share = max(1, left.count() // parts)
    copies, part = (K.fresh([*left.columns, *right.columns], c) for c in ("copies", "part"))
    heavy = staging.put(left.groupBy(*on).agg(F.count("*").alias(copies)).where(F.col(copies) > share).withColumn(copies, F.ceil(F.col(copies) / share).cast("int")), "heavy")
    if heavy.isEmpty():
        return left.join(right, on)
    some = F.coalesce(copies, F.lit(1))
    dealt = left.join(F.broadcast(heavy), on, "left").withColumn(part, F.pmod(F.xxhash64(*left.columns), some).cast("int")).drop(copies)
    copied = right.join(F.broadcast(heavy), on, "left").withColumn(part, F.explode(F.sequence(F.lit(0), some - 1))).drop(copies)
    return dealt.join(copied, [*on, part]).drop(part)

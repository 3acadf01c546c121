"""A filter of keys that rows are tested against before they are shuffled to a join.

The filter is a bit table that a scalar subquery builds while the query runs: nothing runs while the
plan is made, and every task gets ``longs`` longs (half a megabyte by default) however many keys there are. It
may let a row through that has no key, the more the more keys there are, and never stops one that has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONGS = 1 << 16


def may_hold(keys: DataFrame, key: Column, longs: int = LONGS, marks: int = 1) -> Column:
    """Whether ``key`` may be among those in the only column of ``keys``; all are longs. With two ``marks``
    a key sets two bits, from different parts of its value, so keys must be hashes."""
    bits = longs * 64
    places = lambda c: [F.pmod(F.shiftright(c, 29 * i), F.lit(bits)) for i in range(marks)]
    at = F.explode(F.array(*places(F.col(keys.columns[0]))))
    held = (
        keys.select(at.alias("at"))
        .groupBy(F.expr("at div 64").alias("id"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits"))
    )
    every = keys.sparkSession.range(longs).join(held, "id", "left").select(F.struct("id", F.coalesce("bits", F.lit(0)).alias("bits")).alias("s"))
    table = every.agg(F.transform(F.sort_array(F.collect_list("s")), lambda s: s["bits"]).alias("held")).scalar()
    marked = [F.getbit(F.get(table, F.shiftright(own, 6).cast("int")), (own % 64).cast("int")) == 1 for own in places(key)]
    return reduce(lambda a, b: a & b, marked)

"""Running numbers within groups that may be very large.

A window over a whole group is one task; these go over blocks of it and add
what the blocks before hold, so the largest window is one block or the list of
a group's blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(df: DataFrame, group: list[str], block: list[str], order: list, name: str) -> DataFrame:
    """``df`` with ``name``: the place of each row in its group from 0, by ``block``, then ``order``. Blocks must sort like the rows."""
    sizes = df.groupBy(*group, *block).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*group).orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select(*group, *block, before.alias("_before"))
    own = F.row_number().over(Window.partitionBy(*group, *block).orderBy(*order)) - 1
    return df.withColumn("_own", own).join(offsets, [*group, *block]).withColumn(name, F.col("_before") + F.col("_own")).drop("_own", "_before")


def running(df: DataFrame, group: list[str], block: list[str], order: list, flag: Column, carried: Column, names: tuple[str, str]) -> DataFrame:
    """``df`` with the number of true ``flag`` rows up to each row, and the last non-null ``carried`` up to it."""
    marked = df.withColumn("_flag", flag.cast("long")).withColumn("_carried", carried)
    last = F.max_by("_carried", F.when(F.col("_carried").isNotNull(), F.struct(*order)))
    blocks = marked.groupBy(*group, *block).agg(F.sum("_flag").alias("_n"), last.alias("_last"))
    w = Window.partitionBy(*group).orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(*group, *block, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"), F.last("_last", ignorenulls=True).over(w).alias("_earlier"))
    own = Window.partitionBy(*group, *block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = marked.withColumn("_own", F.sum("_flag").over(own)).withColumn("_here", F.last("_carried", ignorenulls=True).over(own)).join(offsets, [*group, *block])
    return out.withColumns({names[0]: F.col("_before") + F.col("_own"), names[1]: F.coalesce("_here", "_earlier")}).drop("_flag", "_carried", "_own", "_here", "_before", "_earlier")

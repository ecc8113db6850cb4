"""Trailing windows over long series without one task a series.

Rows of a series are numbered from counts per time slice; the numbers cut the
series into chunks, each with the rows before it that its windows reach back
to. A series with a third of all rows is as many chunks as it is long.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Rows a chunk.
CHUNK = 8192


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], time: Column, slice_seconds: float = 3600.0) -> DataFrame:
    """Adds ``_row``: the place (from 0) of a row in its series.

    ``time`` (seconds, non-null, ascending with ``order``) gives the slices.
    """
    d = df.withColumn("_slice", F.floor(time / slice_seconds))
    sizes = d.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # one row a slice
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    return d.join(sizes, [*keys, "_slice"]).withColumn("_row", F.col("_before") + F.row_number().over(inside) - 1).drop("_slice", "_before")


def trailing(df: DataFrame, keys: Sequence[str], reach: int, add: Callable[[DataFrame, WindowSpec], DataFrame]) -> DataFrame:
    """Applies ``add`` to a :func:`numbered` table, with a window that reaches back ``reach`` rows.

    ``add`` gets the table and the ordered window of a chunk, on which it may
    use frames of up to ``reach`` preceding rows.
    """
    own = F.floor(F.col("_row") / CHUNK)
    ahead = F.floor((F.col("_row") + reach) / CHUNK)
    d = df.withColumn("_own", own).withColumn("_chunk", F.explode(F.array_distinct(F.array(own, ahead))))
    return add(d, Window.partitionBy(*keys, "_chunk").orderBy("_row")).where("_chunk = _own").drop("_own", "_chunk")

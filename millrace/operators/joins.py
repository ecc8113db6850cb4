"""Lookups that are joins: presence, gaps, and the newest earlier row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.series import numbered, trailing


def as_of(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], slice_seconds: float = 3600.0) -> DataFrame:
    """Each left row with the values of the newest right row of its key at or before ``time``.

    Both sides are united and the last right row is carried forward. Series
    are cut into time slices: inside a slice a window finds the row, and
    across slices only each slice's last right row (one row a slice) is
    carried, so a hot key is as many tasks as it has slices. Right rows with
    null time match nothing; left rows with null time get nulls. Right rows
    that tie in time are taken in the order of their values.
    """
    seconds = F.unix_micros(F.col(time).cast("timestamp")) / 1e6
    entry = F.struct(F.col(time).alias("_at"), *[F.col(v) for v in values])
    carried = right.where(F.col(time).isNotNull()).select(*keys, F.floor(seconds / slice_seconds).alias("_slice"), F.col(time).alias("_t"), F.lit(0).alias("_side"), entry.alias("_entry"))
    lasts = carried.groupBy(*keys, "_slice").agg(F.max("_entry").alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # one row a slice
    own = [c for c in left.columns if c not in keys]
    a = left.select(*keys, F.floor(seconds / slice_seconds).alias("_slice"), F.col(time).alias("_t"), F.lit(1).alias("_side"), F.struct(*own).alias("_row"))
    slices = a.select(*keys, "_slice").distinct().withColumn("_last", F.lit(None).cast(lasts.schema["_last"].dataType)).unionByName(lasts)
    slices = slices.groupBy(*keys, "_slice").agg(F.max("_last").alias("_last")).withColumn("_prior", F.last("_last", ignorenulls=True).over(before)).drop("_last")
    both = a.withColumn("_entry", F.lit(None).cast(lasts.schema["_last"].dataType)).unionByName(carried.withColumn("_row", F.lit(None).cast(a.schema["_row"].dataType)))
    inside = Window.partitionBy(*keys, "_slice").orderBy("_t", "_side", "_entry").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("_found", F.last("_entry", ignorenulls=True).over(inside)).where("_side = 1")
    joined = seen.join(slices, [*keys, "_slice"], "left").withColumn("_found", F.when(F.col("_t").isNotNull(), F.coalesce("_found", "_prior")))
    return joined.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in own], *[F.col(f"_found.{v}").alias(f"asof_{v}") for v in values])


def top_k(df: DataFrame, keys: Sequence[str], by: Sequence[Column], k: int, parts: int = 64) -> DataFrame:
    """The first ``k`` rows of each key in an order that no two rows share.

    Each of ``parts`` splits of a key gives its own first k, and those are
    ranked again, so a hot key is sorted in parts.
    """
    split = F.pmod(F.xxhash64(*df.columns), F.lit(parts))
    some = df.withColumn("_part", split).withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*by))).where(F.col("_r") <= k)
    return some.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where(F.col("_r") <= k).drop("_r", "_part")


def gaps(df: DataFrame, keys: Sequence[str], time_seconds: str, order: Sequence[str], least: float) -> DataFrame:
    """Rows that come more than ``least`` seconds after the row before them, with ``gap``."""

    def add(d: DataFrame, w) -> DataFrame:
        return d.withColumn("gap", F.col(time_seconds) - F.lag(time_seconds).over(w))

    return trailing(numbered(df, keys, order, F.col(time_seconds)), keys, 1, add).where(F.col("gap") > least).drop("_row")

"""Exact profiles: percentiles by rank, length batches, tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nearest_rank(n: Column, p: Column) -> Column:
    """Index ``round-half-even(p * (n - 1))``, within the list."""
    return F.least(F.greatest(F.rint(p * (n - 1)), F.lit(0.0)), n - 1).cast("long")


def floor_rank(n: Column, p: Column) -> Column:
    """Index ``min(n - 1, floor(n * p))``."""
    return F.least(n - 1, F.floor(n * p)).cast("long")


def percentiles(df: DataFrame, group: str, value: str, shares: Sequence[float], rank=nearest_rank) -> DataFrame:
    """``group, p, value``: exact percentiles by a rank definition; null values are left out.

    Rows are first counted per (group, value), so a group is as large as its
    number of distinct values, not its number of rows.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy(group).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("_upto", F.sum("_n").over(order)).withColumn("_all", F.sum("_n").over(Window.partitionBy(group)))
    asked = counts.withColumn("p", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
    at = rank(F.col("_all"), F.col("p"))
    return asked.where((at < F.col("_upto")) & (at >= F.col("_upto") - F.col("_n"))).select(group, "p", F.col(value).alias("value"))


def batch_maxima(df: DataFrame, value: str, row: Column, size: int) -> DataFrame:
    """``batch, longest`` of rows cut into batches of ``size`` by their number (from 0)."""
    return df.withColumn("batch", F.floor(row / size)).groupBy("batch").agg(F.max(value).alias("longest"))


def logits_gib(size: int, mean_longest: Column, vocabulary: int = 151_936) -> Column:
    """Memory of 32-bit logits of a batch."""
    return F.lit(size) * mean_longest * F.lit(vocabulary) * F.lit(4.0) / F.lit(2.0**30)


def image_tokens(t: Column, h: Column, w: Column, merge: int = 2) -> Column:
    """Tokens of a patch grid after merging."""
    return F.floor(t * h * w / (merge * merge)).cast("long")


def video_tokens(frames: int = 32, pixels: int = 16384, patch: int = 28, extra: int = 4, group: int = 4) -> int:
    """Tokens of a video clip: whole patches a frame, merged, with markers."""
    return frames * (pixels // (patch * patch) // group + extra)


def counted_labels(labels: Column, ignored: int = -100) -> Column:
    """Labels that count for the loss."""
    return F.size(F.filter(labels, lambda x: x != ignored))

"""First-failing-reason waterfalls and order-keeping de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEPT = "kept"


def first_reason(rules: Sequence[tuple[str, Column]]) -> Column:
    """The name of the first rule that holds, else null. Null conditions do not hold."""
    out = None
    for name, holds in rules:
        out = F.when(holds, name) if out is None else out.when(holds, name)
    return out


def keep_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """Rows with the smallest ``order`` (unique) of their ``key``.

    The smallest orders come from a partially aggregated grouping and are
    joined back on the unique order, so a key with a third of all rows is
    spread like any other. A null key is a key of its own.
    """
    first = df.groupBy(key).agg(F.min(order).alias(order)).select(order)
    return df.join(first, order, "left_semi")


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """The row with the largest ``order`` of each key, ties broken by later order columns."""
    last = df.groupBy(*keys).agg(F.max(F.struct(*order, *carry)).alias("_last"))
    return last.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in dict.fromkeys([*order, *carry])])


def waterfall(df: DataFrame, rules: Sequence[tuple[str, Column]], key: Column, order: str, duplicate: str = "duplicate") -> DataFrame:
    """Adds ``reason``: the first failing rule, ``duplicate``, or ``kept``.

    Duplicates are looked for only among rows that pass every rule, in
    ``order``; a row dropped earlier never shadows a later one.
    """
    marked = df.withColumn("_reason", first_reason(rules)).withColumn("_key", key)
    first = marked.where("_reason IS NULL").groupBy("_key").agg(F.min(order).alias(order)).select(order, F.lit(True).alias("_first"))
    out = marked.join(first, order, "left")
    reason = F.coalesce("_reason", F.when(F.col("_first"), KEPT).otherwise(duplicate))
    return out.withColumn("reason", reason).drop("_reason", "_key", "_first")


def funnel(df: DataFrame, rules: Sequence[tuple[str, Column]], key: Column, duplicate: str = "duplicate") -> DataFrame:
    """``reason, n`` of a waterfall without ordering rows: counts need no winner."""
    marked = df.select(first_reason(rules).alias("reason"), key.alias("_key"))
    counts = marked.groupBy("reason", F.when(F.col("reason").isNull(), F.col("_key")).alias("_key")).agg(F.count(F.lit(1)).alias("n"))
    kept = F.col("reason").isNull()
    split = F.when(kept, F.array(F.struct(F.lit(KEPT).alias("reason"), F.lit(1).cast("long").alias("n")), F.struct(F.lit(duplicate).alias("reason"), (F.col("n") - 1).alias("n")))).otherwise(F.array(F.struct(F.col("reason").alias("reason"), F.col("n").alias("n"))))
    return counts.select(F.explode(split).alias("r")).groupBy(F.col("r.reason").alias("reason")).agg(F.sum("r.n").alias("n")).where("n > 0")

"""Joins and groupings that stay balanced when one key holds a third of all rows, or move only the rows that can match."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a heavy key that one task takes.
SALT_ROWS = 200_000
#: Bits of a map of keys: so many a key, at most ``MAP_BITS`` (32 MB), and so
#: many in one of its rows (what ``bitmap_construct_agg`` makes).
KEY_BITS, MAP_BITS, MAP_ROW = 16, 1 << 28, 1 << 15


def heavy_keys(df: DataFrame, keys: list[str], share: float = 0.005) -> DataFrame:
    """Keys that hold at least ``share`` of all rows, with their counts.

    At most ``1/share`` keys can qualify, so the result has a proven bound
    (200 rows by default) and may be broadcast whatever the input's size. The
    counting itself is partially aggregated before the shuffle. Null keys are
    not returned: they match nothing in an equi-join. An empty input gives an
    empty result.
    """
    present = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    counted = present.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counted.agg((F.sum("_n") * F.lit(share)).alias("_least"))
    return counted.join(F.broadcast(total), F.col("_n") >= F.greatest(F.col("_least"), F.lit(2.0))).drop("_least")


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", salts: int = 16, share: float = 0.005, spread_by: str | None = None, keys_of: DataFrame | None = None) -> DataFrame:
    """Equi-join in which ``left`` rows of heavy keys are spread over tasks, one for each ``SALT_ROWS`` of them, ``salts`` at least.

    Only ``right`` rows of those (at most ``1/share``) keys are replicated, so
    the right side grows by a bounded amount when its keys are few per heavy
    key. ``how`` may be inner, left, left_semi or left_anti. ``spread_by`` is
    the left column that is hashed for the salt (all columns by default).
    The heavy keys are counted over ``keys_of`` if given: a table with the
    left side's key columns that is cheaper to read than the left side itself.
    Null keys follow the rules of Spark's equi-joins.
    """
    heavy = F.broadcast(heavy_keys((left if keys_of is None else keys_of).select(*keys), keys, share).select(*keys, F.greatest(F.lit(salts), F.ceil(F.col("_n") / SALT_ROWS)).cast("int").alias("_heavy")))
    spread = [F.col(spread_by)] if spread_by else [F.col(c) for c, t in left.dtypes if not t.startswith("map")]
    a = left.join(heavy, keys, "left").withColumn("_salt", F.when(F.col("_heavy").isNotNull(), F.pmod(F.xxhash64(*spread), F.col("_heavy")).cast("int")).otherwise(F.lit(0))).drop("_heavy")
    b = right.join(heavy, keys, "left").withColumn("_salt", F.explode(F.when(F.col("_heavy").isNotNull(), F.sequence(F.lit(0), F.col("_heavy") - 1)).otherwise(F.array(F.lit(0))))).drop("_heavy")
    return a.join(b, [*keys, "_salt"], how).drop("_salt")


def _marked(df: DataFrame, key: str, keys: DataFrame, most: int) -> DataFrame:
    """``df`` with ``_may``: false only where ``key`` is certainly not among ``keys`` (at most ``most`` of them).

    One hash of each of ``keys`` sets one bit of a map that is broadcast, so
    ``df`` stays where it is. The map's size is bounded; with more keys than
    it has room for, more of the other rows are marked, never fewer of theirs.
    """
    bits = min(MAP_BITS, max(MAP_ROW, 1 << (KEY_BITS * most).bit_length()))
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    row, bit = F.floor(place / MAP_ROW).alias("_row"), (place % MAP_ROW).alias("_bit")
    maps = keys.select(row, bit).repartition("_row").groupBy("_row").agg(F.bitmap_construct_agg("_bit").alias("_map"))
    byte = F.expr("cast(conv(hex(substring(_map, cast(_bit div 8 AS int) + 1, 1)), 16, 10) AS int)")
    may = F.coalesce(F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1, F.lit(False))
    return df.select("*", row, bit).join(F.broadcast(maps), "_row", "left").select(*df.columns, may.alias("_may"))


def narrowed(df: DataFrame, key: str, keys: DataFrame, most: int) -> DataFrame:
    """All rows of ``df`` whose ``key`` is among ``keys`` and few others, without moving ``df``.

    For what is joined with ``keys`` afterwards. ``keys`` has the column
    ``key``; repeats do no harm; ``most`` bounds the distinct ones.
    """
    return _marked(df, key, keys, most).where("_may").drop("_may")


def without(df: DataFrame, key: str, keys: DataFrame, most: int) -> DataFrame:
    """Left anti join of ``df`` with ``keys`` in which only rows that may match are moved."""
    marked = _marked(df, key, keys, most)
    return marked.where("NOT _may").drop("_may").unionByName(marked.where("_may").drop("_may").join(keys.select(key), key, "left_anti"))

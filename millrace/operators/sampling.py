"""Deterministic, partition-independent sampling and quotas.

Order comes from ``md5(seed:id)``, so a sample depends only on the rows. The
first k rows of a stratum are found from counts per leading hash digits; only
the digits that hold the cut are ordered row by row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Leading hex digits that split a stratum: 4,096 parts.
DIGITS = 3


def shuffle_key(seed: str, key: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def first_of_strata(df: DataFrame, strata: Sequence[str], takes: DataFrame, order: str, key: str) -> DataFrame:
    """The first ``take`` rows of each stratum by (``order``, ``key``).

    ``takes``: the strata columns and ``take``. ``order`` is a hex text that
    spreads evenly, ``key`` breaks its ties. No stratum is ordered as a whole.
    Null strata are strata like others.
    """
    part = df.withColumn("_part", F.substring(order, 1, DIGITS))
    sizes = part.groupBy(*strata, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*strata).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # 4,096 rows a stratum
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))

    mine = [f"_s{i}" for i in range(len(strata))]
    own = takes.select(*[F.col(c).alias(m) for c, m in zip(strata, mine)], "take")
    plan = sizes.join(own, _all_same(zip(strata, mine))).where("_before < take")
    plan = plan.select(*mine, F.col("_part").alias("_p"), "_n", "_before", "take")
    picked = part.join(plan, _all_same([*zip(strata, mine), ("_part", "_p")])).drop(*mine, "_p")
    whole = picked.where("_before + _n <= take")
    rank = Window.partitionBy(*strata, "_part").orderBy(order, key)
    edge = picked.where("_before + _n > take").withColumn("_r", F.row_number().over(rank)).where("_before + _r <= take").drop("_r")
    return whole.unionByName(edge).drop("_part", "_n", "_before", "take")


def _all_same(pairs: Iterable[tuple[str, str]]) -> Column:
    """Null-safe equality of pairs of columns (an equi-join key for Catalyst)."""
    out = None
    for a, b in pairs:
        same = F.col(a).eqNullSafe(F.col(b))
        out = same if out is None else out & same
    return out


def first_rows(df: DataFrame, take: int | Column, order: str, key: str) -> DataFrame:
    """The first ``take`` rows of a table in shuffled order."""
    one = df.withColumn("_all", F.lit(1))
    takes = df.sparkSession.range(1).select(F.lit(1).alias("_all"), (F.lit(take) if isinstance(take, int) else take).cast("long").alias("take"))
    return first_of_strata(one, ["_all"], takes, order, key).drop("_all")


def allocation(sizes: DataFrame, stratum: str, quota: int | Column, largest_remainder: bool = False) -> DataFrame:
    """``stratum, n, take``: a quota split over strata in proportion to ``n``.

    Each stratum gets the whole part; what is left goes, one each, to the
    largest strata (ties by name), or with ``largest_remainder`` to those with
    the largest fractions. One row a stratum, so the windows are small.
    """
    everything = Window.partitionBy(F.lit(1))
    q = F.lit(quota) if isinstance(quota, int) else quota
    d = sizes.select(stratum, "n", q.cast("long").alias("_q")).withColumn("_total", F.sum("n").over(everything))
    d = d.withColumn("_base", F.floor(F.col("_q") * F.col("n") / F.col("_total")).cast("long")).withColumn("_short", F.col("_q") - F.sum("_base").over(everything))
    by = [(F.col("_q") * F.col("n") / F.col("_total") - F.col("_base")).desc()] if largest_remainder else [F.col("n").desc()]
    d = d.withColumn("_r", F.row_number().over(everything.orderBy(*by, stratum)))
    return d.select(stratum, "n", (F.col("_base") + F.when(F.col("_r") <= F.col("_short"), 1).otherwise(0)).alias("take"))


def stratified(df: DataFrame, stratum: str, quota: int, seed: str, key: str) -> DataFrame:
    """A proportional sample of ``quota`` rows; all rows of a stratum that is too small."""
    sizes = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("n"))
    keyed = df.withColumn("_h", shuffle_key(seed, F.col(key)))
    return first_of_strata(keyed, [stratum], allocation(sizes, stratum, quota).select(stratum, "take"), "_h", key).drop("_h")


def cluster_sample(df: DataFrame, cluster: str, fraction: float, seed: str) -> DataFrame:
    """All rows of a share of the clusters: ``max(1, round-half-even(n * fraction))`` of them."""
    ids = df.where(F.col(cluster).isNotNull()).select(cluster).distinct().withColumn("_h", shuffle_key(seed, F.col(cluster)))
    n = ids.count()
    take = max(1, round(n * fraction)) if fraction < 1 else n
    return df.join(first_rows(ids, take, "_h", cluster).select(cluster), cluster, "left_semi")

"""Health rules over append-only metric logs.

A log row has a run, a time, a step and readings. Rules are column
expressions over trailing windows, the same for batches and streams.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.series import numbered, trailing

KEYS = ["run_id"]
#: Columns that order a log; later ones break ties, so equal rows only may swap.
ORDER = ["ts", "written_at", "step", "loss", "grad_norm"]


def is_finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def finite(x: Column) -> Column:
    """The reading if it is a finite number, else null."""
    return F.when(is_finite(x), x)


def reading_state(x: Column) -> Column:
    """``ok``, ``nan`` or ``inf`` (of either sign), null for no reading: what :func:`finite` leaves out."""
    return F.when(F.isnan(x), "nan").when(F.abs(x) == F.lit(float("inf")), "inf").when(x.isNotNull(), "ok")


def series(log: DataFrame, value: str) -> DataFrame:
    """Numbered rows with a value and a step other than 0 (step 0 is dropped)."""
    rows = log.where(F.col(value).isNotNull() & F.col("step").isNotNull() & (F.col("step") != 0))
    return numbered(rows, KEYS, ORDER, F.col("ts"))


def moving_average(rows: DataFrame, value: str, width: int = 10) -> DataFrame:
    """Adds ``average`` over the row and ``width`` before it, once there are ``width`` before it."""

    def add(d: DataFrame, w) -> DataFrame:
        mean = F.avg(value).over(w.rowsBetween(-width, 0))
        return d.withColumn("average", F.when(F.col("_row") >= width, mean))

    return trailing(rows, KEYS, width, add)


def upper_median(values: Column) -> Column:
    """The middle of a list, of an even one the upper one."""
    return F.get(F.sort_array(values), F.floor(F.size(values) / 2).cast("int"))


def loss_level(rows: DataFrame, last: int = 50, factor: float = 3.0) -> DataFrame:
    """Adds ``median`` (upper, of the last finite losses, this one included) and ``level``.

    CRIT for a loss that is not finite, WARN for one above ``factor`` times a
    positive median, else OK. Losses that are not finite stay out of medians.
    """
    finite = is_finite(F.col("loss"))

    def add(d: DataFrame, w) -> DataFrame:
        return d.withColumn("_last", F.collect_list("loss").over(w.rowsBetween(-(last - 1), 0)))

    good = numbered(rows.where(finite).drop("_row"), KEYS, ORDER, F.col("ts"))
    good = trailing(good, KEYS, last, add).withColumn("median", upper_median(F.col("_last"))).drop("_last")
    spike = (F.col("median") > 0) & (F.col("loss") > factor * F.col("median"))
    good = good.withColumn("level", F.when(spike, "WARN").otherwise("OK"))
    bad = rows.where(~finite).withColumn("median", F.lit(None).cast("double")).withColumn("level", F.lit("CRIT"))
    return good.unionByName(bad)


def streak(rows: DataFrame, holds: Column, reach: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """Adds ``streak``: how many of the last ``reach`` rows, up to this one, hold without a break."""

    def add(d: DataFrame, w) -> DataFrame:
        frame = w.rowsBetween(-(reach - 1), 0)
        d = d.withColumn("_holds", F.coalesce(holds, F.lit(False)))
        broken = F.max(F.when(~F.col("_holds"), F.col("_row"))).over(frame)
        first = F.min("_row").over(frame)
        return d.withColumn("streak", F.col("_row") - F.coalesce(broken, first - 1)).drop("_holds")

    return trailing(rows, keys, reach, add)


def gradient_level(rows: DataFrame, last: int = 40, least: int = 8, large: float = 100.0) -> DataFrame:
    """Adds ``streak`` of zero gradients and ``level``: WARN for a streak or a large gradient, CRIT if not finite."""
    finite = is_finite(F.col("grad_norm"))
    good = streak(numbered(rows.where(finite).drop("_row"), KEYS, ORDER, F.col("ts")), F.col("grad_norm") == 0, last)
    good = good.withColumn("level", F.when((F.col("streak") >= least) | (F.col("grad_norm") > large), "WARN").otherwise("OK"))
    bad = rows.where(~finite).withColumn("streak", F.lit(0).cast("long")).withColumn("level", F.lit("CRIT"))
    return good.unionByName(bad)


def threshold_level(x: Column, warn: float, crit: float) -> Column:
    """CRIT from ``crit`` on, WARN from ``warn`` on, else OK; null for null."""
    return F.when(x >= crit, "CRIT").when(x >= warn, "WARN").when(x.isNotNull(), "OK")


def checkpoint_level(step: Column, n_checkpoints: Column, save_steps: int) -> Column:
    return F.when((step > 0) & (n_checkpoints == 0) & (step >= save_steps), "WARN").otherwise("OK")


def process_level(n_apps: Column, alive: Column) -> Column:
    return F.when((n_apps > 0) | alive, "OK").otherwise("CRIT")


def progress(step: Column, total: Column) -> Column:
    """Percent of all steps, null without a total."""
    return F.when(total > 0, F.lit(100.0) * step / total)


def throughput(log: DataFrame) -> DataFrame:
    """Steps an hour over first and last sample of each run, and the hours left."""
    ends = log.where("step IS NOT NULL").groupBy(*KEYS).agg(F.min(F.struct("ts", "step")).alias("a"), F.max(F.struct("ts", "step")).alias("b"), F.max("total_steps").alias("total"))
    rate = F.when(F.col("b.ts") > F.col("a.ts"), (F.col("b.step") - F.col("a.step")) / (F.col("b.ts") - F.col("a.ts")) * 3600)
    left = F.when(rate > 0, (F.col("total") - F.col("b.step")) / rate)
    return ends.select(*KEYS, rate.alias("steps_per_hour"), left.alias("hours_left"))


def endpoint_slope(log: DataFrame, value: str) -> DataFrame:
    """Difference of the last and first value of each run over the samples between them."""
    ends = log.where(F.col(value).isNotNull()).groupBy(*KEYS).agg(F.min(F.struct("ts", value)).alias("a"), F.max(F.struct("ts", value)).alias("b"), F.count(F.lit(1)).alias("n"))
    return ends.select(*KEYS, "n", F.when(F.col("n") > 1, (F.col(f"b.{value}") - F.col(f"a.{value}")) / (F.col("n") - 1)).alias("slope"))


def _beyond(times: np.ndarray, written: float, least: float, start: int) -> int:
    """The first place from ``start`` on whose time lies more than ``least`` after ``written``."""
    i = max(start, int(np.searchsorted(times, written + least, "right")) - 2)  # sums may round either way
    while i < len(times) and not times[i] - written > least:
        i += 1
    return i


def suppressed_alerts(alerts: DataFrame, key: str, seconds: str, least: float = 1800.0) -> DataFrame:
    """Alerts that are written: a message again only if more than ``least`` seconds passed since it last was.

    ``key`` and ``seconds`` name the message and its time; other columns stay.
    Times that tie are one candidate each, of which the first is written.

    A row that comes more than ``least`` after the row before it is written
    whatever went before, so series are cut at such gaps and each piece is
    walked on its own, streaming over sorted rows. Null keys or times are left
    out.
    """
    rows = alerts.where(F.col(key).isNotNull() & F.col(seconds).isNotNull())

    def add(d: DataFrame, w) -> DataFrame:
        before = F.lag(seconds).over(w)
        return d.withColumn("_cut", F.coalesce(F.col(seconds) - before > least, F.lit(True)))

    marked = trailing(numbered(rows, [key], [seconds], F.col(seconds)), [key], 1, add)
    # cuts before a row, counted per slice of rows, name the piece
    slices = marked.withColumn("_s", F.floor(F.col("_row") / 8192))
    sizes = slices.groupBy(key, "_s").agg(F.sum(F.col("_cut").cast("long")).alias("_n"))
    ahead = Window.partitionBy(key).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).drop("_n")
    inside = Window.partitionBy(key, "_s").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    pieces = slices.join(sizes, [key, "_s"]).withColumn("_piece", F.col("_before") + F.sum(F.col("_cut").cast("long")).over(inside))
    ordered = pieces.repartition(key, "_piece").sortWithinPartitions(key, "_piece", "_row").select(*alerts.columns, "_piece")

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, written = None, 0.0
        for batch in batches:
            keep = np.zeros(len(batch), dtype=bool)
            times = batch[seconds].to_numpy(dtype=float)
            edges = np.flatnonzero((batch[key].ne(batch[key].shift()) | batch["_piece"].ne(batch["_piece"].shift())).to_numpy())
            for a, b in zip(edges, [*edges[1:], len(batch)]):
                own = (batch[key].iat[a], batch["_piece"].iat[a])
                part, i = times[a:b], 0
                if own == at:  # times ascend, so the next row to write is found by bisection
                    i = _beyond(part, written, least, 0)
                while i < len(part):
                    keep[a + i], at, written = True, own, part[i]
                    i = _beyond(part, written, least, i + 1)
            yield batch[keep].drop(columns="_piece")

    return ordered.mapInPandas(walk, alerts.schema)


def status(levels: Sequence[tuple[str, Column]]) -> Column:
    """Rule outputs as (item, level) rows to explode."""
    return F.array(*[F.struct(F.lit(item).alias("item"), level.alias("level")) for item, level in levels])

"""Queries on metric logs: trailing windows, rules, rates and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import joins, monitor
from millrace.session import table


def _log(spark: SparkSession, folder: str) -> DataFrame:
    """The log without repeated rows."""
    return table(spark, folder, "train_metrics").distinct()


def _losses(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.series(_log(spark, folder), "loss")


def moving_avg_11(spark: SparkSession, folder: str) -> DataFrame:
    rows = monitor.moving_average(_losses(spark, folder).where(monitor.is_finite(F.col("loss"))).drop("_row").transform(lambda d: monitor.series(d, "loss")), "loss")
    return rows.select("run_id", "ts", "step", F.round("average", 6).alias("average"))


def spike_upper_median(spark: SparkSession, folder: str) -> DataFrame:
    rows = monitor.loss_level(_losses(spark, folder))
    return rows.where("level <> 'OK'").select("run_id", "ts", "step", monitor.finite(F.col("loss")).alias("loss"), monitor.reading_state(F.col("loss")).alias("loss_state"), F.round("median", 6).alias("median"), "level")


def zero_streak(spark: SparkSession, folder: str) -> DataFrame:
    rows = monitor.gradient_level(monitor.series(_log(spark, folder), "grad_norm"))
    return rows.where("level <> 'OK'").select("run_id", "ts", "step", "grad_norm", "streak", "level")


def idle_streak(spark: SparkSession, folder: str) -> DataFrame:
    """Samples at which some GPU has been idle for three samples in a row (also the debounce rule)."""
    rows = monitor.numbered(_log(spark, folder), monitor.KEYS, [*monitor.ORDER, "iso"], F.col("ts"))
    out = monitor.streak(rows, F.col("gpu_idle_count") > 0, 3)
    return out.where("streak >= 3").select("run_id", "ts", "gpu_idle_count")


def threshold_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Samples by rule and level: anonymous memory, device memory, checkpoint and presence."""
    log = _log(spark, folder)
    levels = monitor.status(
        [
            ("anon_memory", monitor.threshold_level(F.col("anon_mb") / 1024, 42, 47)),
            ("device_memory", F.when(F.col("gpu_mem_max_mb") > 44_000, "WARN").otherwise("OK")),
            ("checkpoint", monitor.checkpoint_level(F.coalesce("step", F.lit(0)), F.lit(0), 500)),
            ("process", monitor.process_level(F.when(F.col("gpu_util_avg") > 0, 1).otherwise(0), F.col("step").isNotNull())),
        ]
    )
    return log.select(F.explode(levels).alias("s")).groupBy(F.col("s.item").alias("item"), F.col("s.level").alias("level")).agg(F.count(F.lit(1)).alias("n"))


def stall_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Samples that come more than 12 minutes after the one before them in their run."""
    found = joins.gaps(_log(spark, folder), ["run_id"], "ts", monitor.ORDER, 720.0)
    return found.select("run_id", "ts", F.round("gap", 6).alias("gap"))


def throughput_eta(spark: SparkSession, folder: str) -> DataFrame:
    out = monitor.throughput(_log(spark, folder))
    return out.select("run_id", F.round("steps_per_hour", 6).alias("steps_per_hour"), F.round("hours_left", 6).alias("hours_left"))


def memory_slope(spark: SparkSession, folder: str) -> DataFrame:
    out = monitor.endpoint_slope(_log(spark, folder), "anon_mb")
    return out.select("run_id", "n", F.round("slope", 6).alias("slope"))


def device_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Readings of each run in GB and percent: peak, mean, and how many were idle or nearly full."""
    log = _log(spark, folder)
    return log.groupBy("run_id").agg(
        F.round(F.max("gpu_mem_max_mb") / 1024, 6).alias("peak_gb"), F.round(F.avg("gpu_util_avg"), 6).alias("mean_util"), F.count_if(F.col("gpu_util_avg") == 0).alias("n_idle"), F.sum("gpu_idle_count").alias("idle_cards"), F.count_if(F.lit(46_068) - F.col("gpu_mem_max_mb") > 8000).alias("n_free")
    )


def progress_share(spark: SparkSession, folder: str) -> DataFrame:
    """How far each run came, in percent of its steps."""
    out = _log(spark, folder).groupBy("run_id").agg(F.max("step").alias("step"), F.max("total_steps").alias("total"))
    return out.select("run_id", F.round(monitor.progress(F.col("step"), F.col("total")), 6).alias("percent"))


def top_readings(spark: SparkSession, folder: str) -> DataFrame:
    """The six samples with most anonymous memory of each run."""
    log = _log(spark, folder).where("anon_mb IS NOT NULL").select("run_id", "anon_mb", "ts")
    return joins.top_k(log, ["run_id"], [F.desc("anon_mb"), F.desc("ts")], 6)


def alert_suppression(spark: SparkSession, folder: str) -> DataFrame:
    """Events of each type that are written when repeats within 1,800 s are not."""
    events = table(spark, folder, "events").select("event_type", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("t"))
    return monitor.suppressed_alerts(events, "event_type", "t")


_L = "l AS (SELECT DISTINCT * FROM train_metrics)"
_O = "ORDER BY ts, written_at, step NULLS FIRST, loss NULLS FIRST, grad_norm NULLS FIRST"
_LOSS = f"{_L}, s AS (SELECT * FROM l WHERE loss IS NOT NULL AND step IS NOT NULL AND step <> 0), f AS (SELECT *, row_number() OVER (PARTITION BY run_id {_O}) - 1 AS i FROM s WHERE isfinite(loss))"

QUERIES = {f.__name__: f for f in (moving_avg_11, spike_upper_median, zero_streak, idle_streak, threshold_levels, stall_gaps, throughput_eta, memory_slope, device_rollup, progress_share, top_readings, alert_suppression)}
ORACLES = {
    "moving_avg_11": f"WITH {_LOSS} SELECT run_id, ts, step, round(CASE WHEN i >= 10 THEN avg(loss) OVER (PARTITION BY run_id ORDER BY i ROWS BETWEEN 10 PRECEDING AND CURRENT ROW) END, 6) AS average FROM f",
    "spike_upper_median": f"""WITH {_LOSS}, m AS (SELECT *, list_sort(list(loss) OVER (PARTITION BY run_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)) AS w FROM f), k AS (SELECT *, w[len(w) // 2 + 1] AS median FROM m)
SELECT run_id, ts, step, loss, 'ok' AS loss_state, round(median, 6) AS median, 'WARN' AS level FROM k WHERE median > 0 AND loss > 3 * median
UNION ALL SELECT run_id, ts, step, NULL, CASE WHEN loss::VARCHAR LIKE '%inf' THEN 'inf' ELSE 'nan' END, NULL, 'CRIT' FROM s WHERE NOT isfinite(loss)""",
    "zero_streak": f"""WITH {_L}, s AS (SELECT * FROM l WHERE grad_norm IS NOT NULL AND step IS NOT NULL AND step <> 0), f AS (SELECT *, row_number() OVER (PARTITION BY run_id {_O}) AS i FROM s WHERE isfinite(grad_norm)),
g AS (SELECT *, max(CASE WHEN grad_norm <> 0 THEN i END) OVER (PARTITION BY run_id ORDER BY i) AS b FROM f), k AS (SELECT *, least(40, i - coalesce(b, 0)) AS streak FROM g)
SELECT run_id, ts, step, grad_norm, streak, 'WARN' AS level FROM k WHERE streak >= 8 OR grad_norm > 100 UNION ALL SELECT run_id, ts, step, grad_norm, 0, 'CRIT' FROM s WHERE NOT isfinite(grad_norm)""",
    "idle_streak": f"""WITH {_L}, f AS (SELECT *, row_number() OVER (PARTITION BY run_id {_O}, iso) AS i FROM l)
SELECT run_id, ts, gpu_idle_count FROM (SELECT *, count(*) FILTER (gpu_idle_count > 0) OVER (PARTITION BY run_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS c FROM f) WHERE c = 3""",
    "threshold_levels": f"""WITH {_L}, x AS (SELECT 'anon_memory' AS item, CASE WHEN anon_mb / 1024 >= 47 THEN 'CRIT' WHEN anon_mb / 1024 >= 42 THEN 'WARN' WHEN anon_mb IS NOT NULL THEN 'OK' END AS level FROM l
UNION ALL SELECT 'device_memory', CASE WHEN gpu_mem_max_mb > 44000 THEN 'WARN' ELSE 'OK' END FROM l UNION ALL SELECT 'checkpoint', CASE WHEN step >= 500 THEN 'WARN' ELSE 'OK' END FROM l
UNION ALL SELECT 'process', CASE WHEN gpu_util_avg > 0 OR step IS NOT NULL THEN 'OK' ELSE 'CRIT' END FROM l) SELECT item, level, count(*) AS n FROM x GROUP BY 1, 2""",
    "stall_gaps": f"WITH {_L} SELECT run_id, ts, round(gap, 6) AS gap FROM (SELECT *, ts - lag(ts) OVER (PARTITION BY run_id {_O}) AS gap FROM l) WHERE gap > 720",
    "throughput_eta": f"""WITH {_L}, e AS (SELECT run_id, min(row(ts, step)) AS a, max(row(ts, step)) AS b, max(total_steps) AS total FROM l WHERE step IS NOT NULL GROUP BY 1),
r AS (SELECT run_id, b[2] AS s, total, CASE WHEN b[1] > a[1] THEN (b[2] - a[2]) / (b[1] - a[1]) * 3600 END AS rate FROM e)
SELECT run_id, round(rate, 6) AS steps_per_hour, round(CASE WHEN rate > 0 THEN (total - s) / rate END, 6) AS hours_left FROM r""",
    "memory_slope": f"WITH {_L}, e AS (SELECT run_id, min(row(ts, anon_mb)) AS a, max(row(ts, anon_mb)) AS b, count(*) AS n FROM l WHERE anon_mb IS NOT NULL GROUP BY 1) SELECT run_id, n, round(CASE WHEN n > 1 THEN (b[2] - a[2]) / (n - 1) END, 6) AS slope FROM e",
    "device_rollup": f"WITH {_L} SELECT run_id, round(max(gpu_mem_max_mb) / 1024, 6) AS peak_gb, round(avg(gpu_util_avg), 6) AS mean_util, count(*) FILTER (gpu_util_avg = 0) AS n_idle, sum(gpu_idle_count)::BIGINT AS idle_cards, count(*) FILTER (46068 - gpu_mem_max_mb > 8000) AS n_free FROM l GROUP BY 1",
    "progress_share": "SELECT run_id, round(CASE WHEN max(total_steps) > 0 THEN 100.0::DOUBLE * max(step) / max(total_steps) END, 6) AS percent FROM train_metrics GROUP BY 1",
    "top_readings": f"WITH {_L} SELECT run_id, anon_mb, ts FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY anon_mb DESC NULLS LAST, ts DESC) AS r FROM l WHERE anon_mb IS NOT NULL) WHERE r <= 6",
    "alert_suppression": """WITH RECURSIVE e AS MATERIALIZED (SELECT event_type, epoch_us(ts) / 1e6 AS t, row_number() OVER (PARTITION BY event_type ORDER BY ts) AS i FROM events),
n AS MATERIALIZED (SELECT a.event_type, a.i, a.t, min(b.i) AS j FROM e a LEFT JOIN e b ON a.event_type = b.event_type AND b.t > a.t + 1800 AND b.t <= a.t + 172800 GROUP BY ALL),
w AS (SELECT event_type, i, t, j FROM n WHERE i = 1 UNION ALL SELECT n.event_type, n.i, n.t, n.j FROM w JOIN n ON n.event_type = w.event_type AND n.i = w.j)
SELECT event_type, t FROM w""",
}

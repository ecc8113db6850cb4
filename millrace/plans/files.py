"""Queries that go through files and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import monitor, profile, quality
from millrace.plans.health import ORACLES as _HEALTH
from millrace.session import discard_at_exit, materialise, shared_folder, table
from millrace.sources import io
from millrace.streaming import monitor_stream


def _folder(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/millrace/{name}-{uuid.uuid4().hex}"
    discard_at_exit(spark, path)
    return path


def jsonl_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Preference records through JSON lines."""
    dpo = table(spark, folder, "dpo_records")
    path = _folder(spark, "jsonl")
    io.write_jsonl(dpo, path)
    back = io.read_jsonl(spark, path, dpo.schema)
    return back.select("pair_id", "source", F.length("chosen.content").cast("long").alias("n"), F.md5("rejected.content").alias("rejected"), F.coalesce(F.size("images"), F.lit(-1)).cast("long").alias("n_images"), "ingested_at")


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The metrics log through CSV, empty cells as nulls."""
    log = table(spark, folder, "train_metrics")
    path = _folder(spark, "csv")
    io.write_csv(log, path, log.columns)
    back = io.read_csv(spark, path, log.schema)
    readings = [f(F.col(c)).alias(n) for c in ("loss", "grad_norm") for f, n in ((monitor.reading_state, f"{c}_state"), (monitor.finite, c))]
    return back.select("run_id", "ts", "step", *readings, "total_steps")


def parquet_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Parts through Parquet shards."""
    part = table(spark, folder, "part")
    path = _folder(spark, "parquet")
    io.save_parquet(part.repartition(3), path)
    return io.read_parquet_tree(spark, path)


def torn_log_parse(spark: SparkSession, folder: str) -> DataFrame:
    """A trainer log as JSON lines: what parses, the last line of each step."""
    log = table(spark, folder, "train_metrics").where("step IS NOT NULL").distinct()
    line = F.to_json(F.struct(F.col("step").alias("current_steps"), "total_steps", "loss", "lr", "epoch"))
    parsed = io.parse_log_objects(log.select("run_id", "ts", "written_at", line.alias("value")), "value", "current_steps long, global_step long, total_steps long, loss double")
    parsed = parsed.withColumn("step", F.coalesce("current_steps", "global_step"))
    return quality.keep_last(parsed, ["run_id", "step"], ["ts", "written_at"], ["loss"]).select("run_id", "step", "ts", monitor.reading_state(F.col("loss")).alias("loss_state"), monitor.finite(F.col("loss")).alias("loss"))


def process_log(spark: SparkSession, folder: str) -> DataFrame:
    """Process log lines written from the metrics, parsed again and summed by name."""
    log = table(spark, folder, "train_metrics").distinct()
    entries = F.array(io.format_process(F.lit(11), F.lit("python"), F.round("anon_mb").cast("long")), io.format_process(F.lit(12), F.lit("pt:worker"), F.round("file_mb").cast("long")))
    lines = log.select(F.concat_ws("  ", F.date_format("iso", "yyyy-MM-dd'T'HH:mm:ss"), entries).alias("value"))
    parsed = io.parse_processes(lines, "value")
    return parsed.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.sum("mb").alias("mb"), F.max("at").alias("last_at"))


def log_errors(spark: SparkSession, folder: str) -> DataFrame:
    """First error line of each document, whole texts searched, cut to 200 characters."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    lines = io.tail_lines(docs, "text")
    bad = lines.where(F.col("value").rlike(r"(?i)error|forbidden|unavailable|skipped one clip") & ~F.contains(F.col("value"), F.lit("skipped one clip |")))
    first = bad.groupBy("doc_id").agg(F.min(F.struct("line", "value")).alias("f"))
    return first.select("doc_id", F.substring("f.value", 1, 200).alias("said"))


def loss_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Last loss in each run note, and the sum of the last 40."""
    losses = F.regexp_extract_all("text", F.lit(r"loss ([0-9.]+)"), F.lit(1))
    notes = table(spark, folder, "documents").select("doc_id", F.transform(losses, lambda x: x.try_cast("double")).alias("l")).where("size(l) > 0")
    last = F.slice("l", F.greatest(F.lit(1), F.size("l") - 39), F.lit(40))
    return notes.select("doc_id", F.element_at("l", -1).alias("loss"), F.round(F.aggregate(last, F.lit(0.0), lambda a, x: a + x), 6).alias("last_40"))


def nested_results(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of nested JSON texts, in percent, with a detail of the splits."""
    from millrace.operators.results import nested_scores

    share = lambda a: F.format_string("%.3f", F.pmod(F.col("n_chars") * a, F.lit(1000)) / 1000)
    text = F.to_json(F.struct(F.struct(share(1).alias("overall")).alias("short"), F.when(F.col("doc_id") % 2 == 0, F.struct(share(7).alias("overall"))).alias("long")))
    scored = table(spark, folder, "documents").where("n_chars IS NOT NULL").select("doc_id", nested_scores(text).alias("s"))
    return scored.select("doc_id", F.round("s.value", 3).alias("value"), F.size(F.split("s.detail", "; ")).cast("long").alias("n_splits"))


def stream_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Newest event of each user and type, by a stream over the table; equals the batch result."""
    source = f"{folder}/events.parquet"
    stream = monitor_stream.log_stream(spark, source, table(spark, folder, "events").schema)
    latest = monitor_stream.latest_per_key(stream, ["user_id", "event_type"], ["ts", "event_id"], ["value"])
    sink = _folder(spark, "stream")
    monitor_stream.run_once(latest, sink, _folder(spark, "stream-state"), "complete")
    return spark.read.parquet(sink)


def stream_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Suppressed alerts by a stateful stream over the table; equals the batch result."""
    stream = monitor_stream.log_stream(spark, f"{folder}/events.parquet", table(spark, folder, "events").schema)
    timed = stream.select("event_type", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("t"))
    sink = _folder(spark, "alerts")
    monitor_stream.run_once(monitor_stream.suppressed(timed, "event_type", "t"), sink, _folder(spark, "alerts-state"))
    return spark.read.parquet(sink)


def fingerprint_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors by fingerprint of their signs, computed once per distinct vector: groups with their size."""
    v = table(spark, folder, "embeddings")
    signs = F.concat_ws("", F.transform("embedding", lambda x: F.when(x >= 0, "1").otherwise("0")))
    prints = materialise(v.select("vec_id", F.sha1(signs).alias("print")), "prints")
    return prints.groupBy("print").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("n")).select("vec_id", "n")


def source_risks(spark: SparkSession, folder: str) -> DataFrame:
    """Records of the sources named in the mix table, with its target as a dimension."""
    docs = table(spark, folder, "documents").groupBy(F.lower(F.trim("source")).alias("source")).agg(F.count(F.lit(1)).alias("n_records"), F.sum(profile.image_tokens(F.lit(1), F.col("n_chars"), F.lit(2))).alias("tokens"))
    return table(spark, folder, "mix_targets").join(docs, "source", "left").select("source", "target_share", F.coalesce("n_records", F.lit(0)).alias("n_records"), F.coalesce("tokens", F.lit(0)).alias("tokens"))


def run_markers(spark: SparkSession, folder: str) -> DataFrame:
    """Slugs of run configurations, and whether the run left a loss (done)."""
    log = table(spark, folder, "train_metrics")
    return log.groupBy(T.slug(F.col("run_id")).alias("slug")).agg(F.count("loss").alias("n_losses")).select("slug", (F.col("n_losses") > 0).alias("done"))


ALERTS = _HEALTH["alert_suppression"]
QUERIES = {f.__name__: f for f in (jsonl_roundtrip, csv_roundtrip, parquet_roundtrip, torn_log_parse, process_log, log_errors, loss_lines, nested_results, stream_latest, stream_alerts, fingerprint_groups, source_risks, run_markers)}
ORACLES = {
    "jsonl_roundtrip": "SELECT pair_id, source, length(chosen.content) AS n, md5(rejected.content) AS rejected, coalesce(len(images), -1) AS n_images, ingested_at FROM dpo_records",
    "csv_roundtrip": "SELECT run_id, ts, step, CASE WHEN isfinite(loss) THEN 'ok' WHEN loss::VARCHAR LIKE '%inf' THEN 'inf' WHEN loss IS NOT NULL THEN 'nan' END AS loss_state, CASE WHEN isfinite(loss) THEN loss END AS loss, CASE WHEN isfinite(grad_norm) THEN 'ok' WHEN grad_norm::VARCHAR LIKE '%inf' THEN 'inf' WHEN grad_norm IS NOT NULL THEN 'nan' END AS grad_norm_state, CASE WHEN isfinite(grad_norm) THEN grad_norm END AS grad_norm, total_steps FROM train_metrics",
    "parquet_roundtrip": "SELECT * FROM part",
    "torn_log_parse": "SELECT run_id, step, ts, CASE WHEN isfinite(loss) THEN 'ok' WHEN loss::VARCHAR LIKE '%inf' THEN 'inf' WHEN loss IS NOT NULL THEN 'nan' END AS loss_state, CASE WHEN isfinite(loss) THEN loss END AS loss FROM (SELECT *, row_number() OVER (PARTITION BY run_id, step ORDER BY ts DESC, written_at DESC, loss DESC NULLS LAST) AS r FROM train_metrics WHERE step IS NOT NULL) WHERE r = 1",
    "process_log": "WITH l AS (SELECT DISTINCT * FROM train_metrics) SELECT 'python' AS name, count(*) AS n, sum(round(anon_mb)) AS mb, date_trunc('second', max(iso)) AS last_at FROM l WHERE anon_mb IS NOT NULL UNION ALL SELECT 'pt:worker', count(*), sum(round(file_mb)), date_trunc('second', max(iso)) FROM l WHERE file_mb IS NOT NULL",
    "log_errors": r"""WITH t AS (SELECT doc_id, string_split(replace(text, chr(13), chr(10)), chr(10)) AS l FROM documents WHERE text IS NOT NULL), e AS (SELECT doc_id, unnest(l) AS v, unnest(range(len(l))) AS i FROM t)
SELECT doc_id, substr(arg_min(v, i), 1, 200) AS said FROM e WHERE regexp_matches(v, '(?i)error|forbidden|unavailable|skipped one clip') AND NOT contains(v, 'skipped one clip |') GROUP BY 1""",
    "loss_lines": "WITH n AS (SELECT doc_id, list_transform(regexp_extract_all(text, 'loss ([0-9.]+)', 1), lambda x: try_cast(x AS DOUBLE)) AS l FROM documents) SELECT doc_id, l[len(l)] AS loss, round(list_sum(l[greatest(1, len(l) - 39):]), 6) AS last_40 FROM n WHERE len(l) > 0",
    "nested_results": "SELECT doc_id, round((n_chars % 1000) / 10.0::DOUBLE, 3) AS value, CASE WHEN doc_id % 2 = 0 THEN 2 ELSE 1 END::BIGINT AS n_splits FROM documents WHERE n_chars IS NOT NULL",
    "stream_latest": "SELECT user_id, event_type, ts, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1",
    "stream_alerts": ALERTS,
    "fingerprint_groups": "SELECT min(vec_id) AS vec_id, count(*) AS n FROM embeddings GROUP BY list_transform(embedding, lambda x: x >= 0)",
    "source_risks": "WITH d AS (SELECT lower(trim(source)) AS source, count(*) AS n_records, sum(n_chars * 2 // 4)::BIGINT AS tokens FROM documents GROUP BY 1) SELECT m.source, target_share, coalesce(n_records, 0) AS n_records, coalesce(tokens, 0) AS tokens FROM mix_targets m LEFT JOIN d USING (source)",
    "run_markers": "SELECT substr(md5(run_id), 1, 8) AS slug, count(loss) > 0 AS done FROM train_metrics GROUP BY run_id",
}

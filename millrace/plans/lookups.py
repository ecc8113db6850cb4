"""Queries on joins, sets, listings and completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import joins
from millrace.operators.skew import salted_join
from millrace.session import table

#: Longest video that is used (strict bound), in seconds.
LONGEST = 180.0


def _listing(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "media_files")


def media_exists_funnel(spark: SparkSession, folder: str) -> DataFrame:
    """Documents by media outcome: none named, file there with content, empty, or missing."""
    files = _listing(spark, folder).groupBy("path").agg(F.max(F.coalesce("n_bytes", F.lit(0))).alias("size"))
    docs = table(spark, folder, "documents").select("doc_id", T.slashed(F.col("media_path")).alias("path"))
    found = salted_join(docs, files, ["path"], "left", spread_by="doc_id")
    state = F.when(F.col("path").isNull(), "no_media").when(F.col("size").isNull(), "media_missing").when(F.col("size") > 1024, "ok").otherwise("too_small")
    return found.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


def semi_join_kept(spark: SparkSession, folder: str) -> DataFrame:
    """Video records whose first video has usable metadata."""
    good = table(spark, folder, "video_meta").where(f"status = 'ok' AND duration IS NOT NULL AND duration < {LONGEST}").select("video_id").distinct()
    sft = table(spark, folder, "sft_records").where("size(videos) > 0").select("rec_id", F.regexp_replace(T.basename(F.get("videos", F.lit(0))), r"\.[^.]*$", "").alias("video_id"))
    return sft.join(good, "video_id", "left_semi").select("rec_id")


def anti_join_todo(spark: SparkSession, folder: str) -> DataFrame:
    """Videos named by records that were never probed."""
    named = table(spark, folder, "sft_records").select(F.explode("videos").alias("raw")).where("trim(raw) <> ''").select(F.regexp_replace(T.basename(F.col("raw")), r"\.[^.]*$", "").alias("video_id")).distinct()
    return named.join(table(spark, folder, "video_meta").select("video_id"), "video_id", "left_anti")


def retry_set(spark: SparkSession, folder: str) -> DataFrame:
    """Videos whose newest probe failed in a way worth another try."""
    last = table(spark, folder, "video_meta").groupBy("video_id").agg(F.max(F.struct("probed_at", "status")).alias("l"))
    return last.where(F.col("l.status").isin("error", "timeout", "blocked")).select("video_id", F.col("l.status").alias("status"))


def two_stage_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Named videos by outcome of probe and length bound; one that probed well but is too long counts as ok."""
    meta = table(spark, folder, "video_meta").groupBy("video_id").agg(F.max(F.struct("probed_at", "status", "duration")).alias("m"))
    named = table(spark, folder, "sft_records").select(F.explode("videos").alias("raw")).where("trim(raw) <> ''").select(F.regexp_replace(T.basename(F.col("raw")), r"\.[^.]*$", "").alias("video_id")).distinct()
    seen = named.join(meta, "video_id", "left")
    use = F.coalesce((F.col("m.status") == "ok") & (F.col("m.duration") < LONGEST), F.lit(False))
    return seen.groupBy(F.when(use, "used").otherwise(F.coalesce("m.status", F.lit("unknown"))).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def failure_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Probes by month with their success rate."""
    meta = table(spark, folder, "video_meta")
    ok = F.sum(F.when(F.col("status") == "ok", 1).otherwise(0))
    return meta.groupBy(F.date_format("probed_at", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"), ok.alias("n_ok"), F.round(F.lit(100.0) * ok / F.greatest(F.count(F.lit(1)), F.lit(1)), 6).alias("rate"))


def set_ops(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes of union, intersection and differences of the media that two tables name."""
    a = table(spark, folder, "sft_records").select(F.explode("images").alias("p")).where("trim(p) <> ''").select(T.slashed(F.col("p")).alias("p")).distinct()
    b = table(spark, folder, "documents").select(T.slashed(F.col("media_path")).alias("p")).where("p IS NOT NULL").distinct()
    flags = a.withColumn("a", F.lit(1)).join(b.withColumn("b", F.lit(1)), "p", "full")
    return flags.agg(F.count(F.lit(1)).alias("n_union"), F.count(F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), 1)).alias("n_both"), F.count(F.when(F.col("b").isNull(), 1)).alias("n_only_a"), F.count(F.when(F.col("a").isNull(), 1)).alias("n_only_b"))


def group_complete(spark: SparkSession, folder: str) -> DataFrame:
    """Folders of the listing: whether every file is there and large enough."""
    files = _listing(spark, folder).withColumn("folder", T.path_prefix(F.col("path")))
    there = F.col("removed_at").isNull() & (F.coalesce("n_bytes", F.lit(0)) > 1024)
    return files.groupBy("folder").agg(F.count(F.lit(1)).alias("n_files"), F.bool_and(there).alias("complete"), F.sum(F.when(there, 0).otherwise(1)).alias("n_lacking"))


def newest_file(spark: SparkSession, folder: str) -> DataFrame:
    """The newest file of each folder, and its age in seconds against the newest of all."""
    files = _listing(spark, folder).where("removed_at IS NULL").withColumn("folder", T.path_prefix(F.col("path")))
    newest = files.groupBy("folder").agg(F.max(F.struct("added_at", "path")).alias("f"))
    top = newest.agg(F.max("f.added_at").alias("top"))
    age = F.round((F.unix_micros(F.col("top").cast("timestamp")) - F.unix_micros(F.col("f.added_at").cast("timestamp"))) / 1e6, 3)
    return newest.join(F.broadcast(top)).select("folder", F.col("f.path").alias("path"), age.alias("age"))


def latest_numbered(spark: SparkSession, folder: str) -> DataFrame:
    """The file with the largest number in its name, by folder and extension."""
    stem = F.regexp_replace(T.basename(F.col("path")), r"\.[^.]*$", "")
    files = _listing(spark, folder).select("path", T.path_prefix(F.col("path")).alias("folder"), F.regexp_extract(stem, r"([0-9]{1,15})$", 1).try_cast("long").alias("k")).where("k IS NOT NULL")
    return files.groupBy("folder").agg(F.max(F.struct("k", "path")).alias("f"), F.countDistinct("path").alias("n_files")).select("folder", F.col("f.path").alias("path"), F.col("f.k").alias("k"), "n_files")


def asof_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Each purchase with the newest error of the same user at or before it."""
    events = table(spark, folder, "events")
    left = events.where("event_type = 'purchase'").select("user_id", "event_id", "ts")
    right = events.where("event_type = 'error'").select("user_id", "ts", F.col("event_id").alias("error_id"), F.col("value").alias("error_value"))
    found = joins.as_of(left, right, ["user_id"], "ts", ["error_id", "error_value"], 86_400.0)
    return found.select("event_id", F.col("asof_error_id").alias("error_id"), F.col("asof_error_value").alias("error_value"))


def sample_state_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Each metrics sample with the newest step and loss written at or before it."""
    log = table(spark, folder, "train_metrics").distinct()
    left = log.select("run_id", F.col("iso").alias("at"), "ts", "anon_mb")
    right = log.where("step IS NOT NULL").select("run_id", F.col("written_at").alias("at"), "step", "loss")
    found = joins.as_of(left, right, ["run_id"], "at", ["step", "loss"])
    return found.select("run_id", "ts", "anon_mb", F.col("asof_step").alias("step"), F.col("asof_loss").alias("loss"))


def conflict_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Media with both dialogue and geometry documents: two kinds that exclude each other."""
    docs = table(spark, folder, "documents").where("media_path IS NOT NULL")
    kinds = docs.groupBy("media_path").agg(F.bool_or(F.col("doc_type") == "dialogue").alias("a"), F.bool_or(F.col("doc_type") == "geometry").alias("b"), F.count(F.lit(1)).alias("n"))
    return kinds.where("a AND b").select("media_path", "n")


_PATH = r"ltrim(replace({0}, '\', '/'), './')"
_STEM = r"regexp_replace(split_part(replace({0}, '\', '/'), '/', -1), '\.[^.]*$', '')"
_NAMED = f"SELECT DISTINCT {_STEM.format('raw')} AS video_id FROM (SELECT unnest(videos) AS raw FROM sft_records) WHERE trim(raw) <> ''"

QUERIES = {
    "media_exists_funnel": media_exists_funnel,
    "semi_join_kept": semi_join_kept,
    "anti_join_todo": anti_join_todo,
    "retry_set": retry_set,
    "two_stage_filter": two_stage_filter,
    "failure_rates": failure_rates,
    "set_ops": set_ops,
    "group_complete": group_complete,
    "newest_file": newest_file,
    "latest_numbered": latest_numbered,
    "asof_latest": asof_latest,
    "sample_state_merge": sample_state_merge,
    "conflict_pairs": conflict_pairs,
}
ORACLES = {
    "media_exists_funnel": f"""WITH f AS (SELECT path, max(coalesce(n_bytes, 0)) AS size FROM media_files GROUP BY 1)
SELECT CASE WHEN media_path IS NULL THEN 'no_media' WHEN size IS NULL THEN 'media_missing' WHEN size > 1024 THEN 'ok' ELSE 'too_small' END AS state, count(*) AS n FROM documents LEFT JOIN f ON path = {_PATH.format('media_path')} GROUP BY 1""",
    "semi_join_kept": f"SELECT rec_id FROM sft_records WHERE len(videos) > 0 AND {_STEM.format('videos[1]')} IN (SELECT video_id FROM video_meta WHERE status = 'ok' AND duration < {LONGEST})",
    "anti_join_todo": f"SELECT video_id FROM ({_NAMED}) WHERE video_id NOT IN (SELECT video_id FROM video_meta WHERE video_id IS NOT NULL)",
    "retry_set": "SELECT video_id, status FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY probed_at DESC, status DESC) AS r FROM video_meta) WHERE r = 1 AND status IN ('error', 'timeout', 'blocked')",
    "two_stage_filter": f"""WITH m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY probed_at DESC, status DESC, duration DESC NULLS LAST) AS r FROM video_meta) WHERE r = 1), n AS ({_NAMED})
SELECT CASE WHEN status = 'ok' AND duration < {LONGEST} THEN 'used' ELSE coalesce(status, 'unknown') END AS outcome, count(*) AS n FROM n LEFT JOIN m USING (video_id) GROUP BY 1""",
    "failure_rates": "SELECT strftime(probed_at, '%Y-%m') AS month, count(*) AS n, count(*) FILTER (status = 'ok') AS n_ok, round(100.0::DOUBLE * count(*) FILTER (status = 'ok') / count(*), 6) AS rate FROM video_meta GROUP BY 1",
    "set_ops": f"""WITH a AS (SELECT DISTINCT {_PATH.format('p')} AS p FROM (SELECT unnest(images) AS p FROM sft_records) WHERE trim(p) <> ''), b AS (SELECT DISTINCT {_PATH.format('media_path')} AS p FROM documents WHERE media_path IS NOT NULL)
SELECT (SELECT count(*) FROM (SELECT p FROM a UNION SELECT p FROM b)) AS n_union, (SELECT count(*) FROM (SELECT p FROM a INTERSECT SELECT p FROM b)) AS n_both, (SELECT count(*) FROM (SELECT p FROM a EXCEPT SELECT p FROM b)) AS n_only_a, (SELECT count(*) FROM (SELECT p FROM b EXCEPT SELECT p FROM a)) AS n_only_b""",
    "group_complete": f"WITH f AS (SELECT split_part({_PATH.format('path')}, '/', 1) AS folder, removed_at IS NULL AND coalesce(n_bytes, 0) > 1024 AS t FROM media_files) SELECT folder, count(*) AS n_files, bool_and(t) AS complete, count(*) FILTER (NOT t) AS n_lacking FROM f GROUP BY 1",
    "newest_file": f"""WITH f AS (SELECT split_part({_PATH.format('path')}, '/', 1) AS folder, path, added_at FROM media_files WHERE removed_at IS NULL), r AS (SELECT *, row_number() OVER (PARTITION BY folder ORDER BY added_at DESC, path DESC) AS i FROM f)
SELECT folder, path, round((epoch_us((SELECT max(added_at) FROM f)) - epoch_us(added_at)) / 1e6, 3) AS age FROM r WHERE i = 1""",
    "latest_numbered": rf"""WITH f AS (SELECT split_part({_PATH.format('path')}, '/', 1) AS folder, path, try_cast(regexp_extract({_STEM.format('path')}, '([0-9]{{1,15}})$', 1) AS BIGINT) AS k FROM media_files), g AS (SELECT * FROM f WHERE k IS NOT NULL)
SELECT folder, path, k, n_files FROM (SELECT *, row_number() OVER (PARTITION BY folder ORDER BY k DESC, path DESC) AS i FROM g) JOIN (SELECT folder, count(DISTINCT path) AS n_files FROM g GROUP BY 1) USING (folder) WHERE i = 1""",
    "asof_latest": """WITH e AS (SELECT user_id, ts, event_id AS error_id, value AS error_value, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS r FROM events WHERE event_type = 'error')
SELECT p.event_id, e.error_id, e.error_value FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM e WHERE r = 1) e ON p.user_id = e.user_id AND p.ts >= e.ts""",
    "sample_state_merge": """WITH d AS (SELECT DISTINCT * FROM train_metrics), s AS (SELECT run_id, written_at, step, loss FROM (SELECT *, row_number() OVER (PARTITION BY run_id, written_at ORDER BY step DESC, loss DESC NULLS LAST) AS r FROM d WHERE step IS NOT NULL) WHERE r = 1)
SELECT d.run_id, d.ts, d.anon_mb, s.step, s.loss FROM d ASOF LEFT JOIN s ON d.run_id = s.run_id AND d.iso >= s.written_at""",
    "conflict_pairs": "SELECT media_path, count(*) AS n FROM documents WHERE media_path IS NOT NULL GROUP BY 1 HAVING bool_or(doc_type = 'dialogue') AND bool_or(doc_type = 'geometry')",
}

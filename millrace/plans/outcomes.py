"""Queries on conversion outcomes, per-model comparisons, runs, checkpoints and devices."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import chat, joins, monitor, pairs, quality, results
from millrace.plans.curation import _annotations
from millrace.plans.health import _L, _O, _log
from millrace.plans.scoring import _FOLD
from millrace.session import discard_at_exit, shared_folder, table
from millrace.sources import io
from millrace.streaming import monitor_stream

# The prefixes whose images a caption source shares, the bounds
# of the usual length classes in seconds, and the note on ranked pairs.
SHARED_PREFIXES = ("coco", "llava")
SHORT, MEDIUM = 120.0, 180.0
ASSUMPTION = "heuristic: length_bonus/length ranking"


def _folder(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/millrace/{name}-{uuid.uuid4().hex}"
    discard_at_exit(spark, path)
    return path


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "media_files").where("path IS NOT NULL").groupBy(F.col("path").alias("found")).agg(F.lit(True).alias("_there"))


def _video_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Video records as question, answer and the first video's path."""
    content = lambda side: F.get(F.filter("messages", lambda m: m["role"] == side), F.lit(0))["content"]
    video = F.get(F.filter("videos", lambda v: v.isNotNull() & (F.trim(v) != "")), F.lit(0))
    return table(spark, folder, "sft_records").select("rec_id", content("user").alias("q"), content("assistant").alias("a"), T.slashed(video).alias("found")).where("found IS NOT NULL")


def conversion_waterfall(spark: SparkSession, folder: str) -> DataFrame:
    """Outcome of converting image annotations: bad conversation, unmapped image, missing file, duplicate or kept."""
    out = _annotations(spark, folder).where("image IS NOT NULL").withColumn("m", chat.normalised(F.col("conversations"), tag="<image>\n"))
    out = out.select("rec_id", "m", T.resolve_image(F.col("image")).alias("found")).join(_listed(spark, folder), "found", "left")
    rules = [("bad_conversation", F.col("m").isNull()), ("unmapped_image", F.col("found").isNull()), ("missing_file", F.col("_there").isNull())]
    return quality.funnel(out, rules, T.record_hash(F.col("m")))


def video_waterfall(spark: SparkSession, folder: str) -> DataFrame:
    """Outcome of converting video annotations: missing video, duplicate or kept."""
    out = _video_pairs(spark, folder).where("q IS NOT NULL AND a IS NOT NULL").join(_listed(spark, folder), "found", "left")
    return quality.funnel(out, [("missing_video", F.col("_there").isNull())], T.record_hash(chat.video_turns(F.col("q"), F.col("a"))))


def video_turns(spark: SparkSession, folder: str) -> DataFrame:
    """Two-turn messages of the video branch, tagged and stripped."""
    m = chat.video_turns(F.col("q"), F.col("a"))
    out = _video_pairs(spark, folder).where("q IS NOT NULL AND a IS NOT NULL").select("rec_id", m.alias("m"))
    return out.select("rec_id", F.md5(F.get("m", F.lit(0))["content"]).alias("question"), F.length(F.get("m", F.lit(1))["content"]).cast("long").alias("answer_chars"))


def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of three models aligned on the first one's ids: improved and regressed by all and by two, net, and format only.

    The sides of the preference records stand for models; the second lacks
    the records without source, the third those without image.
    """
    dpo = table(spark, folder, "dpo_records")
    side = lambda d, c: d.select(F.col("pair_id").alias("index"), F.col(c).alias("said"))
    base = dpo.select(F.col("pair_id").alias("index"), F.col("chosen.content").alias("answer"), F.col("rejected.content").alias("said"))
    return results.compare_models(base, side(dpo.where("source IS NOT NULL"), "chosen.content"), side(dpo.where("size(images) > 0"), "chosen.content"))


def score_pivot(spark: SparkSession, folder: str) -> DataFrame:
    """Report cells, a row a source and a column a language: the mean with its signed difference, or a dash."""
    docs = table(spark, folder, "documents").where("source IS NOT NULL").select(F.lower(F.trim("source")).alias("model"), F.col("lang").alias("bench"), "n_chars")
    scores = docs.groupBy("model", "bench").agg((F.floor(F.avg("n_chars") * 8) / 8).alias("score"))
    return results.pivoted(results.matrix(docs.select("model").distinct(), docs.select("bench").where("bench IS NOT NULL").distinct(), scores, "capfeed"), ["de", "en", "es", "fr"])


def score_files(spark: SparkSession, folder: str) -> DataFrame:
    """Scores written as one quoted CSV a language and read again: names in lower case, cells that are no numbers left out."""
    docs = table(spark, folder, "documents").where("lang IS NOT NULL").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))
    path = _folder(spark, "scores")
    text = F.concat(F.lit('"Perception"," Total, all ",model\n'), F.concat_ws(",", F.concat(F.lit('"'), F.col("n").cast("string"), F.lit('"')), F.col("chars").cast("string"), F.col("lang")))
    docs.select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return io.read_scores(spark, path).groupBy("metric").agg(F.count(F.lit(1)).alias("n_files"), F.sum("value").alias("total"))


def latest_run(spark: SparkSession, folder: str) -> DataFrame:
    """The newest run of each model by the name of its folder (``T`` and a time), and how many there are."""
    runs = _log(spark, folder).select("run_id", F.concat(F.lit("T"), F.date_format("iso", "yyyyMMdd_HH")).alias("name")).distinct()
    return runs.where("startswith(name, 'T')").groupBy("run_id").agg(F.max("name").alias("latest"), F.count(F.lit(1)).alias("n_runs"))


#: Globs of what counts as a checkpoint in the listing.
CHECKPOINTS = ("coco/*", "gqa/*", "vg/*/*", "textvqa/*")


def checkpoint_count(spark: SparkSession, folder: str) -> DataFrame:
    """Number of files that four globs match, and when the newest was added."""
    files = io.matching(table(spark, folder, "media_files").where("removed_at IS NULL"), "path", CHECKPOINTS)
    return files.agg(F.count(F.lit(1)).alias("n"), F.max("added_at").alias("newest"))


def checkpoint_overdue(spark: SparkSession, folder: str) -> DataFrame:
    """Samples by level of the checkpoint rule, against the checkpoints that the listing has at their time."""
    log = _log(spark, folder).where("iso IS NOT NULL").select("run_id", F.col("iso").alias("at"), "ts", F.coalesce("step", F.lit(0)).alias("step"), F.lit(0).alias("_k"))
    files = io.matching(table(spark, folder, "media_files"), "path", ("videos/*",)).where("added_at IS NOT NULL").select(F.lit(0).alias("_k"), F.col("added_at").alias("at"), F.lit(1).cast("long").alias("there"))
    seen = joins.as_of(log, files, ["_k"], "at", ["there"])
    level = monitor.checkpoint_level(F.col("step"), F.coalesce("asof_there", F.lit(0)), 500)
    return seen.groupBy("run_id", level.alias("level")).agg(F.count(F.lit(1)).alias("n"))


def _devices(spark: SparkSession, folder: str) -> DataFrame:
    """Use of each of four devices at each sample: the idle ones first, as many as the sample counts."""
    log = _log(spark, folder)
    util = lambda g: F.when(g < F.coalesce("gpu_idle_count", F.lit(0)), 0.0).otherwise(F.col("gpu_util_avg"))
    each = F.explode(F.array(*[F.struct(F.lit(g).alias("gpu"), util(F.lit(g)).alias("util")) for g in range(4)]))
    return log.select(*log.columns, each.alias("d")).select(*log.columns, "d.gpu", "d.util")


def device_idle_streak(spark: SparkSession, folder: str) -> DataFrame:
    """Samples at which a device has been at 0 % three times in a row, by device."""
    keys = ["run_id", "gpu"]
    rows = monitor.numbered(_devices(spark, folder), keys, [*monitor.ORDER, "iso"], F.col("ts"))
    out = monitor.streak(rows, F.col("util") == 0, 3, keys)
    return out.where("streak >= 3").select("run_id", "gpu", "ts")


def stall_alive(spark: SparkSession, folder: str) -> DataFrame:
    """Stalls of more than 12 minutes while the process was alive: it used a device or had a step."""
    found = joins.gaps(_log(spark, folder), ["run_id"], "ts", monitor.ORDER, 720.0)
    alive = monitor.process_level(F.when(F.col("gpu_util_avg") > 0, 1).otherwise(0), F.col("step").isNotNull()) == "OK"
    return found.where(alive).select("run_id", "ts", F.round("gap", 6).alias("gap"))


def prefix_pool(spark: SparkSession, folder: str) -> DataFrame:
    """Records whose image belongs to a shared prefix, by prefix."""
    image = T.path_prefix(F.col("image"))
    return _annotations(spark, folder).where(image.isin(*SHARED_PREFIXES)).groupBy(image.alias("prefix")).agg(F.count(F.lit(1)).alias("n"))


def duration_kinds(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct videos of the length classes that are asked for."""
    kind = F.when(F.col("duration") < SHORT, "short").when(F.col("duration") < MEDIUM, "medium").otherwise("long")
    meta = table(spark, folder, "video_meta").where("duration IS NOT NULL").withColumn("kind", kind)
    return meta.where(F.col("kind").isin("short", "medium")).groupBy("kind").agg(F.countDistinct("video_id").alias("n"))


def question_contains(spark: SparkSession, folder: str) -> DataFrame:
    """Items whose text holds a literal fragment, letter case aside."""
    parts = ("which WORD", "(or", "next to", "Answer with the letter")
    items = table(spark, folder, "eval_items").select("item_id", F.explode(F.array(*[F.lit(p) for p in parts])).alias("fragment"), "text")
    return items.where(F.contains(F.lower("text"), F.lower("fragment"))).select("item_id", "fragment")


def recent_files(spark: SparkSession, folder: str) -> DataFrame:
    """The newest file of each folder, where one was added within a week before the newest of all, and the number of such."""
    files = table(spark, folder, "media_files").where("added_at IS NOT NULL")
    top = files.agg(F.max("added_at").alias("_top"))
    recent = files.join(F.broadcast(top)).where(F.col("added_at") >= F.col("_top") - F.expr("INTERVAL 7 DAYS"))
    newest = recent.groupBy(T.path_prefix(F.col("path")).alias("folder")).agg(F.max(F.struct("added_at", "path")).alias("f"), F.count(F.lit(1)).alias("n"))
    return newest.select("folder", F.col("f.path").alias("path"), "n")


def detail_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Details of nested score texts, where there are any."""
    share = lambda a: F.format_string("%.3f", F.pmod(F.col("n_chars") * a, F.lit(1000)) / 1000)
    part = lambda a, odd: F.when(F.col("doc_id") % odd == 0, F.struct(share(a).alias("overall")))
    text = F.to_json(F.struct(part(1, 2).alias("short"), part(7, 3).alias("medium")))
    scored = table(spark, folder, "documents").where("n_chars IS NOT NULL").select("doc_id", results.nested_scores(text)["detail"].alias("detail"))
    return scored.where("detail <> ''")


def ranked_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Preference pairs ranked by length, from the first human turn and at least two answers, with the note on the ranking."""
    said = F.transform(F.filter("conversations", lambda t: (t["from"] == "gpt") & t["value"].isNotNull()), lambda t: t["value"])
    rows = _annotations(spark, folder).select("rec_id", chat.first_turn(F.col("conversations")).alias("q"), said.alias("captions")).where("q <> '' AND size(captions) > 1")
    ranked = pairs.best_and_worst(F.col("captions"), F.lit(None).cast("int"))
    return rows.select("rec_id", F.md5("q").alias("question"), F.md5(ranked["best"]).alias("best"), F.md5(ranked["worst"]).alias("worst"), F.lit(ASSUMPTION).alias("assumption"))


def judging_labels(spark: SparkSession, folder: str) -> DataFrame:
    """How each benchmark is judged, with and without a judge model."""
    items = table(spark, folder, "eval_items").select("bench").distinct()
    label = lambda there: results.judging(F.col("bench"), there, ("miniscene",), ("planecheck",))
    return items.select("bench", label(True).alias("with_judge"), label(False).alias("without"))


def word_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Words of each document, and the number at the end of its media path, if any."""
    docs = table(spark, folder, "documents")
    stem = F.regexp_replace(T.basename(F.col("media_path")), r"\.[^.]*$", "")
    return docs.select("doc_id", T.word_count(F.col("text")).cast("long").alias("n_words"), T.number_suffix(F.concat(F.lit("x-"), stem)).alias("number"), T.looked_up(F.col("doc_type"), {"guide": "manual", "fields": "form"}).alias("kind"))


def hash_stems(spark: SparkSession, folder: str) -> DataFrame:
    """Stored names (leading digits of the content hash) of answers, with how many pairs share one."""
    dpo = table(spark, folder, "dpo_records").where("chosen.content IS NOT NULL")
    return dpo.groupBy(T.hash_stem(F.sha1("chosen.content")).alias("stem")).agg(F.count(F.lit(1)).alias("n"))


def json_array_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Evaluation items as one JSON array, read again with and without tolerance for broken files."""
    items = table(spark, folder, "eval_items")  # a fixed, small table: one array is one file
    path = _folder(spark, "array")
    row = F.to_json(F.struct("item_id", "bench", "answer"))
    items.agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list(row)), F.lit("]")).alias("value")).write.text(path)
    strict = io.read_json_array(spark, path, "item_id long, bench string, answer string")
    tolerant, bad = io.read_json_tolerant(spark, path, "item_id long, bench string, answer string")
    both = strict.join(tolerant.select("item_id").withColumn("_t", F.lit(1)), "item_id", "left")
    return both.groupBy("bench").agg(F.count(F.lit(1)).alias("n"), F.count("_t").alias("n_tolerant"), F.count("answer").alias("n_answers"))


def shard_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in Parquet shards by status, read in order of name; rows by footer."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = _folder(spark, "shards")
    orders.write.partitionBy("o_orderstatus").parquet(path)
    shards = io.read_shards(spark, [f"{path}/o_orderstatus={s}" for s in ("P", "F", "O")], "o_orderkey long, o_totalprice double")
    there = F.lit(io.row_count(spark, path)).cast("long")
    return shards.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")).withColumn("n_by_footer", there)


def text_sinks(spark: SparkSession, folder: str) -> DataFrame:
    """Nations appended twice to a CSV, and suppliers by TSV: rows and sums after reading them again."""
    nation, supplier = table(spark, folder, "nation").select("n_nationkey", "n_name"), table(spark, folder, "supplier").select("s_suppkey", "s_name")
    csv, tsv = _folder(spark, "appended"), _folder(spark, "tsv")
    for _ in range(2):
        io.append_csv(nation, csv)
    io.write_tsv(supplier, tsv)
    a = io.read_csv(spark, csv, "n_nationkey int, n_name string").agg(F.lit("csv").alias("sink"), F.count(F.lit(1)).alias("n"), F.sum("n_nationkey").alias("keys"))
    b = spark.read.schema("s_suppkey long, s_name string").option("sep", "\t").csv(tsv).agg(F.lit("tsv").alias("sink"), F.count(F.lit(1)).alias("n"), F.sum("s_suppkey").alias("keys"))
    return a.unionByName(b)


def blob_store(spark: SparkSession, folder: str) -> DataFrame:
    """Answers as bytes keyed by content, each stored once: blobs and bytes by leading digit."""
    dpo = table(spark, folder, "dpo_records").select(F.col("chosen.content").cast("binary").alias("content"))
    path = _folder(spark, "blobs")
    io.write_blobs(dpo, path)
    kept = spark.read.parquet(path)
    return kept.groupBy(F.substring("key", 1, 1).alias("digit")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("content")).alias("n_bytes"))


def stream_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Events by five-minute window and type, by a stream with a watermark: windows that are closed when it ends."""
    stream = monitor_stream.log_stream(spark, f"{folder}/events.parquet", table(spark, folder, "events").schema).withColumn("at", F.col("ts").cast("timestamp"))
    counts = monitor_stream.level_counts(stream, "at", F.when(F.col("event_type") == "error", "WARN").otherwise("OK"))
    sink = _folder(spark, "levels")
    monitor_stream.run_once(counts.select(F.col("window.start").alias("start"), "level", "n"), sink, _folder(spark, "levels-state"))
    return spark.read.parquet(sink).select(F.col("start").cast("timestamp_ntz").alias("start"), "level", "n")


def stream_moving_avg(spark: SparkSession, folder: str) -> DataFrame:
    """Mean of each event's value and the ten before it of its user, by a stream with a count window."""
    stream = monitor_stream.log_stream(spark, f"{folder}/events.parquet", table(spark, folder, "events").schema).where("value IS NOT NULL")
    rows = monitor_stream.moving_average(stream, "user_id", ["ts", "event_id"], "value")
    sink = _folder(spark, "means")
    monitor_stream.run_once(rows, sink, _folder(spark, "means-state"))
    return spark.read.parquet(sink).select("user_id", "event_id", F.round("average", 6).alias("average"))


_STRIP = r"regexp_replace({0}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
_PATH = r"ltrim(replace({0}, '\', '/'), './')"
_VIDEOS = rf"""v AS (SELECT rec_id, list_filter(messages, lambda m: m.role = 'user')[1].content AS q, list_filter(messages, lambda m: m.role = 'assistant')[1].content AS a, {_PATH.format("list_filter(videos, lambda v: v IS NOT NULL AND trim(v) <> '')[1]")} AS found FROM sft_records),
w AS (SELECT * FROM v WHERE q IS NOT NULL AND a IS NOT NULL AND found IS NOT NULL)"""
_TURNS = f"[{{'role': 'user', 'content': '<video>' || chr(10) || {_STRIP.format('q')}}}, {{'role': 'assistant', 'content': {_STRIP.format('a')}}}]"
_KEY = r"lower(trim(regexp_replace(to_json({0}), '[\s\p{{Z}}]+', ' ', 'g')))"
_IMAGE = "list_filter(images, lambda i: i IS NOT NULL AND trim(i) <> '')[1]"
_D = f"{_L}, d AS (SELECT l.*, g.gpu, CASE WHEN g.gpu < coalesce(gpu_idle_count, 0) THEN 0.0 ELSE gpu_util_avg END AS util FROM l, (SELECT unnest(range(4)) AS gpu) g)"


def _funnel_sql(reason: str, key: str, source: str) -> str:
    ranked = f"r AS (SELECT {reason} AS reason, {key} AS h, rec_id FROM {source})"
    return f"{ranked} SELECT coalesce(reason, CASE WHEN i > 1 THEN 'duplicate' ELSE 'kept' END) AS reason, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY h, reason IS NULL ORDER BY rec_id) AS i FROM r) GROUP BY 1"


QUERIES = {
    f.__name__: f
    for f in (
        conversion_waterfall, video_waterfall, video_turns, model_comparison, score_pivot, score_files, latest_run, checkpoint_count, checkpoint_overdue, device_idle_streak, stall_alive,
        prefix_pool, duration_kinds, question_contains, recent_files, detail_rows, ranked_pairs, judging_labels, word_counts, hash_stems, json_array_roundtrip, shard_rows, text_sinks, blob_store,
        stream_levels, stream_moving_avg,
    )
}
ORACLES = {
    "conversion_waterfall": rf"""WITH a AS (SELECT rec_id, messages, {_IMAGE} AS image, {_STRIP.format("messages[1].content")} AS first,
 coalesce(len(messages) >= 2 AND messages[1].role = 'user' AND messages[len(messages)].role = 'assistant' AND len(list_filter(messages, lambda m: coalesce(m.role, '') NOT IN ('user', 'assistant') OR coalesce(regexp_replace(m.content, '[\s\p{{Z}}]+', '', 'g'), '') = '')) = 0, false) AS ok FROM sft_records),
b AS (SELECT *, {_PATH.format("image")} AS p, split_part({_PATH.format("image")}, '/', 1) AS prefix FROM a WHERE image IS NOT NULL),
c AS (SELECT *, CASE prefix WHEN 'coco' THEN 'coco/train2017/' || split_part(p, '/', -1) WHEN 'gqa' THEN 'gqa/images/' || split_part(p, '/', -1) WHEN 'textvqa' THEN 'textvqa/train_images/' || split_part(p, '/', -1) WHEN 'vg' THEN 'vg/' || substr(p, 4) WHEN 'sam' THEN 'sam/images/' || split_part(p, '/', -1) END AS found,
 list_transform(messages, lambda m, i: {{'role': m.role, 'content': CASE WHEN i = 1 AND NOT contains(m.content, '<image>') THEN '<image>' || chr(10) ELSE '' END || {_STRIP.format("m.content")}}}) AS t FROM b),
"""
    + _funnel_sql("CASE WHEN NOT ok THEN 'bad_conversation' WHEN found IS NULL THEN 'unmapped_image' WHEN found NOT IN (SELECT path FROM media_files WHERE path IS NOT NULL) THEN 'missing_file' END", _KEY.format("t"), "c"),
    "video_waterfall": f"WITH {_VIDEOS}, " + _funnel_sql("CASE WHEN found NOT IN (SELECT path FROM media_files WHERE path IS NOT NULL) THEN 'missing_video' END", _KEY.format(_TURNS), "w"),
    "video_turns": f"WITH {_VIDEOS} SELECT rec_id, md5('<video>' || chr(10) || {_STRIP.format('q')}) AS question, length({_STRIP.format('a')}) AS answer_chars FROM w",
    "model_comparison": f"""WITH d AS (SELECT pair_id, chosen.content AS g, rejected.content AS i, CASE WHEN source IS NOT NULL THEN chosen.content END AS s, CASE WHEN len(images) > 0 THEN chosen.content END AS e FROM dpo_records),
n AS (SELECT i AS i0, s AS s0, coalesce({_FOLD.format('g')}, 'nan') AS g, coalesce({_FOLD.format('i')}, 'nan') AS i, coalesce({_FOLD.format('s')}, 'nan') AS s, coalesce({_FOLD.format('e')}, 'nan') AS e FROM d)
SELECT count(*) AS n, count(*) FILTER (i <> g AND s = g AND e = g) AS improved, count(*) FILTER (i = g AND s <> g AND e <> g) AS regressed, count(*) FILTER (i <> g AND s = g AND e = g) - count(*) FILTER (i = g AND s <> g AND e <> g) AS net,
 count(*) FILTER (i <> g AND (s = g OR e = g)) AS improved_by_any, count(*) FILTER (i = s AND coalesce(i0, 'nan') <> coalesce(s0, 'nan')) AS format_only FROM n""",
    "score_pivot": """WITH d AS (SELECT lower(trim(source)) AS model, lang, n_chars FROM documents WHERE source IS NOT NULL), s AS (SELECT model, lang, floor(avg(n_chars) * 8) / 8 AS score FROM d WHERE lang IS NOT NULL GROUP BY 1, 2),
c AS (SELECT s.model, s.lang, printf('%.3f', s.score) || CASE WHEN b.score IS NULL THEN '' ELSE printf(' (%+.3f)', s.score - b.score) END AS cell FROM s LEFT JOIN s b ON b.model = 'capfeed' AND b.lang = s.lang)
SELECT m.model, """
    + ", ".join(f"coalesce(max(cell) FILTER (lang = '{x}'), '—') AS c_{x}" for x in ("de", "en", "es", "fr"))
    + " FROM (SELECT DISTINCT model FROM d) m LEFT JOIN c ON c.model = m.model GROUP BY 1",
    "score_files": "WITH d AS (SELECT lang, count(*) AS n, sum(n_chars) AS chars FROM documents WHERE lang IS NOT NULL GROUP BY 1) SELECT 'perception' AS metric, count(*) AS n_files, sum(n)::DOUBLE AS total FROM d UNION ALL SELECT 'total, all', count(*), sum(chars)::DOUBLE FROM d",
    "latest_run": "SELECT run_id, max(x) AS latest, count(DISTINCT x) AS n_runs FROM (SELECT run_id, 'T' || strftime(iso, '%Y%m%d_%H') AS x FROM train_metrics) WHERE x IS NOT NULL GROUP BY 1",
    "checkpoint_count": "SELECT count(*) AS n, max(added_at) AS newest FROM media_files WHERE removed_at IS NULL AND regexp_matches(path, '^(coco/[^/]*|gqa/[^/]*|vg/[^/]*/[^/]*|textvqa/[^/]*)$')",
    "checkpoint_overdue": f"WITH {_L}, f AS (SELECT min(added_at) AS first FROM media_files WHERE regexp_matches(path, '^videos/[^/]*$')) SELECT run_id, CASE WHEN step >= 500 AND NOT coalesce(iso >= first, false) THEN 'WARN' ELSE 'OK' END AS level, count(*) AS n FROM l, f WHERE iso IS NOT NULL GROUP BY 1, 2",
    "device_idle_streak": f"""WITH {_D}, f AS (SELECT *, row_number() OVER (PARTITION BY run_id, gpu {_O}, iso) AS i FROM d)
SELECT run_id, gpu, ts FROM (SELECT *, count(*) FILTER (util = 0) OVER (PARTITION BY run_id, gpu ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS c FROM f) WHERE c = 3""",
    "stall_alive": f"WITH {_L} SELECT run_id, ts, round(gap, 6) AS gap FROM (SELECT *, ts - lag(ts) OVER (PARTITION BY run_id {_O}) AS gap FROM l) WHERE gap > 720 AND (gpu_util_avg > 0 OR step IS NOT NULL)",
    "prefix_pool": f"SELECT split_part({_PATH.format(_IMAGE)}, '/', 1) AS prefix, count(*) AS n FROM sft_records WHERE split_part({_PATH.format(_IMAGE)}, '/', 1) IN ('coco', 'llava') GROUP BY 1",
    "duration_kinds": "SELECT CASE WHEN duration < 120 THEN 'short' ELSE 'medium' END AS kind, count(DISTINCT video_id) AS n FROM video_meta WHERE duration < 180 GROUP BY 1",
    "question_contains": "SELECT item_id, fragment FROM eval_items, (SELECT unnest(['which WORD', '(or', 'next to', 'Answer with the letter']) AS fragment) WHERE contains(lower(text), lower(fragment))",
    "recent_files": f"WITH f AS (SELECT *, split_part({_PATH.format('path')}, '/', 1) AS folder FROM media_files WHERE added_at >= (SELECT max(added_at) FROM media_files) - INTERVAL 7 DAYS) SELECT folder, arg_max(path, row(added_at, path)) AS path, count(*) AS n FROM f GROUP BY 1",
    "detail_rows": "WITH d AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN printf('short %.1f%%', (n_chars % 1000) / 10.0::DOUBLE) END AS s, CASE WHEN doc_id % 3 = 0 THEN printf('medium %.1f%%', (n_chars * 7 % 1000) / 10.0::DOUBLE) END AS m FROM documents WHERE n_chars IS NOT NULL) SELECT doc_id, concat_ws('; ', s, m) AS detail FROM d WHERE s IS NOT NULL OR m IS NOT NULL",
    "ranked_pairs": f"""WITH d AS (SELECT rec_id, list_filter(messages, lambda m: m.role = 'user')[1].content AS q, list_transform(list_filter(messages, lambda m: m.role = 'assistant' AND m.content IS NOT NULL), lambda m: m.content) AS c FROM sft_records),
e AS (SELECT rec_id, q, unnest(c) AS x, unnest(range(len(c))) AS i FROM d WHERE len(c) > 1 AND q <> '')
SELECT rec_id, md5(any_value(q)) AS question, md5(max(x) FILTER (a = 1)) AS best, md5(max(x) FILTER (z = 1)) AS worst, '{ASSUMPTION}' AS assumption FROM (SELECT *, row_number() OVER (PARTITION BY rec_id ORDER BY length(x) DESC, i) AS a, row_number() OVER (PARTITION BY rec_id ORDER BY length(x), i DESC) AS z FROM e) GROUP BY 1""",
    "judging_labels": "SELECT DISTINCT bench, CASE bench WHEN 'miniscene' THEN 'judge model' WHEN 'planecheck' THEN 'yes or no' ELSE 'default' END AS with_judge, CASE bench WHEN 'miniscene' THEN 'rules, not comparable' WHEN 'planecheck' THEN 'yes or no' ELSE 'default' END AS without FROM eval_items",
    "word_counts": r"SELECT doc_id, coalesce(len(regexp_extract_all(text, '\S+')), 0) AS n_words, try_cast(nullif(regexp_extract(regexp_replace(split_part(replace(media_path, '\', '/'), '/', -1), '\.[^.]*$', ''), '^(.*-)?([0-9]+)$', 2), '') AS BIGINT) AS number, CASE doc_type WHEN 'guide' THEN 'manual' WHEN 'fields' THEN 'form' ELSE doc_type END AS kind FROM documents",
    "hash_stems": "SELECT substr(sha1(chosen.content), 1, 20) AS stem, count(*) AS n FROM dpo_records WHERE chosen.content IS NOT NULL GROUP BY 1",
    "json_array_roundtrip": "SELECT bench, count(*) AS n, count(*) AS n_tolerant, count(answer) AS n_answers FROM eval_items GROUP BY 1",
    "shard_rows": "SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total, count(*) AS n_by_footer FROM orders",
    "text_sinks": "SELECT 'csv' AS sink, 2 * count(*) AS n, 2 * sum(n_nationkey) AS keys FROM nation UNION ALL SELECT 'tsv', count(*), sum(s_suppkey) FROM supplier",
    "blob_store": "SELECT substr(k, 1, 1) AS digit, count(*) AS n, sum(octet_length(encode(c))) AS n_bytes FROM (SELECT DISTINCT sha1(chosen.content) AS k, chosen.content AS c FROM dpo_records WHERE chosen.content <> '') GROUP BY 1",
    "stream_levels": "WITH e AS (SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS start, CASE WHEN event_type = 'error' THEN 'WARN' ELSE 'OK' END AS level FROM events) SELECT start, level, count(*) AS n FROM e WHERE start + INTERVAL 5 MINUTES <= (SELECT max(ts) FROM events) - INTERVAL 15 MINUTES GROUP BY 1, 2",
    "stream_moving_avg": "SELECT user_id, event_id, round(a, 6) AS average FROM (SELECT user_id, event_id, avg(value) OVER w AS a, count(*) OVER w AS k FROM events WHERE value IS NOT NULL AND user_id IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 10 PRECEDING AND CURRENT ROW)) WHERE k = 11",
}

"""Queries on filtering, de-duplication, decontamination and chat structure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import chat, monitor, quality
from millrace.operators.skew import salted_join
from millrace.session import table

#: Most characters of a record (strict bound).
CUTOFF = 11_000


def _present_media(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "media_files").where(F.col("path").isNotNull()).groupBy("path").agg(F.lit(True).alias("_there"))


def _marked(spark: SparkSession, folder: str) -> DataFrame:
    """SFT records with what the waterfall's later rules need: media and evaluation marks."""
    sft = table(spark, folder, "sft_records").select(
        "rec_id",
        "messages",
        T.slashed(F.get(F.filter("media", lambda m: m.isNotNull() & (F.trim(m) != "")), F.lit(0))).alias("path"),
        T.text_hash(F.regexp_replace(F.get("messages", F.lit(0))["content"], "<image>|<video>", "")).alias("asked"),
    )
    sft = salted_join(sft, _present_media(spark, folder), ["path"], "left", spread_by="rec_id")
    held_out = table(spark, folder, "eval_items").select(T.text_hash(F.col("text")).alias("asked")).distinct().withColumn("_eval", F.lit(True))
    return sft.join(held_out, "asked", "left")


def _rules() -> list:
    answer = F.element_at("messages", -1)["content"]
    return [
        ("too_few_messages", F.coalesce(F.size("messages"), F.lit(0)) < 2),
        ("empty_answer", F.coalesce(F.regexp_replace(answer, r"(?U)\s+", ""), F.lit("")) == ""),
        ("too_long", T.total_chars(F.col("messages")) > CUTOFF),
        ("no_media", F.col("path").isNull()),
        ("media_missing", F.col("_there").isNull()),
        ("decontaminated", F.col("_eval").isNotNull()),
    ]


def quality_waterfall(spark: SparkSession, folder: str) -> DataFrame:
    """Records by first failing reason; duplicates counted among survivors only."""
    return quality.funnel(_marked(spark, folder), _rules(), T.record_hash(F.col("messages")))


def quality_survivors(spark: SparkSession, folder: str) -> DataFrame:
    """Records that pass every rule and are the first of their kind."""
    out = quality.waterfall(_marked(spark, folder), _rules(), T.record_hash(F.col("messages")), "rec_id")
    return out.where(F.col("reason") == quality.KEPT).select("rec_id")


def dedup_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", T.text_hash(F.col("text")).alias("h"))
    return quality.keep_first(docs, "h", "doc_id").select("doc_id")


def dedup_groups(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").groupBy(T.text_hash(F.col("text")).alias("h"))
    return docs.agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id", "n")


def record_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """First record of each normalised message list (white space and case do not count)."""
    sft = table(spark, folder, "sft_records").select("rec_id", T.record_hash(F.col("messages")).alias("h"))
    return quality.keep_first(sft, "h", "rec_id").select("rec_id")


def pair_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """First preference pair by answers, per source, then over the union with sources in order of name."""
    dpo = table(spark, folder, "dpo_records").select("pair_id", F.coalesce("source", F.lit("?")).alias("source"), T.pair_hash(F.col("chosen.content"), F.col("rejected.content")).alias("h"))
    first = dpo.groupBy("source", "h").agg(F.min("pair_id").alias("pair_id"))
    return first.groupBy("h").agg(F.min(F.struct("source", "pair_id")).alias("f")).select("f.source", "f.pair_id")


def dedup_keep_last(spark: SparkSession, folder: str) -> DataFrame:
    """Last sample of each step of each run."""
    log = table(spark, folder, "train_metrics").where("step IS NOT NULL")
    last = quality.keep_last(log, ["run_id", "step"], ["ts", "written_at"], ["loss"])
    return last.select("run_id", "step", "ts", "written_at", monitor.reading_state(F.col("loss")).alias("loss_state"), monitor.finite(F.col("loss")).alias("loss"))


def distinct_in_order(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct media paths with the first record that names each."""
    media = table(spark, folder, "sft_records").select("rec_id", F.explode("media").alias("raw")).where("trim(raw) <> ''")
    return media.groupBy(T.slashed(F.col("raw")).alias("path")).agg(F.min("rec_id").alias("first_rec_id"))


def decontam_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Documents whose normalised text is that of an evaluation item."""
    items = table(spark, folder, "eval_items").select(T.text_hash(F.col("text")).alias("h"))
    return table(spark, folder, "documents").select("doc_id", T.text_hash(F.col("text")).alias("h")).join(items, "h", "left_semi").select("doc_id")


def _annotations(spark: SparkSession, folder: str) -> DataFrame:
    """SFT records in the shape of raw annotations: ``from``/``value`` turns and one image."""
    role = lambda m: F.when(m["role"] == "user", "human").when(m["role"] == "assistant", "gpt").otherwise(m["role"])
    turns = F.transform("messages", lambda m: F.struct(role(m).alias("from"), m["content"].alias("value")))
    image = F.get(F.filter("images", lambda i: i.isNotNull() & (F.trim(i) != "")), F.lit(0))
    return table(spark, folder, "sft_records").select("rec_id", image.alias("image"), turns.alias("conversations"))


def chat_normalise(spark: SparkSession, folder: str) -> DataFrame:
    """Valid conversations with their turns, and whether the first turn got a media tag."""
    out = _annotations(spark, folder).withColumn("m", chat.normalised(F.col("conversations"), tag="<image>\n"))
    first = F.get("m", F.lit(0))["content"]
    return out.where("m IS NOT NULL").select("rec_id", F.size("m").cast("long").alias("n_turns"), first.startswith("<image>\n").alias("tagged"), F.length(first).cast("long").alias("first_chars"))


def selection_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """Annotations by selection outcome: no image, excluded or unknown prefix, bad conversation, or pool."""
    out = _annotations(spark, folder).withColumn("m", chat.normalised(F.col("conversations"), tag="<image>\n"))
    return out.groupBy(chat.selection_reason(F.col("image"), F.col("m")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def canonical_records(spark: SparkSession, folder: str) -> DataFrame:
    """Image and video branches of the canonical record, united: media routed by kind."""
    sft = table(spark, folder, "sft_records")
    seen = F.size(F.filter("images", lambda i: F.coalesce(F.trim(i), F.lit("")) != ""))
    image = sft.where(seen > 0).select(F.coalesce("id", F.col("rec_id").cast("string")).alias("id"), F.lit("image").alias("kind"), F.get("images", F.lit(0)).alias("path"))
    video = sft.where(F.size("videos") > 0).select(F.coalesce("id", F.col("rec_id").cast("string")).alias("id"), F.lit("video").alias("kind"), F.get("videos", F.lit(0)).alias("path"))
    routed = chat.routed(image.unionByName(video))
    return routed.groupBy("media_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("images")).alias("n_images"), F.sum(F.size("videos")).alias("n_videos"), F.countDistinct("id").alias("n_ids"))


def answer_lengths(spark: SparkSession, folder: str) -> DataFrame:
    """Total and answer characters of each record with messages."""
    sft = table(spark, folder, "sft_records").where("size(messages) > 0")
    return sft.select("rec_id", T.total_chars(F.col("messages")).alias("n_chars"), F.coalesce(F.length(F.element_at("messages", -1)["content"]), F.lit(0)).cast("long").alias("answer_chars"), F.length(T.joined_contents(F.col("messages"))).cast("long").alias("joined_chars"))


_N = r"lower(trim(regexp_replace({0}, '[\s\p{{Z}}]+', ' ', 'g')))"
_NT = _N.format("text")
_MSG = _N.format("to_json(messages)")
_MARKED = rf"""
WITH f AS (
  SELECT rec_id, messages, len(messages) AS k, messages[len(messages)].content AS answer,
         ltrim(replace(list_filter(media, lambda m: m IS NOT NULL AND trim(m) <> '')[1], '\', '/'), './') AS path,
         coalesce(list_sum(list_transform(messages, lambda m: coalesce(length(m.content), 0))), 0) AS n,
         {_N.format("regexp_replace(messages[1].content, '<image>|<video>', '', 'g')")} AS asked
  FROM sft_records
), r AS (
  SELECT rec_id, {_MSG} AS h,
    CASE WHEN coalesce(k, 0) < 2 THEN 'too_few_messages'
         WHEN coalesce(regexp_replace(answer, '[\s\p{{Z}}]+', '', 'g'), '') = '' THEN 'empty_answer'
         WHEN n > {CUTOFF} THEN 'too_long'
         WHEN path IS NULL THEN 'no_media'
         WHEN path NOT IN (SELECT path FROM media_files WHERE path IS NOT NULL) THEN 'media_missing'
         WHEN asked IN (SELECT {_NT} FROM eval_items WHERE text IS NOT NULL) THEN 'decontaminated' END AS reason
  FROM f
), w AS (
  SELECT rec_id, coalesce(reason, CASE WHEN row_number() OVER (PARTITION BY h, reason IS NULL ORDER BY rec_id) > 1 THEN 'duplicate' ELSE 'kept' END) AS reason FROM r
)
"""
_ANN = r"""
WITH a AS (
  SELECT rec_id, list_filter(images, lambda i: i IS NOT NULL AND trim(i) <> '')[1] AS image, messages,
         len(messages) AS k, messages[1].role AS r1, messages[len(messages)].role AS rn,
         trim(messages[1].content, ' ' || chr(9) || chr(10) || chr(13)) AS first,
         len(list_filter(messages, lambda m: coalesce(m.role, '') NOT IN ('user', 'assistant') OR coalesce(regexp_replace(m.content, '[\s\p{Z}]+', '', 'g'), '') = '')) AS bad
  FROM sft_records
), v AS (
  SELECT *, coalesce(bad = 0 AND k >= 2 AND r1 = 'user' AND rn = 'assistant', false) AS ok,
         split_part(ltrim(replace(image, '\', '/'), './'), '/', 1) AS prefix
  FROM a
)
"""

QUERIES = {
    "quality_waterfall": quality_waterfall,
    "quality_survivors": quality_survivors,
    "dedup_keep_first": dedup_keep_first,
    "dedup_groups": dedup_groups,
    "record_dedup": record_dedup,
    "pair_dedup": pair_dedup,
    "dedup_keep_last": dedup_keep_last,
    "distinct_in_order": distinct_in_order,
    "decontam_exact": decontam_exact,
    "chat_normalise": chat_normalise,
    "selection_reasons": selection_reasons,
    "canonical_records": canonical_records,
    "answer_lengths": answer_lengths,
}
ORACLES = {
    "quality_waterfall": _MARKED + "SELECT reason, count(*) AS n FROM w GROUP BY reason",
    "quality_survivors": _MARKED + "SELECT rec_id FROM w WHERE reason = 'kept'",
    "dedup_keep_first": f"SELECT min(doc_id) AS doc_id FROM documents GROUP BY {_NT}",
    "dedup_groups": f"SELECT min(doc_id) AS doc_id, count(*) AS n FROM documents GROUP BY {_NT} HAVING count(*) > 1",
    "record_dedup": f"SELECT min(rec_id) AS rec_id FROM sft_records GROUP BY {_MSG}",
    "pair_dedup": f"""
WITH p AS (SELECT pair_id, coalesce(source, '?') AS source, {_N.format("coalesce(chosen.content, '') || '||' || coalesce(rejected.content, '')")} AS h FROM dpo_records),
f AS (SELECT source, h, min(pair_id) AS pair_id FROM p GROUP BY ALL)
SELECT source, pair_id FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY source, pair_id) AS r FROM f) WHERE r = 1""",
    "dedup_keep_last": """
SELECT run_id, step, ts, written_at, CASE WHEN isfinite(loss) THEN 'ok' WHEN loss::VARCHAR LIKE '%inf' THEN 'inf' WHEN loss IS NOT NULL THEN 'nan' END AS loss_state, CASE WHEN isfinite(loss) THEN loss END AS loss FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id, step ORDER BY ts DESC, written_at DESC, loss DESC NULLS LAST) AS r FROM train_metrics WHERE step IS NOT NULL) WHERE r = 1""",
    "distinct_in_order": r"SELECT ltrim(replace(raw, '\', '/'), './') AS path, min(rec_id) AS first_rec_id FROM (SELECT rec_id, unnest(media) AS raw FROM sft_records) WHERE trim(raw) <> '' GROUP BY 1",
    "decontam_exact": f"SELECT doc_id FROM documents WHERE {_NT} IN (SELECT {_NT} FROM eval_items)",
    "chat_normalise": _ANN + "SELECT rec_id, k AS n_turns, true AS tagged, length(CASE WHEN contains(first, '<image>') THEN first ELSE '<image>' || chr(10) || first END) AS first_chars FROM v WHERE ok".replace("true AS tagged", "starts_with(CASE WHEN contains(first, '<image>') THEN first ELSE '<image>' || chr(10) || first END, '<image>' || chr(10)) AS tagged"),
    "selection_reasons": _ANN
    + """SELECT CASE WHEN image IS NULL THEN 'no_image' WHEN prefix = 'ocr_vqa' THEN 'excluded_ocr_vqa'
  WHEN prefix NOT IN ('coco', 'gqa', 'textvqa', 'vg', 'sam') THEN 'unknown_prefix_' || prefix
  WHEN NOT ok THEN 'bad_conversation' ELSE 'pool_' || prefix END AS reason, count(*) AS n FROM v GROUP BY 1""",
    "canonical_records": """
SELECT 'image' AS media_type, count(*) AS n, count(*) AS n_images, 0::BIGINT AS n_videos, count(DISTINCT coalesce(id, rec_id::VARCHAR)) AS n_ids FROM sft_records WHERE len(list_filter(images, lambda i: coalesce(trim(i), '') <> '')) > 0
UNION ALL SELECT 'video', count(*), 0, count(*), count(DISTINCT coalesce(id, rec_id::VARCHAR)) FROM sft_records WHERE len(videos) > 0""",
    "answer_lengths": """
SELECT rec_id, list_sum(list_transform(messages, lambda m: coalesce(length(m.content), 0)))::BIGINT AS n_chars, coalesce(length(messages[len(messages)].content), 0) AS answer_chars,
  (list_sum(list_transform(messages, lambda m: coalesce(length(m.content), 0))) + len(messages))::BIGINT AS joined_chars FROM sft_records WHERE len(messages) > 0""",
}

"""Queries on text functions, rewards, results and preference records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import reward
from millrace.functions import text as T
from millrace.operators import monitor, pairs, results
from millrace.session import table

# Predictions and gold answers with their reward.
GOLDEN = [
    ("145", "<answer> 145° </answer>"),
    ("<think>x</think><answer>C</answer>", "c"),
    ("The answer is B", "B"),
    ("13", "3"),
    ("1/2", "0.5"),
    ("1,234.0", "1234"),
    ("3 .", "3"),
    ("", "3"),
]


def _literal(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    return spark.createDataFrame(rows, ddl)


def path_resolve(spark: SparkSession, folder: str) -> DataFrame:
    """Where each image path of the records leads."""
    raw = table(spark, folder, "sft_records").select("rec_id", F.posexplode("images").alias("i", "raw")).where("trim(raw) <> ''")
    return raw.select("rec_id", F.col("i").cast("long").alias("i"), T.path_prefix(F.col("raw")).alias("prefix"), T.resolve_image(F.col("raw")).alias("path"))


def id_prefix_strip(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "video_meta").select("video_id", T.strip_prefix_once(F.col("video_id"), "v_").alias("clip")).distinct()


def media_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Listed files that share a key of name and size."""
    files = table(spark, folder, "media_files").where("n_bytes IS NOT NULL")
    return files.groupBy(T.media_key(F.col("path"), F.col("n_bytes")).alias("k")).agg(F.min("file_id").alias("file_id"), F.count(F.lit(1)).alias("n")).where("n > 1").select("file_id", "n")


def error_taxonomy(spark: SparkSession, folder: str) -> DataFrame:
    """Probe states by the first failure mark in their text, most frequent first."""
    meta = table(spark, folder, "video_meta")
    return meta.groupBy(T.first_mark(F.col("status"), T.PROBE_ERRORS).alias("kind")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "kind")


def fetch_taxonomy(spark: SparkSession, folder: str) -> DataFrame:
    """Download outcomes by the first mark in their message, with the default of messages without any."""
    said = table(spark, folder, "video_meta").select(F.when(F.col("duration").isNull(), F.concat(F.lit("Requested format is not available, "), "status")).otherwise(F.concat(F.lit("video "), F.upper("status"))).alias("said"))
    return said.groupBy(T.first_mark(F.col("said"), T.FETCH_ERRORS).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def answer_norm(spark: SparkSession, folder: str) -> DataFrame:
    dpo = table(spark, folder, "dpo_records")
    return dpo.select("pair_id", F.md5(T.trim_answer(F.col("chosen.content"))).alias("chosen"), F.length(T.trim_answer(F.col("chosen.content"))).cast("long").alias("n"))


def tag_extract(spark: SparkSession, folder: str) -> DataFrame:
    """Inner text of the first answer tag, on answers dressed in thinking and answer tags."""
    dpo = table(spark, folder, "dpo_records").where("chosen.content IS NOT NULL")
    tag = F.element_at(F.array(*[F.lit(t) for t in T.ANSWER_TAGS]), (F.pmod("pair_id", F.lit(3)) + 1).cast("int"))
    dressed = F.concat(F.lit("<think>"), F.col("rejected.content"), F.lit("</think><"), tag, F.lit(">"), F.col("chosen.content"), F.lit("</"), F.upper(tag), F.lit("> end"))
    return dpo.where("rejected.content IS NOT NULL").select("pair_id", F.md5(T.inner_answer(dressed)).alias("inner"))


def number_extract(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "dpo_records").select("pair_id", T.first_number(F.col("chosen.content")).alias("chosen"), T.first_number(F.col("rejected.content")).alias("rejected"))


def reward_score(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected answers scored against the chosen ones, with a format share."""
    dpo = table(spark, folder, "dpo_records")
    tagged = F.concat(F.lit("<think>t</think><answer>"), F.col("rejected.content"), F.lit("</answer>"))
    thinking = F.concat(F.lit("<Think>still on it "), F.col("rejected.content"))  # never closed
    prediction = F.when(F.col("pair_id") % 2 == 0, tagged).when(F.col("pair_id") % 4 == 1, thinking).otherwise(F.col("rejected.content"))
    return dpo.select("pair_id", reward.answer_reward(F.coalesce(prediction, F.lit("")), F.coalesce("chosen.content", F.lit(""))).alias("answer"), reward.score(F.coalesce(prediction, F.lit("")), F.col("chosen.content"), 0.9, 0.1).alias("score"))


def reward_golden(spark: SparkSession, folder: str) -> DataFrame:
    rows = _literal(spark, GOLDEN, "pred string, gold string")
    return rows.select("pred", "gold", reward.answer_reward(F.col("pred"), F.col("gold")).alias("reward"))


def result_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Mean characters of every source and language, with the difference to the baseline source."""
    docs = table(spark, folder, "documents").select(F.coalesce(F.lower(F.trim("source")), F.lit("?")).alias("model"), F.coalesce("lang", F.lit("?")).alias("bench"), "n_chars")
    scores = docs.groupBy("model", "bench").agg(F.round(F.avg("n_chars"), 6).alias("score"))
    return results.matrix(docs.select("model").distinct(), docs.select("bench").distinct(), scores, "capfeed", 3)


def pivot_matrix(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").groupBy("doc_type").pivot("lang", ["de", "en", "es", "fr"]).agg(F.count(F.lit(1)))
    return docs.na.fill(0).select("doc_type", *[F.col(c).alias(f"n_{c}") for c in ("de", "en", "es", "fr")])


def disclosure_status(spark: SparkSession, folder: str) -> DataFrame:
    """Whether decontamination ran, per benchmark: no items, items without text, or executed."""
    items = table(spark, folder, "eval_items").groupBy("bench").agg(F.count(F.lit(1)).alias("n_items"), F.count(F.when(T.norm_text(F.col("text")) != "", 1)).alias("n_prints"))
    return items.select("bench", "n_items", "n_prints", results.disclosure(F.col("n_items"), F.col("n_prints")).alias("status"))


def melt_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Numeric columns of the parts table as rows, with totals."""
    part = table(spark, folder, "part")
    long = part.unpivot(["p_partkey"], [F.col("p_size").cast("double").alias("p_size"), "p_retailprice"], "metric", "value")
    return long.groupBy("metric").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


def first_file_wins(spark: SparkSession, folder: str) -> DataFrame:
    """For each metric step, the value of the first run (by name) that has one."""
    log = table(spark, folder, "train_metrics").where("step IS NOT NULL AND loss IS NOT NULL")
    first = log.groupBy("step").agg(F.min(F.struct("run_id", "loss")).alias("f"))
    return first.select("step", F.col("f.run_id").alias("run_id"), monitor.reading_state(F.col("f.loss")).alias("loss_state"), monitor.finite(F.col("f.loss")).alias("loss"))


def json_drilldown(spark: SparkSession, folder: str) -> DataFrame:
    """Nested values of a JSON text: one key, scaled, with a default."""
    events = table(spark, folder, "events")
    k = F.get_json_object("props", "$.k").try_cast("double")
    return events.groupBy("event_type").agg(F.count(k).alias("n_k"), F.round(F.avg(k) * 100, 6).alias("mean_k"), F.max(F.coalesce(k, F.lit(-1.0))).alias("max_k"))


def score_scrape(spark: SparkSession, folder: str) -> DataFrame:
    """Scores found in log-like lines made of the events."""
    line = F.concat(F.lit("step done; Accuracy = "), F.format_string("%.2f", "value"), F.lit(" after"))
    return table(spark, folder, "events").select("event_id", T.scraped_score(line).alias("score"))


def multiway_compare(spark: SparkSession, folder: str) -> DataFrame:
    """Answers to one question over sources: improved, regressed and net change against the first."""
    dpo = table(spark, folder, "dpo_records").where("size(messages) > 0").select(F.md5(F.get("messages", F.lit(0))["content"]).alias("index"), "pair_id", T.trim_answer(F.col("chosen.content")).alias("gold"), T.trim_answer(F.col("rejected.content")).alias("said"))
    return results.compare_sides(dpo)


def answer_share(spark: SparkSession, folder: str) -> DataFrame:
    """Share of yes among yes/no answers, by source."""
    yes, no = ["yes", "ja", "oui", "sí"], ["no", "nein", "non"]
    turns = F.explode(F.filter("messages", lambda m: m["role"] == "assistant")).alias("m")
    sft = table(spark, folder, "sft_records").select(F.coalesce("source", F.lit("?")).alias("source"), turns).select("source", F.col("m.content").alias("raw"))
    said = sft.select("source", T.trim_answer(F.col("raw")).alias("a")).where(F.col("a").isin(*yes, *no))
    return said.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.when(F.col("a").isin(*yes), 1.0).otherwise(0.0)) * 100, 6).alias("yes_share"))


def pref_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Preference records parsed from JSON texts; broken ones drop out."""
    dpo = table(spark, folder, "dpo_records")
    text = F.to_json(F.struct(F.get("messages", F.lit(0))["content"].alias("question"), F.col("chosen.content").alias("chosen"), F.col("rejected.content").alias("rejected")))
    out = pairs.parsed_preferences(dpo.select("pair_id", text.alias("text")), "text")
    return out.select("pair_id", F.size("messages").cast("long").alias("n_messages"), F.length("chosen.content").cast("long").alias("chosen_chars"), F.length("rejected.content").cast("long").alias("rejected_chars"))


def best_worst(spark: SparkSession, folder: str) -> DataFrame:
    """Longest and shortest assistant turn of each record with two of them."""
    said = F.transform(F.filter("messages", lambda m: (m["role"] == "assistant") & m["content"].isNotNull()), lambda m: m["content"])
    sft = table(spark, folder, "sft_records").select("rec_id", said.alias("captions"), F.when(F.col("rec_id") % 2 == 0, F.lit(40)).alias("bonus")).where("size(captions) > 1")
    ranked = pairs.best_and_worst(F.col("captions"), F.col("bonus"))
    return sft.select("rec_id", F.md5(ranked["best"]).alias("best"), F.md5(ranked["worst"]).alias("worst"))


def schema_unify(spark: SparkSession, folder: str) -> DataFrame:
    """Questions and answers of three tables under one schema, by origin."""
    items = table(spark, folder, "eval_items").select(F.col("text").alias("problem"), F.col("answer").alias("solution"))
    dpo = table(spark, folder, "dpo_records").select(F.get("messages", F.lit(0))["content"].alias("question"), F.col("chosen.content").alias("answer"))
    docs = table(spark, folder, "documents").select(F.col("text").alias("query"), F.col("doc_type").alias("label"))
    both = pairs.unified({"eval_items": items, "dpo_records": dpo, "documents": docs})
    return both.groupBy("origin").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("problem")).alias("problem_chars"), F.count("answer").alias("n_answers"))


_FOLD = r"regexp_replace(lower({0}), '^[\s\p{{Z}}]+|[\s\p{{Z}}.!。，,]+$', '', 'g')"
_INNER = r"CASE WHEN regexp_matches(t, '(?is)<\s*answer\s*>(.*?)<\s*/\s*answer\s*>') THEN regexp_extract(t, '(?is)<\s*answer\s*>(.*?)<\s*/\s*answer\s*>', 1) ELSE t END"
_NORM = r"trim(regexp_replace(replace(replace(regexp_replace(lower(regexp_replace({0}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')), '[.。]+$', ''), '×', '*'), '÷', '/'), '[\s\p{{Z}}]+', ' ', 'g'))"
_NUM = r"try_cast(nullif(regexp_extract(replace({0}, ',', ''), '-?[0-9]+\.?[0-9]*', 0), '') AS DOUBLE)"


def _reward_sql(p: str, g: str) -> str:
    a, b = _NUM.format(p), _NUM.format(g)
    return f"CASE WHEN {_NORM.format(p)} = '' OR {_NORM.format(g)} = '' THEN 0.0::DOUBLE WHEN {_NORM.format(p)} = {_NORM.format(g)} OR coalesce(abs({a} - {b}) <= greatest(1e-4 * greatest(abs({a}), abs({b})), 1e-4), false) OR contains({_NORM.format(p)}, {_NORM.format(g)}) THEN 1.0 ELSE 0.0 END"


QUERIES = {
    f.__name__: f
    for f in (
        path_resolve, id_prefix_strip, media_keys, error_taxonomy, fetch_taxonomy, answer_norm, tag_extract, number_extract, reward_score, reward_golden, result_matrix, pivot_matrix,
        disclosure_status, melt_scores, first_file_wins, json_drilldown, score_scrape, multiway_compare, answer_share, pref_pairs, best_worst, schema_unify,
    )
}
_P = r"ltrim(replace(raw, '\', '/'), './')"
ORACLES = {
    "path_resolve": rf"""WITH r AS (SELECT rec_id, unnest(images) AS raw, unnest(range(len(images))) AS i FROM sft_records), p AS (SELECT rec_id, i, {_P} AS p, split_part({_P}, '/', 1) AS prefix FROM r WHERE trim(raw) <> '')
SELECT rec_id, i, prefix, CASE prefix WHEN 'coco' THEN 'coco/train2017/' || split_part(p, '/', -1) WHEN 'gqa' THEN 'gqa/images/' || split_part(p, '/', -1) WHEN 'textvqa' THEN 'textvqa/train_images/' || split_part(p, '/', -1) WHEN 'vg' THEN 'vg/' || substr(p, 4) WHEN 'sam' THEN 'sam/images/' || split_part(p, '/', -1) END AS path FROM p""",
    "id_prefix_strip": "SELECT DISTINCT video_id, regexp_replace(video_id, '^v_', '') AS clip FROM video_meta",
    "media_keys": r"SELECT min(file_id) AS file_id, count(*) AS n FROM media_files WHERE n_bytes IS NOT NULL GROUP BY split_part(replace(path, '\', '/'), '/', -1), n_bytes HAVING count(*) > 1",
    "error_taxonomy": """SELECT CASE WHEN contains(s, 'unavailable') THEN 'unavailable' WHEN contains(s, 'private') THEN 'private' WHEN contains(s, 'removed') THEN 'removed' WHEN contains(s, 'blocked') THEN 'blocked' WHEN contains(s, 'age') THEN 'age_restricted' ELSE 'error' END AS kind, count(*) AS n
FROM (SELECT coalesce(lower(status), '') AS s FROM video_meta) GROUP BY 1""",
    "fetch_taxonomy": """SELECT CASE WHEN contains(s, 'requested format') THEN 'no_format' WHEN contains(s, 'private') THEN 'private' WHEN contains(s, 'unavailable') OR contains(s, 'removed') THEN 'unavailable' ELSE 'error' END AS kind, count(*) AS n
FROM (SELECT lower(CASE WHEN duration IS NULL THEN 'Requested format is not available, ' || status ELSE 'video ' || status END) AS s FROM video_meta) GROUP BY 1""",
    "answer_norm": f"SELECT pair_id, md5({_FOLD.format('chosen.content')}) AS chosen, length({_FOLD.format('chosen.content')}) AS n FROM dpo_records",
    "tag_extract": "SELECT pair_id, md5(chosen.content) AS inner FROM dpo_records WHERE chosen.content IS NOT NULL AND rejected.content IS NOT NULL".replace("AS inner", 'AS "inner"'),
    "number_extract": f"SELECT pair_id, {_NUM.format('chosen.content')} AS chosen, {_NUM.format('rejected.content')} AS rejected FROM dpo_records",
    "reward_score": f"""WITH d AS (SELECT pair_id, CASE WHEN rejected.content IS NULL THEN 0 WHEN pair_id % 2 = 0 THEN 1 WHEN pair_id % 4 = 1 THEN 0.5 ELSE 0 END::DOUBLE AS tagged, coalesce(CASE WHEN pair_id % 4 = 1 THEN '<think>still on it ' ELSE '' END || rejected.content, '') AS p, coalesce(chosen.content, '') AS g FROM dpo_records), r AS (SELECT pair_id, tagged, {_reward_sql('p', 'g')} AS answer FROM d)
SELECT pair_id, answer, 0.9::DOUBLE * answer + 0.1::DOUBLE * tagged AS score FROM r""",
    "reward_golden": "SELECT pred, gold, reward FROM (VALUES ('145', '<answer> 145° </answer>', 1.0::DOUBLE), ('<think>x</think><answer>C</answer>', 'c', 1.0), ('The answer is B', 'B', 1.0), ('13', '3', 1.0), ('1/2', '0.5', 0.0), ('1,234.0', '1234', 1.0), ('3 .', '3', 1.0), ('', '3', 0.0)) AS t(pred, gold, reward)",
    "result_matrix": """WITH d AS (SELECT coalesce(lower(trim(source)), '?') AS model, coalesce(lang, '?') AS bench, n_chars FROM documents), s AS (SELECT model, bench, round(avg(n_chars), 6) AS score FROM d GROUP BY 1, 2),
g AS (SELECT model, bench FROM (SELECT DISTINCT model FROM d), (SELECT DISTINCT bench FROM d))
SELECT g.model, g.bench, s.score, round(s.score - b.score, 3) AS delta FROM g LEFT JOIN s USING (model, bench) LEFT JOIN (SELECT bench, score FROM s WHERE model = 'capfeed') b ON b.bench = g.bench""",
    "pivot_matrix": "SELECT doc_type, count(*) FILTER (lang = 'de') AS n_de, count(*) FILTER (lang = 'en') AS n_en, count(*) FILTER (lang = 'es') AS n_es, count(*) FILTER (lang = 'fr') AS n_fr FROM documents GROUP BY 1",
    "disclosure_status": "SELECT bench, count(*) AS n_items, count(*) FILTER (trim(text) <> '') AS n_prints, CASE WHEN count(*) = 0 THEN 'not_run' WHEN count(*) FILTER (trim(text) <> '') = 0 THEN 'not_effective' ELSE 'executed' END AS status FROM eval_items GROUP BY 1",
    "melt_scores": "SELECT metric, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT 'p_size' AS metric, p_size::DOUBLE AS value FROM part UNION ALL SELECT 'p_retailprice', p_retailprice FROM part) GROUP BY 1",
    "first_file_wins": "SELECT step, run_id, CASE WHEN isfinite(loss) THEN 'ok' WHEN loss::VARCHAR LIKE '%inf' THEN 'inf' WHEN loss IS NOT NULL THEN 'nan' END AS loss_state, CASE WHEN isfinite(loss) THEN loss END AS loss FROM (SELECT *, row_number() OVER (PARTITION BY step ORDER BY run_id, loss) AS r FROM train_metrics WHERE step IS NOT NULL AND loss IS NOT NULL) WHERE r = 1",
    "json_drilldown": "SELECT event_type, count(k) AS n_k, round(avg(k) * 100, 6) AS mean_k, max(coalesce(k, -1)) AS max_k FROM (SELECT event_type, try_cast(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events) GROUP BY 1",
    "score_scrape": "SELECT event_id, round(value, 2) AS score FROM events",
    "multiway_compare": rf"""WITH d AS (SELECT md5(messages[1].content) AS i, pair_id, {_FOLD.format('chosen.content')} AS gold, {_FOLD.format('rejected.content')} AS said FROM dpo_records WHERE len(messages) > 0),
f AS (SELECT i, arg_min(gold, pair_id) FILTER (true) AS g, min(pair_id) AS p FROM d GROUP BY 1), b AS (SELECT d.i, d.gold AS g, d.said AS s FROM d JOIN f ON d.pair_id = f.p),
c AS (SELECT d.i, coalesce(b.s, 'nan') = coalesce(b.g, 'nan') AS r0, coalesce(d.said, 'nan') = coalesce(b.g, 'nan') AS r1, coalesce(d.gold, 'nan') = coalesce(b.g, 'nan') AS r2 FROM d JOIN b ON d.i = b.i)
SELECT count(*) AS n, count(*) FILTER (NOT r0 AND r2) AS improved, count(*) FILTER (r0 AND NOT r2) AS regressed, count(*) FILTER (NOT r0 AND r2) - count(*) FILTER (r0 AND NOT r2) AS net, count(*) FILTER (NOT r0 AND r1 AND r2) AS all_improved FROM c""",
    "answer_share": f"""WITH a AS (SELECT coalesce(source, '?') AS source, {_FOLD.format('x')} AS a FROM (SELECT source, unnest(list_transform(list_filter(messages, lambda m: m.role = 'assistant'), lambda m: m.content)) AS x FROM sft_records))
SELECT source, count(*) AS n, round(avg(CASE WHEN a IN ('yes', 'ja', 'oui', 'sí') THEN 1.0 ELSE 0.0 END) * 100, 6) AS yes_share FROM a WHERE a IN ('yes', 'ja', 'oui', 'sí', 'no', 'nein', 'non') GROUP BY 1""",
    "pref_pairs": r"""WITH d AS (SELECT pair_id, regexp_replace(chosen.content, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS c, regexp_replace(rejected.content, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS r, regexp_replace(messages[1].content, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS q FROM dpo_records)
SELECT pair_id, 1::BIGINT AS n_messages, length(c) AS chosen_chars, length(r) AS rejected_chars FROM d WHERE c <> '' AND r <> '' AND q <> ''""",
    "best_worst": """WITH d AS (SELECT rec_id, CASE WHEN rec_id % 2 = 0 THEN 40 END AS bonus, list_transform(list_filter(messages, lambda m: m.role = 'assistant' AND m.content IS NOT NULL), lambda m: m.content) AS c FROM sft_records),
e AS (SELECT rec_id, bonus, unnest(c) AS x, unnest(range(len(c))) AS i FROM d WHERE len(c) > 1), k AS (SELECT *, CASE WHEN bonus IS NULL THEN length(x) ELSE -abs(length(x) - bonus) END AS k FROM e)
SELECT rec_id, md5(max(x) FILTER (a = 1)) AS best, md5(max(x) FILTER (z = 1)) AS worst FROM (SELECT *, row_number() OVER (PARTITION BY rec_id ORDER BY k DESC, i) AS a, row_number() OVER (PARTITION BY rec_id ORDER BY k, i DESC) AS z FROM k) GROUP BY 1""",
    "schema_unify": """SELECT 'eval_items' AS origin, count(*) AS n, sum(length(text))::BIGINT AS problem_chars, count(answer) AS n_answers FROM eval_items UNION ALL
SELECT 'dpo_records', count(*), sum(length(messages[1].content))::BIGINT, count(chosen.content) FROM dpo_records UNION ALL SELECT 'documents', count(*), sum(length(text))::BIGINT, count(doc_type) FROM documents""",
}

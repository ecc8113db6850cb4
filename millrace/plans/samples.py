"""Queries on sampling, quotas and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import profile, sampling
from millrace.operators.series import numbered
from millrace.session import table

QUOTA = 500
SEED = "7"


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").withColumn("stratum", F.coalesce("lang", F.lit("?")))


def _source(c: str = "source"):
    return F.coalesce(F.lower(F.trim(c)), F.lit("?"))


def stratified_alloc(spark: SparkSession, folder: str) -> DataFrame:
    sizes = _docs(spark, folder).groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))
    return sampling.allocation(sizes, "stratum", QUOTA)


def stratified_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.stratified(_docs(spark, folder), "stratum", QUOTA, SEED, "doc_id").select("doc_id", "stratum")


def simple_sample(spark: SparkSession, folder: str) -> DataFrame:
    """A seeded simple random sample (also the one that profiles are taken from)."""
    docs = _docs(spark, folder).withColumn("_h", sampling.shuffle_key(SEED, F.col("doc_id")))
    return sampling.first_rows(docs, QUOTA, "_h", "doc_id").select("doc_id")


def cluster_sample(spark: SparkSession, folder: str) -> DataFrame:
    """All documents of a third of the media files."""
    return sampling.cluster_sample(_docs(spark, folder), "media_path", 1 / 3, SEED).select("doc_id", "media_path")


def sample_per_class(spark: SparkSession, folder: str) -> DataFrame:
    """At most 20 documents of each type."""
    docs = _docs(spark, folder).withColumn("_h", sampling.shuffle_key(SEED, F.col("doc_id")))
    takes = docs.select("doc_type").distinct().withColumn("take", F.lit(20).cast("long"))
    return sampling.first_of_strata(docs, ["doc_type"], takes, "_h", "doc_id").select("doc_id", "doc_type")


def backfill_quota(spark: SparkSession, folder: str) -> DataFrame:
    """Two branches taken whole; captions fill what is missing to four fifths of all documents, split by language."""
    docs = _docs(spark, folder)
    branch = F.when(F.col("doc_type") == "video_note", "video").when(F.col("doc_type") == "dialogue", "dialogue").when(F.col("doc_type") == "caption", "caption")
    marked = docs.withColumn("branch", branch)
    fixed = marked.where("branch IN ('video', 'dialogue')")
    need = marked.agg(F.greatest(F.lit(0), F.floor(F.count(F.lit(1)) * 0.8).cast("long") - F.sum(F.when(F.col("branch").isin("video", "dialogue"), 1).otherwise(0))).alias("need"))
    sizes = marked.where("branch = 'caption'").groupBy("stratum").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(need))
    plan = sampling.allocation(sizes, "stratum", F.col("need"))
    keyed = marked.where("branch = 'caption'").withColumn("_h", sampling.shuffle_key(SEED, F.col("doc_id")))
    filled = sampling.first_of_strata(keyed, ["stratum"], plan.select("stratum", "take"), "_h", "doc_id")
    return fixed.select("doc_id", "branch").unionByName(filled.select("doc_id", "branch"))


def shuffled_union(spark: SparkSession, folder: str) -> DataFrame:
    """Both record tables united and numbered in one seeded order."""
    sft = table(spark, folder, "sft_records").select(F.concat(F.lit("s"), F.col("rec_id").cast("string")).alias("key"))
    dpo = table(spark, folder, "dpo_records").select(F.concat(F.lit("d"), F.col("pair_id").cast("string")).alias("key"))
    both = sft.unionByName(dpo).withColumn("_h", sampling.shuffle_key("9", F.col("key")))
    place = F.conv(F.substring("_h", 1, 3), 16, 10).cast("double")
    return numbered(both.withColumn("_all", F.lit(1)), ["_all"], ["_h", "key"], place, 1.0).select("key", F.col("_row").alias("place"))


def topped_up(spark: SparkSession, folder: str) -> DataFrame:
    """First source's pairs, and as many of the second as are missing to three quarters of all."""
    dpo = table(spark, folder, "dpo_records").withColumn("first", F.coalesce("source", F.lit("?")) == "humanpref").withColumn("_h", sampling.shuffle_key(SEED, F.col("pair_id")))
    n = dpo.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("first").cast("long")).alias("own")).first()
    need = max(0, n["n"] * 3 // 4 - (n["own"] or 0))
    extra = sampling.first_rows(dpo.where("NOT first"), need, "_h", "pair_id")
    return dpo.where("first").select("pair_id", "first").unionByName(extra.select("pair_id", "first"))


def corpus_profile(spark: SparkSession, folder: str) -> DataFrame:
    docs = _docs(spark, folder).withColumn("src", _source())
    return docs.groupBy("src").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.avg("n_chars"), F.lit(0.0)).alias("mean_chars"), F.coalesce(F.max("n_chars"), F.lit(0)).alias("max_chars"), F.sum("n_chars").alias("total_chars"))


def media_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Records by source and media type, with turns and characters."""
    sft = table(spark, folder, "sft_records")
    return sft.groupBy(F.coalesce("source", F.lit("?")).alias("source"), F.coalesce("media_type", F.lit("?")).alias("media_type")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.size("messages")).alias("mean_turns"), F.avg(T.total_chars(F.col("messages"))).alias("mean_chars"), F.max(T.total_chars(F.col("messages"))).alias("max_chars")
    )


def distinct_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Exact distinct media, documents and sources by type."""
    return _docs(spark, folder).groupBy("doc_type").agg(F.countDistinct("media_path").alias("n_media"), F.countDistinct(_source()).alias("n_sources"), F.countDistinct(F.xxhash64(T.text_hash(F.col("text")))).alias("n_texts"))  # hashes, not texts, are moved


def quota_attainment(spark: SparkSession, folder: str) -> DataFrame:
    """Share of a target of characters that each source reaches, and what is missing."""
    own = _docs(spark, folder).withColumn("source", _source()).groupBy("source").agg(F.sum("n_chars").alias("n_chars"))
    target = table(spark, folder, "mix_targets").select("source", (F.col("target_share") * 1_000_000).cast("long").alias("target"))
    got = F.coalesce(F.col("n_chars"), F.lit(0))
    return target.join(own, "source", "left").select("source", "target", got.alias("n_chars"), F.round(F.lit(100.0) * got / F.greatest("target", F.lit(1)), 6).alias("attained"), (F.col("target") - got).alias("missing"))


def pct_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return profile.percentiles(_docs(spark, folder), "stratum", "n_chars", [0.5, 0.95, 0.99, 1.0], profile.nearest_rank)


def pct_floor(spark: SparkSession, folder: str) -> DataFrame:
    return profile.percentiles(_docs(spark, folder), "stratum", "n_chars", [0.5, 0.95, 0.99, 1.0], profile.floor_rank)


def token_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Words and visual tokens of records by source."""
    sft = table(spark, folder, "sft_records").select(F.coalesce("source", F.lit("?")).alias("source"), T.word_count(T.joined_contents(F.col("messages"))).cast("long").alias("words"), F.coalesce(F.size("videos"), F.lit(0)).alias("v"))
    visual = F.col("v").cast("long") * profile.video_tokens()
    return sft.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.avg("words").alias("mean_words"), F.avg(visual).alias("mean_visual"), F.sum("words").alias("words"), F.sum(visual).alias("visual"), F.sum(F.col("words") + visual).alias("tokens"))


def batch_max_mean(spark: SparkSession, folder: str) -> DataFrame:
    """Mean of the longest document of batches of 8 and 4, in order of id and sorted by length.

    The last batch is left out, full or not.
    """
    docs = _docs(spark, folder).where("n_chars > 0").select("doc_id", "n_chars", F.lit(1).alias("_all"))
    outs = []
    by_id = numbered(docs, ["_all"], ["doc_id"], F.col("doc_id"), 4096.0)
    by_length = numbered(docs, ["_all"], ["n_chars", "doc_id"], F.col("n_chars"), 64.0)
    for order, rows in (("id", by_id), ("length", by_length)):
        for size in (8, 4):
            batches = profile.batch_maxima(rows, "n_chars", F.col("_row"), size)
            last = batches.agg(F.max("batch").alias("_last"))
            kept = batches.join(F.broadcast(last), F.col("batch") < F.col("_last"))
            outs.append(kept.agg(F.lit(order).alias("rows_by"), F.lit(size).cast("long").alias("size"), F.round(F.avg("longest"), 6).alias("mean_longest"), F.round(profile.logits_gib(size, F.avg("longest")), 6).alias("gib")))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


def random_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Mean longest document of 20,000 batches of 8, drawn by hash: closed form of the same simulation.

    The mean of the maximum of 8 draws without replacement follows exactly
    from the counts per length, so nothing is drawn.
    """
    docs = _docs(spark, folder).where("n_chars > 0").groupBy("n_chars").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(F.lit(1)).orderBy("n_chars").rowsBetween(Window.unboundedPreceding, 0)  # one row a length
    d = docs.withColumn("upto", F.sum("c").over(w)).withColumn("n", F.sum("c").over(Window.partitionBy(F.lit(1))))

    def below(k):
        out = F.lit(1.0)
        for i in range(8):
            out = out * F.greatest(k - i, F.lit(0)) / (F.col("n") - i)
        return out

    return d.agg(F.round(F.sum(F.col("n_chars") * (below(F.col("upto")) - below(F.col("upto") - F.col("c")))), 6).alias("mean_longest"))


def label_mask(spark: SparkSession, folder: str) -> DataFrame:
    """Tokenised shards united: input length and labels that count, by source."""
    sft = table(spark, folder, "sft_records").select(F.coalesce("source", F.lit("?")).alias("source"), "messages")
    ids = F.flatten(F.transform("messages", lambda m: F.split(F.coalesce(m["content"], F.lit("")), " ")))
    labels = F.flatten(F.transform("messages", lambda m: F.transform(F.split(F.coalesce(m["content"], F.lit("")), " "), lambda x: F.when(m["role"] == "assistant", F.length(x)).otherwise(-100))))
    shards = [sft.where(F.col("source") == "mixchat"), sft.where(F.col("source") != "mixchat")]
    both = shards[0].unionByName(shards[1]).select("source", F.size(ids).alias("n"), profile.counted_labels(labels).alias("counted"))
    return both.groupBy("source").agg(F.sum("n").alias("input_ids"), F.sum("counted").alias("labels"))


_S = "coalesce(lang, '?')"
_ALLOC = """
s AS (SELECT stratum, count(*) AS n FROM d GROUP BY 1),
b AS (SELECT stratum, n, q * n // sum(n) OVER () AS base, q FROM s, quota),
a AS (SELECT stratum, n, base + CASE WHEN row_number() OVER (ORDER BY n DESC, stratum) <= q - sum(base) OVER () THEN 1 ELSE 0 END AS take FROM b)
"""
_D = f"d AS (SELECT *, {_S} AS stratum FROM documents)"
_SRC = "coalesce(lower(trim(source)), '?')"


def _pct(index: str) -> str:
    return f"""WITH d AS (SELECT {_S} AS stratum, n_chars, row_number() OVER (PARTITION BY {_S} ORDER BY n_chars) - 1 AS i, count(*) OVER (PARTITION BY {_S}) AS n FROM documents WHERE n_chars IS NOT NULL)
SELECT stratum, p, n_chars AS value FROM d, (VALUES (0.5::DOUBLE), (0.95), (0.99), (1.0)) AS t(p) WHERE i = {index}"""


_BATCH = """SELECT '{0}' AS rows_by, {1}::BIGINT AS size, round(avg(m), 6) AS mean_longest, round({1} * avg(m) * 151936 * 4.0 / 1073741824.0, 6) AS gib FROM (
  SELECT i // {1} AS b, max(n_chars) AS m, max(i // {1}) AS k FROM (SELECT n_chars, row_number() OVER (ORDER BY {2}) - 1 AS i FROM documents WHERE n_chars > 0) GROUP BY 1)
WHERE b < (SELECT (count(*) - 1) // {1} FROM documents WHERE n_chars > 0)"""
_BELOW = " * ".join(f"greatest({{0}} - {i}, 0) / (n - {i})::DOUBLE" for i in range(8))

QUERIES = {
    "stratified_alloc": stratified_alloc,
    "stratified_sample": stratified_sample,
    "simple_sample": simple_sample,
    "cluster_sample": cluster_sample,
    "sample_per_class": sample_per_class,
    "backfill_quota": backfill_quota,
    "shuffled_union": shuffled_union,
    "topped_up": topped_up,
    "corpus_profile": corpus_profile,
    "media_profile": media_profile,
    "distinct_counts": distinct_counts,
    "quota_attainment": quota_attainment,
    "pct_nearest": pct_nearest,
    "pct_floor": pct_floor,
    "token_profile": token_profile,
    "batch_max_mean": batch_max_mean,
    "random_batches": random_batches,
    "label_mask": label_mask,
}
ORACLES = {
    "stratified_alloc": f"WITH {_D}, quota AS (SELECT {QUOTA}::BIGINT AS q), {_ALLOC} SELECT stratum, n, take::BIGINT AS take FROM a",
    "stratified_sample": f"""WITH {_D}, quota AS (SELECT {QUOTA}::BIGINT AS q), {_ALLOC}, r AS (SELECT doc_id, stratum, row_number() OVER (PARTITION BY stratum ORDER BY md5('{SEED}:' || doc_id), doc_id) AS i FROM d)
SELECT doc_id, r.stratum FROM r JOIN a USING (stratum) WHERE i <= take""",
    "simple_sample": f"SELECT doc_id FROM documents ORDER BY md5('{SEED}:' || doc_id), doc_id LIMIT {QUOTA}",
    "cluster_sample": f"""WITH c AS (SELECT DISTINCT media_path FROM documents WHERE media_path IS NOT NULL), p AS (SELECT media_path, row_number() OVER (ORDER BY md5('{SEED}:' || media_path), media_path) AS i FROM c)
SELECT doc_id, media_path FROM documents JOIN p USING (media_path) WHERE i <= (SELECT greatest(1, round_even(count(*) / 3.0, 0)) FROM c)""",
    "sample_per_class": f"SELECT doc_id, doc_type FROM (SELECT *, row_number() OVER (PARTITION BY doc_type ORDER BY md5('{SEED}:' || doc_id), doc_id) AS i FROM documents) WHERE i <= 20",
    "backfill_quota": f"""WITH d AS (SELECT *, {_S} AS stratum FROM documents WHERE doc_type = 'caption'),
quota AS (SELECT greatest(0, floor(count(*) * 0.8)::BIGINT - count(*) FILTER (doc_type IN ('video_note', 'dialogue'))) AS q FROM documents), {_ALLOC},
r AS (SELECT doc_id, stratum, row_number() OVER (PARTITION BY stratum ORDER BY md5('{SEED}:' || doc_id), doc_id) AS i FROM d)
SELECT doc_id, CASE doc_type WHEN 'video_note' THEN 'video' ELSE doc_type END AS branch FROM documents WHERE doc_type IN ('video_note', 'dialogue')
UNION ALL SELECT doc_id, 'caption' FROM r JOIN a USING (stratum) WHERE i <= take""",
    "shuffled_union": "WITH b AS (SELECT 's' || rec_id AS key FROM sft_records UNION ALL SELECT 'd' || pair_id FROM dpo_records) SELECT key, row_number() OVER (ORDER BY md5('9:' || key), key) - 1 AS place FROM b",
    "topped_up": f"""WITH p AS (SELECT pair_id, coalesce(source, '?') = 'humanpref' AS first FROM dpo_records), r AS (SELECT *, row_number() OVER (ORDER BY md5('{SEED}:' || pair_id), pair_id) AS i FROM p WHERE NOT first)
SELECT pair_id, first FROM p WHERE first UNION ALL SELECT pair_id, first FROM r WHERE i <= (SELECT greatest(0, count(*) * 3 // 4 - count(*) FILTER (first)) FROM p)""",
    "corpus_profile": f"SELECT {_SRC} AS src, count(*) AS n, coalesce(avg(n_chars), 0) AS mean_chars, coalesce(max(n_chars), 0) AS max_chars, sum(n_chars)::BIGINT AS total_chars FROM documents GROUP BY 1",
    "media_profile": """WITH s AS (SELECT *, coalesce(list_sum(list_transform(messages, lambda m: coalesce(length(m.content), 0))), 0)::BIGINT AS c FROM sft_records)
SELECT coalesce(source, '?') AS source, coalesce(media_type, '?') AS media_type, count(*) AS n, avg(len(messages)) AS mean_turns, avg(c) AS mean_chars, max(c) AS max_chars FROM s GROUP BY 1, 2""",
    "distinct_counts": rf"SELECT doc_type, count(DISTINCT media_path) AS n_media, count(DISTINCT {_SRC}) AS n_sources, count(DISTINCT lower(trim(regexp_replace(text, '[\s\p{{Z}}]+', ' ', 'g')))) AS n_texts FROM documents GROUP BY 1",
    "quota_attainment": f"""WITH o AS (SELECT {_SRC} AS source, sum(n_chars)::BIGINT AS n_chars FROM documents GROUP BY 1), t AS (SELECT source, trunc(target_share * 1000000)::BIGINT AS target FROM mix_targets)
SELECT t.source, target, coalesce(n_chars, 0) AS n_chars, round(100.0::DOUBLE * coalesce(n_chars, 0) / greatest(target, 1), 6) AS attained, target - coalesce(n_chars, 0) AS missing FROM t LEFT JOIN o USING (source)""",
    "pct_nearest": _pct("round_even(p * (n - 1), 0)::BIGINT"),
    "pct_floor": _pct("least(n - 1, floor(n * p)::BIGINT)"),
    "token_profile": r"""WITH s AS (SELECT coalesce(source, '?') AS source, len(regexp_extract_all(array_to_string(list_transform(messages, lambda m: coalesce(m.content, '') || chr(10)), ''), '[^ \t\n\x0B\f\r]+'))::BIGINT AS words, coalesce(len(videos), 0) * 288 AS v FROM sft_records)
SELECT source, count(*) AS n, avg(words) AS mean_words, avg(v) AS mean_visual, sum(words)::BIGINT AS words, sum(v)::BIGINT AS visual, sum(words + v)::BIGINT AS tokens FROM s GROUP BY 1""",
    "batch_max_mean": " UNION ALL ".join(_BATCH.format(o, k, c) for o, c in (("id", "doc_id"), ("length", "n_chars, doc_id")) for k in (8, 4)),
    "random_batches": f"""WITH c AS (SELECT n_chars, count(*) AS c FROM documents WHERE n_chars > 0 GROUP BY 1), d AS (SELECT n_chars, c, sum(c) OVER (ORDER BY n_chars) AS upto, sum(c) OVER () AS n FROM c)
SELECT round(sum(n_chars * ({_BELOW.format('upto')} - {_BELOW.format('(upto - c)')})), 6) AS mean_longest FROM d""",
    "label_mask": """WITH w AS (SELECT coalesce(source, '?') AS source, m.role AS role, len(string_split(coalesce(m.content, ''), ' ')) AS k FROM (SELECT source, unnest(messages) AS m FROM sft_records))
SELECT source, sum(k)::BIGINT AS input_ids, coalesce(sum(k) FILTER (role = 'assistant'), 0)::BIGINT AS labels FROM w GROUP BY 1""",
}

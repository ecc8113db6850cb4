"""All queries of this subpackage by name, with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.defects import broken_pairs
from millrace.llm.leakage import leaked_items
from millrace.llm.mixing import TOKENIZERS, Mix, mix_sources, token_counts
from millrace.llm.near import classes, expanded, near_duplicates
from millrace.llm.outward import outward_duplicates
from millrace.llm.packing import QUADRATIC, pack
from millrace.llm.residue import residue
from millrace.session import materialise, table


def _pairs_of_copies(spark: SparkSession, folder: str) -> DataFrame:
    dpo = table(spark, folder, "dpo_records")
    return outward_duplicates(dpo.select(F.col("pair_id").alias("id"), F.col("chosen.content").alias("chosen"), F.col("rejected.content").alias("rejected")), materialise)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """(smallest pair_id, other pair_id) for every outward copy."""
    return _pairs_of_copies(spark, folder).where("id <> rep").select(F.col("rep").alias("pair_a"), F.col("id").alias("pair_b"))


def p1_collapsed(spark: SparkSession, folder: str) -> DataFrame:
    """Each recurring preference pair once, with the number of its copies."""
    return _pairs_of_copies(spark, folder).groupBy(F.col("rep").alias("pair_id")).agg(F.count(F.lit(1)).alias("n_copies"))


def _near_sft(spark: SparkSession, folder: str):
    text = F.concat_ws("\n", F.transform("messages", lambda m: F.coalesce(m["content"], F.lit(""))))
    return near_duplicates(table(spark, folder, "sft_records").select(F.col("rec_id").alias("id"), text.alias("text")), materialise)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """All pairs of records whose three-word sequences agree to at least 0.6."""
    return expanded(_near_sft(spark, folder))


def p3_classes(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record that belongs with others: its class and its number of links."""
    found = classes(_near_sft(spark, folder), materialise)
    return found.select(F.col("id").alias("rec_id"), "class_id", "n_links")


def question_answer_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """User turns directly followed by an assistant turn, and both answers of each preference pair."""
    turn = F.expr("filter(transform(messages, (m, i) -> struct(i AS turn, m.role AS role, m.content AS answer, get(messages, i - 1) AS asked)), x -> x.role = 'assistant' AND x.asked.role = 'user')")
    sft = table(spark, folder, "sft_records").select("rec_id", F.explode(turn).alias("t"))
    sft = sft.select(F.lit("sft_records").alias("src_table"), F.col("rec_id").alias("row_id"), F.lit("messages").alias("field"), F.col("t.turn").alias("turn"), F.col("t.asked.content").alias("question"), F.col("t.answer").alias("answer"))
    dpo = table(spark, folder, "dpo_records").withColumn("question", F.expr("get(filter(messages, m -> m.role = 'user'), 0).content"))
    both = F.explode(F.array(*[F.struct(F.lit(k).alias("field"), F.col(f"{k}.content").alias("answer")) for k in ("chosen", "rejected")])).alias("t")
    dpo = dpo.select("pair_id", "question", both).select(F.lit("dpo_records").alias("src_table"), F.col("pair_id").alias("row_id"), F.col("t.field").alias("field"), F.lit(0).alias("turn"), "question", F.col("t.answer").alias("answer"))
    return sft.unionByName(dpo)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every defective answer with its kind of defect."""
    return broken_pairs(question_answer_pairs(spark, folder), materialise).drop("evidence")


def p4_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Number of defective answers by table, field and kind, and how many truncations neighbours and length limits show."""
    found = broken_pairs(question_answer_pairs(spark, folder), materialise)
    shown = [F.sum(F.when(F.col("evidence") == k, 1).otherwise(0)).alias(n) for k, n in (("neighbour", "n_by_neighbour"), ("limit", "n_by_limit"))]
    return found.groupBy("src_table", "field", "defect").agg(F.count(F.lit(1)).alias("n_answers"), *shown)


#: Characters a training sequence holds.
SEQUENCE_CHARS = 11_000


def _packed(spark: SparkSession, folder: str) -> DataFrame:
    chars = F.expr("aggregate(messages, 0L, (n, m) -> n + coalesce(length(m.content), 0))")
    return pack(table(spark, folder, "sft_records").select(F.col("rec_id").alias("id"), chars.alias("n")), SEQUENCE_CHARS, materialise)


def p5_sequences(spark: SparkSession, folder: str) -> DataFrame:
    """Sequence number and offset of every record (of every piece, where one is divided)."""
    return _packed(spark, folder).select(F.col("id").alias("rec_id"), "piece", "length", "sequence", "offset")


def p5_fill(spark: SparkSession, folder: str) -> DataFrame:
    """Sequences, characters, least possible number of sequences, and how balanced the costs are."""
    packed = _packed(spark, folder)
    cost = F.col("length") + F.col("length") * F.col("length") * F.lit(QUADRATIC)
    each = packed.groupBy("sequence").agg(F.sum("length").alias("used"), F.sum(cost).alias("cost"))
    least = F.ceil(F.sum("used") / SEQUENCE_CHARS).alias("least_sequences")
    return each.agg(F.count(F.lit(1)).alias("n_sequences"), F.sum("used").alias("n_chars"), least, F.avg(F.col("used") / SEQUENCE_CHARS).alias("mean_fill"), (F.stddev("cost") / F.avg("cost")).alias("cost_spread"))


def p5_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """What any packing must keep: records, characters and pieces, and no sequence too full, with gaps or without number."""
    packed = _packed(spark, folder)
    each = packed.groupBy("sequence").agg(F.sum("length").alias("used"), F.max(F.col("offset") + F.col("length")).alias("end"))
    bad = each.agg(F.count_if(F.col("used") > SEQUENCE_CHARS).alias("n_overfull"), F.count_if(F.col("used") != F.col("end")).alias("n_gaps"), (F.max("sequence") + 1 - F.count(F.lit(1))).alias("n_unnumbered"))
    by_record = packed.groupBy("id").agg(F.sum("length").alias("n"), F.count(F.lit(1)).alias("k"))
    kept = by_record.agg(F.count(F.lit(1)).alias("n_records"), F.sum("n").alias("n_chars"), F.sum("k").alias("n_pieces"), F.count_if(F.col("k") > 1).alias("n_divided"))
    return kept.join(bad)  # one row each


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that share a run of at least 12 words with an item, and the items."""
    documents, items = table(spark, folder, "documents"), table(spark, folder, "eval_items")
    return leaked_items(documents, items, materialise).select("doc_id", "item_id")


def p6_items(spark: SparkSession, folder: str) -> DataFrame:
    """The items given away, verbatim or paraphrased, with their number of documents."""
    documents, items = table(spark, folder, "documents"), table(spark, folder, "eval_items")
    found = leaked_items(documents, items, materialise, paraphrases=True)
    return found.groupBy("item_id").agg(F.sum(F.when(F.col("kind") == "run", 1).otherwise(0)).alias("n_verbatim"), F.sum(F.when(F.col("kind") == "paraphrase", 1).otherwise(0)).alias("n_paraphrased"))


def _mix(spark: SparkSession, folder: str) -> Mix:
    documents = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "source", "text")
    sized = token_counts(documents, f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    return mix_sources(sized, table(spark, folder, "mix_targets"), materialise)


def p7_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The chosen documents with their repeats."""
    return _mix(spark, folder).chosen.select(F.col("id").alias("doc_id"), "source", "tokens", "repeats", "finish")


def p7_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The shares reached, by target."""
    return _mix(spark, folder).shares


def p7_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """What any mix must keep, as numbers of breaches: repeats, sources, documents twice, shares off.

    At any cut a source lags by less than its longest document, and all of
    them together by less than the sum of these: a share is off if it misses
    its target by more than either allows.
    """
    mix = _mix(spark, folder)
    every = Window.partitionBy(F.lit(1))  # one row a target
    shares = mix.shares.join(mix.longest, "source").withColumn("_missed", F.abs(F.col("tokens") - F.col("share_of_available") * F.sum("tokens").over(every)))
    slack = F.greatest(F.col("longest"), F.col("share_of_available") * F.sum("longest").over(every))
    shares = shares.select("source", "max_repeats", (F.col("_missed") > slack + 1e-6).alias("off"))
    seen = mix.chosen.join(shares.select("source", "max_repeats"), "source", "left")
    used = seen.groupBy("id").agg(F.count(F.lit(1)).alias("k"), F.max(F.col("repeats") - F.col("max_repeats")).alias("over"), F.count("max_repeats").alias("known"))
    a = used.agg(F.count_if(F.col("over") > 0).alias("n_over_repeats"), F.count_if(F.col("known") == 0).alias("n_unknown"), F.count_if(F.col("k") > 1).alias("n_twice"))
    return a.join(shares.agg(F.count(F.lit(1)).alias("n_targets"), F.count_if("off").alias("n_share_off")))  # one row each


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with template residue or error-page text, and their kind."""
    return residue(table(spark, folder, "documents").select("doc_id", "text"), materialise)


def p8_clean(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that remain when those with residue are left out."""
    documents = table(spark, folder, "documents")
    return documents.join(p8_found(spark, folder).select("doc_id"), "doc_id", "left_anti").select("doc_id", "doc_type", "n_chars")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_collapsed": p1_collapsed,
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p4_summary": p4_summary,
    "p5_sequences": p5_sequences,
    "p5_fill": p5_fill,
    "p5_invariants": p5_invariants,
    "p6_found": p6_found,
    "p6_items": p6_items,
    "p7_mix": p7_mix,
    "p7_shares": p7_shares,
    "p7_invariants": p7_invariants,
    "p8_found": p8_found,
    "p8_clean": p8_clean,
    "p3_classes": p3_classes,
}

_RUNS = "SELECT {0}, w[i] {1} AS run FROM (SELECT *, unnest(range(1, len(w) - {2})) AS i FROM (SELECT {0}, regexp_extract_all(lower({3}), '[\\p{{L}}\\p{{N}}]+') AS w FROM {4}))"


def _runs(key: str, n: int, text: str, source: str) -> str:
    """SQL for the distinct runs of ``n`` words of each text, by key."""
    return "SELECT DISTINCT * FROM (" + _RUNS.format(key, "".join(f" || ' ' || w[i + {k}]" for k in range(1, n)), n - 2, text, source) + ")"


_TEXT = "(SELECT rec_id, array_to_string(list_transform(messages, lambda m: coalesce(m.content, '')), chr(10)) AS text FROM sft_records)"
ORACLES: dict[str, str] = {
    "p3_found": f"""WITH r AS MATERIALIZED ({_runs("rec_id", 3, "text", _TEXT)}), n AS MATERIALIZED (SELECT rec_id, count(*) AS n FROM r GROUP BY 1),
c AS (SELECT a.rec_id AS rec_a, b.rec_id AS rec_b, count(*) AS k FROM r a JOIN r b ON a.run = b.run AND a.rec_id < b.rec_id GROUP BY 1, 2)
SELECT rec_a, rec_b FROM c JOIN n x ON x.rec_id = rec_a JOIN n y ON y.rec_id = rec_b WHERE 10 * k >= 6 * (x.n + y.n - k)""",
    "p5_invariants": f"""WITH r AS (SELECT rec_id, coalesce(list_sum(list_transform(messages, lambda m: coalesce(length(m.content), 0))), 0) AS n FROM sft_records)
SELECT count(*) AS n_records, sum(n)::BIGINT AS n_chars, sum(greatest(1, ceil(n / {SEQUENCE_CHARS})))::BIGINT AS n_pieces, count(*) FILTER (n > {SEQUENCE_CHARS}) AS n_divided, 0::BIGINT AS n_overfull, 0::BIGINT AS n_gaps, 0::BIGINT AS n_unnumbered FROM r""",
    "p6_found": f"""WITH d AS MATERIALIZED ({_runs("doc_id", 12, "text", "documents")}), i AS MATERIALIZED ({_runs("item_id", 12, "text", "eval_items")})
SELECT DISTINCT doc_id, item_id FROM d JOIN i ON d.run = i.run""",
    "p7_invariants": "SELECT count(DISTINCT lower(trim(source))) AS n_targets, 0::BIGINT AS n_over_repeats, 0::BIGINT AS n_unknown, 0::BIGINT AS n_twice, 0::BIGINT AS n_share_off FROM mix_targets",
}

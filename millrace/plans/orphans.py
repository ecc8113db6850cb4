"""Queries of problem 2: media references that point nowhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.references import clean_path, is_blank, orphan_references
from millrace.session import table


def media_references(spark: SparkSession, folder: str) -> DataFrame:
    """Every non-blank media path of both record tables, cleaned."""
    sft, dpo = table(spark, folder, "sft_records"), table(spark, folder, "dpo_records")
    parts = [
        (sft, "sft_records", "rec_id", "images"),
        (sft, "sft_records", "rec_id", "videos"),
        (dpo, "dpo_records", "pair_id", "images"),
    ]
    found = None
    for df, name, key, field in parts:
        one = df.select(F.lit(name).alias("src_table"), F.col(key).cast("long").alias("row_id"), F.lit(field).alias("field"), F.explode(field).alias("raw"), F.col("ingested_at").alias("at"))
        found = one if found is None else found.unionByName(one)
    return found.where(~is_blank(F.col("raw"))).withColumn("path", clean_path(F.col("raw"))).drop("raw")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Orphan media references with the month of the referring row."""
    bad = orphan_references(media_references(spark, folder), table(spark, folder, "media_files"))
    return bad.select("src_table", F.date_format("at", "yyyy-MM").alias("period"), "row_id", "field", "path", "kind")


def p2_report(spark: SparkSession, folder: str) -> DataFrame:
    """Orphans per table, period, field and kind."""
    bad = p2_found(spark, folder)
    return bad.groupBy("src_table", "period", "field", "kind").agg(F.count(F.lit(1)).alias("n_references"), F.countDistinct("path").alias("n_paths"))


_FOUND = r"""
WITH r AS (
  SELECT 'sft_records' AS src_table, rec_id AS row_id, 'images' AS field, unnest(images) AS raw, ingested_at AS t FROM sft_records
  UNION ALL SELECT 'sft_records', rec_id, 'videos', unnest(videos), ingested_at FROM sft_records
  UNION ALL SELECT 'dpo_records', pair_id, 'images', unnest(images), ingested_at FROM dpo_records
), p AS (
  SELECT src_table, row_id, field, t, ltrim(replace(raw, '\', '/'), './') AS path
  FROM r WHERE raw IS NOT NULL AND regexp_replace(raw, '[\s\p{Z}]+', '', 'g') <> ''
), j AS (
  SELECT p.src_table, p.row_id, p.field, p.t, p.path,
         count(m.file_id) AS n_rows,
         coalesce(bool_or(m.added_at <= p.t AND (m.removed_at IS NULL OR m.removed_at > p.t)), false) AS good,
         coalesce(bool_and(m.added_at > p.t), false) AS all_late
  FROM p LEFT JOIN media_files m ON m.path = p.path
  GROUP BY ALL
), found AS (
  SELECT DISTINCT src_table, strftime(t, '%Y-%m') AS period, row_id, field, path,
         CASE WHEN n_rows = 0 THEN 'missing' WHEN all_late THEN 'late' ELSE 'deleted' END AS kind
  FROM j WHERE NOT good
)
"""

QUERIES = {"p2_found": p2_found, "p2_report": p2_report}
ORACLES = {
    "p2_found": _FOUND + "SELECT src_table, period, row_id, field, path, kind FROM found",
    "p2_report": _FOUND + "SELECT src_table, period, field, kind, count(*) AS n_references, count(DISTINCT path) AS n_paths FROM found GROUP BY ALL",
}

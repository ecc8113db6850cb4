"""References to records that do not exist (orphan detection).

Parent keys are turned into integers inside a *family* (the key's text with
its last digit run cut out), so that sorted keys of one family compress into
contiguous runs. A reference is matched as of the preceding run start: it is
an orphan if it lies beyond that run's end. References inside a run are then
matched in time against the listing rows of their own key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.skew import heavy_keys

#: Keys per bucket of a family: a window partition never spans more integers.
BUCKET = 4096
#: References of one bucket that a task takes, and the least share of all
#: references from which a bucket is spread (so at most 2,000 are, and broadcast).
SALT_ROWS, SALT_SHARE = 200_000, 0.0005

_LAST_DIGITS = r"^(.*?)([0-9]{1,15})([^0-9]*)$"


def clean_path(raw: Column) -> Column:
    r"""``\`` becomes ``/``; leading ``.`` and ``/`` characters go. Case stays."""
    return F.regexp_replace(F.translate(raw, "\\", "/"), r"^[./]+", "")


def is_blank(raw: Column) -> Column:
    """Null, or nothing but white space (Unicode included)."""
    return raw.isNull() | (F.regexp_replace(raw, r"(?U)\s+", "") == "")


def integer_key(df: DataFrame, path: str) -> DataFrame:
    """Adds ``_family`` and ``_number``; together they stand for ``path`` exactly.

    The family keeps the digit run's width when it has leading zeros, so
    ``a/07`` and ``a/7`` differ. A path without digits is its own family with
    number 0.
    """
    before, digits, after = (F.regexp_extract(path, _LAST_DIGITS, i) for i in (1, 2, 3))
    width = F.when((F.length(digits) > 1) & digits.startswith("0"), F.length(digits)).otherwise(F.lit(0))
    has = digits != ""
    return df.withColumn("_family", F.when(has, F.concat(before, F.lit("\x01"), width.cast("string"), F.lit("\x01"), after)).otherwise(F.col(path))).withColumn(
        "_number", F.when(has, digits.cast("long")).otherwise(F.lit(0).cast("long"))
    )


def orphan_references(references: DataFrame, parents: DataFrame) -> DataFrame:
    """References whose parent is missing, deleted or not there yet.

    ``references``: ``src_table, row_id, field, path, at`` (cleaned paths, see
    :func:`clean_path`). ``parents``: ``path, added_at, removed_at``
    (``removed_at`` null: still there). Returns the references with a
    ``kind``: ``missing`` if no parent row has the path, ``late`` if every
    one was added after ``at``, else ``deleted``. Equal rows come out once.

    Defined cases: a null ``at`` satisfies no listing (``deleted`` if any row
    was added, since none can be shown to be later); a parent row without
    ``added_at`` makes the path known but never valid; null paths are no
    references; empty inputs give empty (or all-missing) results; extra
    columns are ignored.

    Cost: one shuffle of references and one of parents, both on (family,
    bucket, salt); the two windows share that partitioning. Buckets bound a
    window partition; heavy buckets (at most 2,000, by share) are
    spread over as many tasks as they have ``SALT_ROWS`` references.
    """
    ref = references.select("src_table", "row_id", "field", "path", "at").where(F.col("path").isNotNull()).distinct()
    ref = integer_key(ref, "path").withColumn("_bucket", F.floor(F.col("_number") / BUCKET))
    heavy = heavy_keys(ref, ["_family", "_bucket"], SALT_SHARE).where(F.col("_n") > SALT_ROWS)
    heavy = F.broadcast(heavy.select("_family", "_bucket", F.ceil(F.col("_n") / SALT_ROWS).cast("int").alias("_hot")))
    ref = ref.join(heavy, ["_family", "_bucket"], "left").withColumn("_salt", F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64("src_table", "row_id", "field"), F.col("_hot")).cast("int")).otherwise(F.lit(0))).drop("_hot")

    own = parents.select("path", "added_at", "removed_at").where(F.col("path").isNotNull())
    own = integer_key(_undominated(own), "path").withColumn("_bucket", F.floor(F.col("_number") / BUCKET))
    own = own.join(heavy, ["_family", "_bucket"], "left")
    fan = F.explode(F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.col("_hot") - 1)).otherwise(F.array(F.lit(0))))
    own = own.withColumn("_salt", fan).drop("_hot", "path")

    part = ["_family", "_bucket", "_salt"]
    runs = _runs(own.select(*part, "_number").distinct(), part)
    nothing = {"_end": "long", "added_at": "timestamp_ntz", "removed_at": "timestamp_ntz", "src_table": "string", "row_id": "long", "field": "string", "path": "string", "at": "timestamp_ntz"}

    def row(df: DataFrame, rank: int, when: str | None, **have: str) -> DataFrame:
        return df.select(*part, "_number", F.lit(rank).alias("_rank"), (F.col(when) if when else F.lit(None)).cast("timestamp_ntz").alias("_t"), *[(F.col(have[c]) if c in have else F.lit(None)).cast(t).alias(c) for c, t in nothing.items()])

    both = row(runs, 0, None, _end="_end").unionByName(row(own, 1, "added_at", added_at="added_at", removed_at="removed_at")).unionByName(row(ref, 2, "at", **{c: c for c in ("src_table", "row_id", "field", "path", "at")}))
    by_key = Window.partitionBy(*part).orderBy("_number", "_rank").rowsBetween(Window.unboundedPreceding, 0)
    by_time = Window.partitionBy(*part, "_number").orderBy(F.col("_t").asc_nulls_first(), "_rank").rowsBetween(Window.unboundedPreceding, 0)
    listed = F.col("_rank") == 1
    known = both.withColumn("_run_end", F.last("_end", ignorenulls=True).over(by_key))
    far = F.lit("9999-12-31 23:59:59").cast("timestamp_ntz")
    dated = listed & F.col("added_at").isNotNull()
    known = known.withColumn("_until", F.max(F.when(dated, F.coalesce("removed_at", far))).over(by_time)).withColumn("_open", F.max(dated & F.col("removed_at").isNull()).over(by_time))
    ahead = known.where(F.col("_rank") == 2)
    missing = F.col("_run_end").isNull() | (F.col("_number") > F.col("_run_end"))
    good = F.col("_open") | (F.col("_until") > F.col("at"))
    kind = F.when(missing, "missing").when(good & F.col("at").isNotNull(), None).when(F.col("at").isNotNull() & F.col("_until").isNull(), "late").otherwise("deleted")
    return ahead.select("src_table", "row_id", "field", "path", "at", kind.alias("kind")).where(F.col("kind").isNotNull())


def _undominated(parents: DataFrame) -> DataFrame:
    """Listing rows that can decide a match.

    Pre-aggregates to one row per (path, added_at), then drops, within each
    (path, month), rows whose interval lies inside an earlier one. A path
    listed again and again shrinks to its distinct validity steps.
    """
    far = F.lit("9999-12-31 23:59:59").cast("timestamp_ntz")
    once = parents.groupBy("path", "added_at").agg(F.max(F.coalesce("removed_at", far)).alias("_until"))
    before = Window.partitionBy("path", F.date_trunc("month", "added_at")).orderBy("added_at").rowsBetween(Window.unboundedPreceding, -1)
    kept = once.withColumn("_top", F.max("_until").over(before)).where(F.col("_top").isNull() | (F.col("_until") > F.col("_top")))
    return kept.select("path", "added_at", F.when(F.col("_until") < far, F.col("_until")).alias("removed_at"))


def _runs(keys: DataFrame, part: list[str]) -> DataFrame:
    """Distinct sorted integers compressed into contiguous runs (gaps and islands)."""
    order = Window.partitionBy(*part).orderBy("_number")
    island = keys.withColumn("_island", F.col("_number") - F.row_number().over(order))
    return island.groupBy(*part, "_island").agg(F.min("_number").alias("_start"), F.max("_number").alias("_end")).select(*part, F.col("_start").alias("_number"), "_end")

"""Problem 7: mixing sources to target weights.

Weighted fair queueing: every shuffled document gets a virtual finish time,
the tokens of its source up to and including it divided by the source's
weight. All documents are ordered by finish time and the order is cut where
the total budget is reached, so every source has had its share at any point.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.kernels import slices
from millrace.session import scan_slices

#: Where the public vocabulary files lie; see the folder's README.
TOKENIZERS = "/opt/tokenizers"
#: Largest vocabulary file that is sent to executors.
VOCABULARY_BYTES = 64 << 20
#: Targets up to this number are broadcast (with 256 rows each), more are joined by shuffles.
FEW_TARGETS = 2_000
#: Splits of the range of finish times; the one with the cut is ordered row by row.
RANGES = 4096

# Fixed value: the split pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def _encoding(vocabulary: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in vocabulary.splitlines())}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, path: str) -> DataFrame:
    """``id, source, tokens`` of ``id, source, text``: one pass, no shuffle.

    Null and empty texts have no tokens. Texts are encoded whole. The
    vocabulary file is read by the driver and sent along (about a megabyte,
    at most ``VOCABULARY_BYTES``), so executors need no copy of it.
    """
    if os.path.getsize(path) > VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {VOCABULARY_BYTES} bytes")
    sent = documents.sparkSession.sparkContext.broadcast(Path(path).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(sent.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            counts: list[int] = []
            for lo, hi in slices(texts):
                counts += [len(x) for x in encoding.encode_ordinary_batch(texts[lo:hi], num_threads=1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=["id", "source", "tokens"])

    return scan_slices(documents.select(F.col("id").cast("long").alias("id"), "source", "text")).mapInArrow(run, "id long, source string, tokens long")


def same_source(raw):
    """Sources are compared trimmed (Unicode white space) and in lower case."""
    return F.lower(F.regexp_replace(raw, r"(?U)^\s+|\s+$", ""))


def _horizon(t: DataFrame, total: float) -> float:
    """A virtual time by which ``total`` tokens are certainly sent.

    At a time v a source has sent at least ``min(w * v, all it may send)``
    less its longest document; the sum is linear between the times at which
    sources run out.
    """
    sending = t.where(F.col("_w").isNotNull()).select("_w", "_top", (F.col("_have") * F.col("max_repeats")).alias("_cap")).withColumn("_v", F.col("_cap") / F.col("_w"))
    upto = Window.orderBy("_v").rangeBetween(Window.unboundedPreceding, Window.currentRow)  # one row a target
    out = sending.select("_v", F.sum("_cap").over(upto).alias("_out"), (F.lit(1.0) - F.sum("_w").over(upto)).alias("_left"), F.sum("_top").over(Window.partitionBy(F.lit(1))).alias("_slack"))
    out = out.distinct().withColumn("_need", F.lit(float(total)) + F.col("_slack"))
    before = Window.orderBy("_v")
    out = out.withColumn("_out0", F.coalesce(F.lag("_out").over(before), F.lit(0.0))).withColumn("_left0", F.coalesce(F.lag("_left").over(before), F.lit(1.0)))
    reached = out.where(F.col("_out") + F.col("_v") * F.col("_left") >= F.col("_need"))
    first = reached.agg(F.min_by(F.try_divide(F.col("_need") - F.col("_out0"), F.col("_left0")), "_v")).first()[0]
    end = out.agg(F.max("_v")).first()[0] or 0.0
    return float(end if first is None else min(first, end)) * (1 + 1e-9)


def _passes(upto, have, weight, repeats, horizon: float):
    """The passes of a document whose finish time lies within ``horizon``."""
    last = F.least(repeats - 1, F.floor((F.lit(horizon) * weight - upto) / have))
    return F.when(last >= 0, F.sequence(F.lit(0).cast("long"), last.cast("long"))).otherwise(F.array().cast("array<bigint>"))


class Mix:
    """Result of :func:`mix_sources`: chosen documents and shares."""

    def __init__(self, chosen: DataFrame, shares: DataFrame, longest: DataFrame):
        self.chosen = chosen
        self.shares = shares
        #: ``source, longest``: tokens of each target's longest document.
        self.longest = longest


def mix_sources(sized: DataFrame, targets: DataFrame, materialise, budget: int | None = None, seed: str = "mix") -> Mix:
    """Chooses documents so that each source supplies its share of all tokens.

    ``sized``: ``id, source, tokens``; ``targets``: ``source, target_share,
    max_repeats``. Sources are compared by :func:`same_source`; target rows
    that become equal add their shares and keep the larger ``max_repeats``.
    Without ``budget`` the total is the largest at which no source needs a
    document more often than allowed: the least of tokens * max_repeats /
    share over the sources with a share and with tokens. With a larger
    ``budget``, sources that run out are exhausted and fall short.

    ``chosen``: ``id, source, tokens, repeats, finish`` (virtual finish time of
    the last use). ``shares``: for each target
    ``source, target_share, max_repeats, n_documents, tokens, share,
    share_of_available``, where ``share`` is of all tokens reached and
    ``share_of_available`` is the target's share among sources with documents
    (a target without documents, with share 0 or with max_repeats 0 supplies
    nothing; the others keep their proportions).

    Defined cases: null sources match no target; documents without tokens or
    id are not chosen; null shares or repeats count as 0; empty tables give no
    chosen documents.

    Scale: the running sum of a source is taken per bucket of the shuffled
    order (256 a source), after a sum per bucket, so a source with a third of
    all rows is no single task. The global order is by ranges of finish time
    (finish times are spread evenly by construction); only the range with the
    cut is ordered row by row. Repeats are written only as far as the cut can lie
    (:func:`_horizon`), so a large ``max_repeats`` costs nothing. Up to ``FEW_TARGETS`` targets are broadcast,
    with at most 256 rows each; more are joined by shuffles.
    """
    t = targets.select(same_source(F.col("source")).alias("source"), F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.coalesce("max_repeats", F.lit(0)).alias("max_repeats"))
    t = t.where(F.col("source").isNotNull()).groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").cast("long").alias("max_repeats"))
    d = sized.select(F.col("id").alias("id"), same_source(F.col("source")).alias("source"), F.col("tokens").cast("long").alias("tokens")).where("tokens > 0 AND source IS NOT NULL AND id IS NOT NULL")
    few = F.broadcast if t.count() <= FEW_TARGETS else (lambda x: x)
    d = d.join(few(t), "source")
    # the shuffled order of a source: by a hash of the id; buckets are ranges of it
    d = d.withColumn("_h", F.xxhash64(F.lit(seed), "id")).withColumn("_b", F.shiftright("_h", 56))
    d = materialise(d, "mix-documents")
    sums = d.groupBy("source", "_b").agg(F.sum("tokens").alias("_sum"), F.max("tokens").alias("_top"))
    sums = materialise(sums, "mix-sums")  # at most 256 rows a target
    have = sums.groupBy("source").agg(F.sum("_sum").alias("_have"), F.max("_top").alias("_top"))
    t = t.join(have, "source", "left").withColumn("_have", F.coalesce("_have", F.lit(0)))
    usable = (F.col("_have") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)
    weight = F.sum(F.when(usable, F.col("target_share"))).over(Window.partitionBy(F.lit(1)))  # one row a target
    t = t.withColumn("_w", F.when(usable, F.col("target_share") / weight))
    t = materialise(t, "mix-targets")
    total = budget
    if total is None:
        total = t.agg(F.min(F.col("_have") * F.col("max_repeats") / F.col("_w"))).first()[0] or 0
    horizon = _horizon(t, total)
    plan = few(t.where(F.col("_w").isNotNull()).select("source", "_w", "_have", "max_repeats"))
    ahead = Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # at most 256 rows
    starts = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(ahead), F.lit(0))).select("source", "_b", "_before")
    inside = Window.partitionBy("source", "_b").orderBy("_h", "id").rowsBetween(Window.unboundedPreceding, 0)
    q = d.select("id", "source", "tokens", "_h", "_b").join(few(starts), ["source", "_b"]).join(plan, "source")
    q = q.withColumn("_upto", F.col("_before") + F.sum("tokens").over(inside))
    q = q.select("id", "source", "tokens", "_upto", "_have", "_w", F.explode(_passes(F.col("_upto"), F.col("_have"), F.col("_w"), F.col("max_repeats"), horizon)).alias("_pass"))
    q = q.select("id", "source", "tokens", "_pass", ((F.col("_pass") * F.col("_have") + F.col("_upto")) / F.col("_w")).alias("finish"))
    step = max(horizon / RANGES, 1e-9)
    q = materialise(q.withColumn("_r", F.least(F.floor(F.col("finish") / step), F.lit(RANGES)).cast("int")), "mix-queue")
    ranges = q.groupBy("_r").agg(F.sum("tokens").alias("_sum"))
    ordered = Window.partitionBy(F.lit(1)).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    ranges = ranges.withColumn("_start", F.coalesce(F.sum("_sum").over(ordered), F.lit(0)))
    q = q.join(F.broadcast(ranges), "_r")
    within = q.where((F.col("_start") + F.col("_sum") <= total)).select("id", "source", "tokens", "_pass", "finish")
    row = Window.partitionBy("_r").orderBy("finish", "id", "_pass").rowsBetween(Window.unboundedPreceding, 0)
    edge = q.where((F.col("_start") < total) & (F.col("_start") + F.col("_sum") > total)).withColumn("_cum", F.col("_start") + F.sum("tokens").over(row))
    sent = within.unionByName(edge.where(F.col("_cum") <= total).select(within.columns))
    chosen = sent.groupBy("id", "source", "tokens").agg(F.count(F.lit(1)).cast("int").alias("repeats"), F.max("finish").alias("finish"))
    chosen = materialise(chosen, "mix-chosen")
    got = chosen.groupBy("source").agg(F.count(F.lit(1)).alias("n_documents"), F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"))
    shares = t.select("source", "target_share", "max_repeats", F.coalesce("_w", F.lit(0.0)).alias("share_of_available")).join(got, "source", "left").na.fill(0, ["n_documents", "tokens"])
    share = F.try_divide(F.col("tokens"), F.sum("tokens").over(Window.partitionBy(F.lit(1))))
    shares = shares.withColumn("share", F.coalesce(share, F.lit(0.0)))
    return Mix(chosen, shares.select("source", "target_share", "max_repeats", "n_documents", "tokens", "share", "share_of_available"), t.select("source", F.coalesce("_top", F.lit(0)).alias("longest")))

"""Result matrices and comparisons of predictions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import trim_answer

#: Models and benchmarks that a report's grid may have.
GRID_NAMES = 10_000


def matrix(models: DataFrame, benches: DataFrame, scores: DataFrame, baseline: str, digits: int = 3) -> DataFrame:
    """Every model and benchmark with its score and the rounded difference to the baseline's.

    Models and benchmarks are names, a handful of rows each; their product is
    the report's grid, and more than ``GRID_NAMES`` of either raise. Missing
    scores and differences are null.
    """
    for names in (models, benches):
        if names.limit(GRID_NAMES + 1).count() > GRID_NAMES:
            raise ValueError(f"a grid has at most {GRID_NAMES} names a side")
    grid = models.crossJoin(benches)
    base = scores.where(F.col("model") == baseline).select("bench", F.col("score").alias("_base"))
    full = grid.join(scores, ["model", "bench"], "left").join(base, "bench", "left")
    return full.select("model", "bench", "score", F.round(F.col("score") - F.col("_base"), digits).alias("delta"))


def cell(score: Column, delta: Column) -> Column:
    """A report cell: the score with its signed difference, or a dash."""
    return F.when(score.isNull(), "—").otherwise(F.concat(F.format_string("%.3f", score), F.when(delta.isNotNull(), F.format_string(" (%+.3f)", delta)).otherwise(F.lit(""))))


def disclosure(n_items: Column, n_prints: Column) -> Column:
    """Whether decontamination may be claimed."""
    return F.when(F.coalesce(n_items, F.lit(0)) == 0, "not_run").when(n_prints == 0, "not_effective").otherwise("executed")


def judging(bench: Column, has_judge: bool, judged: tuple[str, ...] = ("MathVista",), binary: tuple[str, ...] = ("MME",)) -> Column:
    """How a benchmark's answers were judged."""
    return F.when(bench.isin(*judged), F.lit("judge model" if has_judge else "rules, not comparable")).when(bench.isin(*binary), "yes or no").otherwise("default")


def nested_scores(text: Column, splits: tuple[str, ...] = ("short", "medium", "long")) -> Column:
    """``value`` (percent of the first split) and ``detail`` (all splits that are there) of a score JSON."""
    overall = {s: F.get_json_object(text, f"$.{s}.overall").try_cast("double") * 100 for s in splits}
    detail = F.concat_ws("; ", *[F.when(v.isNotNull(), F.format_string(s + " %.1f%%", v)) for s, v in overall.items()])
    return F.struct(overall[splits[0]].alias("value"), detail.alias("detail"))


def compare_sides(answers: DataFrame) -> DataFrame:
    """Changes against the first answer to each question.

    ``answers``: ``index, pair_id, gold, said``. The row with the smallest
    ``pair_id`` of an index gives the gold answer and the baseline; a missing
    answer compares as wrong unless the gold one is missing, too.
    """
    first = answers.groupBy("index").agg(F.min(F.struct("pair_id", "gold", "said")).alias("b"))
    both = answers.join(first, "index")
    right = lambda c: F.coalesce(c, F.lit("nan")) == F.coalesce("b.gold", F.lit("nan"))
    r0, r1, r2 = right(F.col("b.said")), right(F.col("said")), right(F.col("gold"))
    better, worse = F.count_if(~r0 & r2), F.count_if(r0 & ~r2)
    return both.agg(F.count(F.lit(1)).alias("n"), better.alias("improved"), worse.alias("regressed"), (better - worse).alias("net"), F.count_if(~r0 & r1 & r2).alias("all_improved"))


def compare_models(base: DataFrame, *others: DataFrame) -> DataFrame:
    """Changes from a first model's predictions to those of others, aligned on its ids.

    ``base``: ``index, answer, said``; others: ``index, said`` (ids unique).
    Ids that only others have vanish; an id that another lacks counts as the
    text ``nan`` there, and so mostly as wrong. ``improved`` and ``regressed``
    ask for all others, ``improved_by_any`` for one; ``format_only`` counts
    equal answers of base and first other in different form.
    """
    out = base.withColumnRenamed("said", "_0")
    for i, other in enumerate(others, 1):
        out = out.join(other.select("index", F.col("said").alias(f"_{i}")), "index", "left")
    raw = [F.coalesce(f"_{i}", F.lit("nan")) for i in range(len(others) + 1)]
    norm = [trim_answer(x) for x in raw]
    right = [x == trim_answer(F.coalesce("answer", F.lit("nan"))) for x in norm]
    every, some = reduce(lambda a, b: a & b, right[1:]), reduce(lambda a, b: a | b, right[1:])
    better, worse = F.count_if(~right[0] & every), F.count_if(right[0] & ~some)
    return out.agg(F.count(F.lit(1)).alias("n"), better.alias("improved"), worse.alias("regressed"), (better - worse).alias("net"), F.count_if(~right[0] & some).alias("improved_by_any"), F.count_if((norm[0] == norm[1]) & (raw[0] != raw[1])).alias("format_only"))


def pivoted(grid: DataFrame, benches: Sequence[str]) -> DataFrame:
    """A row a model and a column ``c_<bench>`` a named benchmark, with the report's cells."""
    wide = grid.select("model", "bench", cell(F.col("score"), F.col("delta")).alias("_cell")).groupBy("model").pivot("bench", list(benches)).agg(F.first("_cell"))
    return wide.select("model", *[F.coalesce(F.col(b), F.lit("—")).alias(f"c_{b}") for b in benches])

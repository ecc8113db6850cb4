"""Verifiable rewards as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import ANSWER_TAGS, first_number, normal_answer


def is_close(a: Column, b: Column, tolerance: float = 1e-4) -> Column:
    """Equal within a relative or absolute tolerance; null if either is null."""
    return F.abs(a - b) <= F.greatest(F.lit(tolerance) * F.greatest(F.abs(a), F.abs(b)), F.lit(tolerance))


def answer_reward(prediction: Column, gold: Column, tolerance: float = 1e-4) -> Column:
    """1.0 if the answers are equal, numerically close, or the gold one is contained, else 0.0.

    An empty or null side gives 0.0. Containment is literal: 3 is found in 13.
    """
    p, g = normal_answer(prediction), normal_answer(gold)
    close = F.coalesce(is_close(first_number(prediction), first_number(gold), tolerance), F.lit(False))
    return F.when((p == "") | (g == ""), 0.0).when((p == g) | close | F.contains(p, g), 1.0).otherwise(0.0)


def format_reward(prediction: Column) -> Column:
    """Half a point each for a thinking tag (it need not be closed) and for an answer tag."""
    p = F.coalesce(prediction, F.lit(""))
    tags = "|".join(ANSWER_TAGS)
    thought = p.rlike(r"(?i)<\s*think\s*>")
    answered = p.rlike(rf"(?is)<\s*({tags})\s*>(.*?)<\s*/\s*\1\s*>")
    return F.when(thought, 0.5).otherwise(0.0) + F.when(answered, 0.5).otherwise(0.0)


def score(prediction: Column, gold: Column, answer_weight: float = 1.0, format_weight: float = 0.0) -> Column:
    """Weighted reward; a missing gold answer counts as empty."""
    return F.lit(answer_weight) * answer_reward(prediction, F.coalesce(gold, F.lit(""))) + F.lit(format_weight) * format_reward(prediction)


def score_lists(predictions: Column, golds: Column, answer_weight: float = 1.0, format_weight: float = 0.0) -> Column:
    """Scores of a list of predictions against a list of gold answers.

    A single gold answer serves all predictions; where the list is too short,
    the gold answer counts as empty.
    """
    gold = lambda i: F.coalesce(F.when(F.size(golds) == 1, F.get(golds, F.lit(0))).otherwise(F.get(golds, i)), F.lit(""))
    return F.transform(predictions, lambda p, i: score(p, gold(i), answer_weight, format_weight))

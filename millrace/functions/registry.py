"""Named scoring functions, so a configuration can choose one by name.

A scoring function takes columns of prediction and gold answer and gives a
column, so it is planned like built-in functions and needs no Python worker.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import Column

from millrace.functions import reward

Scorer = Callable[..., Column]

SCORERS: dict[str, Scorer] = {
    "answer": reward.answer_reward,
    "format": lambda prediction, gold: reward.format_reward(prediction),
    "weighted": reward.score,
}


def scorer(name: str) -> Scorer:
    """A registered function, or one named ``module:function``."""
    if name in SCORERS:
        return SCORERS[name]
    module, _, function = name.partition(":")
    if not function:
        raise KeyError(f"no scoring function is named {name}")
    return getattr(importlib.import_module(module), function)

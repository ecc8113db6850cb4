"""Small outputs of a run: sidecar statistics, Markdown tables, evaluation configurations."""

from __future__ import annotations

import json
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

#: Rows a report table may have; a report is read by people.
REPORT_ROWS = 1_000


def sidecar(spark: SparkSession, stats: Mapping[str, object]) -> DataFrame:
    """``metric, value`` rows of run statistics; values that are no plain texts become JSON."""
    rows = [(k, v if isinstance(v, str) else json.dumps(v, ensure_ascii=False, sort_keys=True)) for k, v in stats.items()]
    return spark.createDataFrame(rows, "metric string, value string")


def write_sidecar(spark: SparkSession, stats: Mapping[str, object], path: str) -> None:
    sidecar(spark, stats).coalesce(1).write.mode("overwrite").json(path)


def reason_counts(reasons: DataFrame, prefix: str = "dropped_") -> dict[str, int]:
    """Statistics of a ``reason, n`` funnel, dropped reasons with a prefix; a funnel is a few rows."""
    rows = reasons.orderBy("reason").limit(REPORT_ROWS).collect()
    return {(r.reason if r.reason == "kept" else prefix + r.reason): r.n for r in rows}


def cell(value: object, digits: int = 3) -> str:
    """Whole numbers with thousands marks, others with fixed digits, nothing as a dash."""
    if value is None:
        return "—"
    if isinstance(value, bool):
        return "yes" if value else "no"
    if isinstance(value, int):
        return f"{value:,}"
    if isinstance(value, float):
        return "—" if value != value else f"{value:,.{digits}f}"
    return str(value).replace("|", "\\|").replace("\n", " ")


def markdown(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 3) -> str:
    """A table of a small DataFrame, in its order; more than ``REPORT_ROWS`` rows raise."""
    columns = list(columns or df.columns)
    rows = df.select(*columns).limit(REPORT_ROWS + 1).collect()
    if len(rows) > REPORT_ROWS:
        raise ValueError(f"a report table has at most {REPORT_ROWS} rows")
    lines = ["| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]
    return "\n".join(lines + ["| " + " | ".join(cell(v, digits) for v in r) + " |" for r in rows]) + "\n"


def evaluation_config(models: Sequence[str], datasets: Sequence[str], known: Mapping[str, Mapping], present: Collection[str]) -> dict:
    """The configuration of selected models and datasets.

    Unknown names raise; models whose folder is not ``present`` are left out.
    """
    unknown = sorted({*models, *datasets} - set(known))
    if unknown:
        raise KeyError(f"unknown names: {', '.join(unknown)}")
    return {"model": {m: dict(known[m]) for m in models if m in present}, "data": {d: dict(known[d]) for d in datasets}}

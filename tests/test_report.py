import json

import pytest

from millrace.sources import report


def test_sidecar_and_counts(spark, tmp_path):
    report.write_sidecar(spark, {"n": 3, "note": "x", "by": {"b": 1, "a": [2]}}, str(tmp_path / "s"))
    got = {r.metric: r.value for r in spark.read.json(str(tmp_path / "s")).collect()}
    assert got["note"] == "x" and json.loads(got["n"]) == 3 and json.loads(got["by"]) == {"a": [2], "b": 1}
    funnel = spark.createDataFrame([("kept", 5), ("too_long", 2)], "reason string, n long")
    assert report.reason_counts(funnel) == {"kept": 5, "dropped_too_long": 2}


def test_markdown(spark):
    df = spark.createDataFrame([("a|b", 12345, 1.5, None, float("nan"))], "s string, i long, d double, x string, y double")
    assert report.markdown(df).splitlines()[2] == "| a\\|b | 12,345 | 1.500 | — | — |"
    with pytest.raises(ValueError):
        report.markdown(spark.range(2000))


def test_evaluation_config():
    known = {"m1": {"path": "x"}, "m2": {"path": "y"}, "d": {"kind": "z"}}
    assert report.evaluation_config(["m1", "m2"], ["d"], known, {"m2"}) == {"model": {"m2": {"path": "y"}}, "data": {"d": {"kind": "z"}}}
    with pytest.raises(KeyError):
        report.evaluation_config(["m3"], ["d"], known, {"m2"})

import hashlib

import pytest
from pyspark.sql import functions as F

from millrace.functions import reward
from millrace.functions import text as T


def values(spark, rows, ddl, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, ddl).select(*columns).collect()]


def test_norm_text_and_hash(spark):
    got = values(spark, [("  A \t\n b C ",), (None,), ("",)], "s string", T.norm_text(F.col("s")), T.text_hash(F.col("s")))
    assert got[0] == ("a b c", hashlib.sha1(b"a b c").hexdigest())
    assert got[1] == (None, None) and got[2][0] == ""


def test_record_hash_keeps_escaped_line_ends(spark):
    ddl = "m array<struct<role:string,content:string>>"
    a, b, c = (h for (h,) in values(spark, [([("user", "x\ny")],), ([("user", "x y")],), ([("USER", "X  Y")],)], ddl, T.record_hash(F.col("m"))))
    assert a != b and b == c


@pytest.mark.parametrize(
    "raw,prefix,path",
    [
        ("./coco\\train2017\\8.jpg", "coco", "coco/train2017/8.jpg"),
        ("vg/VG_100K/5.jpg", "vg", "vg/VG_100K/5.jpg"),
        ("textvqa/train_images/6.jpg", "textvqa", "textvqa/train_images/6.jpg"),
        ("ocr_vqa/images/3.jpg", "ocr_vqa", None),
        ("wikiart/4.jpg", "wikiart", None),
        (None, None, None),
    ],
)
def test_resolve_image(spark, raw, prefix, path):
    assert values(spark, [(raw,)], "s string", T.path_prefix(F.col("s")), T.resolve_image(F.col("s"))) == [(prefix, path)]


def test_taxonomy_first_mark_wins(spark):
    rows = [("Video UNAVAILABLE, private",), ("this message",), ("blocked",), (None,), ("x",)]
    assert [r for (r,) in values(spark, rows, "s string", T.first_mark(F.col("s"), T.PROBE_ERRORS))] == ["unavailable", "age_restricted", "blocked", "error", "error"]


@pytest.mark.parametrize(
    "pred,gold,expected",
    [
        ("145", "<answer> 145° </answer>", 1.0),
        ("<think>x</think><answer>C</answer>", "c", 1.0),
        ("The answer is B", "B", 1.0),
        ("13", "3", 1.0),
        ("1/2", "0.5", 0.0),
        ("1,234.0", "1234", 1.0),
        ("3 .", "3", 1.0),
        ("", "3", 0.0),
        (None, "3", 0.0),
        ("<Final>2×3</final>", "2*3", 1.0),
    ],
)
def test_answer_reward(spark, pred, gold, expected):
    assert values(spark, [(pred, gold)], "p string, g string", reward.answer_reward(F.col("p"), F.col("g"))) == [(expected,)]


def test_format_reward_and_weights(spark):
    rows = [("<think>a</think> <answer>b</answer>", "b"), ("<answer>b</answer>", None), ("b", "b")]
    got = values(spark, rows, "p string, g string", reward.format_reward(F.col("p")), reward.score(F.col("p"), F.col("g"), 0.9, 0.1))
    assert [a for a, _ in got] == [1.0, 0.5, 0.0]
    assert [round(b, 6) for _, b in got] == [1.0, 0.05, 0.9]


def test_small_functions(spark):
    got = values(
        spark, [("v_v_abc", "run/checkpoint-120", "Accuracy: 71.25 of 99.5", " Yes 。. ")], "a string, b string, c string, d string",
        T.strip_prefix_once(F.col("a"), "v_"), T.number_suffix(F.col("b")), T.scraped_score(F.col("c")), T.trim_answer(F.col("d")),
    )
    assert got == [("v_abc", 120, 71.25, "yes")]


def test_override_arguments():
    assert T.override_arguments(["--a", "1", "--b=2", "--flag", "--c", "x", "k=v", "--last"]) == ["a=1", "b=2", "flag=true", "c=x", "k=v", "last=true"]
    assert T.override_arguments([]) == []


def test_score_lists_and_names(spark):
    from millrace.functions import registry

    row = spark.createDataFrame([(["a", "b"], ["a"], ["a", "b"], ["a"][:0])], "p array<string>, one array<string>, two array<string>, none array<string>")
    got = row.select(*[reward.score_lists(F.col("p"), F.col(g)).alias(g) for g in ("one", "two", "none")]).first()
    assert (got.one, got.two, got.none) == ([1.0, 0.0], [1.0, 1.0], [0.0, 0.0])
    assert values(spark, [("x", "x")], "p string, g string", registry.scorer("answer")(F.col("p"), F.col("g")), registry.scorer("millrace.functions.reward:score")(F.col("p"), F.col("g"))) == [(1.0, 1.0)]
    with pytest.raises(KeyError):
        registry.scorer("nothing")
    assert values(spark, [("a",), ("b",), (None,)], "s string", T.looked_up(F.col("s"), {"a": "A"})) == [("A",), ("b",), (None,)]

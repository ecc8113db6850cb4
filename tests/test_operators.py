import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.operators import chat, joins, monitor, pairs, profile, quality, results, sampling, series, skew
from millrace.operators.references import BUCKET, clean_path, is_blank, orphan_references


def test_waterfall_ignores_dropped_rows_when_it_looks_for_duplicates(spark):
    rows = [(1, "a", True), (2, "a", False), (3, "a", False), (4, None, False), (5, None, False)]
    df = spark.createDataFrame(rows, "id int, h string, bad boolean")
    out = quality.waterfall(df, [("bad", F.col("bad"))], F.coalesce("h", F.lit("")), "id")
    assert {r.id: r.reason for r in out.collect()} == {1: "bad", 2: "kept", 3: "duplicate", 4: "kept", 5: "duplicate"}
    assert {r.reason: r.n for r in quality.funnel(df, [("bad", F.col("bad"))], F.coalesce("h", F.lit(""))).collect()} == {"bad": 1, "kept": 2, "duplicate": 2}


def test_keep_first_and_last(spark):
    df = spark.createDataFrame([(3, "x", 1.0), (1, "x", 2.0), (2, None, 3.0), (4, None, 0.5)], "id int, k string, v double")
    assert sorted(r.id for r in quality.keep_first(df, "k", "id").collect()) == [1, 2]
    assert {(r.k, r.id) for r in quality.keep_last(df, ["k"], ["id"], ["v"]).collect()} == {("x", 3), (None, 4)}


def test_allocation_is_the_published_one(spark):
    pools = spark.createDataFrame([("coco", 364100), ("gqa", 72140), ("textvqa", 21953), ("vg", 86417)], "s string, n long")
    assert {r.s: r["take"] for r in sampling.allocation(pools, "s", 296838).collect()} == {"coco": 198452, "gqa": 39319, "textvqa": 11965, "vg": 47102}
    other = {r.s: r["take"] for r in sampling.allocation(pools, "s", 296838, largest_remainder=True).collect()}
    assert other["gqa"] == 39320 and other["vg"] == 47101


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_stratified_sample_does_not_depend_on_partitions(spark, partitions):
    df = spark.range(2000).select(F.col("id").alias("k"), F.when(F.col("id") % 10 == 0, None).otherwise((F.col("id") % 3).cast("string")).alias("s")).repartition(partitions)
    got = sampling.stratified(df, "s", 100, "x", "k").collect()
    assert len(got) == 100
    assert sum(r.k for r in got) == sum(r.k for r in sampling.stratified(df.coalesce(1), "s", 100, "x", "k").collect())


def test_samples_of_empty_and_small_tables(spark):
    empty = spark.createDataFrame([], "k long, s string")
    assert sampling.stratified(empty, "s", 5, "x", "k").count() == 0
    one = spark.createDataFrame([(1, "a")], "k long, s string")
    assert sampling.stratified(one, "s", 5, "x", "k").count() == 1
    assert sampling.cluster_sample(one, "s", 0.1, "x").count() == 1


def test_percentiles(spark):
    random.seed(3)
    data = [(random.choice("abc"), random.randint(0, 30)) for _ in range(500)]
    df = spark.createDataFrame(data + [("a", None)], "g string, v int")
    by = defaultdict(list)
    for g, v in data:
        by[g].append(v)
    for rank, index in ((profile.nearest_rank, lambda n, p: round(p * (n - 1))), (profile.floor_rank, lambda n, p: min(n - 1, int(n * p)))):
        got = {(r.g, r.p): r["value"] for r in profile.percentiles(df, "g", "v", [0.0, 0.5, 0.95, 1.0], rank).collect()}
        assert got == {(g, p): sorted(v)[index(len(v), p)] for g, v in by.items() for p in (0.0, 0.5, 0.95, 1.0)}


def test_video_tokens():
    assert profile.video_tokens() == 288


def test_trailing_windows_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(series, "CHUNK", 16)
    df = spark.range(200).select((F.col("id") % 2).alias("run_id"), F.col("id").cast("double").alias("ts"), F.lit(0).alias("written_at"), (F.col("id") + 1).alias("step"), ((F.col("id") * 7) % 13).cast("double").alias("loss"), F.lit(None).cast("double").alias("grad_norm"))
    got = {(r.run_id, r.ts): r.average for r in monitor.moving_average(monitor.series(df, "loss"), "loss").collect()}
    for run in (0, 1):
        ids = [i for i in range(200) if i % 2 == run]
        for k, i in enumerate(ids):
            want = None if k < 10 else sum((j * 7) % 13 for j in ids[k - 10 : k + 1]) / 11
            assert got[(run, float(i))] == (pytest.approx(want) if want is not None else None)


def _log(spark, rows):
    return spark.createDataFrame([("r", float(i), 0, i + 1, loss, gn) for i, (loss, gn) in enumerate(rows)], "run_id string, ts double, written_at int, step int, loss double, grad_norm double")


def test_loss_and_gradient_rules(spark):
    log = _log(spark, [(1.0, 0.0)] * 7 + [(4.0, 0.0), (float("nan"), 1.0), (1.0, 101.0)])
    assert [(r.step, r.level) for r in monitor.loss_level(monitor.series(log, "loss")).where("level <> 'OK'").orderBy("step").collect()] == [(8, "WARN"), (9, "CRIT")]
    assert [(r.step, r.streak) for r in monitor.gradient_level(monitor.series(log, "grad_norm")).where("level <> 'OK'").orderBy("step").collect()] == [(8, 8), (10, 0)]


def test_alerts_are_suppressed_up_to_the_bound(spark):
    times = [0.0, 1799.0, 1800.0, 1801.0, 3601.0, 3601.5, 10_000.0]
    df = spark.createDataFrame([("m", t) for t in times] + [("n", 5.0), (None, 1.0), ("m", None)], "k string, t double")
    got = sorted((r.k, r.t) for r in monitor.suppressed_alerts(df, "k", "t").collect())
    assert got == [("m", 0.0), ("m", 1801.0), ("m", 3601.5), ("m", 10_000.0), ("n", 5.0)]


def test_throughput_and_slope(spark):
    log = spark.createDataFrame([("r", 0.0, 10, 100, 1.0), ("r", 3600.0, 30, 100, 3.0)], "run_id string, ts double, step int, total_steps int, anon_mb double")
    assert [tuple(r) for r in monitor.throughput(log).collect()] == [("r", 20.0, 3.5)]
    assert [tuple(r) for r in monitor.endpoint_slope(log, "anon_mb").collect()] == [("r", 2, 2.0)]


def test_as_of_matches_brute_force(spark):
    random.seed(5)
    left = [(random.randint(0, 2), i, random.randint(0, 400)) for i in range(150)]
    right = [(random.randint(0, 2), random.randint(0, 400), i) for i in range(60)]
    stamp = lambda c: F.timestamp_seconds(c).cast("timestamp_ntz")
    a = spark.createDataFrame(left, "k int, id int, s int").select("k", "id", stamp("s").alias("t"), "s")
    b = spark.createDataFrame(right, "k int, s int, v int").select("k", stamp("s").alias("t"), "v")
    got = {r.id: r.asof_v for r in joins.as_of(a, b, ["k"], "t", ["v"], 50.0).collect()}
    for k, i, s in left:
        best = max(((rs, v) for rk, rs, v in right if rk == k and rs <= s), default=(None, None))
        assert got[i] == best[1]


def test_top_k(spark):
    df = spark.range(300).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    assert sorted(r.v for r in joins.top_k(df, ["k"], [F.desc("v")], 3).collect()) == [294, 295, 296, 297, 298, 299]


def test_salted_join_spreads_and_keeps_all_rows(spark):
    left = spark.range(1000).select(F.when(F.col("id") < 600, 7).when(F.col("id") < 610, None).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    right = spark.range(500, 1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w")).union(spark.sql("SELECT 7L, 14L"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain, salted = left.join(right, ["k"], how), skew.salted_join(left, right, ["k"], how, share=0.1)
        assert salted.count() == plain.count() and salted.exceptAll(plain.select(salted.columns)).count() == 0
    assert {r.k for r in skew.heavy_keys(left, ["k"], 0.1).collect()} == {7}
    assert skew.heavy_keys(left.limit(0), ["k"]).count() == 0


@pytest.mark.parametrize("most", [0, 5000])
def test_narrowed_keeps_all_rows_that_match(spark, most):
    df = spark.range(-20_000, 20_000).select(F.when(F.col("id") != 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    keys = df.where("k % 10 = 3").select("k").union(spark.sql("SELECT 13L"))
    matching, rest = df.join(keys, "k", "left_semi"), df.join(keys, "k", "left_anti")
    got = skew.narrowed(df, "k", keys, most)
    assert got.columns == ["k", "v"] and matching.exceptAll(got).count() == 0 and got.count() < (2 * matching.count() if most else df.count())
    got = skew.without(df, "k", keys, most)
    assert got.count() == rest.count() and rest.exceptAll(got).count() == 0
    none = keys.limit(0)
    assert skew.narrowed(df, "k", none, most).count() == 0 and skew.without(df, "k", none, most).count() == df.count()


CHAT = [
    ("ok", "coco/train2017/1.jpg", [("human", "q"), ("gpt", "a")]),
    ("tagged", "gqa/images/2.jpg", [("human", "see <image> q"), ("gpt", "a")]),
    ("no_image", None, [("human", "q"), ("gpt", "a")]),
    ("excluded_ocr_vqa", "ocr_vqa/images/3.jpg", [("human", "q"), ("gpt", "a")]),
    ("unknown_prefix_wikiart", "wikiart/4.jpg", [("human", "q"), ("gpt", "a")]),
    ("bad_role", "vg/VG_100K/5.jpg", [("system", "q"), ("gpt", "a")]),
    ("blank", "textvqa/train_images/6.jpg", [("human", "q"), ("gpt", "  ")]),
    ("ends_with_user", "coco/train2017/7.jpg", [("human", "q"), ("gpt", "a"), ("human", "q")]),
    ("dot_path", "./coco\\train2017\\8.jpg", [("human", "q"), ("gpt", "a")]),
    ("null_turns", "coco/1.jpg", None),
]


def test_chat_cases(spark):
    df = spark.createDataFrame(CHAT, "name string, image string, c array<struct<from:string,value:string>>")
    out = df.withColumn("m", chat.normalised(F.col("c"), "<image>\n")).withColumn("r", chat.selection_reason(F.col("image"), F.col("m")))
    got = {r.name: r for r in out.collect()}
    assert got["ok"].m[0].content == "<image>\nq" and got["tagged"].m[0].content == "see <image> q" and got["ok"].m[1].role == "assistant"
    assert [n for n in got if got[n].r == "bad_conversation"] == ["bad_role", "blank", "ends_with_user", "null_turns"]
    assert got["dot_path"].r == "pool_coco" and all(got[n].r == n for n in ("no_image", "excluded_ocr_vqa", "unknown_prefix_wikiart"))


def test_preferences_ranking_and_unification(spark):
    rows = [(1, '{"question": " q ", "chosen": "c", "rejected": "r"}'), (2, "{torn"), (3, '{"question": "q", "chosen": "c"}'), (4, None)]
    out = pairs.parsed_preferences(spark.createDataFrame(rows, "id int, text string"), "text").collect()
    assert [(r.id, r.messages[0].content, r.chosen.content) for r in out] == [(1, "q", "c")]
    ranked = spark.createDataFrame([(["a", "bbb", "cc", "ddd"], None), (["a", "bbb", "cc"], 2)], "t array<string>, b int").select(pairs.best_and_worst(F.col("t"), F.col("b")).alias("r")).collect()
    assert [(r.r.best, r.r.worst) for r in ranked] == [("bbb", "a"), ("cc", "bbb")]
    a = spark.createDataFrame([("p", "s")], "problem string, solution string")
    b = spark.createDataFrame([("q", "l", 1)], "query string, label string, extra int")
    c = spark.createDataFrame([("x",)], "other string")
    assert {(r.origin, r.problem, r.answer) for r in pairs.unified({"a": a, "b": b, "c": c}).collect()} == {("a", "p", "s"), ("b", "q", "l")}
    with pytest.raises(ValueError):
        pairs.unified({"c": c})


def test_results(spark):
    models = spark.createDataFrame([("pretrained",), ("sft",)], "model string")
    benches = spark.createDataFrame([("MME",), ("MathVista",)], "bench string")
    scores = spark.createDataFrame([("pretrained", "MME", 1492.712), ("sft", "MME", 1536.296)], "model string, bench string, score double")
    got = {(r.model, r.bench): (r.delta, r.cell) for r in results.matrix(models, benches, scores, "pretrained").withColumn("cell", results.cell(F.col("score"), F.col("delta"))).collect()}
    assert got[("sft", "MME")] == (43.584, "1536.296 (+43.584)") and got[("sft", "MathVista")] == (None, "—")
    text = '{"short": {"overall": "0.600"}, "long": {"overall": "0.5"}}'
    r = spark.range(1).select(results.nested_scores(F.lit(text)).alias("s")).first().s
    assert round(r.value, 6) == 60.0 and r.detail == "short 60.0%; long 50.0%"


STAMP = "timestamp_ntz"


def _orphans(spark, refs, parents):
    r = spark.createDataFrame(refs, "src_table string, row_id long, field string, raw string, s long, noise string")
    r = r.where(~is_blank(F.col("raw"))).select("src_table", "row_id", "field", clean_path(F.col("raw")).alias("path"), F.timestamp_seconds("s").cast(STAMP).alias("at"), "noise")
    p = spark.createDataFrame(parents, "path string, a long, b long").select("path", F.timestamp_seconds("a").cast(STAMP).alias("added_at"), F.timestamp_seconds("b").cast(STAMP).alias("removed_at"), F.lit(1).alias("kind"))
    return {(x.row_id, x.field, x.path): x.kind for x in orphan_references(r, p).collect()}


def test_orphans_against_brute_force(spark):
    random.seed(11)
    names = [f"coco/{i:05d}.jpg" for i in range(40)] + [f"vg/{i}.jpg" for i in range(BUCKET - 5, BUCKET + 5)] + ["plain", "v/a1b.mp4", "coco/7.jpg", "coco/07.jpg"]
    parents = []
    for n in random.sample(names, 40):
        for _ in range(random.randint(1, 4)):
            a = random.randint(0, 100)
            parents.append((n, a, random.choice([None, a + random.randint(0, 40)])))
    parents += parents[:5] + [(None, 1, 2), ("plain", None, None)]
    refs = [("t", i, "images", random.choice(["", "./", "..\\"]) + random.choice(names), random.randint(0, 120), "x") for i in range(400)]
    refs += [("t", 1000 + i, "images", names[0], 50 + i % 9, "x") for i in range(300)] + [("t", 5000, "images", None, 5, "x"), ("t", 5001, "images", "  ", 5, "x")]
    want = {}
    for _, i, f, raw, s, _ in refs:
        if raw is None or not raw.strip():
            continue
        path = raw.replace("\\", "/").lstrip("./")
        own = [(a, b) for p, a, b in parents if p == path]
        if any(a is not None and a <= s and (b is None or b > s) for a, b in own):
            continue
        want[(i, f, path)] = "missing" if not own else "late" if all(a is None or a > s for a, b in own) else "deleted"
    assert _orphans(spark, refs, parents) == want


def test_orphans_of_empty_tables_and_repeats(spark):
    assert _orphans(spark, [], []) == {}
    assert _orphans(spark, [("t", 1, "images", "a/1", 5, None)] * 3, []) == {(1, "images", "a/1"): "missing"}
    assert _orphans(spark, [], [("a", 1, None)]) == {}


def test_image_columns_and_judging(spark):
    rows = [("p", (None, "x"), [(bytearray(b"1"), "y")], 1)]
    df = spark.createDataFrame(rows, "image string, decoded_image struct<bytes:binary,path:string>, images array<struct<bytes:binary,path:string>>, n int")
    assert pairs.image_column(df) == "images" and pairs.image_column(df.drop("images")) is None
    assert bytes(df.select(pairs.image_bytes(F.col("decoded_image"), F.col("images")).alias("b")).first().b) == b"1"
    got = [r.j for r in spark.createDataFrame([("MME",), ("MathVista",), ("x",)], "b string").select(results.judging(F.col("b"), False).alias("j")).collect()]
    assert got == ["yes or no", "rules, not comparable", "default"]

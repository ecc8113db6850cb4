"""Problems 1 and 3 against brute force on small tables."""

import json
import random
import unicodedata
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import near, outward
from millrace.llm.kernels import WordSlice, shingles
from millrace.session import materialise


def fold(s):
    return "".join(c for c in s.casefold() if not c.isspace() and unicodedata.category(c)[0] != "P")


def dress(s, rng):
    kind = rng.randrange(6)
    if kind == 0:
        return s.upper()
    if kind == 1:
        return "  " + s.replace(" ", "  ") + "\n"
    if kind == 2:
        return f"«{s}»!!"
    if kind == 3:
        return s.replace(",", "").replace("'", "’")
    if kind == 4:
        return s.title()
    return s


def field_forms(d, rng):
    items = list(d.items())
    rng.shuffle(items)
    return rng.choice([json.dumps(dict(items)), json.dumps(dict(items), indent=2), "\n".join(f"{k}: {v}" for k, v in items), "; ".join(f"{k.upper()} :  {v}" for k, v in items), "\n".join(f"- {k.title()}: {v}" for k, v in items)])


def copies(spark, rows):
    df = spark.createDataFrame(rows, "id long, chosen string, rejected string, rep string, c int")
    return {r.id: r.rep for r in outward.outward_duplicates(df, materialise).collect()}


def test_outward_copies_against_brute_force(spark):
    rng = random.Random(2)
    prose = [f"The {a} straße touches a {b}, it's 'new' {i}." for i, (a, b) in enumerate([("red", "box"), ("blue", "hat"), ("old", "cat")])]
    sets = [{"object": f"a {w}", "count": n, "place": "here"} for n, w in enumerate(("vase", "tram", "kite"))]
    rows, keys = [], defaultdict(list)
    for i in range(160):
        a, b = rng.randrange(6), rng.randrange(4)
        chosen = dress(prose[a], rng) if a < 3 else field_forms(sets[a - 3], rng)
        rejected = dress(prose[b], rng) if b < 3 else None
        rows.append((i, chosen, rejected, "x", i))
        keys[(a, b)].append(i)
    want = {i: min(v) for v in keys.values() if len(v) > 1 for i in v}
    assert copies(spark, rows) == want


def test_outward_edge_cases(spark):
    long = "word " * 200_000
    rows = [
        (1, None, None, "", 0), (2, "", " 　…", "", 0), (3, "​", None, "", 0), (4, "a b", "x", "", 0), (5, "A. B", "X!", "", 0), (6, long, "y", "", 0), (7, long.upper(), "Y", "", 0),
        (8, "one: a\ntwo: b", "z", "", 0), (9, "two b one a", "z", "", 0), (10, "one a two b", "z", "", 0), (None, "a b", "x", "", 0), (11, "1 + 1", "s", "", 0), (12, "1 1", "s", "", 0),
    ]
    assert copies(spark, rows) == {1: 1, 2: 1, 4: 4, 5: 4, 6: 6, 7: 6, 8: 8, 10: 8}
    assert copies(spark, []) == {}


def test_hot_set_of_copies(spark):
    rng = random.Random(5)
    rows = [(i, dress("The same, always.", rng), dress("Same", rng), "", 0) for i in range(400)] + [(1000 + i, f"n{i}", "r", "", 0) for i in range(800)]
    got = copies(spark, rows)
    assert got == {i: 0 for i in range(400)}


def test_equal_by_stream_or_by_items(spark, monkeypatch):
    """Punctuation that hides a field's edge, nested values, and sets that only others connect."""
    rows = [
        (1, "a: 1; b: 2; c: 3", "x", "", 0), (2, "a: 1; b: 2 c: 3", "X", "", 0), (3, "c: 3; a: 1; b: 2", "x!", "", 0), (4, "b: 2 c: 3; a: 1", "x", "", 0), (5, "a 1 b 2 c 3", "x", "", 0),
        (11, '{"a": "1", "b": [1, 2]}', None, "", 0), (12, '{"b": [1, 2], "a": "1"}', "", "", 0), (13, '{"b": [2, 1], "a": "1"}', "", "", 0), (14, '{"q": {"x": 1, "y": "}"}, "r": 2}', "n", "", 0), (15, '{"r": 2, "q": {"x": 1, "y": "}"}}', "N", "", 0),
        (20, "left side of the very long name of a field in this table: 1\nright: 2", "k", "", 0), (21, "Right: 2\nLeft side of the very long name of a field in this table: 1", "k", "", 0),
    ]
    want = {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 11: 11, 12: 11, 14: 14, 15: 14, 20: 20, 21: 20}
    assert copies(spark, rows) == want
    monkeypatch.setattr(outward, "COPIES_A_TASK", 1)
    assert copies(spark, rows) == want


def test_colliding_hashes_are_told_apart():
    pa = __import__("pyarrow")
    rows = [(1, "a", "x"), (2, "b", "x"), (3, "A", "x"), (4, "B!", "X")]
    zero = {k: [0] * 4 for k in ("c", "r", "c_raw", "c_free", "r_raw", "r_free")} | {k: [False] * 4 for k in ("c_set", "r_set")}
    batch = pa.RecordBatch.from_pydict(zero | {"id": [r[0] for r in rows], "chosen": [r[1] for r in rows], "rejected": [r[2] for r in rows]})
    out = [dict(zip(b.column("id").to_pylist(), b.column("rep").to_pylist())) for b in outward._verify(iter([batch]))]
    assert out == [{1: 1, 2: 2, 3: 1, 4: 2}]


def test_rolling_hash_does_not_depend_on_blocks(monkeypatch):
    text = "Größe — ‘x’ " * 500
    whole = outward.rolling_hash(text)
    monkeypatch.setattr(outward, "BLOCK", 7)
    assert outward.rolling_hash(text) == whole
    texts = [text, "", "Straße: ẞ\nname: x", "…", "a: 1; b: 2"]
    raw, free, is_set = outward.hash_texts(texts)
    assert raw.tolist() == [outward.rolling_hash(t) for t in texts] and is_set.tolist() == [False, False, True, False, True]
    assert outward.hash_texts(["b: 2\nA: 1!"])[1][0] == free[4] != raw[4]
    assert outward.same_answer(text, text.upper()) and not outward.same_answer(text, text + "y")


def words(s):
    out, w = [], ""
    for c in (s or "").lower() + " ":
        if c.isalnum():
            w += c
        elif w:
            out.append(w)
            w = ""
    return out


def runs(s, n=3):
    w = words(s)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def test_kernels_match_plain_python():
    texts = ["A b_c, d-E 12!", "", "ß İx", "one two three four", "\0nul\0 x", "…"]
    cut = WordSlice(texts)
    assert [[cut.word(i) for i in range(cut.first[t], cut.first[t + 1])] for t in range(len(texts))] == [words(t) for t in texts]
    value, row = shingles(cut, 3)
    assert [len(set(value[row == t].tolist())) for t in range(len(texts))] == [len(runs(t)) for t in texts]
    assert WordSlice([]).n == 0 and len(WordSlice([]).hash) == 0


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    for share in (0.9, 0.5):
        k = int(300 * share)
        other = np.concatenate([base[:k], rng.integers(0, 2**63, 300 - k, dtype=np.uint64)])
        true = k / (600 - k)
        s = near.sketch_rows(np.concatenate([base, other]), np.repeat([0, 1], 300), 2, 400)
        assert abs((s[0] == s[1]).mean() - true) < 0.1
    small = near.sketch_rows(base[:3], np.zeros(3, dtype=np.int64), 1, 64)
    assert (small != np.iinfo(np.uint64).max).all()  # every coordinate is filled


@pytest.mark.parametrize(("large", "hot"), [(8192, 1 << 16), (2, 1 << 16), (2, 1)])
def test_near_pairs_against_brute_force(spark, monkeypatch, large, hot):
    """Buckets paired at once, divided by further bands, and hot keys that pass the first step."""
    monkeypatch.setattr(near, "LARGE", large)
    monkeypatch.setattr(near, "HELD", hot)
    monkeypatch.setattr(near, "BLOCK", 4)
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(30, 80))]
        for _ in range(rng.randint(1, 6)):
            t = list(base)
            for _ in range(rng.randint(0, 4)):
                t[rng.randrange(len(t))] = rng.choice(vocabulary)
            texts.append(" ".join(t))
    texts += [texts[0].upper()] * 12 + [None, "", "a b", "a b", "x y z", "X, y; Z", "word " * 50_000]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "x y z", 1)], "id long, text string, rep int")
    found = near.near_duplicates(df, materialise)
    got = [tuple(r) for r in near.expanded(found).collect()]
    sets = [runs(t) for t in texts]
    want = {(j, i) for i in range(len(texts)) for j in range(i) for s in [len(sets[i] & sets[j])] if s and 10 * s >= 6 * (len(sets[i]) + len(sets[j]) - s)}
    assert len(got) == len(set(got)) and set(got) == want
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in want:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    assert {r.id: r.class_id for r in near.classes(found, materialise).collect()} == {x: root(x) for x in list(parent)}


def test_buckets_of_any_size_are_sent_on_whole(monkeypatch):
    pa = __import__("pyarrow")
    monkeypatch.setattr(near, "HELD", 50)
    sizes = {5: 2, 7: 200, 8: 1, 9: 3, 10: 60, 11: 4, 12: 40}
    keys = np.repeat(list(sizes), list(sizes.values())).astype(np.int64)
    ids = np.arange(len(keys), dtype=np.int64)
    bits = np.zeros(len(keys), dtype=np.int64)
    bits[keys == 5] = [0, -1]  # too different to be a pair
    for step in (1, 7, 40, 1000):
        for large, inside in ((3, 3), (45, 3 + 6 + 780)):
            batches = [pa.RecordBatch.from_arrays([pa.array(x[i : i + step]) for x in (keys, ids, bits, bits)], names=["key", "member", "s0", "s1"]) for i in range(0, len(keys), step)]
            pairs, sent = set(), defaultdict(dict)
            for out in near._bucket_pairs(near.least_bits((6, 10)), large)(iter(batches)):
                for k, a, b in zip(*(out.column(c).to_pylist() for c in range(3))):
                    if k is None:
                        pairs.add((a, b))
                    else:
                        sent[k][a] = b
            assert len(pairs) == inside
            assert {k: len(v) for k, v in sent.items()} == {k: n for k, n in sizes.items() if n > large}
            assert all(sorted(v.values()) == list(range(len(v))) for v in sent.values())


def test_near_pairs_of_empty_table(spark):
    found = near.near_duplicates(spark.createDataFrame([], "id long, text string"), materialise)
    assert near.expanded(found).count() == 0 and near.classes(found, materialise).count() == 0


def test_long_chain_is_one_class(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(120)], "a long, b long")
    members = spark.range(121).select("id", F.col("id").alias("rep"))
    assert {r.class_id for r in near.classes(near.NearDuplicates(members, links), materialise).collect()} == {0}

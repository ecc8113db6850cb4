"""Problems 5 and 7: packing and mixing."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing, packing
from millrace.session import materialise


def check_packing(rows, placed, capacity):
    pieces = defaultdict(list)
    filled = defaultdict(list)
    for r in placed:
        pieces[r.id].append((r.piece, r.length))
        filled[r.sequence].append((r.offset, r.length))
    for i, n in rows:
        own = sorted(pieces[i])
        assert [p for p, _ in own] == list(range(len(own))) and sum(x for _, x in own) == n
        assert len(own) == max(1, -(-n // capacity))
    for spans in filled.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(filled) == list(range(len(filled)))
    return len(filled)


@pytest.mark.parametrize("group", [50_000, 300])
def test_packing_is_tight_and_whole(spark, group):
    rng = random.Random(1)
    rows = [(i, int(rng.paretovariate(1.2) * 60)) for i in range(1500)] + [(9000, 1000), (9001, 2500), (9002, 0), (9003, 3000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "id long, n int, grp string")
    n = check_packing(rows, packing.pack(df, 1000, materialise, group_pieces=group).collect(), 1000)
    least = -(-sum(x for _, x in rows) // 1000)
    assert n <= least * 1.02 + len(rows) // group + 1


def test_packing_edge_cases(spark):
    assert packing.pack(spark.createDataFrame([], "id long, n int"), 10, materialise).count() == 0
    rows = [(1, 0), (2, 0), (3, 10), (4, 20)]
    assert check_packing(rows, packing.pack(spark.createDataFrame(rows, "id long, n int"), 10, materialise).collect(), 10) == 4
    got = packing.pack(spark.createDataFrame([(1, None), (None, 5), (2, 3)], "id long, n int"), 10, materialise).collect()
    assert sorted((r.id, r.length) for r in got) == [(1, 0), (2, 3)]


def test_lowest_cost_with_room_is_chosen():
    place, n = packing.pack_sizes([6, 5, 4, 3, 2], 10, 1.0, 0.0, 2)
    assert (place, n) == ([0, 1, 1, 0, 2], 3)  # 4 goes to the cheaper sequence, 2 finds no room
    assert packing.pack_sizes([], 10, 1.0, 0.0, 1) == ([], 1)


def test_costs_are_balanced():
    """The spread of costs stays below that of filling one sequence after the other, at about as many sequences."""
    rng = random.Random(4)
    sizes = sorted((rng.randint(20, 480) for _ in range(4000)), reverse=True)
    cost = lambda place: [sum(x + x * x * packing.QUADRATIC for x in own) for own in _by_sequence(sizes, place)]
    spread = lambda c: (sum((x - sum(c) / len(c)) ** 2 for x in c) / len(c)) ** 0.5 / (sum(c) / len(c))
    least = -(-sum(sizes) // 1000)
    balanced, n = packing.pack_sizes(sizes, 1000, 1.0, packing.QUADRATIC, least)
    greedy, m = packing.pack_sizes(sizes, 1000, 1.0, packing.QUADRATIC, 0)
    assert n <= least * 1.01 and spread(cost(balanced)) < spread(cost(greedy)) and spread(cost(balanced)) < 0.12


def _by_sequence(sizes, place):
    out = defaultdict(list)
    for x, p in zip(sizes, place):
        out[p].append(x)
    return list(out.values())


def test_very_many_repeats_are_not_written(spark):
    """Allowing a thousand million repeats costs nothing where the budget needs a few."""
    docs = [(i, "ab"[i % 2], 10) for i in range(400)]
    chosen, shares = _mix(spark, docs, [("a", 0.25, 1_000_000_000), ("b", 0.75, 1_000_000_000)], budget=8000)
    assert shares["a"].tokens == pytest.approx(2000, abs=10) and shares["b"].tokens == pytest.approx(6000, abs=10)
    assert max(r["repeats"] for r in chosen) == 3


def _mix(spark, docs, targets, **more):
    d = spark.createDataFrame(docs, "id long, source string, tokens long")
    t = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    out = mixing.mix_sources(d, t, materialise, **more)
    return [r.asDict() for r in out.chosen.collect()], {r.source: r for r in out.shares.collect()}


def test_shares_reach_their_targets(spark):
    rng = random.Random(6)
    docs = [(i, "Big " if i % 2 else "big", rng.randint(5, 50)) for i in range(3000)] + [(5000 + i, "small", rng.randint(5, 50)) for i in range(150)] + [(9000, None, 10), (9001, "other", 10), (9002, "big", 0), (None, "big", 5)]
    targets = [("big", 0.6, 1), (" SMALL", 0.3, 3), ("absent", 0.1, 4), ("zero", 0.0, 2)]
    chosen, shares = _mix(spark, docs, targets)
    assert max(r["repeats"] for r in chosen) <= 3 and all(r["repeats"] == 1 for r in chosen if r["source"] == "big")
    assert shares["big"].share == pytest.approx(2 / 3, abs=0.01) and shares["small"].share == pytest.approx(1 / 3, abs=0.01)
    assert shares["absent"].tokens == 0 and shares["zero"].tokens == 0
    small = [t for _, s, t in docs if s == "small"]
    assert shares["small"].tokens >= 3 * sum(small) * 0.97  # the scarce source is used up
    for s in ("big", "small"):
        assert sum(r["tokens"] * r["repeats"] for r in chosen if r["source"] == s) == shares[s].tokens


def test_budget_cuts_in_fair_order(spark):
    docs = [(i, "ab"[i % 2], 10) for i in range(1000)]
    chosen, shares = _mix(spark, docs, [("a", 0.25, 2), ("b", 0.75, 2)], budget=2000)
    assert sum(r["tokens"] * r["repeats"] for r in chosen) in (1990, 2000)
    assert shares["a"].tokens == pytest.approx(500, abs=10)
    _, beyond = _mix(spark, docs, [("a", 0.25, 1), ("b", 0.75, 1)], budget=100_000)
    assert beyond["a"].tokens == 5000 and beyond["b"].tokens == 5000


def test_mix_of_empty_tables(spark):
    chosen, shares = _mix(spark, [], [("a", 1.0, 1)])
    assert chosen == [] and shares["a"].tokens == 0
    chosen, shares = _mix(spark, [(1, "a", 5)], [])
    assert chosen == [] and shares == {}


def test_token_counts_of_a_public_vocabulary(spark):
    df = spark.createDataFrame([(1, "s", "hello world"), (2, "s", None), (3, "s", ""), (4, "s", "<|endoftext|>"), (5, "s", "x " * 30_000)], "id long, source string, text string")
    got = {r.id: r.tokens for r in mixing.token_counts(df, f"{mixing.TOKENIZERS}/byte_bpe_50k.tiktoken").collect()}
    assert got[1] == 2 and got[2] == got[3] == 0 and got[4] > 1 and got[5] >= 30_000
    assert df.where(F.col("id") < 0).transform(lambda d: mixing.token_counts(d, f"{mixing.TOKENIZERS}/byte_bpe_50k.tiktoken")).count() == 0

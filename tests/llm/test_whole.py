"""Problems 3, 4 and 6 do the whole job: rows that an earlier cut left out."""

import random

import numpy as np
import pyarrow as pa

from millrace.llm import defects, near
from millrace.session import materialise

Q = "Which word is printed on the red kite near the gate?"


def flagged(spark, answers):
    rows = [("t", i, "f", 0, Q, a) for i, a in enumerate(answers)]
    df = spark.createDataFrame(rows, "src_table string, row_id long, field string, turn int, question string, answer string")
    return {answers[r.row_id]: r.defect for r in defects.broken_pairs(df, materialise).collect()}


def shown(texts, cuts):
    """Pieces found with the sorted texts in partitions that end at ``cuts``."""
    texts, found, asks, most = sorted(set(texts)), set(), [], {}
    for a, b in zip([0, *cuts], [*cuts, len(texts)]):
        parts = [texts[i : min(b, i + 3)] for i in range(a, b, 3)]
        batches = [pa.RecordBatch.from_pydict({"text": x, "ask": [True] * len(x)}) for x in parts]
        for r in (r for x in defects._neighbours(iter(batches)) for r in x.to_pylist()):
            if r["kind"] == "cut":
                found.add(r["text"])
            elif r["kind"] == "ask":
                asks.append(r)
            else:
                most[r["start"]] = max(most.get(r["start"], 0), r["chars"])
    return found | {r["text"] for r in asks if most.get(r["start"], 0) >= r["chars"]}


def test_pieces_meet_all_that_share_their_start():
    rng = random.Random(5)
    for _ in range(300):
        opening = rng.choice(["", defects._OPENING])
        full = [opening + "The " + "".join(rng.choice("ab ") for _ in range(rng.randint(5, rng.choice([230, 900])))) for _ in range(3)]
        texts = sorted({t[: rng.randint(3, len(t))] for t in full for _ in range(8)} | set(full[: rng.randint(0, 3)]) | {"Zoo one two"})
        expected = {t for t in texts for start, least, _ in defects._asks(t) if any(o[:start] == t[:start] and len(o) >= least for o in texts)}
        for n in range(4):
            assert shown(texts, sorted(rng.sample(range(len(texts)), min(n, len(texts))))) == expected


def test_answer_cut_at_every_character(spark):
    full = "The label on the red kite near the gate reads Nofesi."
    pieces = [full[:n] for n in range(16, 30)]
    got = flagged(spark, [full, *pieces])
    assert {p for p in pieces if defects.cut_state(p) == "open"} <= set(got) and set(got.values()) == {"truncated"}


def test_earliest_round_wins_after_round_256():
    bins, value = 192, np.array([11, 22, 33], dtype=np.uint64)
    first = np.full(bins, -1)
    for i in range(2 * bins):
        h = near.mix(value + np.uint64((i + 1) * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF))
        place = ((h >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(int) if i < bins else np.array([i - bins])
        first[place] = np.where(first[place] < 0, i, first[place])
    got = near.sketch_rows(value, np.zeros(3, dtype=np.int64), 1, bins)[0]
    assert max(first) > 256 and np.argsort(got)[-1] == np.argmax(first) and (np.sort(first) == first[np.argsort(got)]).all()


def test_pairs_of_the_least_similarity_are_candidates():
    rng, n = np.random.default_rng(3), 4000  # pairs with 45 of 75 elements in common
    common, own = rng.integers(0, 1 << 63, (n, 1, 45), dtype=np.uint64), rng.integers(0, 1 << 63, (n, 2, 15), dtype=np.uint64)
    value = np.concatenate([np.repeat(common, 2, axis=1), own], axis=2).reshape(-1)
    sketches = near.sketch_rows(value, np.repeat(np.arange(2 * n), 60), 2 * n, near.BINS)
    keys, bits = near.band_keys(sketches, near.BANDS, near.ROWS), near.sketch_bits(sketches)
    found = (keys[::2] == keys[1::2]).any(axis=1) & (near._agree(bits[::2], bits[1::2]) >= near.least_bits((6, 10)))
    assert (~found).mean() < 0.002


def test_most_truncations_are_shown_by_neighbours(spark):
    """Whole answers of one kind teach nothing by rule here: the end rule alone would not tell which evidence there is."""
    rng = random.Random(1)
    colours, things = ["red", "blue", "old", "tiny", "glossy"], ["kite", "lamp", "tram", "vase", "goat"]
    sentence = lambda: f"The {rng.choice(colours)} {rng.choice(things)} stands near the {rng.choice(things)} and hides a {rng.choice(colours)} {rng.choice(things)}."
    answers = [" ".join(sentence() for _ in range(3)) for _ in range(120)]
    cut = [a[: rng.randint(len(a) * 3 // 4, len(a) - 8)] for a in answers[:40]]
    cut = [a for a in cut if defects.cut_state(a) == "cut"]
    rows = [("t", i, "f", 0, Q, a) for i, a in enumerate(answers + cut + ['{"a": "x", "b'])]
    df = spark.createDataFrame(rows, "src_table string, row_id long, field string, turn int, question string, answer string")
    got = {r.row_id: (r.defect, r.evidence) for r in defects.broken_pairs(df, materialise).collect()}
    assert set(got) == set(range(120, len(rows))) and got[len(rows) - 1] == ("truncated", "end")
    assert sum(e == "neighbour" for _, e in got.values()) >= 0.9 * len(cut)


def test_refusals_of_any_length(spark):
    short = ["No comment.", "Kein Kommentar.", "Sin comentarios.", "Aucun commentaire."]
    long = " ".join(["I'm sorry, but I can't describe this image. Thank you for understanding."] * 12)
    answering = long + " The label on the red kite near the gate reads Nofesi."
    assert flagged(spark, [*short, long, answering]) == dict.fromkeys([*short, long], "refusal")


def shuffled(spark, after=-1):
    """Bytes that the stages after number ``after`` wrote to shuffles, and the last number."""
    context = spark.sparkContext._jsc.sc()
    context.listenerBus().waitUntilEmpty()
    jvm = spark.sparkContext._jvm
    stages = context.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    stages = [stages.apply(i) for i in range(stages.size())]
    return sum(x.shuffleWriteBytes() for x in stages if x.stageId() > after), max([after, *(x.stageId() for x in stages)])


def test_texts_without_candidate_are_not_moved(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(f"{rng.getrandbits(48):x}" for _ in range(1500))) for i in range(200)]
    rows += [(1000 + i, rows[i][1].replace(" a", " b")) for i in range(2)] + [(2000, rows[7][1])]
    df = materialise(spark.createDataFrame(rows, "id long, text string").repartition(4))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where the candidates are too many
    try:
        before = shuffled(spark)[1]
        found = near.near_duplicates(df, materialise)
        moved = shuffled(spark, before)[0]
        assert {(r.rec_a, r.rec_b) for r in near.expanded(found).collect()} == {(0, 1000), (1, 1001), (7, 2000)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert 0 < moved < 0.25 * sum(len(t) for _, t in rows)

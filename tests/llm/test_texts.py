"""Problems 4, 6 and 8 on small tables with known cases."""

import random

import numpy as np
import pytest

from millrace.llm import defects, leakage, residue
from millrace.llm.kernels import WordSlice
from millrace.session import materialise

Q = "Which word is printed on the red kite near the gate?"
A = "The label on the red kite near the gate reads 'Nofesi'. A nurse dropped the old lamp beside the window."


@pytest.mark.parametrize(
    "text,expected",
    [
        ("I'm sorry, but I can't describe this image.", True),
        ("SORRY , I  CANNOT discuss what you sent. Thank you for understanding.", True),
        ("As an AI model, I'd rather not answer that question, as it may be sensitive.", True),
        ("Leider kann ich zu diesem Bild nichts sagen. Danke für dein Verständnis.", True),
        ("Je ne suis pas en mesure de décrire cette image, car mes règles l'interdisent.", True),
        ("Lo siento, pero no puedo ayudar con esta solicitud. Prueba con otra imagen, por favor.", True),
        ("No comment on this one, my rules forbid it.", True),
        ("I can't read the smallest line, but the large word on the kite is 'Tapo'.", False),
        ("The notice says 'Sorry, we cannot open before 57', and a lantern hangs above.", False),
        ("The painter refused to sell the goat and cleaned a basket.", False),
        ("As a model of a goat, the vase is not able to stand alone, so a porter dropped a sled.", False),
        ("I cannot describe the lamp, but the kite on the left is red and old.", False),
        ("Unfortunately for the cyclist, the sled supports a kite.", False),
        ("No", False),
        ("", False),
    ],
)
def test_refusals(text, expected):
    assert defects.is_refusal(text) is expected


@pytest.mark.parametrize(
    "answer,expected",
    [(Q, True), (Q.upper().rstrip("?"), True), ("You ask: " + Q, True), ("which  word is printed \n on the red kite near the gate", True), ("To your question, " + Q + " " + A, False), (A, False), ("the red kite", False), ("", False)],
)
def test_copies(answer, expected):
    assert defects.is_copy(Q + "\nAnswer briefly.", answer) is expected


@pytest.mark.parametrize(
    "text,state",
    [
        (A, "whole"), (A[:-20], "cut"), (A[:-20] + "…", "cut"), (A[:-20] + "...", "cut"), (A + ")", "whole"), ("a red kite", "whole"), ("B. a copper shelf", "whole"), ("1. a kite\n2. a lamp", "whole"),
        ("object: a kite\ncount: 3", "whole"), ('{"a": "b", "c": 1}', "whole"), ('{"a": "b", "c', "cut"), ("The label on the red", "open"), ("Yes", "whole"), ("", "whole"), ("Behind the red kite there is a lamp that hides the", "cut"),
    ],
)
def test_cut_state(text, state):
    assert defects.cut_state(text) == state


def test_broken_pairs(spark):
    german = "Auf dem Schild an der Rampe steht das Wort 'Fono', daneben eine Lampe aus Holz und ein Fass mit Rand."
    pad = [("t", 1000 + i, "f", 0, Q, A.replace("red", c)) for i, c in enumerate(["red", "blue", "old", "tiny"] * 10)]
    pad += [("t", 2000 + i, "f", 0, "Welches Wort steht an der Rampe auf dem Schild, wo ein Fass eine Lampe berührt?", german) for i in range(30)]
    rows = pad + [
        ("t", 1, "f", 0, Q, None), ("t", 2, "f", 0, Q, " … "), ("t", 3, "f", 0, Q, Q), ("t", 4, "f", 0, Q, "I won't describe this image."), ("t", 5, "f", 0, Q, german), ("t", 6, "f", 0, Q + " Please answer in German.", german),
        ("t", 7, "f", 0, Q, A[:-15]), ("t", 8, "f", 0, Q, "The label on the red"), ("t", 9, "f", 0, None, A), ("t", 10, "f", 0, Q, "No"), ("t", 11, "f", 0, Q, A * 2000), ("t", 11, "f", 0, Q, A * 2000), ("t", 12, "f", 0, Q, "on the red kite"),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "src_table string, row_id long, field string, turn int, question string, answer string, text string")
    got = {r.row_id: r.defect for r in defects.broken_pairs(df, materialise).collect()}
    assert got == {1: "empty", 2: "empty", 3: "copy", 4: "refusal", 5: "other_language", 7: "truncated", 8: "truncated"}
    assert defects.broken_pairs(df.limit(0), materialise).count() == 0


def test_refusals_in_unseen_wordings():
    """The model is taught without a wording and must find it: nine of ten, and no other answer."""
    known = [
        "I'm sorry, but I can't help with this image.", "I cannot answer this question.", "I'd rather not describe this picture.", "I am unable to comment on this request.", "I won't discuss that question, sorry.", "Sorry, I can't say anything about this picture.",
        "I must decline to answer this request.", "I am not allowed to describe this image.", "I don't want to comment on that image.", "I'm not able to help with that request.",
    ]
    unseen = ["I'd rather skip this request.", "I must respectfully pass on this question.", "I won't be answering that question.", "Sorry, but I can't go there.", "I'm afraid this is not for me to describe.", "I am sorry, this request is not one I can take."]
    rng = random.Random(2)
    thing = lambda: f"{rng.choice(['red', 'old', 'tiny'])} {rng.choice(['kite', 'lamp', 'tram', 'vase'])}"
    clean = [f"The {thing()} stands near the {thing()} and hides a {thing()}." for _ in range(400)] + [f"I count {i} marks on the {thing()}." for i in range(200)]
    taught = np.zeros((1 << defects.FEATURE_BITS) + 1, dtype=np.int64)
    whole = taught.copy()
    for texts, into in ((known, (taught, whole)), (clean + unseen, (whole,))):
        cut = WordSlice(texts)
        for x in into:
            x[:-1] += np.bincount(defects.features(cut.hash, cut.first)[0], minlength=1 << defects.FEATURE_BITS)
            x[-1] += len(texts)
    model = defects.refusal_model(whole, taught)
    score = lambda texts: model.score(*defects.features(WordSlice(texts).hash, WordSlice(texts).first), len(texts))[:, 0]
    assert (score(unseen) >= defects.REFUSAL_ODDS).mean() >= 0.8
    assert not (score(clean) >= defects.REFUSAL_ODDS).any()


def words(s):
    return [w for w in "".join(c if c.isalnum() else " " for c in (s or "").lower()).split()]


def test_leaks_against_brute_force(spark):
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(400)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randint(20, 60)), "ans") for i in range(20)] + [(90, "too short here", "x"), (91, None, None)]
    docs = []
    for i in range(120):
        body = text(rng.randint(0, 80)).split()
        if i % 3 == 0:
            it = rng.choice(items[:20])[1].split()
            n = rng.randint(10, 16)
            at = rng.randrange(max(1, len(it) - n))
            body[len(body) // 2 : len(body) // 2] = [w.upper() + "," for w in it[at : at + n]]
        docs.append((i, " ".join(body), 1))
    docs += [(500, None, 1), (501, "", 1), (502, docs[0][1], 1), (503, "v1 " * 60_000 + items[0][1], 1), (None, items[0][1], 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id int")
    e = spark.createDataFrame(items, "item_id long, text string, answer string")
    grams = lambda s: {tuple(w[i : i + 12]) for w in [words(s)] for i in range(len(w) - 11)}
    want = {(a, b) for a, t, _ in docs if a is not None for b, u, _ in items if grams(t) & grams(u)}
    got = [(r.doc_id, r.item_id) for r in leakage.leaked_items(d, e, materialise).collect()]
    assert len(got) == len(set(got)) and set(got) <= want
    assert len(got) >= 0.98 * len(want)
    assert leakage.leaked_items(d.limit(0), e, materialise).count() == 0
    assert leakage.leaked_items(d, e.limit(0), materialise).count() == 0


def test_paraphrase_is_found_by_subsequence(spark):
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(500)]
    item = [rng.choice(vocabulary) for _ in range(80)]
    near = [w if i % 9 else "changed" for i, w in enumerate(item)]
    docs = [(1, " ".join(near) + " the answer is blue"), (2, " ".join(rng.choice(vocabulary) for _ in range(80)))] + [(i, " ".join(rng.choice(vocabulary) for _ in range(60))) for i in range(3, 60)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    e = spark.createDataFrame([(7, " ".join(item), "blue")], "item_id long, text string, answer string")
    assert [tuple(r) for r in leakage.leaked_items(d, e, materialise, paraphrases=True).collect()] == [(1, 7, "paraphrase")]


def test_common_subsequence():
    a, b = [1, 2, 3, 4, 5], [9, 2, 4, 4, 5, 1]
    common = lambda a, b: leakage.common_subsequence(leakage._places(np.array(a, dtype=np.int64)), len(a), b)
    assert common(a, b) == 3 and common([], b) == 0 and common(a, []) == 0
    rng = random.Random(6)
    for _ in range(50):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(90))] for _ in range(2))
        table = [0] * (len(b) + 1)
        for x in a:
            before = 0
            for j, y in enumerate(b, 1):
                before, table[j] = table[j], before + 1 if x == y else max(table[j], table[j - 1])
        assert common(a, b) == table[-1]


def test_index_against_brute_force():
    rng = np.random.default_rng(2)
    matrix = rng.standard_normal((1 << leakage.FEATURE_BITS, 32)).astype(np.float32)
    texts = [" ".join(f"v{x}" for x in rng.integers(0, 300, 70)) for _ in range(120)]
    index = leakage.ItemIndex(list(range(120)), texts, [""] * 120, matrix)
    docs = WordSlice([t + " " + " ".join(f"v{x}" for x in rng.integers(0, 300, 40)) for t in texts[:60]] + ["v1 v2"])
    latent = leakage.document_latent(docs, matrix)
    text, begin, length = leakage.document_passages(docs)
    for t, b, n, v in zip(text, begin, length, latent):  # blocks add up to passages
        assert np.allclose(v, leakage.unit(matrix[leakage.features(docs)[b : b + n]].sum(axis=0)[None])[0], atol=1e-4)
    exact = set(zip(*(x.tolist() for x in index.search(latent, probes=10**6)[:2])))
    brute = {(int(p), int(i)) for vectors, item, first in index.lists for p, q in zip(*np.nonzero(np.maximum.reduceat(latent @ vectors, first, axis=1) >= leakage.COSINE)) for i in [item[q]]}
    assert exact == brute
    strong = {(p, i) for p, i, c in zip(*(x.tolist() for x in index.search(latent, probes=10**6))) if c >= 0.6}
    found = set(zip(*(x.tolist() for x in index.search(latent)[:2])))
    assert found <= brute and len(found & strong) >= 0.9 * len(strong)


def test_paraphrases_are_recalled(spark):
    """Items with every tenth word changed and words inserted, amid other text: at least nine of ten are found."""
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(900)]
    items = [[rng.choice(vocabulary) for _ in range(rng.randint(14, 90))] for _ in range(40)]
    docs = []
    for i, item in enumerate(items):
        near = [w if (k + i) % 10 else "changed" for k, w in enumerate(item)]
        near.insert(len(near) // 2, "inserted")
        around = [[rng.choice(vocabulary) for _ in range(20 * (i % 2))] for _ in range(2)]
        docs.append((i, " ".join(around[0] + near + around[1])))
    docs += [(100 + i, " ".join(rng.choice(vocabulary) for _ in range(80))) for i in range(100)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    e = spark.createDataFrame([(i, " ".join(x), "") for i, x in enumerate(items)], "item_id long, text string, answer string")
    got = {(r.doc_id, r.item_id) for r in leakage.leaked_items(d, e, materialise, paraphrases=True).collect()}
    assert got <= {(i, i) for i in range(40)} and len(got) >= 36


def test_residue(spark):
    scene = ["The old kite hides a lamp near the gate.", "A nurse cleaned the red barrel beside the window.", "Behind the tram there is a goat that faces a kite."]
    rng = random.Random(3)
    clean = [" ".join(rng.sample(scene, 2)) for _ in range(200)]
    mention = [
        "A poster is covered with lorem ipsum in small print.", "The syntax ${name} stands for an environment value.", "Write the prompt as `{{question}}` in the config.", "The screen shows a page with the number 404.",
        "Pages that say JavaScript is required were removed.", "<image> [00:36] The kite.", '{"object": "a kite", "count": 3}',
    ]
    cases = [
        ("This picture shows {{ title }} near the gate.", "placeholder"), ("Dear <your name>, the kite is red.", "placeholder"), ("[INSERT caption] hides a lamp.", "placeholder"),
        ("Lorem ipsum dolor sit amet.", "filler"), ("bla bla bla bla.", "filler"), ("Replace this paragraph with the real description.", "filler"), ("Das ist nur ein Blindtext.", "filler"),
        ("404 Not Found\nTry again.", "error_page"), ("Erreur 404 : page introuvable", "error_page"), ("Zugriff verweigert", "error_page"),
        ("Please enable JavaScript.", "script_notice"), ("<noscript>This viewer requires scripting support.</noscript>", "script_notice"), ("Bitte aktivieren Sie Skripte.", "script_notice"),
    ]
    texts = clean + mention + [scene[0] + "\n" + t for t, _ in cases] + [None, "", "…"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "404 Not Found", "x")], "doc_id long, text string, kind string")
    got = {r.doc_id: r.kind for r in residue.residue(df, materialise).collect()}
    first = len(clean) + len(mention)
    assert got == {first + i: k for i, (_, k) in enumerate(cases)}
    assert residue.residue(df.limit(0), materialise).count() == 0

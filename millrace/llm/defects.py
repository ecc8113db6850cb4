"""Problem 4: broken prompt and response pairs.

The sentences of all responses are sorted and compared with all that share
their start: a response whose last, unfinished sentence is the start of a
longer one, or shares much of it, is a shortened version. Lengths at which
unfinished responses pile up are taken as length limits. What neither shows
(and objects that do not close) is decided by how the response ends. Rules for
copies, refusals and languages go before, as an answer has one defect at most;
refusals in words that no rule has are found by a model that the others teach.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.kernels import WordSlice, signed, slices
from millrace.llm.outward import fields_of
from millrace.llm.residue import FEATURE_BITS, Model, features
from millrace.operators.skew import salted_join
from millrace.session import release, scan_slices

LANGUAGES = ("en", "de", "fr", "es")

# Common function words, the names of the four languages, and
# wordings of refusals and of the courtesies around them.
FUNCTION_WORDS = {
    "en": "the of and is are with that this to in on it what which who how does near where while an at by from between".split(),
    "de": "der die das und ist ein eine einen im am auf mit wie was wer welche welches nicht zu von dem den neben über unter".split(),
    "fr": "le la les des un une et est dans sur avec qui quel quelle combien où du au pour pas près derrière sous".split(),
    "es": "el la los las una y en es con de que qué cuántos dónde por para se del al junto detrás bajo".split(),
}
LANGUAGE_NAMES = {
    "en": r"english|englisch\w*|anglais|inglés|ingles",
    "de": r"german|deutsch\w*|allemand|alemán|aleman",
    "fr": r"french|französisch\w*|franzoesisch\w*|français|francais|francés|frances",
    "es": r"spanish|spanisch\w*|espagnol|español|espanol|castellano",
}
_SPEAK = r"(?:answer|assist|help|describe|comment|discuss|say|open|respond|reply|talk|tell|provide|comply|engage|share|give|process|fulfil|fulfill|view|see|identify|analy[sz]e|continue|address|speak|do|complete)"
_SAGEN = r"(?:beantworten|antworten|beschreiben|helfen|weiterhelfen|sagen|kommentieren|äußern|äussern|öffnen|geben|machen|besprechen|eingehen|nachkommen|bearbeiten|annehmen|mitteilen|erfüllen)"
_DIRE = r"(?:répondre|décrire|commenter|aider|dire|ouvrir|parler|discuter|donner|faire|traiter|aborder|fournir|satisfaire|voir)"
_DECIR = r"(?:responder|contestar|describir|comentar|ayudar|decir|abrir|hablar|dar|hacer|tratar|atender|facilitar|ver|cumplir)"
REFUSALS = [
    # English
    rf"\bi (?:really |simply |just )?(?:can t|cannot|can not|could not|couldn t|won t|will not|am unable to|m unable to|am not able to|m not able to|must decline to|have to decline to|decline to|refuse to|d rather not|would rather not|d prefer not to|prefer not to|am not allowed to|m not allowed to|am not permitted to|do not want to|don t want to) (?:\w+ ){{0,2}}?{_SPEAK}\b",
    rf"^ ?(?:sorry |unfortunately |regrettably )?(?:but )?(?:unable to|cannot|can t|can not|not able to) {_SPEAK}\b",
    r"\bit would (?:be inappropriate|not be appropriate|be wrong) for me\b",
    r"\bnot (?:something|a topic|a subject) (?:that )?i (?:can|may|am able to|am allowed to)\b",
    r"\b(?:get|gets|receive|receives) no (?:answer|reply|response) from me\b",
    r"^ ?no comment\b",
    r"\bmy (?:rules|guidelines|policies|policy|instructions) (?:forbid|forbids|prohibit|prohibits|prevent|prevents|do not allow|don t allow|does not allow)\b",
    r"\b(?:outside|beyond) (?:of )?what i (?:am|m|can|may)\b",
    r"\b(?:against|violates?) my (?:rules|guidelines|policies|policy)\b",
    r"\bnothing i can (?:tell|say|do|offer)\b",
    r"\bi have no access to\b",
    r"\bi (?:do not|don t) (?:answer|discuss|comment on|respond to|take) (?:such|this|these|that|questions|requests)\b",
    # German
    rf"\bich\b(?: \w+){{0,8}} (?:nicht|nichts|keine\w*)\b(?: \w+){{0,4}} {_SAGEN}\b",
    rf"\bich\b(?: \w+){{0,8}} (?:nicht|nichts|keine\w*) {_SAGEN}\b",
    r"\b(?:nehme|beantworte|kommentiere|bearbeite) ich nicht\b",
    r"\b(?:äußere|äussere) ich mich nicht\b",
    r"\bich (?:äußere|äussere) mich\b.* nicht\b",
    r"\blehne ich\b.* ab\b",
    r"\bich lehne\b.* ab\b",
    r"\b(?:ist|bleibt) mir (?:leider )?(?:nicht|untersagt|verboten)\b",
    r"\b(?:dazu|hierzu|darüber) (?:sage|darf|kann|möchte|werde|gebe) ich\b.*(?:nicht|nichts|keine)\b",
    r"\bkein kommentar\b",
    r"\bmeine (?:regeln|richtlinien) (?:verbieten|untersagen|erlauben)\b",
    # French
    rf"\bje ne (?:peux|puis|veux|souhaite|dois|saurais|pourrai|vais) (?:pas )?(?:\w+ ){{0,2}}?{_DIRE}\b",
    r"\bje ne suis pas (?:en mesure|autorisée?|habilitée?)\b",
    r"\bil m est (?:impossible|interdit)\b",
    r"\bje préfère (?:m abstenir|ne pas|ne rien)\b",
    r"\bje (?:refuse|m abstiens|décline)\b",
    r"\bne peut pas être (?:abordé|traité|discuté|commenté)e?\b",
    r"\bmes (?:règles|consignes) (?:l interdisent|me l interdisent|l empêchent)\b",
    r"\baucun commentaire\b",
    r"\bje n ai pas accès\b",
    r"\bje ne (?:réponds|commente|parle|traite) pas\b",
    # Spanish
    rf"\bno (?:puedo|debo|quiero|voy a|deseo|podría) (?:\w+ ){{0,2}}?{_DECIR}\b",
    r"\bno me es posible\b",
    r"\bno (?:estoy en condiciones|estoy autorizad[oa]|me está permitido|se me permite)\b",
    r"\bprefiero (?:no|abstenerme)\b",
    r"\bme (?:niego|abstengo)\b",
    r"\bmis (?:normas|reglas|directrices) (?:lo |me lo )?(?:impiden|prohíben|prohiben)\b",
    r"\bsin comentarios\b",
    r"\bno (?:respondo|contesto|comento|atiendo|tengo acceso)\b",
]
COURTESIES = [
    r"\bthank(?:s| you) for\b",
    r"\b(?:something|anything) else\b",
    r"\bplease (?:try|ask|choose|send)\b",
    r"\bi (?:am|m) sorry\b",
    r"^ ?(?:i )?apologi[sz]e\b",
    r"\bmy apologies\b",
    r"\bdanke (?:für|dir|ihnen)\b",
    r"\bbitte (?:versuche|versuchen|frage|stelle|wähle)\b",
    r"\btut mir leid\b",
    r"\bmerci (?:d|de|pour)\b",
    r"\bveuillez\b",
    r"\bdésolée?\b",
    r"\b(?:prueba|pruebe|intenta|intente) con\b",
    r"\bgracias por\b",
    r"\blo siento\b",
    r"\b(?:algo más|otra cosa|autre chose|sonst noch)\b",
]
#: Every refusal has one of these words; answers without any are not searched.
REFUSAL_HINTS = (
    "i me my comment unable able cannot can "
    "ich mir meine kommentar "
    "je moi mes m impossible commentaire abordé traité discuté commenté abordée traitée discutée commentée "
    "no me prefiero mis comentarios puedo debo quiero voy deseo podría posible estoy niego abstengo respondo contesto comento atiendo"
).split()
_REFUSE = re.compile("|".join(f"(?:{p})" for p in REFUSALS))
_COURTESY = re.compile("|".join(f"(?:{p})" for p in COURTESIES))
_TURN = re.compile(r" (?:but|however|still|aber|jedoch|doch|mais|cependant|pero|sin embargo)(?= )")
_REQUEST = {k: re.compile(rf"(?<!\w)(?:{v})(?!\w)", re.IGNORECASE) for k, v in LANGUAGE_NAMES.items()}

_TAG = re.compile(r"<\s*/?\s*(?:image|video|audio)\s*>", re.IGNORECASE)
_WORD = re.compile(r"[^\W_]+")
_CLOSERS = " \t\r\n\f\v\"'`´“”‘’«»„‚)]*_,;:  　​"
_ENDS = ".!?。！？"
_ITEM = re.compile(r"^\s*(?:\(?\d{1,3}[.)]|[-*•–])\s")
#: Where a response is divided into sentences (the same in Java).
_SENTENCE = r"(?<=[.!?。！？])[\"'”’»)*\]]*[ \t\r]+|\n+"
_CHOICE = re.compile(r"^\s*[\"'(*]*\w{1,2}[.)]\s+")
#: Words up to which an unfinished single sentence may also be a mere phrase.
PHRASE_WORDS = 7


def folded_words(text: str) -> str:
    return " ".join(_WORD.findall(text.lower()))


def is_refusal(text: str) -> bool:
    """True if some sentence declines and no sentence says anything else."""
    refused = False
    for sentence in re.split(r"[.!?。！？…]+", text):
        s = f" {folded_words(sentence)} "
        n = s.count(" ") - 1
        if n < 2:
            continue
        m = _REFUSE.search(s)
        if m:
            turn = _TURN.search(s, m.end() - 1)
            if turn and s[turn.end() :].count(" ") > 4 and not _REFUSE.search(s[turn.end() :]) and not _COURTESY.search(s[turn.end() :]):
                return False
            refused = True
        elif n > 3 and not _COURTESY.search(s):
            return False
    return refused


#: Least log odds and number of words at which an answer in a wording that no
#: pattern has is taken as a refusal.
REFUSAL_ODDS, REFUSAL_LEAST = 5.0, 3
#: Features in a smaller share of answers that no known refusal has say nothing:
#: they may be the words of a refusal that is not known.
REFUSAL_RARE = 0.002
# Marks of rows that carry counts of features: of all answers, and of those that patterns show to be refusals.
_WHOLE, _TAUGHT = "#whole", "#taught"


def is_copy(question: str, answer: str) -> bool:
    """The question again: whole, or from its start to a sentence or line end.

    Up to eight words may lead in and two may follow; single words may differ.
    """
    a = _WORD.findall(answer.lower())
    cores, so_far = [], []
    for part in re.split(r"(?<=[.!?。:])\s+|\n", question):
        words = _WORD.findall(part.lower())
        if words:
            so_far = so_far + words
            cores.append(so_far)
            if len(words) >= 5:
                cores.append(words)
    for core in cores:
        n = len(core)
        if n < 4 or not n - 2 <= len(a) <= n + 10:
            continue
        for lead in range(max(0, len(a) - n - 2), min(8, max(0, len(a) - n)) + 1):
            if a[lead : lead + n] == core:
                return True
        if _near_sequence(core, a):
            return True
    return False


def _near_sequence(core: list[str], a: list[str]) -> bool:
    """``core`` is a suffix-near subsequence of ``a`` but for a tenth of its words."""
    if len(core) < 8:
        return False
    row = [0] * (len(a) + 1)
    for w in core:
        last = 0
        for j, x in enumerate(a, 1):
            keep = row[j]
            row[j] = last + 1 if w == x else max(row[j], row[j - 1])
            last = keep
    common = row[-1]
    return common >= 0.9 * len(core) and len(a) - common <= 8


def cut_state(text: str) -> str:
    """``cut`` (breaks off), ``whole``, or ``open``: a short piece without an end.

    JSON must close; prose with a finished sentence before must finish its
    last one; fields, list items and choices need no end; an ellipsis mark
    counts as a break.
    """
    body = text.strip(_CLOSERS)
    head = text.lstrip(_CLOSERS + ".")
    tail = text.rstrip(_CLOSERS)
    if head[:1] in ("{", "["):
        return "whole" if tail.rstrip(". …").endswith("}" if head[0] == "{" else "]") else "cut"
    if not body:
        return "whole"
    if tail.endswith("…") or tail.endswith("..."):
        return "cut" if len(_WORD.findall(body)) > 1 else "whole"
    if tail[-1:] in _ENDS:
        return "whole"
    if ":" in text and fields_of(text):
        return "whole"
    lines = [x for x in text.split("\n") if x.strip()]
    if lines and _ITEM.match(lines[-1]):
        return "whole"
    rest = _CHOICE.sub("", body)
    ends = list(re.finditer(r"[.!?。！？][\"'”’»)*\]]*\s", rest))
    if ends and len(_WORD.findall(rest[: ends[-1].start()])) > 2:
        return "cut"
    n = len(_WORD.findall(rest))
    if n > PHRASE_WORDS:
        return "cut"
    # a sentence opens with a capital letter, a phrase rarely does
    return "open" if n > 2 and rest.lstrip(_CLOSERS)[:1].isupper() else "whole"


class LanguageModel:
    """Word weights of the four languages: sorted hashes and log probabilities."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray):
        self.keys, self.weights = keys, weights

    def score(self, words: WordSlice) -> tuple[np.ndarray, np.ndarray]:
        """Summed log probabilities (texts x languages) and known words of each text."""
        total = np.zeros((words.n, len(LANGUAGES)))
        known = np.zeros(words.n, dtype=np.int64)
        if len(self.keys) and len(words.hash):
            at = np.minimum(np.searchsorted(self.keys, words.hash), len(self.keys) - 1)
            hit = self.keys[at] == words.hash
            row, at = words.rows()[hit], at[hit]
            known = np.bincount(row, minlength=words.n)
            for k in range(len(LANGUAGES)):
                total[:, k] = np.bincount(row, weights=self.weights[at, k], minlength=words.n)
        return total, known


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts by the language that a text's function words show."""
    seeds = {k: set(WordSlice([" ".join(v)]).hash.tolist()) for k, v in FUNCTION_WORDS.items()}
    keys = np.array(sorted(set().union(*seeds.values())), dtype=np.uint64)
    votes = np.array([[float(int(x) in seeds[k]) for k in LANGUAGES] for x in keys])
    model = LanguageModel(keys, votes)
    for batch in batches:
        texts = [t or "" for t in batch.column(0).to_pylist()]
        for lo, hi in slices(texts):
            words = WordSlice(texts[lo:hi])
            score, _ = model.score(words)
            best = np.sort(score, axis=1)
            sure = (best[:, -1] >= 3) & (best[:, -1] > best[:, -2] + 1)
            lang = np.where(sure, score.argmax(axis=1), -1)[words.rows()]
            keep = lang >= 0
            pair, n = np.unique(np.stack([words.hash[keep], lang[keep].astype(np.uint64)]), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(signed(np.ascontiguousarray(pair[0]))), pa.array(pair[1].astype(np.int32)), pa.array(n)], names=["word", "lang", "n"])


def fit_languages(texts: DataFrame, sample_rows: int = 20_000, vocabulary: int = 20_000) -> LanguageModel:
    """Naive Bayes word weights from a bounded sample of labelled texts.

    ``texts``: ``key`` (long), ``text``. At most about ``sample_rows`` texts,
    chosen by a hash of ``key``, are labelled by their function words; the
    ``vocabulary`` most frequent words are kept. Both bounds do not depend on
    the input's size, so what reaches the driver is bounded, too.
    """
    n = texts.count()
    share = min(1.0, sample_rows / max(n, 1))
    part = texts.where(F.pmod(F.xxhash64("key", F.lit(4)), F.lit(1_000_000)) < int(share * 1_000_000) + 1).select("text")
    counts = part.mapInArrow(_count_words, "word long, lang int, n long").groupBy("word").pivot("lang", list(range(len(LANGUAGES)))).agg(F.sum("n"))
    counts = counts.na.fill(0).select("word", *[F.col(str(k)).alias(f"n{k}") for k in range(len(LANGUAGES))])
    total = sum(F.col(f"n{k}") for k in range(len(LANGUAGES)))
    top = counts.where(total >= 2).orderBy(total.desc(), "word").limit(vocabulary).toPandas()
    keys = top["word"].to_numpy(dtype=np.int64).view(np.uint64)
    by = top[[f"n{k}" for k in range(len(LANGUAGES))]].to_numpy(dtype=float)
    # smoothed by the common distribution: what a language was never seen with does not speak for it
    common = by.sum(axis=1, keepdims=True) / max(by.sum(), 1.0)
    weights = np.log((by + 50 * common) / (by.sum(axis=0) + 50))
    weights[:, by.sum(axis=0) < 100] = -30.0  # a language that the sample hardly shows is not told
    order = np.argsort(keys)
    return LanguageModel(keys[order], weights[order])


_FLAG_DDL = "src_table string, row_id long, field string, turn int, defect string, key string, chars int"


def _classifier(model_cast):
    """Pairs to defects; unfinished answers (``cut``, ``open``) come out with their last sentence for the neighbour comparison."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: LanguageModel = model_cast.value
        hints = WordSlice([" ".join(REFUSAL_HINTS)]).hash
        counts = np.zeros((2, (1 << FEATURE_BITS) + 1), dtype=np.int64)
        for batch in batches:
            q = [_TAG.sub(" ", t) if t else "" for t in batch.column(4).to_pylist()]
            a = [_TAG.sub(" ", t) if t else "" for t in batch.column(5).to_pylist()]
            pick, defect, key = [], [], []
            for lo, hi in slices([x + y for x, y in zip(q, a)]):
                n = hi - lo
                words = WordSlice(q[lo:hi] + a[lo:hi])
                count = np.diff(words.first)
                score, known = model.score(words)
                shared = _shared(words, n)
                row = words.rows()[words.first[n] :] - n
                feature, of = features(words.hash[words.first[n] :], words.first[n:] - words.first[n])
                refused = np.zeros(n, dtype=bool)
                hinted = np.bincount(row[np.isin(words.hash[words.first[n] :], hints)], minlength=n)
                for i in range(n):
                    text = a[lo + i]
                    na, nq = count[n + i], count[i]
                    found, own = None, None
                    if na == 0:
                        found = "empty"
                    elif nq > 3 and shared[i] >= max(4, na - 10, 0.6 * min(na, nq)) and is_copy(q[lo + i], text):
                        found = "copy"
                    elif na > 1 and hinted[i] and is_refusal(text):
                        found, refused[i] = "refusal", True
                    elif _foreign(score[i], known[i], score[n + i], known[n + i], q[lo + i]):
                        found = "other_language"
                    else:
                        state = cut_state(text)
                        if state != "whole":
                            found = state
                            own = None if text.lstrip(_CLOSERS + ".")[:1] in ("{", "[") else last_sentence(text)
                    if found:
                        pick.append(lo + i)
                        defect.append(found)
                        key.append(own)
                for k, some in enumerate((np.ones(n, dtype=bool), refused)):
                    counts[k, :-1] += np.bincount(feature[some[of]], minlength=1 << FEATURE_BITS)
                    counts[k, -1] += some.sum()
            if pick:
                take = pa.array(pick, pa.int64())
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(take) for c in range(4)), pa.array(defect, pa.string()), pa.array(key, pa.string()), pa.array([len(a[i]) for i in pick], pa.int32())], names=["src_table", "row_id", "field", "turn", "defect", "key", "chars"])
        for k, mark in enumerate((_WHOLE, _TAUGHT)):
            at = np.flatnonzero(counts[k])
            none = pa.nulls(len(at), pa.string())
            yield pa.RecordBatch.from_arrays([none, pa.array(counts[k, at]), none, pa.nulls(len(at), pa.int32()), pa.array([mark] * len(at), pa.string()), none, pa.array(at, pa.int32())], names=["src_table", "row_id", "field", "turn", "defect", "key", "chars"])

    return run


def refusal_model(whole: np.ndarray, taught: np.ndarray) -> Model:
    """Naive Bayes of refusals against all other answers, from counts of features (answers last)."""
    known = taught[:-1] > 0
    model = Model(np.stack([whole - taught, taught], axis=1)[:-1].astype(float), np.array([whole[-1] - taught[-1], taught[-1]], dtype=float), known)
    model.odds[~known & (whole[:-1] < REFUSAL_RARE * whole[-1])] = 0
    return model


def _refusals(sent):
    """Answers that the model takes as refusals (all columns but the texts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        for batch in batches:
            texts = [_TAG.sub(" ", t) if t else "" for t in batch.column(5).to_pylist()]
            for lo, hi in slices(texts):
                words = WordSlice(texts[lo:hi])
                odds = model.score(*features(words.hash, words.first), words.n)[:, 0]
                at = pa.array(lo + np.flatnonzero((odds >= REFUSAL_ODDS) & (np.diff(words.first) >= REFUSAL_LEAST)), pa.int64())
                if len(at):
                    yield pa.RecordBatch.from_arrays([batch.column(c).take(at) for c in range(4)], names=["src_table", "row_id", "field", "turn"])

    return run


def _shared(words: WordSlice, n: int) -> np.ndarray:
    """Words of each answer (texts n to 2n) that its question (texts 0 to n) has, too."""
    row = words.rows()
    tagged = words.hash ^ ((row % n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    cut = words.first[n]
    hit = np.isin(tagged[cut:], tagged[:cut])
    return np.bincount(row[cut:][hit] - n, minlength=n)


def _foreign(q: np.ndarray, q_known: int, a: np.ndarray, a_known: int, question: str) -> bool:
    """The answer is clearly in another language than the question, unasked."""
    if q_known < 3 or a_known < 4:
        return False
    asked, given = int(q.argmax()), int(a.argmax())
    if asked == given or a[given] - a[asked] < 1.0 * a_known**0.5 + 4 or np.partition(q, -2)[-2] > q.max() - 2:
        return False
    return not _REQUEST[LANGUAGES[given]].search(question)


_STRIP = " \t\r\n\u00a0\u2009\u3000\u200b\"'`´“”‘’«»)]*_,;:.…"


#: Characters of a common start that are told apart; a longer piece needs so many in common.
PIECE_CHARS = 400
#: Least common start of two sentences that are compared.
LEAST_START = 8
#: Share of an unfinished sentence that a longer one must have in common with it.
LEAST_SHARE = 0.4
#: Before the first sentences of responses, to which pieces that may be whole are compared.
_OPENING = "\x01"


def last_sentence(text: str) -> str:
    return next((p for x in reversed(re.split(_SENTENCE, text)) if (p := x.strip(_STRIP))), "")


def _asks(text: str) -> list[tuple[int, int, str]]:
    """(start, least, text): the piece is shortened if a sentence with the same ``start`` characters has ``least`` or more.

    It is continued by one that starts with it and goes on, or shares enough
    of its start with a longer one. A piece that may be whole (``open``) is
    held only against how responses open, and must be well outrun.
    """
    n = len(text)
    if text[:1] != _OPENING:
        return [(min(PIECE_CHARS, max(LEAST_START, math.ceil(LEAST_SHARE * n))), n + 3, text)] if n >= LEAST_START else []
    if n <= LEAST_START:
        return []
    out = [(min(PIECE_CHARS, n), n + 15, text)]
    if not text.isupper():
        out.append((min(PIECE_CHARS, max(LEAST_START + 1, math.ceil(0.3 * n))), n + 20, text))
    return out


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted distinct sentences (``text, ask``) to the pieces that another sentence shows to be cut (``cut``).

    Sentences with a common start follow each other, so the runs that the
    last sentence is in form a stack, the longest common start on top; each
    keeps its longest sentence and the pieces that wait for a longer one. A
    run that reaches the end of a partition may go on in others: its pieces
    come out as ``ask``, and as ``edge`` the starts of the first and the last
    sentence with the most characters of a sentence that has them.
    """
    stack: list[list] = []  # [start, most, asks], ascending
    first, last, level = None, None, 0
    first_most: dict[int, int] = {}
    out: dict[str, list] = {k: [] for k in _NEAR.names}

    def put(kind: str, text: str | None, start: str | None, chars: int | None) -> None:
        for k, v in zip(_NEAR.names, (kind, text, start, chars)):
            out[k].append(v)

    def close(depth: int) -> None:
        """Ends the runs whose common start is longer than ``depth``."""
        while stack and stack[-1][0] > depth:
            _, most, asks = stack.pop()
            below = stack[-1][0] if stack else 0
            wait = []
            for ask in asks:
                start, least, text = ask
                if most >= least:
                    put("cut", text, None, None)
                elif start <= max(depth, below):
                    wait.append(ask)
                elif first.startswith(text[:start]):
                    put("ask", text, text[:start], least)
            if below >= depth and stack:
                stack[-1][1] = max(stack[-1][1], most)
                stack[-1][2] += wait
            elif depth >= LEAST_START:
                stack.append([depth, most, wait])

    for batch in batches:
        for text, asks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            depth = min(len(text), PIECE_CHARS)
            if last is None:
                first, level = text, depth
            else:
                common = _common(last[:PIECE_CHARS], text[:PIECE_CHARS])
                level = min(level, common)
                close(common if common >= LEAST_START else 0)
            if level >= LEAST_START:
                first_most[level] = max(first_most.get(level, 0), len(text))
            if stack and stack[-1][0] == depth:
                stack[-1][1] = max(stack[-1][1], len(text))
                stack[-1][2] += _asks(text) if asks else []
            else:
                stack.append([depth, len(text), _asks(text) if asks else []])
            last = text
        yield pa.RecordBatch.from_pydict(out, schema=_NEAR)
        for v in out.values():
            v.clear()
    if last is None:
        return
    last_most, most = {}, 0
    for run in reversed(stack):
        most = last_most[run[0]] = max(most, run[1])
        for start, least, text in run[2]:
            # the run with just this start may be a longer one, lower in the stack
            put("ask", text, text[:start], least)
    for text, by_start in ((first, first_most), (last, last_most)):
        most, starts = 0, sorted(by_start)
        for start in range(starts[-1] if starts else 0, LEAST_START - 1, -1):
            most = max(most, by_start.get(start, 0))
            put("edge", None, text[:start], most)
    yield pa.RecordBatch.from_pydict(out, schema=_NEAR)


_NEAR = pa.schema([("kind", pa.string()), ("text", pa.string()), ("start", pa.string()), ("chars", pa.int32())])
_NEAR_DDL = "kind string, text string, start string, chars int"


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n  # the longest common prefix, by bisection
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    return lo


def broken_pairs(pairs: DataFrame, materialise, sample_rows: int = 20_000) -> DataFrame:
    """Every defective answer with its kind of defect.

    ``pairs``: ``src_table, row_id, field, turn, question, answer``; null texts
    count as empty. Returns the first four columns and ``defect``: ``empty``
    (neither letter nor digit), ``copy``, ``refusal``, ``other_language`` or
    ``truncated``, one at most, tested in this order. Refusals that patterns
    show teach a naive Bayes model of their wording; answers without any other
    defect that it takes as refusals are added.

    Defined cases: an empty question makes no copy and no language defect;
    equal rows give equal results; an empty table gives an empty result;
    extra columns are ignored; whole texts are read, of any length.

    A fifth column, ``evidence``, says what showed a truncation: ``neighbour``,
    ``limit`` or ``end``; it is null for other defects.

    Scale: classification is one pass without shuffle. For the neighbour
    comparison distinct sentences are range-sorted (repeats collapse in the
    partial aggregation, so a frequent sentence costs one row) and each is
    compared with all that share its start, across partitions by at most
    ``2 * PIECE_CHARS`` starts a partition; only unfinished answers are joined
    with its outcome.
    """
    spark = pairs.sparkSession
    own = pairs.select("src_table", F.col("row_id").cast("long").alias("row_id"), "field", F.col("turn").cast("int").alias("turn"), "question", "answer")
    own = scan_slices(own)
    model = fit_languages(own.select(F.col("row_id").alias("key"), F.concat_ws("\n", "question", "answer").alias("text")), sample_rows)
    flagged = materialise(own.mapInArrow(_classifier(spark.sparkContext.broadcast(model)), _FLAG_DDL), "pair-flags")
    names = ["src_table", "row_id", "field", "turn"]
    sure = flagged.where(f"defect NOT IN ('cut', 'open', '{_WHOLE}', '{_TAUGHT}')").select(*names, "defect", F.lit(None).cast("string").alias("evidence"))
    maybe = flagged.where("defect IN ('cut', 'open')").withColumn("text", F.when(F.col("defect") == "open", F.concat(F.lit(_OPENING), "key")).otherwise(F.col("key"))).drop("key")

    pieces = maybe.where("text IS NOT NULL").select("text", F.lit(True).alias("ask"))
    bare = F.regexp_replace("answer", r"(?i)<\s*/?\s*(?:image|video|audio)\s*>", " ")
    said = own.where("answer IS NOT NULL").select(F.transform(F.split(bare, _SENTENCE), lambda x: F.btrim(x, F.lit(_STRIP))).alias("said"))
    said = said.select(F.explode(F.concat("said", F.array(F.concat(F.lit(_OPENING), F.col("said")[0])))).alias("text")).where(F.length("text") >= LEAST_START)
    texts = said.select("text", F.lit(False).alias("ask")).unionByName(pieces).groupBy("text").agg(F.max("ask").alias("ask"))
    near = materialise(texts.repartitionByRange("text").sortWithinPartitions("text").mapInArrow(_neighbours, _NEAR_DDL), "pair-neighbours")
    short = near.where("kind = 'cut'").select("text").unionByName(_across(near)).distinct()
    limits = _length_limits(maybe.where("defect = 'cut'"))
    shown = salted_join(maybe, short.withColumn("_near", F.lit(True)), ["text"], "left", spread_by="row_id").join(limits.withColumn("_limit", F.lit(True)), "chars", "left")
    evidence = F.when(F.col("_near"), F.lit("neighbour")).when(F.col("_limit"), F.lit("limit")).when(F.col("defect") == "cut", F.lit("end"))
    cut = shown.withColumn("evidence", evidence).where("evidence IS NOT NULL").select(*names, F.lit("truncated").alias("defect"), "evidence")
    counted = flagged.where(f"defect IN ('{_WHOLE}', '{_TAUGHT}')").groupBy("defect", "chars").agg(F.sum("row_id").alias("n")).toPandas()  # one row a feature
    counts = {m: np.zeros((1 << FEATURE_BITS) + 1, dtype=np.int64) for m in (_WHOLE, _TAUGHT)}
    for mark, rows in counted.groupby("defect"):
        counts[mark][rows["chars"].to_numpy()] = rows["n"].to_numpy()
    found = materialise(sure.unionByName(cut), "pair-defects")
    release(flagged, near)
    if not counts[_TAUGHT][-1]:
        return found
    sent = spark.sparkContext.broadcast(refusal_model(counts[_WHOLE], counts[_TAUGHT]))
    learnt = own.mapInArrow(_refusals(sent), "src_table string, row_id long, field string, turn int").alias("l")
    other = found.select(*[F.col(c).alias(f"_{c}") for c in names])
    free = learnt.join(other, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names]), "left_anti")
    return found.unionByName(free.select(*names, F.lit("refusal").alias("defect"), F.lit(None).cast("string").alias("evidence")))


def _across(near: DataFrame) -> DataFrame:
    """Pieces that wait at the end of a partition and that a response of any partition shows to be cut."""
    most = near.where("kind = 'edge'").groupBy("start").agg(F.max("chars").alias("_most"))
    return near.where("kind = 'ask'").join(most, "start").where(F.col("_most") >= F.col("chars")).select("text")


def _length_limits(cut: DataFrame, least: int = 20, factor: float = 5.0, around: int = 10) -> DataFrame:
    """Lengths (``chars``) at which cut responses pile up.

    A length is a limit if at least ``least`` responses are cut there, and
    ``factor`` times as many as on average within ``around`` characters (so
    there is at most one in ``least`` cut responses, and in practice a few).
    """
    hist = cut.groupBy("chars").agg(F.count(F.lit(1)).alias("n"))
    near = Window.partitionBy(F.lit(0)).orderBy("chars").rangeBetween(-around, around)  # one row a length
    others = (F.sum("n").over(near) - F.col("n")) / (2 * around)
    return hist.withColumn("_others", others).where((F.col("n") >= least) & (F.col("n") >= factor * F.col("_others"))).select("chars")

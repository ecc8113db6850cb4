"""Problem 8: template residue and error-page text.

Positive-unlabelled naive Bayes: passages and template slots that carry an
unmistakable mark are trusted examples of their kind, all others are
unlabelled. Expectation maximisation learns what else belongs to each kind.
Then every passage and slot is scored, trusted ones like all others, and a
record takes the kind of its strongest one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.kernels import WordSlice, mix, slices
from millrace.session import scan_slices

KINDS = ("placeholder", "filler", "error_page", "script_notice")
#: Hashed features of the classifier.
FEATURE_BITS = 16
#: Rounds of expectation maximisation after the trusted start.
ROUNDS = 2
#: Weight of the background in a kind's smoothed distribution, as a share of
#: its features: what a kind was never seen with speaks against it alike at every size.
SMOOTHING = 0.1
#: Features seen less often, and in no trusted example, never speak for a kind: on them a guess would confirm itself.
LEAST_COUNT = 5
#: Least probability at which an unlabelled passage counts for a kind while learning.
SURE = 0.9
#: Least log odds of a kind against clean text for a passage to count.
LEAST_ODDS = 3.0

#: Log odds below which a passage is clean in every round: its part in the
#: expected counts would be less than e**REACH.
REACH = -30.0

_D = 1 << FEATURE_BITS
_U = np.uint64

# Shapes and usual names of template slots, wordings of error
# pages, script notices and filler text in the four languages.
_NAME = r"(?:date|time|year|name|title|caption|answer|question|speaker|scene|location|place|colou?r|count|number|object|subject|topic|video|image|picture|annotator|author|text|description|city|country|url|link|email|phone|person|user|company|product|value|label|id)"
SLOTS = [
    r"\{\{\s*[\w .\-]+\s*\}\}",
    r"\$\{\s*[\w .\-]+\s*\}",
    r"<%=?\s*[\w .\-]+\s*%>",
    r"\{%\s*[\w .\-]+\s*%\}",
    r"<<\s*[\w \-]+\s*>>",
    r"%\(\w+\)[sd]",
    r"@@\w+@@",
    r"(?<![\w_])__[A-Za-z]\w*?__(?![\w_])",
    r"(?<![\w#])#[A-Za-z_]{2,}#(?![\w#])",
    r"(?<![\w$])\$[A-Za-z_]{2,}\$(?![\w$])",
    r"(?<![\w%])%[A-Za-z_]{2,}%(?![\w%])",
    r"&lt;\s*[\w \-]+\s*&gt;",
    r"<(?:your|insert|add|enter)\s[\w \-]+>",
    r"<\w+_here>",
    r"<[A-Z]{2,}(?:_[A-Z]+)*>",
    r"\[(?i:insert|add|your|enter|put|fill in)\s[^\]\n]+\]",
    r"\[[\w]+_[\w]+\]",
    r"\[[A-Z][A-Z_]{2,}\]",
    r"\[(?i:" + _NAME + r")\]",
    r"\{\d{1,2}\}",
    r"\{[A-Za-z]\w*\}",
    r"\bTODO\(\s*[\w \-]+\s*\)",
    r"\b(?:FIXME|TBD)\(\s*[\w \-]+\s*\)",
]
_SLOT = re.compile("|".join(f"(?P<s{i}>{x})" for i, x in enumerate(SLOTS)))
_CODE = re.compile(r"`[^`\n]+`")
#: Where a slot, code or a tag that divides passages may begin.
_START = re.compile(r"[{$<%@_#&\[`]|TODO\(|FIXME\(|TBD\(")
_DIVIDE = re.compile(r"(?i)</?noscript>")
_ABOUT = r"(?i)\b(?:syntax|config|configuration|variable|environment|template engine|loader|escaped?|stands for|documents it)\b"
_SCRIPTS = r"(?:java\s?scripts?|\bjs\b|\bscripts?\b|\bscripting\b|\bskripte?\b|\bskripten\b)"
TRUSTED = {
    "error_page": [
        r"^(?:error\s*|http\s*)?[45]\d\d\s*[:,\-–]?\s*(?:not found|forbidden|unauthorized|bad request|service unavailable|bad gateway|gateway timeout|internal server error|page not found|access denied|too many requests|method not allowed|gone)\b",
        r"^(?:error|fehler|erreur)\s*[45]\d\d\b.{0,60}$",
        r"^(?:interner serverfehler|erreur interne du serveur|error interno del servidor|internal server error)\b",
        r"^(?:page|file) not found\W*$|^(?:die )?seite (?:wurde )?nicht gefunden\W*$|^page introuvable\W*$|^página no encontrada\W*$",
        r"^[^\W\d_][\w' \-]{2,40}\s*\(\s*[45]\d\d\s*\)\W*$",
        r"^service (?:temporarily )?(?:unavailable|indisponible)\W*$|^dienst (?:ist )?nicht verfügbar\W*$|^servicio no disponible\W*$",
        r"^(?:die |this |cette |esta )?(?:page|seite|página)\s(?:does not exist|no longer exists?|n'existe (?:plus|pas)|existiert nicht(?: mehr)?|ist nicht erreichbar|(?:ya )?no existe|is not available|n'est pas disponible|no está disponible|kann nicht angezeigt werden)\W*$",
        r"^(?:access denied|zugriff verweigert|accès refusé|acceso denegado)\W*$",
        r"^(?:oops\W*)?something went wrong\W*$|^this page could not be loaded\W*$",
    ],
    "script_notice": [
        rf"^(?:please |kindly )?(?:enable|activate|turn on|switch on|allow)\b.{{0,40}}{_SCRIPTS}",
        rf"\b(?:requires?|needs?|(?:need|have) to (?:enable|turn on|activate|switch on|allow)|has disabled|does not support)\s(?:\w+\s){{0,3}}{_SCRIPTS}",
        rf"\b(?:turn on|switch on|enable|activate)\s(?:\w+\s){{0,2}}{_SCRIPTS}\s*(?:and cookies)?\s*(?:in your browser)?\W*$",
        rf"\b(?:unable|not able|cannot|can't)\b.{{0,40}}\bwithout\s(?:\w+\s){{0,2}}{_SCRIPTS}",
        rf"^(?:\w+\s){{1,8}}(?:without|ohne|sans|sin)\s(?:\w+\s){{0,2}}{_SCRIPTS}\W*$",
        rf"\b(?:aktivieren sie|schalten sie|erlauben sie|braucht es|benötigt|erfordert)\b.{{0,40}}{_SCRIPTS}|{_SCRIPTS}.{{0,40}}\b(?:aktivieren|einschalten|erlauben|zulassen|benötigt)\W*$",
        rf"\b(?:activez|autorisez|veuillez activer|nécessite|requiert)\b.{{0,40}}{_SCRIPTS}",
        rf"\b(?:active|habilite|permita|active usted|requiere|necesita)\b.{{0,40}}{_SCRIPTS}",
    ],
    "filler": [
        r"^lorem ipsum\b",
        r"\blorem ipsum dolor\b",
        r"^(\w+)(?:\s+\1){2,}\W*$",
        r"^(?:asdf|qwer|bla|xxx+|foo|blah)\b(?:\W+(?:asdf|qwer|bla|x+|foo|bar|baz|blah)\b){1,}\W*$",
        r"^.{0,30}\b(?:dummy|placeholder|sample|filler) (?:text|answer|caption|content)\b.{0,30}$",
        r"^.{0,20}\b(?:blindtext|platzhaltertext|fülltext|beispieltext)\b.{0,20}$",
        r"^.{0,20}\b(?:texte (?:provisoire|factice|d'exemple)|texto (?:provisional|de relleno|de ejemplo))\b.{0,30}$",
        r"^\W*(?:caption|title|text|description|content|answer) (?:goes|comes) here\W*$",
        r"^replace this (?:paragraph|text|sentence|caption)\b",
    ],
}
# Words of which every trusted wording of a kind has one (or one
# word three times in a row); other passages are not searched for it.
HINTS = {
    "error_page": "found gefunden introuvable encontrada error fehler erreur serverfehler unavailable indisponible verfügbar disponible denied verweigert refusé denegado wrong loaded exist exists existe existiert erreichbar available angezeigt",
    "script_notice": "javascript javascripts script scripts scripting skript skripte skripten js",
    "filler": "lorem asdf qwer bla blah foo dummy placeholder sample filler text answer caption content blindtext platzhaltertext fülltext beispieltext texte texto here replace",
}
#: Characters up to which a passage may be trusted; longer ones are scored like all others.
LONGEST = {"error_page": 160, "script_notice": 200, "filler": 200}
#: What a passage must show to be of a kind at all.
EVIDENCE = {"script_notice": _SCRIPTS}
#: Lines of JSON objects are data; only a slot in one counts.
_JSON_LINE = re.compile(r'^\s*[\[{,]*\s*"[^"\n]*"\s*:|^\s*[{}\[\],]+\s*$')
_BULLET = re.compile(r"^\s*[-*•–]\s+")
_RULES = {k: [re.compile(r, re.IGNORECASE) for r in v] for k, v in TRUSTED.items()}
_SEEN = re.compile(_ABOUT)


def marked(text: str) -> tuple[str, list[str]]:
    """A text with each slot and each span of code replaced by a word, and its slots.

    Slots come as tokens of their shape and name, those in code with a token
    that says so.
    """
    parts, slots, done = [], [], 0
    for m in _START.finditer(text):
        at = m.start()
        if at < done:
            continue
        if text[at] == "`":
            found = _CODE.match(text, at)
            if not found:
                continue
            inner = [x for x in _SLOT.finditer(found.group())]
            word = " qcodeq " + " qslotq " * len(inner)
            slots += [_slot_tokens(x) + " qincode" for x in inner]
        elif found := _DIVIDE.match(text, at):
            word = "\n"
        elif found := _SLOT.match(text, at):
            word = " qslotq "
            slots.append(_slot_tokens(found))
        else:
            continue
        parts += [text[done:at], word]
        done = found.end()
    return "".join([*parts, text[done:]]) if parts else text, slots


def _slot_tokens(slot: re.Match) -> str:
    return " ".join([f"qshape{slot.lastgroup}", *(f"qname{w}" for w in re.findall(r"[^\W_]+", slot.group().lower()))])


def _hashes(words: list[str]) -> np.ndarray:
    return np.unique(WordSlice([" ".join(words)]).hash)


class Passages:
    """Sentences, lines and dash items of a slice of texts that have words, as ranges of words.

    ``hash[first[p]:first[p + 1]]`` are the words of passage ``p``, ``text[p]``
    is its text and ``label[p]`` the place in :data:`KINDS` of the kind that it
    unmistakably shows (0: none). ``slots``: for each slot its text, its
    tokens and those around it, and whether it is trusted.
    """

    def __init__(self, texts: list[str]):
        both = [marked(t.replace("\0", " ")) for t in texts]
        words = self.words = WordSlice([t for t, _ in both])
        codes = words.codes
        space = (codes == 32) | (codes == 10) | (codes == 0) | (codes == 9) | (codes == 13) | (codes == 0xA0)
        cut = (codes == 10) | (codes == 0)
        cut[1:] |= space[1:] & ((codes[:-1] == 46) | (codes[:-1] == 33) | (codes[:-1] == 63))
        if len(codes) > 2:
            cut[1:-1] |= ((codes[1:-1] == 45) | (codes[1:-1] == 0x2013)) & space[:-2] & space[2:]
        cut = np.flatnonzero(cut)
        of_word = np.searchsorted(cut, words.start, "right")
        begin = np.flatnonzero(np.diff(of_word, prepend=-1)) if len(of_word) else np.zeros(0, dtype=np.int64)
        which = of_word[begin]
        self.low = np.concatenate([[0], cut + 1])[which]
        self.high = np.append(cut, len(codes))[which]
        self.first = np.append(begin, len(words.start))
        self.text = np.searchsorted(words.first, begin, "right") - 1
        self.label = np.zeros(len(begin), dtype=np.int32)
        self._trust()
        self.slots = self._slots([s for _, s in both])
        # lines of JSON objects that show nothing are left out
        solid = np.flatnonzero(~space)
        head = codes[solid[np.searchsorted(solid, self.low)]] if len(begin) else codes[:0]
        keep = np.ones(len(begin), dtype=bool)
        for p in np.flatnonzero(np.isin(head, [ord(c) for c in '"{[}],']) & (self.label == 0)):
            keep[p] = not _JSON_LINE.search(self.passage(p))
        size = np.diff(self.first)
        self.hash = words.hash[np.repeat(keep, size)]
        self.text, self.label, self.low, self.high = self.text[keep], self.label[keep], self.low[keep], self.high[keep]
        self.first = np.concatenate([[0], np.cumsum(size[keep])])
        self.n = len(self.text)

    def passage(self, p: int) -> str:
        return self.words.lowered[self.low[p] : self.high[p]]

    def _trust(self) -> None:
        value, n = self.words.hash, len(self.label)
        if not n:
            return
        row = np.repeat(np.arange(n), np.diff(self.first))
        three = np.zeros(n, dtype=bool)
        if len(value) > 2:
            three[row[2:][(value[2:] == value[1:-1]) & (value[1:-1] == value[:-2]) & (row[2:] == row[:-2])]] = True
        for kind in TRUSTED:
            hints = _hint_hashes(kind)
            hinted = np.zeros(n, dtype=bool)
            hinted[row[hints[np.minimum(np.searchsorted(hints, value), len(hints) - 1)] == value]] = True
            if kind == "filler":
                hinted |= three
                hinted[row[np.isin(self.words.start, self._of_x())]] = True
            for p in np.flatnonzero(hinted & (self.label == 0)):
                shown = _BULLET.sub("", self.passage(p)).strip()
                if len(shown) <= LONGEST[kind] and any(r.search(shown) for r in _RULES[kind]):
                    self.label[p] = KINDS.index(kind)

    def _of_x(self) -> list[int]:
        """Where words of x alone begin."""
        return [m.start() for m in re.finditer(r"(?<![^\W_])x{3,}(?![^\W_])", self.words.lowered)]

    def _slots(self, of_text: list[list[str]]) -> list[tuple[int, str, int]]:
        words, out = self.words, []
        for i in np.flatnonzero(words.hash == _hashes(["qslotq"])[0]):
            text = int(np.searchsorted(words.first, i, "right") - 1)
            if not of_text[text]:
                continue
            p = int(np.searchsorted(self.first, i, "right") - 1)
            tokens = [of_text[text].pop(0)]
            about = bool(_SEEN.search(self.passage(p))) or "qcodeq" in self.passage(p)
            for k, side in ((-2, "qbeforebefore"), (-1, "qbefore"), (1, "qafter"), (2, "qafterafter")):
                tokens.append(side + (words.word(i + k) if self.first[p] <= i + k < self.first[p + 1] else "none"))
            out.append((text, " ".join(tokens + ["qabout"] * about), int(not about)))
        return out


@lru_cache(maxsize=8)
def _hint_hashes(kind: str) -> np.ndarray:
    numbers = [str(x) for x in range(400, 600)] if kind == "error_page" else []
    return _hashes(HINTS[kind].split() + numbers)


def features(value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of passages and the passage of each: words, word pairs, first word, length."""
    n = np.diff(first)
    row = np.repeat(np.arange(len(n)), n)
    inner = np.flatnonzero(row[1:] == row[:-1]) if len(row) > 1 else np.zeros(0, dtype=np.int64)
    some = np.flatnonzero(n > 0)
    parts = [(value, row), (value[inner] * _U(3) + value[inner + 1], row[inner]), (value[first[:-1][some]] + _U(11), some), (np.minimum(n[some], 12).astype(np.uint64) + _U(1 << 40), some)]
    return (mix(np.concatenate([p[0] for p in parts])) >> _U(64 - FEATURE_BITS)).astype(np.int64), np.concatenate([p[1] for p in parts])


class Model:
    """Log odds of each feature for each kind against clean text, and of the kinds."""

    def __init__(self, counts: np.ndarray, passages: np.ndarray, trusted: np.ndarray):
        """``counts``: features x (clean, kinds...); ``passages``: number of each; ``trusted``: features of trusted examples."""
        whole = counts.sum(axis=1)
        background = (whole + 1e-3) / (whole.sum() + 1e-3 * _D)
        size = counts.sum(axis=0)
        weight = SMOOTHING * size + 1
        logs = np.log((counts + weight * background[:, None]) / (size + weight))
        self.odds = (logs[:, 1:] - logs[:, :1]).astype(np.float32)
        rare = (whole < LEAST_COUNT) & ~trusted
        self.odds[rare] = np.minimum(self.odds[rare], 0)
        self.prior = np.log((passages[1:] + 1) / (passages[0] + 1))

    def score(self, feature: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        out = np.tile(self.prior, (n, 1))
        for k in range(out.shape[1]):
            out[:, k] += np.bincount(row, weights=self.odds[feature, k], minlength=n)
        return out


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, Passages]]:
    for batch in batches:
        ids, texts = batch.column(0).to_numpy(zero_copy_only=False), [t or "" for t in batch.column(1).to_pylist()]
        for lo, hi in slices(texts):
            yield ids[lo:hi], Passages(texts[lo:hi])


_SURVEY = pa.schema([("what", pa.string()), ("doc_id", pa.int64()), ("passage", pa.string()), ("label", pa.int32()), ("feature", pa.int32()), ("n", pa.int64())])
_SURVEY_DDL = "what string, doc_id long, passage string, label int, feature int, n long"


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over documents: trusted passages, slots, and how often each feature occurs in passages (``-1``: passages)."""
    total, n = np.zeros(_D, dtype=np.int64), 0
    for ids, p in _sliced(batches):
        feature, _ = features(p.hash, p.first)
        total += np.bincount(feature, minlength=_D)
        n += p.n
        sure = np.flatnonzero(p.label)
        out = {"what": ["trusted"] * len(sure) + ["slot"] * len(p.slots), "doc_id": [int(ids[p.text[x]]) for x in sure] + [int(ids[t]) for t, _, _ in p.slots]}
        out |= {"passage": [p.passage(x) for x in sure] + [x for _, x, _ in p.slots], "label": p.label[sure].tolist() + [x for _, _, x in p.slots]}
        size = len(out["what"])
        yield pa.RecordBatch.from_pydict(out | {"feature": [None] * size, "n": [None] * size}, schema=_SURVEY)
    have = np.flatnonzero(total)
    counts = {"what": ["count"] * (len(have) + 1), "doc_id": [None] * (len(have) + 1), "passage": [None] * (len(have) + 1), "label": [None] * (len(have) + 1)}
    yield pa.RecordBatch.from_pydict(counts | {"feature": np.append(have, -1).astype(np.int32), "n": np.append(total[have], n)}, schema=_SURVEY)


def _reachable(sent):
    """The passages that are trusted or not surely clean."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        for ids, p in _sliced(batches):
            odds = model.score(*features(p.hash, p.first), p.n)
            at = np.flatnonzero((odds.max(axis=1, initial=-np.inf) >= REACH) | (p.label > 0))
            yield pa.RecordBatch.from_arrays([pa.array(ids[p.text[at]], pa.int64()), pa.array([p.passage(x) for x in at], pa.string()), pa.array(p.label[at])], names=["doc_id", "passage", "label"])

    return run


def _counter(sent, kinds: int):
    """One expectation step: expected feature and passage counts of a partition, by kind (``n0``: of all)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model | None = sent.value
        total = np.zeros((_D + 1, kinds + 1))
        for batch in batches:
            texts, label = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for lo, hi in slices(texts):
                words, own = WordSlice(texts[lo:hi]), label[lo:hi]
                feature, row = features(words.hash, words.first)
                share = np.zeros((words.n, kinds))
                if model is not None:
                    odds = np.clip(model.score(feature, row, words.n), -50, 50)
                    top = np.maximum(odds.max(axis=1, keepdims=True), 0)
                    share = np.exp(odds - top)
                    share /= share.sum(axis=1, keepdims=True) + np.exp(-top)
                    share[share.max(axis=1) < SURE] = 0
                share[own > 0] = 0
                share[own > 0, own[own > 0] - 1] = 1
                total[:_D, 0] += np.bincount(feature, minlength=_D)
                total[_D, 0] += words.n
                for k in range(kinds):
                    some = share[row, k] > 1e-6
                    total[:_D, k + 1] += np.bincount(feature[some], weights=share[row[some], k], minlength=_D)
                    total[_D, k + 1] += share[:, k].sum()
        at = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *(pa.array(total[at, k]) for k in range(kinds + 1))], names=["feature", *(f"n{k}" for k in range(kinds + 1))])

    return run


def learn(passages: DataFrame, kinds: int, rounds: int, whole: np.ndarray | None = None) -> Model:
    """Naive Bayes from trusted and unlabelled passages (``passage, label``: 1 to ``kinds``, 0 unlabelled).

    ``whole`` holds the counts of each feature (and of passages, last) over
    all passages, if ``passages`` has only those that may be of a kind. Every
    round sums expected counts of a fixed number of features, so what reaches
    the driver does not grow with the input.
    """
    context = passages.sparkSession.sparkContext
    names = [f"n{k}" for k in range(kinds + 1)]
    ddl = "feature int, " + ", ".join(f"{n} double" for n in names)
    model, trusted = None, None
    for _ in range(rounds + 1):
        sent = context.broadcast(model)
        rows = passages.select("passage", "label").mapInArrow(_counter(sent, kinds), ddl).groupBy("feature").agg(*[F.sum(n).alias(n) for n in names]).toPandas()
        total = np.zeros((_D + 1, kinds + 1))
        total[rows["feature"].to_numpy()] = rows[names].to_numpy()
        if whole is not None:
            total[:, 0] = whole
        total[:, 0] = np.maximum(total[:, 0] - total[:, 1:].sum(axis=1), 0)
        trusted = total[:_D, 1:].any(axis=1) if trusted is None else trusted
        model = Model(total[:_D], total[_D], trusted)
        sent.unpersist()
    return model


def _scorer(sent, kinds: tuple[str, ...]):
    """Passages (``doc_id, passage, label``) to those whose best kind reaches ``LEAST_ODDS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        needs = [re.compile(EVIDENCE[k]) if k in EVIDENCE else None for k in kinds]
        place = np.array([KINDS.index(k) for k in kinds], dtype=np.int32)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in slices(texts):
                words = WordSlice(texts[lo:hi])
                odds = model.score(*features(words.hash, words.first), words.n)
                for k, need in enumerate(needs):
                    for i in np.flatnonzero(odds[:, k] >= LEAST_ODDS) if need else ():
                        if not need.search(texts[lo + i]):
                            odds[i, k] = -np.inf
                best = odds.argmax(axis=1)
                value = odds[np.arange(words.n), best]
                at = np.flatnonzero(value >= LEAST_ODDS)
                shown = batch.column(2).to_numpy()[lo + at] == best[at] + 1
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(lo + at)), pa.array(place[best[at]]), pa.array(shown), pa.array(value[at])], names=["doc_id", "kind", "shown", "odds"])

    return run


def residue(documents: DataFrame, materialise, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, kind`` of documents with template residue or error-page text.

    ``documents``: ``doc_id, text``. A passage is of the kind with the highest
    log odds against clean text, if they reach ``LEAST_ODDS`` and the passage
    shows what the kind cannot do without (:data:`EVIDENCE`); template slots
    are scored for ``placeholder`` by their shape, name and neighbouring words.
    Trusted examples only teach: whether they count is decided by their score,
    as for all others. A document takes the kind of its strongest passage or
    slot; if several kinds reach the bound, a kind with a trusted one goes
    first, and ties go by the order of :data:`KINDS`.

    Defined cases: null and empty texts and texts without words are clean;
    repeated texts get equal results; an empty table gives an empty result;
    rows without id and extra columns are ignored; texts are read whole, whatever their length.

    Scale: two passes over the documents without shuffle, one to survey all
    passages and one to find those that are not surely clean under the first
    model; only these and the slots are written, and the rounds of expectation
    maximisation and the final scores read nothing else. Counts cover all passages.
    """
    own = scan_slices(documents.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    context = own.sparkSession.sparkContext
    survey = materialise(own.mapInArrow(_survey, _SURVEY_DDL), "residue-survey")
    rows = survey.where("what = 'count'").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()  # one row a feature
    whole = np.zeros(_D + 1)
    whole[rows["feature"].to_numpy()] = rows["n"].to_numpy()
    kinds = KINDS[1:]
    start = learn(survey.where("what = 'trusted'"), len(kinds), 0, whole)
    reach = materialise(own.mapInArrow(_reachable(context.broadcast(start)), "doc_id long, passage string, label int"), "residue-passages")
    slots = survey.where("what = 'slot'").select("doc_id", "passage", "label")
    scored = None
    for table, names, total in ((slots, KINDS[:1], None), (reach, kinds, whole)):
        model = learn(table, len(names), rounds, total)
        one = table.select("doc_id", "passage", "label").mapInArrow(_scorer(context.broadcast(model), names), "doc_id long, kind int, shown boolean, odds double")
        scored = one if scored is None else scored.unionByName(one)
    best = scored.groupBy("doc_id").agg(F.max(F.struct("shown", "odds", (-F.col("kind")).alias("_k"))).alias("_best"))
    return best.select("doc_id", F.element_at(F.array(*[F.lit(k) for k in KINDS]), 1 - F.col("_best._k")).alias("kind"))

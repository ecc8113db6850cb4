"""Problem 1: duplicates hidden by formatting differences.

Texts are streamed through a skip-and-fold lookup table into rolling
polynomial hashes; canonical strings are never built. Rows whose hashes agree
are verified by a two-pointer comparison that skips as it goes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.kernels import _BASE, _GOLD, SKIP, code_points, fold_table, mix, powers, signed, slices
from millrace.operators.skew import salted_join
from millrace.session import release, scan_slices

#: Code points read at a time by the streaming loops.
BLOCK = 1 << 16
_FULL = (1 << 64) - 1
#: Copies of one record that a task verifies; more are spread over further tasks.
COPIES_A_TASK = 20_000
#: Rounds in which keys of one answer are brought together; each halves a chain of them.
ROUNDS = 40

_ITEM = re.compile(r"\s*(?:[-*•]\s+)?[\"']?([^\W\d_][\w \-]*?)[\"']?\s*:\s*")
_KEY = re.compile(r'\s*"(?:[^"\\]|\\.)*"\s*:\s*')
_JSON_STEP = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\],]')


def _json_spans(text: str) -> list[tuple[int, int]] | None:
    """Spans of the pairs of a JSON object, nested values included, or None if it is none."""
    at, end = text.index("{") + 1, text.rindex("}")
    spans, depth, begin = [], 0, at
    for m in [*_JSON_STEP.finditer(text, at, end), None]:
        mark = m.group() if m else ","
        if mark in ("{", "["):
            depth += 1
        elif mark in ("}", "]"):
            depth -= 1
            if depth < 0:
                return None
        elif mark == "," and depth == 0:
            stop = m.start() if m else end
            if _KEY.match(text, begin, stop):
                spans.append((begin, stop))
            elif text[begin:stop].strip():
                return None
            begin = stop + 1
    return spans if depth == 0 else None


def fields_of(text: str) -> list[tuple[int, int]] | None:
    """Spans of the items if ``text`` is a set of named fields, else None.

    A set of named fields is a JSON object, or ``name: value`` items
    divided by line ends or semicolons. At least two items are needed (one
    has no order), the first piece must carry a name, and a piece without a
    name continues the item before it.
    """
    body = text.strip()
    if len(body) < 3:
        return None
    if body[0] == "{" and body[-1] == "}":
        spans = _json_spans(text)
        return spans if spans and len(spans) > 1 else None
    if ":" not in text:
        return None
    spans: list[tuple[int, int]] = []
    at = 0
    for piece in re.split(r"([\n;])", text):
        if piece and piece not in "\n;" and piece.strip():
            if _ITEM.match(piece):
                spans.append((at, at + len(piece)))
            elif not spans:
                return None
            else:
                spans[-1] = (spans[-1][0], at + len(piece))
        at += len(piece)
    return spans if len(spans) > 1 else None


def folded_blocks(text: str, start: int = 0, end: int | None = None) -> Iterator[np.ndarray]:
    """The folded, skipped code points of a span, a block at a time."""
    table, several = fold_table()
    end = len(text) if end is None else end
    for at in range(start, end, BLOCK):
        codes = code_points(text[at : min(at + BLOCK, end)])
        out = table[codes]
        if several and codes.size and codes.max() > 127:
            many = [i for i in np.flatnonzero(codes > 127) if int(codes[i]) in several]
            if many:
                parts, last = [], 0
                for i in many:
                    parts += [out[last:i], np.array(several[int(codes[i])], dtype=np.uint32)]
                    last = i + 1
                out = np.concatenate([*parts, out[last:]])
        yield out[out != SKIP]


def _terms(codes: np.ndarray) -> np.ndarray:
    return mix(codes.astype(np.uint64) + _GOLD)


def _finish(value: np.ndarray, length: np.ndarray) -> np.ndarray:
    return mix(value + length.astype(np.uint64) * _GOLD)


def rolling_hash(text: str, start: int = 0, end: int | None = None) -> int:
    """Polynomial hash of a span's folded stream, a block at a time."""
    value, length = 0, 0
    for block in folded_blocks(text, start, end):
        n = len(block)
        if n:
            part = int((_terms(block) * powers(n)).sum(dtype=np.uint64))
            value = (value + part * pow(_BASE, length, 1 << 64)) & _FULL
            length += n
    return int(_finish(np.array([value], dtype=np.uint64), np.array([length]))[0])


def hash_texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes in the written order, regardless of field order, and which texts are field sets.

    The texts run through the table as one stream; equal to
    :func:`rolling_hash` of each text and of each field.
    """
    n = len(texts)
    size = np.array([len(t) for t in texts], dtype=np.int64)
    first = np.cumsum(size) - size
    codes = code_points("".join(texts))
    table, several = fold_table()
    folded = table[codes]
    width = (folded != SKIP).astype(np.int64)
    many = [i for i in np.flatnonzero(codes > 127).tolist() if int(codes[i]) in several] if codes.size and codes.max() > 127 else []
    for i in many:
        width[i] = len(several[int(codes[i])])
    place = np.concatenate([[0], np.cumsum(width)])  # where each code point's folded ones begin
    stream = np.repeat(folded, width)
    for i in many:
        stream[place[i] : place[i + 1]] = several[int(codes[i])]
    terms = _terms(stream)
    raw = _spans_hash(terms, place[first], place[first + size])
    owner, a, b = [], [], []
    for i, t in enumerate(texts):
        for x, y in (fields_of(t) if ":" in t else None) or ():
            owner.append(i)
            a.append(first[i] + x)
            b.append(first[i] + y)
    free, is_set = raw.copy(), np.zeros(n, dtype=bool)
    if owner:
        owner = np.array(owner)
        items = _spans_hash(terms, place[np.array(a)], place[np.array(b)])
        begin = np.flatnonzero(np.diff(owner, prepend=-1))
        sets = owner[begin]
        is_set[sets] = True
        free[sets] = _finish(np.add.reduceat(items, begin), np.diff(np.append(begin, len(owner))))
    return raw, free, is_set


def _spans_hash(terms: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    size = end - start
    value = np.zeros(len(size), dtype=np.uint64)
    some = size > 0
    if some.any():
        count = size[some]
        lead = np.cumsum(count) - count
        place = np.arange(int(count.sum())) - np.repeat(lead, count)
        value[some] = np.add.reduceat(terms[np.repeat(start[some], count) + place] * powers(int(count.max()))[place], lead)
    return _finish(value, size)


class _Stream:
    """Folded code points of spans, to be consumed in step with another stream."""

    def __init__(self, text: str, spans: list[tuple[int, int]]):
        self._blocks = (b for a, e in spans for b in folded_blocks(text, a, e))
        self._left = np.zeros(0, dtype=np.uint32)

    def peek(self) -> np.ndarray | None:
        while not len(self._left):
            nxt = next(self._blocks, None)
            if nxt is None:
                return None
            self._left = nxt
        return self._left

    def advance(self, n: int) -> None:
        self._left = self._left[n:]


def same_stream(a: _Stream, b: _Stream) -> bool:
    """Two pointers run over both streams, skipping alike, until they differ or end."""
    while True:
        x, y = a.peek(), b.peek()
        if x is None or y is None:
            return x is None and y is None
        n = min(len(x), len(y))
        if not np.array_equal(x[:n], y[:n]):
            return False
        a.advance(n)
        b.advance(n)


def _sorted_spans(text: str) -> list[tuple[int, int]] | None:
    spans = fields_of(text)
    return sorted(spans, key=lambda s: rolling_hash(text, *s)) if spans else None


def same_answer(a: str | None, b: str | None) -> bool:
    """Equal apart from white space, case, punctuation and field order."""
    a, b = a or "", b or ""
    if a == b:
        return True
    whole = same_stream(_Stream(a, [(0, len(a))]), _Stream(b, [(0, len(b))]))
    if whole:
        return True
    x, y = _sorted_spans(a), _sorted_spans(b)
    if x is None or y is None or len(x) != len(y):
        return False
    return all(same_stream(_Stream(a, [s]), _Stream(b, [t])) for s, t in zip(x, y))


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = [[t or "" for t in batch.column(k).to_pylist()] for k in (1, 2)]
        for lo, hi in slices([a + b for a, b in zip(*both)]):
            out = [batch.column(0).slice(lo, hi - lo)]
            for texts in both:
                raw, free, is_set = hash_texts(texts[lo:hi])
                out += [pa.array(signed(raw)), pa.array(signed(free)), pa.array(is_set)]
            yield pa.RecordBatch.from_arrays(out, names=_HASHED)


_HASHED = ["id", "c_raw", "c_free", "c_set", "r_raw", "r_free", "r_set"]
_HASHED_DDL = "id long, c_raw long, c_free long, c_set boolean, r_raw long, r_free long, r_set boolean"


def _labels(hashed: DataFrame, k: str, materialise) -> DataFrame:
    """``{k}_raw, {k}``: one label for all written orders of a field set and for what is written like one.

    Answers are equal if they have the same stream or the same items; a
    label covers all that such steps connect. Mostly one step does; where a
    stream is read as several sets, labels spread until nothing changes.
    """
    raw, free = f"{k}_raw", f"{k}_free"
    edges = materialise(hashed.where(f"{k}_set").select(raw, free).distinct(), "outward-edges")
    spread = lambda e: e.join(e.groupBy(free).agg(F.min("m").alias("_f")), free).select(raw, free, F.least("m", "_f").alias("m"))
    current = spread(edges.withColumn("m", F.col(raw)))
    if not edges.groupBy(raw).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        current = materialise(current, "outward-labels")
        for _ in range(ROUNDS):
            by_raw = current.join(current.groupBy(raw).agg(F.min("m").alias("_r")), raw).select(raw, free, F.least("m", "_r").alias("m"))
            # a label is a stream itself; its own label is at most that
            jump = current.groupBy(F.col(raw).alias("m")).agg(F.min("m").alias("_j"))
            following = materialise(spread(by_raw.join(jump, "m", "left").select(raw, free, F.coalesce("_j", "m").alias("m"))), "outward-labels")
            done = following.join(current, [raw, free]).where(following["m"] != current["m"]).isEmpty()
            release(current)
            current = following
            if done:
                break
    return current.groupBy(raw).agg(F.min("m").alias(k)).where(F.col(raw) != F.col(k))


class _Forms:
    """The distinct forms of one group of records, by the hashes of their answers."""

    def __init__(self):
        self.by_key: dict[tuple, list[tuple[int, str, str]]] = {}

    def add(self, rep: int | None, keys: list[tuple], chosen: str, rejected: str) -> tuple[list[int], bool]:
        """Classes of verified equal records, and whether this is a new form (then kept under ``rep`` or its class)."""
        found, new = [], False
        for key in keys:
            match = next((r for r, a, b in self.by_key.get(key, ()) if same_answer(a, chosen) and same_answer(b, rejected)), None)
            if match is None:
                new = True
            else:
                found.append(match)
        if new:
            own = rep if not found else min(found)
            for key in keys:
                self.by_key.setdefault(key, []).append((own, chosen, rejected))
        return found, new


def _keys(c_raw: int, c_free: int, c_set: bool, r_raw: int, r_free: int, r_set: bool) -> list[tuple]:
    chosen, rejected = [(0, c_raw)] + [(1, c_free)] * c_set, [(0, r_raw)] + [(1, r_free)] * r_set
    return [(*x, *y) for x in chosen for y in rejected]


_COLUMNS = ("c", "r", "id", *_HASHED[1:], "chosen", "rejected")


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (c, r, id) to (id, rep); a row that shows a new form comes out whole."""
    key, forms = None, _Forms()
    for batch in batches:
        rows = list(zip(*(batch.column(n).to_pylist() for n in _COLUMNS)))
        rep, kept = [], []
        for row in rows:
            if key != row[:2]:
                key, forms = row[:2], _Forms()
            found, new = forms.add(row[2], _keys(*row[3:9]), row[9] or "", row[10] or "")
            rep.append(min(found) if found else row[2])
            kept.append(new)
        keep = pa.array(kept, pa.bool_())
        blank = [pc.if_else(keep, batch.column(n), pa.nulls(len(rows), t)) for n, t in (("chosen", pa.string()), ("rejected", pa.string()))]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in _COLUMNS[:9]), *blank, pa.array(rep, pa.int64()), keep], names=[*_COLUMNS, "rep", "form"])


_VERIFIED_DDL = "c long, r long, " + _HASHED_DDL + ", chosen string, rejected string, rep long, form boolean"


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forms sorted by (c, r, id), with the class each has in its part, to (local class, class)."""
    key, forms, root = None, _Forms(), {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def close() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(root), pa.int64()), pa.array([find(x) for x in root], pa.int64())], names=["local", "top"])

    for batch in batches:
        for *row, rep in zip(*(batch.column(n).to_pylist() for n in (*_COLUMNS, "rep"))):
            if key != tuple(row[:2]):
                yield close()
                key, forms, root = tuple(row[:2]), _Forms(), {}
            found, _ = forms.add(rep, _keys(*row[3:9]), row[9] or "", row[10] or "")
            for other in [rep, *found]:
                a, b = find(rep), find(other)
                root[max(a, b)] = min(a, b)
    yield close()


def outward_duplicates(records: DataFrame, materialise) -> DataFrame:
    """Every record with the smallest id of its set of outwardly equal records.

    ``records``: ``id, chosen, rejected`` (texts may be null). Returns ``id,
    rep`` for all records that have at least one copy, ``rep = id`` for the
    smallest. ``materialise`` writes an intermediate table durably.

    Defined cases: null and empty texts are equal to each other and to texts
    of white space and punctuation only; ids are unique, rows without id are
    left out; extra columns are ignored; an empty table gives an empty result; long texts are streamed.

    Two answers are equal if they have the same stream or, as field sets, the
    same items; records that such steps connect are one set.

    Scale: hashes are 50 bytes a record; only records whose hashes recur send
    their texts, once. A set of copies is verified in as many tasks as it has
    ``COPIES_A_TASK``, each of which keeps the distinct forms it meets and
    looks them up by hash; the forms alone (dress does not count) are
    compared in a second, small step.
    """
    texts = scan_slices(records.where(F.col("id").isNotNull()).select(F.col("id").cast("long").alias("id"), "chosen", "rejected"))
    hashed = materialise(texts.mapInArrow(_hash_batches, _HASHED_DDL), "outward-hashes")
    keyed = hashed
    for k in ("c", "r"):
        keyed = salted_join(keyed, _labels(hashed, k, materialise), [f"{k}_raw"], "left", spread_by="id", keys_of=hashed).withColumn(k, F.coalesce(k, f"{k}_raw"))
    keyed = materialise(keyed, "outward-keys")
    again = keyed.groupBy("c", "r").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    members = salted_join(keyed, again, ["c", "r"], spread_by="id").join(texts, "id")
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("_n") / COPIES_A_TASK))
    near = members.withColumn("_part", part).repartition("c", "r", "_part").sortWithinPartitions("c", "r", "id")
    # one (c, r) may meet several parts in a partition; that only makes its forms fewer
    local = materialise(near.select(*_COLUMNS).mapInArrow(_verify, _VERIFIED_DDL), "outward-local")
    top = local.where("form").select(*_COLUMNS, "rep").repartition("c", "r").sortWithinPartitions("c", "r", "id").mapInArrow(_unite, "local long, top long")
    joined = salted_join(local.select("id", F.col("rep").alias("local")), top, ["local"], "inner", spread_by="id")
    final = materialise(joined.select("id", F.col("top").alias("rep")), "outward-classes")
    release(hashed, keyed, local)
    real = final.groupBy("rep").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    return salted_join(final, real, ["rep"], "left_semi", spread_by="id").select("id", "rep")

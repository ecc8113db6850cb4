"""Problem 6: evaluation texts leaking into training text.

Latent semantic retrieval: documents and items are cut into overlapping
passages, weighted by TF-IDF and projected to the leading right singular
vectors, found by a distributed randomised SVD. The item passages lie in an
inverted index of latent clusters; document passages look into the clusters
next to them, and pairs whose cosine is high are candidates; those are checked for a common run of words, and, for
paraphrases, for a long common subsequence and the item's answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.kernels import WordSlice, mix, shingles, slices
from millrace.session import scan_slices

#: Hashed features and latent dimensions (and extra ones of the range finder).
FEATURE_BITS, LATENT, EXTRA = 14, 128, 8
#: Words a document passage and words between starts: every run of RUN words
#: lies inside one passage.
PASSAGE, STEP = 24, 12
#: Words that must run in common, and words between starts of item passages.
RUN, ITEM_STEP = 12, 6
#: Least cosine of a candidate.
COSINE = 0.5
#: Clusters of item passages that a document passage looks into.
PROBES = 8
#: Documents from which the projection is fitted (a bound, not a share).
FIT_DOCUMENTS = 3_000
#: Items a search; more items are searched in further blocks.
ITEM_BLOCK = 5_000

# Paraphrases: least cosine and number of passages, and least share of the
# item's words in the longest common subsequence with and without its answer.
NEAR_COSINE, NEAR_PASSAGES = 0.6, 3
SUBSEQUENCE_WITH_ANSWER, SUBSEQUENCE_ALONE = 0.6, 0.75

_D = 1 << FEATURE_BITS


def features(words: WordSlice) -> np.ndarray:
    return (mix(words.hash) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def passages(words: WordSlice, size: int, step: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passages of ``size`` words: text, first word, number of words.

    The last passage of a text ends with it; texts of fewer than ``least``
    words have none.
    """
    n = np.diff(words.first)
    count = np.where(n < least, 0, np.where(n <= size, 1, 1 - (-(n - size) // step)))
    text = np.repeat(np.arange(words.n), count)
    k = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    begin = words.first[text] + np.minimum(k * step, np.maximum(n[text] - size, 0))
    return text, begin, np.minimum(size, n[text])


def weighted(words: WordSlice, begin: np.ndarray, length: np.ndarray, size: int, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and unit-length TF-IDF weights of passages (``size`` columns)."""
    own = np.append(features(words), 0)
    at = begin[:, None] + np.arange(size)
    inside = np.arange(size) < length[:, None]
    feature = own[np.where(inside, at, len(own) - 1)]
    weight = np.where(inside, idf[feature], 0).astype(np.float32)
    return feature, weight / (np.sqrt((weight**2).sum(axis=1, keepdims=True)) + 1e-9)


def times(feature: np.ndarray, weight: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Sparse passages times a dense matrix."""
    out = np.zeros((len(feature), matrix.shape[1]), dtype=np.float32)
    for j in range(feature.shape[1]):
        out += weight[:, j, None] * matrix[feature[:, j]]
    return out


def transposed_times(feature: np.ndarray, weight: np.ndarray, dense: np.ndarray) -> np.ndarray:
    """Transposed sparse passages times a dense matrix, a few thousand rows at a time."""
    out = np.zeros((_D, dense.shape[1]), dtype=np.float32)
    for a in range(0, len(feature), 2000):
        f = feature[a : a + 2000].ravel()
        part = (weight[a : a + 2000, :, None] * dense[a : a + 2000, None, :]).reshape(len(f), -1)
        order = np.argsort(f, kind="stable")
        f = f[order]
        first = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]]))
        out[f[first]] += np.add.reduceat(part[order], first, axis=0)
    return out


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each hashed feature, over all documents, and their number.

    The result has a fixed size (one number a feature), whatever the input.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(_D, dtype=np.int64), 0
        for batch in batches:
            own = [t or "" for t in batch.column(0).to_pylist()]
            n += len(own)
            for lo, hi in slices(own):
                words = WordSlice(own[lo:hi])
                total += np.bincount(np.unique(words.rows() * _D + features(words)) % _D, minlength=_D)
        have = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(have, -1), pa.int32()), pa.array(np.append(total[have], n), pa.int64())], names=["feature", "n"])

    counted = texts.mapInArrow(run, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(_D)
    real = counted["feature"] >= 0
    df[counted["feature"][real]] = counted["n"][real]
    return df, int(counted["n"][~real].sum())


def _gram_pass(sample: DataFrame, idf: np.ndarray, basis: np.ndarray, project: bool) -> np.ndarray:
    """``A' A basis``, or ``(A basis)' (A basis)``, summed over the sample's partitions."""
    sent = sample.sparkSession.sparkContext.broadcast((idf, basis))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, basis = sent.value
        total = np.zeros((basis.shape[1] if project else _D, basis.shape[1]), dtype=np.float32)
        for batch in batches:
            own = [t or "" for t in batch.column(0).to_pylist()]
            for lo, hi in slices(own):
                words = WordSlice(own[lo:hi])
                _, begin, length = passages(words, PASSAGE, PASSAGE, RUN)
                feature, weight = weighted(words, begin, length, PASSAGE, idf)
                y = times(feature, weight, basis)
                total += y.T @ y if project else transposed_times(feature, weight, y)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["m"])

    shape = (basis.shape[1] if project else _D, basis.shape[1])
    total = np.zeros(shape, dtype=np.float32)
    for row in sample.mapInArrow(run, "m binary").toLocalIterator():
        total += np.frombuffer(row["m"], dtype=np.float32).reshape(shape)
    sent.unpersist()
    return total


def fit_projection(texts: DataFrame, n_documents: int, idf: np.ndarray, materialise, sample: int = FIT_DOCUMENTS, parts: int = 4, rounds: int = 2, seed: int = 7) -> np.ndarray:
    """Leading right singular vectors of the TF-IDF passages of a bounded sample.

    ``texts``: ``key, text``. About ``sample`` texts, chosen by a hash of
    ``key``, lie in ``parts`` partitions; each pass multiplies where they lie
    and sums one fixed-size matrix a partition.
    """
    share = min(1.0, sample / max(n_documents, 1))
    part = texts.where(F.pmod(F.xxhash64("key", F.lit(6)), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    part = materialise(part.select("text").repartition(parts), "leak-sample")
    basis = np.random.default_rng(seed).standard_normal((_D, LATENT + EXTRA)).astype(np.float32)
    for _ in range(rounds + 1):
        basis, _r = np.linalg.qr(_gram_pass(part, idf, basis, False))
    values, rotation = np.linalg.eigh(_gram_pass(part, idf, basis, True))
    return (basis @ rotation[:, ::-1][:, :LATENT]).astype(np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    return x / (np.linalg.norm(x, axis=1, keepdims=True) + 1e-9)


def document_passages(words: WordSlice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and number of words of the passages of ``PASSAGE`` words, a step apart.

    Every run of ``RUN`` words lies inside one; the last of a text may be
    shorter; texts of fewer than ``RUN`` words have none.
    """
    n = np.diff(words.first)
    count = np.where(n < RUN, 0, np.maximum(-(-n // STEP) - 1, 1))
    text = np.repeat(np.arange(words.n), count)
    begin = words.first[text] + (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * STEP
    return text, begin, np.minimum(PASSAGE, words.first[text + 1] - begin)


def document_latent(words: WordSlice, matrix: np.ndarray, part: int = 20_000) -> np.ndarray:
    """Unit latent vectors of :func:`document_passages`.

    Words are projected once, in blocks of ``STEP``; a passage is the sum of
    the two blocks it covers. ``matrix`` holds the weighted projection.
    """
    n = np.diff(words.first)
    blocks = np.where(n < RUN, 0, -(-n // STEP))
    text = np.repeat(np.arange(words.n), blocks)
    begin = words.first[text] + (np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * STEP
    size = np.minimum(STEP, words.first[text + 1] - begin)
    feature = features(words)
    out = np.empty((len(text), matrix.shape[1]), dtype=np.float32)
    for a in range(0, len(text), part // STEP):
        b = slice(a, a + part // STEP)
        lead = np.cumsum(size[b]) - size[b]
        at = np.repeat(begin[b] - lead, size[b]) + np.arange(int(size[b].sum()))
        out[b] = np.add.reduceat(matrix[feature[at]], lead, axis=0)
    # a passage for each block that has a successor, and for the only block of a text
    has_next = np.append(text[1:] == text[:-1], False) if len(text) else np.zeros(0, dtype=bool)
    only = ~has_next & ~np.append(False, has_next[:-1]) if len(text) else has_next
    first = np.flatnonzero(has_next | only)
    own = out[first]
    pair = has_next[first]
    own[pair] += out[first[pair] + 1]
    return unit(own)


def clusters(latent: np.ndarray, seed: int = 5, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Unit centres of about the square root of as many clusters, and the cluster of each row."""
    n = len(latent)
    rng = np.random.default_rng(seed)
    centres = latent[rng.choice(n, max(1, int(n**0.5)), replace=False)]
    for _ in range(rounds):
        nearest = np.concatenate([(latent[a : a + 4096] @ centres.T).argmax(axis=1) for a in range(0, n, 4096)])
        total = np.zeros_like(centres)
        np.add.at(total, nearest, latent)
        lost = ~total.any(axis=1)
        total[lost] = centres[lost]
        centres = unit(total)
    return centres, np.concatenate([(latent[a : a + 4096] @ centres.T).argmax(axis=1) for a in range(0, n, 4096)])


class ItemIndex:
    """Latent vectors in clusters, word runs and words of one block of items."""

    def __init__(self, ids: list[int], texts: list[str], answers: list[str], matrix: np.ndarray):
        words = WordSlice(texts)
        text, begin, length = passages(words, RUN, ITEM_STEP, RUN)
        total = np.concatenate([np.zeros((1, matrix.shape[1])), np.cumsum(matrix[features(words)], axis=0, dtype=np.float64)])
        latent = unit((total[begin + length] - total[begin]).astype(np.float32))
        self.n_passages = np.bincount(text, minlength=len(texts))
        self.centres, self.lists = np.zeros((0, matrix.shape[1]), dtype=np.float32), []
        if len(latent):
            self.centres, nearest = clusters(latent)
            for k in range(len(self.centres)):
                own = np.flatnonzero(nearest == k)
                item, first = np.unique(text[own], return_index=True)  # passages are in order of items
                self.lists.append((latent[own].T.copy(), item, first))
        self.ids = np.array(ids, dtype=np.int64)
        value, row = shingles(words, RUN)
        self.runs = np.unique(value ^ mix(row.astype(np.uint64)))
        self.any_run = np.unique(value)
        self.words = [words.hash[words.first[i] : words.first[i + 1]] for i in range(len(texts))]
        self.places = [_places(w) for w in self.words]
        own = WordSlice(answers)
        self.answers = [own.hash[own.first[i] : own.first[i + 1]] for i in range(len(texts))]

    def search(self, latent: np.ndarray, probes: int = PROBES, least: float = COSINE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Passage, item and cosine of the pairs that reach ``least``, in order of both, once each."""
        found, cosines = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.float32)]
        for a in range(0, len(latent) if self.lists else 0, 8192):
            part = latent[a : a + 8192]
            near = part @ self.centres.T
            k = min(probes, near.shape[1])
            lists = np.argpartition(near, near.shape[1] - k, axis=1)[:, -k:]
            order = np.argsort(lists, axis=None, kind="stable")
            edges = np.searchsorted(lists.ravel()[order], np.arange(len(self.lists) + 1))
            for one in range(len(self.lists)):
                rows = order[edges[one] : edges[one + 1]] // k
                vectors, item, first = self.lists[one]
                if len(rows) and len(item):
                    cosine = np.maximum.reduceat(part[rows] @ vectors, first, axis=1)
                    i, j = np.nonzero(cosine >= least)
                    found.append((a + rows[i]) * len(self.ids) + item[j])
                    cosines.append(cosine[i, j])
        found, cosines = np.concatenate(found), np.concatenate(cosines)
        order = np.argsort(found, kind="stable")
        found, cosines = found[order], cosines[order]
        first = np.flatnonzero(np.diff(found, prepend=-1))
        if len(first):
            found, cosines = found[first], np.maximum.reduceat(cosines, first)
        return found // len(self.ids), found % len(self.ids), cosines


def _places(words: np.ndarray) -> dict[int, int]:
    """For each word a number whose bits are its places."""
    out: dict[int, int] = {}
    for i, w in enumerate(words.tolist()):
        out[w] = out.get(w, 0) | 1 << i
    return out


def common_subsequence(places: dict[int, int], n: int, b: list[int]) -> int:
    """Length of the longest common subsequence of ``n`` words with the places given and ``b``.

    A row of the table is one number, a bit a word; a step takes constant time for any ``n`` of usual length.
    """
    row = (1 << n) - 1
    for x in b:
        hit = row & places.get(x, 0)
        row = (row + hit) | (row - hit)
    return n - (row & ((1 << n) - 1)).bit_count()


def _holds(words: np.ndarray, answer: np.ndarray) -> bool:
    n = len(answer)
    if not n or n > len(words):
        return False
    return bool(np.all(np.lib.stride_tricks.sliding_window_view(words, n) == answer, axis=1).any())


def _searcher(sent, paraphrases: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, index = sent.value
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            own = [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in slices(own, 400_000):
                words = WordSlice(own[lo:hi])
                text, begin, length = document_passages(words)
                if not len(text) or not index.lists:
                    continue
                w, i, cosine = index.search(document_latent(words, matrix))
                doc, item = _runs_in_common(words, index, text, begin, length, w, i)
                kind = ["run"] * len(doc)
                if paraphrases:
                    d, k = _paraphrases(words, index, text, begin, length, w, i, cosine, doc * len(index.ids) + item)
                    doc, item, kind = np.concatenate([doc, d]), np.concatenate([item, k]), kind + ["paraphrase"] * len(d)
                if len(doc):
                    yield pa.RecordBatch.from_arrays([pa.array(keys[lo:hi][doc], pa.int64()), pa.array(index.ids[item]), pa.array(kind)], names=["doc_id", "item_id", "kind"])

    return run


def _runs_in_common(words: WordSlice, index: ItemIndex, text, begin, length, w, i) -> tuple[np.ndarray, np.ndarray]:
    """Texts and items of the candidates (passage ``w``, item ``i``) that share a run of ``RUN`` words."""
    grams, _ = shingles(words, RUN)
    # the first run of each text in ``grams``
    per = np.maximum(np.diff(words.first) - RUN + 1, 0)
    shift = np.cumsum(per) - per - words.first[:-1]
    # a passage none of whose runs is in any item cannot be one of its
    place = np.minimum(np.searchsorted(index.any_run, grams), len(index.any_run) - 1)
    known = np.concatenate([[0], np.cumsum(index.any_run[place] == grams)])
    lead = begin[w] + shift[text[w]]
    some = known[lead + np.maximum(length[w] - RUN + 1, 0)] > known[lead]
    w, i = w[some], i[some]
    # runs that lie inside each candidate passage, for its item
    count = np.maximum(length[w] - RUN + 1, 0)
    pair = np.repeat(np.arange(len(w)), count)
    at = np.repeat(begin[w] + shift[text[w]], count) + (np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count))
    wanted = grams[at] ^ mix(i[pair].astype(np.uint64))
    place = np.minimum(np.searchsorted(index.runs, wanted), len(index.runs) - 1)
    good = np.unique(pair[index.runs[place] == wanted])
    found = np.unique(text[w[good]] * len(index.ids) + i[good])
    return found // len(index.ids), found % len(index.ids)


def _paraphrases(words: WordSlice, index: ItemIndex, text, begin, length, w, i, cosine, found) -> tuple[np.ndarray, np.ndarray]:
    """Texts and items of candidates with enough close passages and a long common subsequence."""
    close = cosine >= NEAR_COSINE
    both, w = (text[w] * len(index.ids) + i)[close], w[close]
    order = np.lexsort((w, both))
    keys, at, count = np.unique(both[order], return_index=True, return_counts=True)
    # short texts and items have fewer passages
    want = np.minimum(np.minimum(np.bincount(text, minlength=words.n)[keys // len(index.ids)], index.n_passages[keys % len(index.ids)]), NEAR_PASSAGES)
    often = (count >= want) & ~np.isin(keys, found)
    doc, item = [], []
    for key, one, last in zip(keys[often].tolist(), w[order][at[often]], w[order][at[often] + count[often] - 1]):
        d, k = divmod(key, len(index.ids))
        n = len(index.words[k])
        part = words.hash[begin[one] : begin[last] + length[last]].tolist()
        share = common_subsequence(index.places[k], n, part) / n
        if share >= SUBSEQUENCE_ALONE or share >= SUBSEQUENCE_WITH_ANSWER and _holds(words.hash[words.first[d] : words.first[d + 1]], index.answers[k]):
            doc.append(d)
            item.append(k)
    return np.array(doc, dtype=np.int64), np.array(item, dtype=np.int64)


def leaked_items(documents: DataFrame, items: DataFrame, materialise, paraphrases: bool = False, sample: int = FIT_DOCUMENTS) -> DataFrame:
    """``doc_id, item_id, kind``: documents that give items away.

    ``documents``: ``doc_id, text``; ``items``: ``item_id, text, answer``.
    ``kind`` is ``run`` (at least ``RUN`` consecutive words in common) or, if
    ``paraphrases``, ``paraphrase``. Each pair comes out once.

    Defined cases: null texts count as empty; texts of fewer than ``RUN``
    words match nothing as a run; equal items are reported each; rows without
    id are left out; extra columns are ignored; empty tables give an empty result; documents are
    read whole, whatever their length.

    Scale: the items are the query set, searched in blocks of ``ITEM_BLOCK``
    against every document in one pass without shuffle; a document passage is
    compared with the item passages of ``PROBES`` clusters only. What is broadcast has
    a fixed size: the projection (2**FEATURE_BITS x LATENT numbers) and one
    block of items. Document frequencies cover all documents; only the
    projection is fitted on a bounded sample.
    """
    spark = documents.sparkSession
    own = scan_slices(documents.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("key"), "text"))
    df, n = document_frequencies(own.select("text"))
    idf = np.maximum(np.log((n + 1) / (df + 1)), 0.05)
    vectors = fit_projection(own, n, idf, materialise, sample)
    asked = items.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("answer", F.lit("")).alias("answer"))
    matrix = (idf[:, None] * vectors).astype(np.float32)
    blocks = max(1, -(-asked.count() // ITEM_BLOCK))
    out = None
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).orderBy("item_id").collect()  # one block
        index = ItemIndex([r.item_id for r in rows], [r.text for r in rows], [r.answer for r in rows], matrix)
        sent = spark.sparkContext.broadcast((matrix, index))
        one = own.mapInArrow(_searcher(sent, paraphrases), "doc_id long, item_id long, kind string")
        out = one if out is None else out.unionByName(one)
    return out.distinct()

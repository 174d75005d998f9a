"""Toxicity by nearest labelled examples.

Texts are TF-IDF vectors over all their terms (words, and beginnings of words that
stand in for their stems); document frequencies are counted over all documents. A term
whose presence goes clearly with the label, by chi-square over a bounded sample of
labelled rows (``SAMPLE_ROWS`` of the quality classifier, drawn by id hash), weighs more;
no term is left out. A bounded set of labelled examples is kept in an
inverted index with a maximum weight for each block of examples: terms of few examples
as lists of postings, terms of many as dense blocks. A text's short lists are summed
first. The block maxima of its other terms then bound what a block's examples can come
to: blocks that cannot hold one of the nearest are left out, the others are summed,
for several texts at a time, those with the largest bounds first, and the rows that
reach the last place get their exact cosine. The votes of the nearest, weighted by
distance, are calibrated on the examples themselves, each left out of its own search.

The index holds at most ``EXAMPLES`` rows (those with the smallest id hash); it is
the model and travels by broadcast, with the term statistics in ``2**BITS``
counters. All documents are scored, whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import held_out, ship
from .quality import SAMPLE_ROWS, first_rows, logistic_fit, training_sample
from .tokens import chunks, mix, runs, texts_of

BITS = 18
EXAMPLES = 4096
#: Bytes of a word's beginning that are terms beside the word.
STEMS = (4, 5)
#: Least chi-square of a word with the label, one degree of freedom (p below 1e-6).
LEAST_CHI2 = 24.0
#: Least part of a term's training rows that are toxic, at the lower end of its
#: interval at two standard errors (Wilson).
LEAST_SHARE = 0.5
NEAREST = 15
BLOCK = 64
#: A term of more than this part of the examples is held as dense blocks.
DENSE = 1 / 16
#: Texts searched together, and blocks of each that are summed before the others are bounded again.
TOGETHER, AHEAD = 32, 8
#: What single-precision sums may be off.
SLACK = 1e-5
ACCEPT = 0.3
#: Weight of the base rate among the votes.
PRIOR = 0.5


def terms(texts: list[str | None], bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Term numbers of each text and how often they occur."""
    shift = np.uint64(64 - bits)
    for a, b in chunks(texts):
        r = runs(texts[a:b], stems=STEMS)
        number = [(r.hash >> shift).astype(np.int64)]
        doc = [r.doc]
        for k, (n, h) in enumerate(zip(STEMS, r.stems), 1):
            longer = r.chars > n
            number.append((mix(h[longer] + np.uint64(k)) >> shift).astype(np.int64))
            doc.append(r.doc[longer])
        number, doc = np.concatenate(number), np.concatenate(doc)
        kinds, times = np.unique(doc << bits | number, return_counts=True)
        cut = np.searchsorted(kinds >> bits, np.arange(b - a + 1))
        kinds &= (1 << bits) - 1
        for i, j in zip(cut[:-1], cut[1:]):
            yield kinds[i:j], times[i:j]


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = np.zeros((2, 1 << BITS), np.int64), np.zeros(2, np.int64)
    for batch in batches:
        y = batch.column(batch.schema.get_field_index("y")).to_pylist()
        for k, (found, _) in zip(y, terms(texts_of(batch))):
            total[k, found] += 1
            rows[k] += 1
    found = np.flatnonzero(total.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(found, -1).astype(np.int32)), *[pa.array(np.append(t[found], n)) for t, n in zip(total, rows)]],
        ["term", "n0", "n1"])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = np.zeros(1 << BITS, np.int64), 0
    for batch in batches:
        for found, _ in terms(texts_of(batch)):
            total[found] += 1
            rows += 1
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(found, -1).astype(np.int32)), pa.array(np.append(total[found], rows))],
                                     ["term", "n"])


@dataclass
class Index:
    """Examples in rows; postings by term and block in row order."""

    weight: np.ndarray  # by term number; 0 where no document has the term
    ids: np.ndarray
    y: np.ndarray
    base: float
    rows: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))  # postings of the terms of few examples
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))
    posts: np.ndarray = field(default_factory=lambda: np.zeros((1 << BITS) + 1, np.int64))  # by term: its first posting, and the end
    common: np.ndarray = field(default_factory=lambda: np.full(1 << BITS, -1, np.int32))  # by term: its dense number
    dense: np.ndarray = field(default_factory=lambda: np.zeros((0, 0, BLOCK), np.float32))  # by block and dense number
    tops: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))  # largest weights of its blocks
    # the dense terms of each row once more, in double precision
    row_first: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    row_terms: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    row_values: np.ndarray = field(default_factory=lambda: np.zeros(0))
    slope: float = 1.0
    shift: float = 0.0

    def vector(self, found: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weight = self.weight[found]
        own = weight > 0
        value = (1 + np.log(times[own])) * weight[own]
        return found[own], value / (float(np.sqrt(value @ value)) or 1.0)

    def build(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> None:
        n = len(vectors)
        row = np.repeat(np.arange(n, dtype=np.int32), [len(f) for f, _ in vectors])
        word = np.concatenate([f for f, _ in vectors] or [np.zeros(0, np.int64)])
        value = np.concatenate([v for _, v in vectors] or [np.zeros(0)])
        held = np.bincount(word, minlength=1 << BITS)
        often = np.flatnonzero(held > DENSE * n)
        self.common[often] = np.arange(len(often))
        blocks = -(-n // BLOCK)
        self.dense = np.zeros((blocks, len(often), BLOCK), np.float32)
        many = self.common[word] >= 0
        self.dense[row[many] // BLOCK, self.common[word[many]], row[many] % BLOCK] = value[many]
        self.tops = self.dense.max(axis=2).T
        self.row_first = np.searchsorted(row[many], np.arange(n + 1))
        self.row_terms, self.row_values = self.common[word[many]], value[many]
        word, row, value = word[~many], row[~many], value[~many]
        order = np.lexsort((row, word))
        self.rows, self.values = row[order], value[order]
        self.posts = np.searchsorted(word[order], np.arange((1 << BITS) + 1))

    def nearest(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int = NEAREST,
                without: list[int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each vector the rows and cosines of the ``k`` nearest examples that share a
        term, nearest first, ties to the smaller id; ``without``: not this row."""
        for a in range(0, len(vectors), TOGETHER):
            yield from self._nearest(vectors[a : a + TOGETHER], k, without[a : a + TOGETHER] if without else None)

    def _nearest(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int,
                 without: list[int] | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        n, (blocks, _, block) = len(self.ids), self.dense.shape
        width = blocks * block
        lists = np.zeros((len(vectors), width))
        asked = np.zeros((len(vectors), self.dense.shape[1]))
        for t, (found, value) in enumerate(vectors):
            number = self.common[found]
            many = number >= 0
            asked[t, number[many]] = value[many]
            few = found[~many]
            post, of = _ranges(self.posts[few], self.posts[few + 1])
            lists[t] = np.bincount(self.rows[post], self.values[post] * value[~many][of], width)
            if without is not None:
                lists[t, without[t]] = -9.0
        sums, single = lists.astype(np.float32), asked.astype(np.float32)
        bound = single @ self.tops
        summed = np.zeros(bound.shape, bool)
        for last in (False, True):
            kth = np.maximum(self._kth(sums, k, n), 0)[:, None]
            most = sums.reshape(len(vectors), blocks, block).max(axis=2) + bound
            open_ = ~summed & (most > 0) & (most >= kth - SLACK)
            if not last and bound.shape[1] > AHEAD:
                edge = np.partition(most, bound.shape[1] - AHEAD, axis=1)[:, bound.shape[1] - AHEAD][:, None]
                open_ &= most >= edge
            for b in np.flatnonzero(open_.any(axis=0)).tolist():
                of = np.flatnonzero(open_[:, b])
                sums[of, b * block : (b + 1) * block] += single[of] @ self.dense[b]
            summed |= open_
        kth = np.maximum(self._kth(sums, k, n), 0)
        whole = np.repeat(summed | (bound == 0), block, axis=1)[:, :n]
        for t in range(len(vectors)):
            rows = np.flatnonzero(whole[t] & (sums[t, :n] > 0) & (sums[t, :n] >= kth[t] - SLACK))
            at, of = _ranges(self.row_first[rows], self.row_first[rows + 1])
            cosines = lists[t, rows] + np.bincount(of, self.row_values[at] * asked[t, self.row_terms[at]], len(rows))
            best = np.lexsort((self.ids[rows], -np.round(cosines, 12)))[:k]
            yield rows[best], cosines[best]

    @staticmethod
    def _kth(sums: np.ndarray, k: int, n: int) -> np.ndarray:
        """The k-th largest sum of each text: no more than its k-th largest cosine."""
        return np.partition(sums, sums.shape[1] - k, axis=1)[:, sums.shape[1] - k] if n >= k else np.zeros(len(sums), np.float32)

    def vote(self, rows: np.ndarray, cosines: np.ndarray) -> float:
        """Share of toxic votes, each weighing its closeness over its distance, with the
        base rate as one more vote, as log-odds."""
        weight = cosines / (1.05 - np.minimum(cosines, 1.0))
        share = (float(weight @ self.y[rows]) + PRIOR * self.base) / (float(weight.sum()) + PRIOR)
        share = min(max(share, 1e-4), 1 - 1e-4)
        return float(np.log(share / (1 - share)))

    def probability(self, vote: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * vote + self.shift, -30, 30))))


def _ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges one after another, and the range each is of."""
    size = end - start
    of = np.repeat(np.arange(len(size)), size)
    return np.arange(len(of)) + (start - (np.cumsum(size) - size))[of], of


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", examples: int = EXAMPLES) -> Index | None:
    """None where there are not both classes to learn from."""
    known = training_sample(docs, labels, label, SAMPLE_ROWS)
    counted = (known.mapInArrow(_classes, "term int, n0 long, n1 long").groupBy("term")
               .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow())  # at most 2^BITS + 1 rows
    term, n0, n1 = (counted.column(c).to_numpy() for c in ("term", "n0", "n1"))
    t0, t1 = (int(x[term < 0].sum()) for x in (n0, n1))
    if min(t0, t1) == 0:
        return None
    term, n0, n1 = (x[term >= 0] for x in (term, n0, n1))
    both = n0 + n1
    part = both * (t0 + t1 - both) * float(t0) * t1
    chi2 = np.divide((n1 * float(t0) - n0 * float(t1)) ** 2 * (t0 + t1), part, out=np.zeros(len(term)), where=part > 0)
    share = n1 / both
    surely = (share + 2 / both - 2 * np.sqrt(share * (1 - share) / both + 1 / both**2)) / (1 + 4 / both)
    marked = (surely >= LEAST_SHARE) & (chi2 >= LEAST_CHI2)
    factor = np.ones(1 << BITS)
    factor[term[marked]] += np.sqrt(chi2[marked])
    counted = (docs.select("text").mapInArrow(_frequencies, "term int, n long").groupBy("term")
               .agg(F.sum("n").alias("n")).toArrow())  # at most 2^BITS + 1 rows
    term, n = counted.column("term").to_numpy(), counted.column("n").to_numpy()
    idf = np.zeros(1 << BITS)
    idf[term[term >= 0]] = np.log((int(n[term < 0].sum()) + 1) / (n[term >= 0] + 1)) + 1
    drawn = (first_rows(known, examples, t0 + t1)
             .mapInArrow(_vectors, "doc_id long, found array<int>, times array<int>, y int, place long"))
    drawn = drawn.toArrow().sort_by([("place", "ascending"), ("doc_id", "ascending")]).slice(0, examples)
    index = Index(idf * factor, drawn.column("doc_id").to_numpy(), drawn.column("y").to_numpy().astype(float), t1 / (t0 + t1))
    vectors = [index.vector(np.array(f, np.int64), np.array(c, float))
               for f, c in zip(drawn.column("found").to_pylist(), drawn.column("times").to_pylist())]
    # like rows side by side, so that the blocks' bounds are tight
    order = sorted(range(len(vectors)), key=lambda i: tuple(vectors[i][0][np.argsort(-vectors[i][1])][:2]))
    index.ids, index.y = index.ids[order], index.y[order]
    vectors = [vectors[i] for i in order]
    index.build(vectors)
    votes = np.array([index.vote(*near) for near in index.nearest(vectors, without=list(range(len(vectors))))])
    index.slope, index.shift = logistic_fit(votes, index.y)
    return index


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = list(terms(texts_of(batch)))
        part = {n: batch.column(batch.schema.get_field_index(n)) for n in ("doc_id", "y", "place")}
        yield pa.RecordBatch.from_arrays(
            [part["doc_id"].cast(pa.int64()), pa.array([f.astype(np.int32) for f, _ in pairs], pa.list_(pa.int32())),
             pa.array([c.astype(np.int32) for _, c in pairs], pa.list_(pa.int32())), part["y"].cast(pa.int32()),
             part["place"]], ["doc_id", "found", "times", "y", "place"])


def score(docs: DataFrame, labels: DataFrame, label: str = "toxic", accept: float = ACCEPT,
          examples: int = EXAMPLES) -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence`` of every row: evidence holds
    the ids of the nearest examples, nearest first.

    Null or empty text, or one without a term of an example: the calibrated base
    rate, no evidence. Null id: not learned from. Repeated rows: each is scored. No
    usable labels: score 0, no evidence. Empty table: empty result."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, label, examples))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            values, evidence = [], []
            vectors = [index.vector(found, times) for found, times in terms(texts_of(batch))] if index else []
            for rows, cosines in index.nearest(vectors) if index else ():
                values.append(index.probability(index.vote(rows, cosines)))
                evidence.append(index.ids[rows])
            if not index:
                values, evidence = [0.0] * batch.num_rows, [[]] * batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), pa.array(values, pa.float64()),
                 pa.array(evidence, pa.list_(pa.int64()))], ["doc_id", "score", "evidence"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").mapInArrow(scored, f"doc_id {kind}, score double, evidence array<long>")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= accept).cast("int").alias("predicted"), "evidence")

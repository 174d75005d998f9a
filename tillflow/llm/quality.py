"""Quality classifier: naive Bayes support vectors.

Indicators of n-grams (words, gaps between words, pairs of gaps, triples of word
shapes, runs of one word) are scaled by their class log-count ratio; a linear
hinge-loss model on the scaled, length-normalised rows is fitted by dual
coordinate descent and its margins are mapped to probabilities by a logistic curve
fitted on margins of rows left out of the fit.

The class counts are taken over a bounded sample of ``SAMPLE_ROWS`` labelled
training rows and the hinge-loss fit over ``FIT_ROWS`` of them, those with the
smallest id hash. Every document is scored, whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .frames import held_out, pack, ship, unpack, written
from .tokens import Runs, chunks, mix, runs, texts_of

BITS = 18
SAMPLE_ROWS = 12288
FIT_ROWS = 4096
#: An n-gram on fewer training rows has no ratio (weight 0).
MIN_ROWS = 4
EPOCHS = 20
PENALTY = 1.0
ACCEPT = 0.7


def indicators(r: Runs, bits: int = BITS) -> Iterator[np.ndarray]:
    """Distinct feature numbers of each text."""
    size = np.uint64(64 - bits)
    n = len(r.hash)

    def number(h: np.ndarray, kind: int) -> np.ndarray:
        return (mix(h + np.uint64(kind)) >> size).astype(np.int64)

    upper = r.raw != r.hash
    shape = np.where(upper, np.uint64(2), np.uint64(1)) * np.uint64(4) + np.minimum(r.chars, 3).astype(np.uint64)
    same = np.zeros(n, bool)
    same[1:] = (r.hash[1:] == r.hash[:-1]) & (r.doc[1:] == r.doc[:-1])
    run = np.zeros(n, np.uint64)
    for _ in range(4):  # words of a run so far, up to 5
        run = np.where(same, np.roll(run, 1) + np.uint64(1), np.uint64(0))
    word = number(r.hash, 1)
    gap = number(r.gap, 2)
    gaps = number(r.gap * np.uint64(31) + np.roll(r.gap, -1), 3)
    shapes = number(shape * np.uint64(10007) + np.roll(shape, -1) * np.uint64(101) + np.roll(shape, -2), 4)
    runs_ = number(run, 5)
    seen = np.zeros(1 << bits, bool)
    for a, b in zip(r.first[:-1], r.first[1:]):
        parts = [word[a:b], gap[a:b], gaps[a : max(a, b - 1)], shapes[a : max(a, b - 2)], runs_[a:b]]
        for p in parts:
            seen[p] = True
        found = np.flatnonzero(seen)
        seen[found] = False
        yield found


@dataclass
class Model:
    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, found: np.ndarray) -> float:
        x = self.ratio[found]
        norm = float(np.sqrt(x @ x)) or 1.0
        margin = float(self.weight[found] @ x) / norm + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30))))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """``doc_id, text, y, place`` of at most about ``1.2 * rows`` labelled rows that may
    be learned from, those with the smallest id hash (``place``), one for each id (the
    larger label, the last text). The sample's ids have a fixed bound, so they are
    broadcast, and no other text is moved."""
    known = (labels.where(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
             .select(F.col("doc_id").alias("label_id"), F.col(label).cast("int").alias("y"),
                     F.xxhash64(F.col("doc_id").cast("string")).alias("place")))
    limit = -(2**63) + int(2**64 * min(1.0, 1.2 * rows / max(1, known.select("label_id").distinct().count()))) - 1
    drawn = known.where(F.col("place") <= limit).groupBy("label_id", "place").agg(F.max("y").alias("y"))
    taken = docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("label_id"))
    return written(taken.groupBy("doc_id", "place").agg(F.max(F.struct("text", "y")).alias("best"))
                   .select("doc_id", "best.text", "best.y", "place"), "sample")


def first_rows(sample: DataFrame, rows: int, of: int) -> DataFrame:
    """About 1.2 times ``rows`` rows of a sample that has ``of``; the caller cuts them."""
    highest = sample.agg(F.max("place")).first()[0]
    return sample.where(F.col("place") <= -(2**63) + int((highest + 2**63) * min(1.0, 1.2 * rows / of)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, 1 << BITS), np.int64)
    rows = np.zeros(2, np.int64)
    for batch in batches:
        texts, y = texts_of(batch), batch.column(batch.schema.get_field_index("y")).to_pylist()
        for a, b in chunks(texts):
            for k, found in zip(y[a:b], indicators(runs(texts[a:b], full=True))):
                total[k, found] += 1
                rows[k] += 1
    found = np.flatnonzero(total.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(found, -1).astype(np.int32)), pa.array(np.append(total[0, found], rows[0])),
         pa.array(np.append(total[1, found], rows[1]))], ["feature", "n0", "n1"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, y = texts_of(batch), batch.column(batch.schema.get_field_index("y"))
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        found = [f.astype(np.int32) for a, b in chunks(texts) for f in indicators(runs(texts[a:b], full=True))]
        place = batch.column(batch.schema.get_field_index("place"))
        yield pa.RecordBatch.from_arrays(
            [ids.cast(pa.int64()), pa.array(found, pa.list_(pa.int32())), y.cast(pa.int32()), place],
            ["doc_id", "found", "y", "place"])


def hinge_fit(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, epochs: int = EPOCHS,
              penalty: float = PENALTY) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the L1-loss linear support vector machine on
    unit-length rows with a constant feature; classes weigh alike."""
    w, bias = np.zeros(len(ratio)), 0.0
    values = []
    for found in rows:
        x = ratio[found]
        values.append(x / (float(np.sqrt(x @ x)) or 1.0))
    square = np.array([float(v @ v) + 1.0 for v in values])
    n1 = max(1, int(y.sum()))
    n0 = max(1, len(y) - int(y.sum()))
    cap = penalty * np.where(y == 1, len(y) / (2 * n1), len(y) / (2 * n0))
    alpha, sign = np.zeros(len(y)), np.where(y == 1, 1.0, -1.0)
    order = np.random.default_rng(3)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(y)):
            found, v = rows[i], values[i]
            slope = sign[i] * (float(w[found] @ v) + bias) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), cap[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                w[found] += step * v
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, bias


def logistic_fit(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the probability curve, with smoothed targets."""
    n1, n0 = float(y.sum()), float(len(y) - y.sum())
    goal = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, float(np.log((n1 + 1) / (n0 + 1)))
    x = np.stack([margin, np.ones(len(margin))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        grad = x @ (p - goal) + 1e-6 * np.array([a, 0])
        hess = (x * (p * (1 - p) + 1e-9)) @ x.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        step /= max(1.0, np.abs(step).max() / 5)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", fit_rows: int = FIT_ROWS) -> Model | None:
    """None where there are not both classes to learn from."""
    known = training_sample(docs, labels, label, SAMPLE_ROWS)
    counts = (known.mapInArrow(_count, "feature int, n0 long, n1 long").groupBy("feature")
              .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))
    counted = counts.toArrow()  # at most 2^BITS + 1 rows
    feature, n0, n1 = (counted.column(c).to_numpy() for c in ("feature", "n0", "n1"))
    own = feature >= 0
    total = [int(n[~own].sum()) for n in (n0, n1)]
    if min(total) == 0:
        return None
    ratio = np.zeros(1 << BITS)
    often = own & (n0 + n1 >= MIN_ROWS)
    ratio[feature[often]] = (np.log((n1[often] + 1) / (total[1] + 2)) - np.log((n0[often] + 1) / (total[0] + 2)))
    sample = first_rows(known, fit_rows, sum(total)).mapInArrow(_features, "doc_id long, found array<int>, y int, place long")
    drawn = sample.toArrow().sort_by([("place", "ascending"), ("doc_id", "ascending")]).slice(0, fit_rows)
    found, y = drawn.column("found").to_pylist(), drawn.column("y").to_numpy()
    rows = [np.array([i for i in f if ratio[i]], np.int64) for f in found]
    half = np.arange(len(y)) % 2
    margin = np.zeros(len(y))
    for k in (0, 1):  # margins of rows that the fit has not seen
        w, bias = hinge_fit([r for r, h in zip(rows, half) if h != k], y[half != k], ratio)
        for i in np.flatnonzero(half == k):
            x = ratio[rows[i]]
            margin[i] = float(w[rows[i]] @ x) / (float(np.sqrt(x @ x)) or 1.0) + bias
    slope, shift = logistic_fit(margin, y)
    w, bias = hinge_fit(rows, y, ratio)
    return Model(ratio.astype(np.float32), w.astype(np.float32), bias, slope, shift)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs``, which has a ``text``, with the text replaced by its ``score``; 0.5 without
    a model."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = texts_of(batch)
            values = [m.score(f) if m else 0.5
                      for a, b in chunks(texts) for f in indicators(runs(texts[a:b], full=True))]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != "text"],
                 pa.array(values, pa.float64())], [*[n for n in batch.schema.names if n != "text"], "score"])

    kept = StructType([f for f in docs.schema.fields if f.name != "text"])
    return docs.mapInArrow(scored, kept.add("score", "double"))


def accepted(docs: DataFrame, model: Model | None, accept: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` whose text reaches ``accept``; all of them without a model."""
    if model is None:
        return docs
    packed = score(pack(docs, text=F.col("text")), model)
    return unpack(packed.where(F.col("score") >= accept), docs)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", accept: float = ACCEPT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Null or empty text: the score of a text without n-grams. Null id: not learned
    from. Repeated rows: each is scored. No usable labels: every score is 0.5.
    Empty table: empty result. Other columns are not read."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, label))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= accept).cast("int").alias("predicted"))

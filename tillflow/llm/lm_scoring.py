"""Masked pseudo-likelihood of documents under a bidirectional window network.

The network sees the ``SIDE`` words before and after a masked position and predicts
the word there: word vectors scaled by position, a tanh layer, and a softmax in two
steps, over word classes and over the words of a class. A document's score is the sum
of the log-probabilities of all its words, each predicted from both sides.

The network's vocabulary holds the most frequent words of all documents; other words
share hash buckets, and a word of a bucket has the bucket's probability times its share
of the bucket's words, by a count table of all words. The shares of words that make up
one in ``COMMON`` of all words or more go to each task; the others are joined in Spark. Training
passes over all documents: every word is a masked target once, in one of the rounds;
in every round each task trains its own copy of the network, and the copies are
averaged by the positions they saw, in two steps, a part of the parameters at a time.
What is counted so grows with the corpus; the network does not.

Texts are read twice, to count their words and to number them; training and scoring read
the numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import ship, written
from .tokens import chunks, mix, runs, texts_of

SIDE = 2
CLASSES = 48
WIDTH = 32
KNOWN = 2048
BUCKETS = CLASSES * CLASSES - KNOWN
#: Passes over the texts; each trains on another share of the masked positions.
ROUNDS = 2
RATE = 0.2
#: Targets of a step: the texts at hand are cut into about ``STEPS``, of these sizes.
STEPS, LEAST, BATCH = 32, 256, 4096
#: Parameters averaged as one row.
PART = 8192
#: Words of the texts handled at once, about.
HELD = 1 << 18
#: Words as frequent as one in so many, so no more words than this, are looked up in the tasks.
COMMON = 1 << 20
_PAD = CLASSES * CLASSES


class Places:
    """Places of hashes in an ascending list, found by their leading bits."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        bits = min(18, 4 + len(hashes).bit_length())
        self.shift = np.uint64(64 - bits)
        times = np.bincount((hashes >> self.shift).astype(np.int64), minlength=1 << bits)
        self.first = np.append(0, np.cumsum(times)).astype(np.int32)
        self.deep = int(times.max())

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """-1: not in the list."""
        out = np.full(len(hashes), -1, np.int32)
        if len(self.hashes) == 0:
            return out
        slot = (hashes >> self.shift).astype(np.int64)
        at, end = self.first[slot], self.first[1:][slot]
        left = np.flatnonzero(at < end)
        for deep in range(self.deep):
            place = at[left] + deep
            found = self.hashes[place] == hashes[left]
            out[left[found]] = place[found]
            more = ~found & (place + 1 < end[left])
            left = left[more]
        return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch)
        for a, b in chunks(texts):
            kinds, times = np.unique(runs(texts[a:b]).hash, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(times.astype(np.int64))], ["word", "n"])


class Network:
    def __init__(self, words: np.ndarray, flat: np.ndarray | None = None):
        self.by_rank = words
        self.order = np.argsort(words, kind="stable")  # rank of the words by hash
        self.places = Places(words[self.order])
        shapes = [(_PAD + 1, WIDTH), (2 * SIDE, WIDTH), (WIDTH,), (WIDTH, CLASSES), (CLASSES,), (CLASSES, WIDTH, CLASSES), (CLASSES, CLASSES)]
        if flat is None:
            rng = np.random.default_rng(1)
            flat = np.concatenate([(rng.normal(0, s, int(np.prod(shape)))).astype(np.float32) for shape, s in
                                   zip(shapes, (0.1, 0.0, 0.0, 0.1, 0.0, 0.1, 0.0))])
            at = int(np.prod(shapes[0]))
            flat[at : at + 2 * SIDE * WIDTH] = 1
        self.flat, self.parts, at = flat, [], 0
        for shape in shapes:
            n = int(np.prod(shape))
            self.parts.append(flat[at : at + n].reshape(shape))
            at += n

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers; frequent words by rank, dealt over the classes in runs."""
        at = self.places.of(hashes)
        known = at >= 0
        out = np.empty(len(hashes), np.int64)
        out[known] = self.order[at[known]]
        out[~known] = KNOWN + (mix(hashes[~known] + np.uint64(5)) % np.uint64(BUCKETS)).astype(np.int64)
        return out

    @staticmethod
    def contexts(number: np.ndarray, first: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Words around the positions ``at``, a row for each place of the window; texts are
        laid end to end and begin at ``first`` (with the end)."""
        n = len(first) - 1
        doc = np.repeat(np.arange(n), np.diff(first))
        spread = np.full(len(number) + SIDE * (n + 1), _PAD, np.int16)  # pads between texts
        spread[np.arange(len(number)) + SIDE * (doc + 1)] = number
        place = at + SIDE * (doc[at] + 1)
        return np.stack([spread[place + shift] for shift in (*range(-SIDE, 0), *range(1, SIDE + 1))])

    def hidden(self, context: np.ndarray) -> np.ndarray:
        e, s, b = self.parts[:3]
        context = context.astype(np.intp)
        total = (e * s[0]).take(context[0], axis=0)
        for p in range(1, 2 * SIDE):
            total += (e * s[p]).take(context[p], axis=0)
        total += b
        return np.tanh(total, out=total)

    def logits(self, h: np.ndarray, cut: np.ndarray) -> Iterator[np.ndarray]:
        """Of the words' classes, then of the words in the class; a column for each row of
        ``h``, whose rows are sorted by class and cut at ``cut``. Both come in one array."""
        w1, b1, w2, b2 = self.parts[3:]
        x = _columns(len(h))
        np.matmul(w1.T, h.T, out=x)
        x += b1[:, None]
        yield x
        for c in np.flatnonzero(np.diff(cut)).tolist():
            own = x[:, cut[c] : cut[c + 1]]
            np.matmul(w2[c].T, h[cut[c] : cut[c + 1]].T, out=own)
            own += b2[c][:, None]
        yield x

    def scores(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log-probability of each masked word."""
        order, kind, inner, cut = _by_class(target)
        h = self.hidden(context[:, order])
        found = np.zeros(len(h), np.float32)
        for x, at in zip(self.logits(h, cut), (kind, inner)):
            found += _log_at(x, at)
        out = np.empty_like(found)
        out[order] = found
        return out

    def train(self, context: np.ndarray, target: np.ndarray, squares: list[np.ndarray]) -> None:
        """One Adagrad step."""
        e, s, b, w1, b1, w2, b2 = self.parts
        order, kind, inner, cut = _by_class(target)
        context = context[:, order]
        h = self.hidden(context)
        n = len(h)
        off = np.empty((n, CLASSES), np.float32)
        logits = self.logits(h, cut)

        off[...] = _off_by(next(logits), kind).T
        back = off @ w1.T
        grads = {3: h.T @ off, 4: off.sum(axis=0), 5: np.zeros_like(w2), 6: np.zeros_like(b2)}
        off[...] = _off_by(next(logits), inner).T
        through = np.empty_like(back)
        for c in np.flatnonzero(np.diff(cut)).tolist():
            q, rows = off[cut[c] : cut[c + 1]], slice(cut[c], cut[c + 1])
            np.matmul(q, w2[c].T, out=through[rows])
            np.matmul(h[rows].T, q, out=grads[5][c])
            np.add.reduce(q, axis=0, out=grads[6][c])
        back += through
        back *= 1 - h * h
        grads[2] = back.sum(axis=0)
        # for each place of the window the gradients summed by word; the words' and the
        # place's own both follow from these sums
        grads[0], grads[1] = np.zeros_like(e), np.empty_like(s)
        key, sums = _sums(back, context)
        for k in range(2 * SIDE):
            own = slice(*np.searchsorted(key, (k * len(e), (k + 1) * len(e))))
            word = key[own] - k * len(e)
            grads[1][k] = np.einsum("wd,wd->d", e[word], sums[own])
            grads[0][word] += sums[own] * s[k]
        for i, grad in grads.items():
            grad /= n
            squares[i] += grad * grad
            self.parts[i] -= RATE * grad / np.sqrt(squares[i] + 1e-8)


def _columns(n: int) -> np.ndarray:
    """A column of ``CLASSES`` numbers for each of ``n`` positions. The rows lie a little
    apart, since rows a power of two apart share cache lines."""
    return np.empty((CLASSES, n + 16), np.float32)[:, :n]


def _by_class(target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The targets' order by class; in that order their classes and their words in the
    class; and where each class begins, with the end."""
    kind = (target // CLASSES).astype(np.int8)  # numpy sorts short integers by radix
    order = np.argsort(kind, kind="stable")
    kind = kind[order].astype(np.int64)
    return order, kind, target[order] - kind * CLASSES, np.searchsorted(kind, np.arange(CLASSES + 1))


def _powers(x: np.ndarray) -> np.ndarray:
    """Sums of the columns' exponentials, eight rows at a time; ``x`` becomes these."""
    np.exp(x, out=x)
    part = x.reshape(-1, 8, x.shape[1]).sum(axis=0)
    while len(part) > 1:
        part = part[::2] + part[1::2]
    return part[0]


def _off_by(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Softmax of each column less one at its entry; ``x`` is used up."""
    x -= x.max(axis=0)
    x /= _powers(x)
    x[at, np.arange(len(at))] -= 1
    return x


def _log_at(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log-softmax of one entry of each column; ``x`` is used up."""
    x -= x.max(axis=0)
    own = x[at, np.arange(len(at))]
    return own - np.log(_powers(x))


def _sums(rows: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``rows`` summed by place of the window and word there: the keys ``place * words +
    word``, ascending, and the sums."""
    key = (context + (np.arange(2 * SIDE) * (_PAD + 1))[:, None]).astype(np.int16).ravel()
    order = np.argsort(key, kind="stable")
    key, source = key[order], order % len(rows)
    start = np.flatnonzero(np.diff(key, prepend=np.int16(-1)))
    times = np.diff(start, append=len(key))
    sums = np.empty((len(start), rows.shape[1]), np.float32)
    # most words come a few times: all their first rows at once, then all their second ones
    often = times > 8
    many = np.flatnonzero(often)
    if len(many):
        at = source[np.repeat(often, times)]
        sums[many] = np.add.reduceat(rows.take(at, axis=0), np.cumsum(times[many]) - times[many], axis=0)
    few = np.flatnonzero(~often)
    few = few[np.argsort(-times[few], kind="stable")]
    first, left = start[few], np.searchsorted(-times[few], -np.arange(1, 9), side="right")
    more = rows.take(source[first[: left[1]] + 1], axis=0)
    for j in range(2, 8):
        more[: left[j]] += rows.take(source[first[: left[j]] + j], axis=0)
    total = rows.take(source[first], axis=0)
    total[: len(more)] += more
    sums[few] = total
    return key[start].astype(np.int64), sums


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n``: every word's hash and how often it occurs."""
    ship(docs.sparkSession)
    return written(docs.select("text").mapInArrow(_counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")


def shares(counts: DataFrame, net: Network) -> DataFrame:
    """``word, n, share``: how often a word occurs and the log of its share of its bucket, of
    every word that the network does not know itself."""
    shared = counts.sparkSession.sparkContext.broadcast(net.by_rank)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network(shared.value)
        for batch in batches:
            word, n = batch.column("word").to_numpy(), batch.column("n").to_numpy()
            number = own.number(word.view(np.uint64))
            rest = number >= KNOWN
            yield pa.RecordBatch.from_arrays([pa.array(word[rest]), pa.array(n[rest]), pa.array(number[rest])], ["word", "n", "bucket"])

    rows = counts.select("word", "n").mapInArrow(dealt, "word long, n long, bucket long")
    totals = rows.groupBy("bucket").agg(F.sum("n").alias("total"))  # at most BUCKETS rows
    return rows.join(F.broadcast(totals), "bucket").select("word", "n", F.log(F.col("n") / F.col("total")).alias("share"))


def common(counts: DataFrame, dealt: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, ascending, and shares of the common words of ``dealt``: at most ``COMMON``
    words, however many there are."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    rows = dealt.where(F.col("n") >= total / COMMON).select("word", "share").toArrow()
    word, share = rows.column("word").to_numpy().view(np.uint64), rows.column("share").to_numpy()
    order = np.argsort(word)
    return word[order], share[order]


def numbered(docs: DataFrame, words: np.ndarray, known: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """``row, doc_id, number, rest, inner`` of every row: its words by number; the hashes of
    those in buckets, without the words of ``known``; and the sum of the latter's shares."""
    shared = docs.sparkSession.sparkContext.broadcast((words, known or (np.zeros(0, np.uint64), np.zeros(0))))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, (hashes, share) = shared.value
        net, places = Network(words), Places(hashes)
        for batch in batches:
            texts = texts_of(batch)
            numbers, cut, rest, rest_cut = [np.zeros(0, np.int16)], [np.zeros(1, np.int64)], [np.zeros(0, np.int64)], [np.zeros(1, np.int64)]
            inner = [np.zeros(0)]
            for a, b in chunks(texts):
                r = runs(texts[a:b])
                own = net.number(r.hash)
                dealt = own >= KNOWN
                at = np.full(len(own), -1, np.int32)
                at[dealt] = places.of(r.hash[dealt])
                dealt &= at < 0
                inner.append(np.bincount(r.doc[at >= 0], share[at[at >= 0]], minlength=b - a))
                numbers.append(own.astype(np.int16))
                rest.append(r.hash[dealt].view(np.int64))
                cut.append(cut[-1][-1] + r.first[1:])
                rest_cut.append(rest_cut[-1][-1] + np.append(0, np.cumsum(dealt))[r.first[1:]])
            lists = [pa.ListArray.from_arrays(pa.array(np.concatenate(c), pa.int32()), pa.array(np.concatenate(v)))
                     for c, v in ((cut, numbers), (rest_cut, rest))]
            own = [batch.column(batch.schema.get_field_index(c)) for c in ("row", "doc_id")]
            yield pa.RecordBatch.from_arrays([*own, *lists, pa.array(np.concatenate(inner))], ["row", "doc_id", "number", "rest", "inner"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return written(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
                   .mapInArrow(number, f"row long, doc_id {kind}, number array<smallint>, rest array<long>, inner double"), "numbered")


def vocabulary(counts: DataFrame) -> np.ndarray:
    """Hashes of the most frequent words, the most frequent first."""
    return counts.orderBy(F.desc("n"), "word").limit(KNOWN).toArrow().column("word").to_numpy().view(np.uint64)


def fit(texts: DataFrame, words: np.ndarray, rounds: int = ROUNDS) -> Network:
    """The network trained on numbered texts."""
    ship(texts.sparkSession)
    flat = Network(words).flat
    for turn in range(rounds):
        shared = texts.sparkSession.sparkContext.broadcast((words, flat))
        trained = texts.select("number").mapInArrow(_trainer(shared, turn, rounds), "part int, task int, value binary, weight double")
        local = trained.groupBy("part", F.pmod("task", F.lit(32)).alias("salt")).applyInPandas(_mean, "part int, value binary, weight double")
        mean = local.groupBy("part").applyInPandas(_mean, "part int, value binary, weight double").orderBy("part").toPandas()
        if mean.empty:
            break
        flat = np.concatenate([np.frombuffer(v, np.float32) for v in mean["value"]]).copy()
    return Network(words, flat)


def _mean(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values(["weight", "value"])  # one order of the sum, however the rows came
    weight = frame["weight"].to_numpy()
    total = sum(np.frombuffer(v, np.float32) * w for v, w in zip(frame["value"], weight)) / weight.sum()
    return pd.DataFrame({"part": [frame["part"].iloc[0]], "value": [total.astype(np.float32).tobytes()], "weight": [weight.sum()]})


def targets(number: np.ndarray, place: np.ndarray, turn: int, rounds: int) -> np.ndarray:
    """Positions that a round trains on; the rounds share all positions out."""
    return np.flatnonzero(mix(number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64)) % np.uint64(rounds) == turn)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of some texts end to end, and where each begins, with the end; about
    ``HELD`` words at a time, a longer text alone."""
    column = batch.column(batch.schema.get_field_index("number"))
    values, cut = column.flatten().to_numpy(), np.append(0, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))).astype(np.int64)
    a = 0
    while a < len(cut) - 1:
        b = max(a + 1, int(np.searchsorted(cut, cut[a] + HELD, side="right")) - 1)
        yield values[cut[a] : cut[b]].astype(np.int64), cut[a : b + 1] - cut[a]
        a = b


def _trainer(shared, turn: int, rounds: int):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, flat = shared.value
        net = Network(words, flat.copy())
        squares = [np.full(p.shape, 1e-6, np.float32) for p in net.parts]
        seen = 0
        for batch in batches:
            for number, first in _texts(batch):
                place = np.arange(len(number)) - np.repeat(first[:-1], np.diff(first))
                at = targets(number, place, turn, rounds)
                at = at[np.argsort(mix(at.astype(np.uint64)))]
                context = net.contexts(number, first, at)
                size = min(BATCH, max(LEAST, len(at) // STEPS))
                for i in range(0, len(at), size):
                    net.train(context[:, i : i + size], number[at[i : i + size]], squares)
                seen += len(at)
        if seen:
            task = TaskContext.get().partitionId()
            values = [net.flat[i : i + PART].tobytes() for i in range(0, len(net.flat), PART)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(values)), pa.int32()), pa.array([task] * len(values), pa.int32()),
                 pa.array(values, pa.binary()), pa.array([float(seen)] * len(values))], ["part", "task", "value", "weight"])
    return train


def score(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, n_tokens, log_prob, mean_log_prob`` of every row of ``docs``, after
    training on all of them.

    Null, empty or wordless text: no tokens, sum 0, mean null. Repeated rows: each is
    trained on and scored. Empty table: empty result. Other columns are not read."""
    counts = word_counts(docs)
    words = vocabulary(counts)
    dealt = shares(counts, Network(words))
    texts = numbered(docs, words, common(counts, dealt))
    net = fit(texts, words, rounds)
    shared = docs.sparkSession.sparkContext.broadcast((net.by_rank, net.flat))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network(*shared.value)
        for batch in batches:
            sums, tokens = [], []
            for number, first in _texts(batch):
                logs = np.zeros(len(number))
                context = own.contexts(number, first, np.arange(len(number)))
                for i in range(0, len(number), 1 << 14):
                    logs[i : i + (1 << 14)] = own.scores(context[:, i : i + (1 << 14)], number[i : i + (1 << 14)])
                tokens += np.diff(first).tolist()
                sums += [float(logs[i:j].sum()) for i, j in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in ("row", "doc_id")), pa.array(tokens, pa.int64()),
                 pa.array(np.array(sums) + batch.column(batch.schema.get_field_index("inner")).to_numpy(), pa.float64())],
                ["row", "doc_id", "n_tokens", "sum"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = texts.select("row", "doc_id", "number", "inner").mapInArrow(scored, f"row long, doc_id {kind}, n_tokens long, sum double")
    rare = (texts.select("row", F.explode("rest").alias("word")).join(dealt.select("word", "share"), "word")
            .groupBy("row").agg(F.sum("share").alias("rare")))
    total = F.col("sum") + F.coalesce("rare", F.lit(0.0))
    return rows.join(rare, "row", "left").select(
        "doc_id", "n_tokens", total.alias("log_prob"), F.try_divide(total, F.col("n_tokens")).alias("mean_log_prob"))

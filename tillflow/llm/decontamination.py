"""Benchmark decontamination by SimHash windows.

Windows of about an item's length slide over every document, one word at a time.
Each window's fingerprint takes, for each of 64 bits, the majority among its
five-word shingles; counts come from one running sum per bit. A multi-index finds
the fingerprints near an item's: two fingerprints within ``RADIUS`` agree within
``RADIUS // 4`` bits on at least one of four 16-bit blocks, and a table for each
block lists all values that near, so none within the radius is missed. Candidates
are verified by the exact weighted similarity of their shingles.

Items share a window length with those up to a tenth shorter, so that the number of
passes over a text depends on the range of lengths, not on the number of items. A text
shorter than a window is one window. The
benchmark is held by every task in slices of at most ``SLICE`` items; a longer
benchmark takes more passes. A shingle's weight follows from how many items of the whole
benchmark hold it, so results do not depend on the slices.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import pack, ship, unpack, written
from .tokens import chunks, runs, shingles, texts_of

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 15
LADDER = 1.1
SLICE = 20_000
#: Windows handled at a time, so that their counts stay in the processor's cache.
STRIP = 4096


def window_length(words: int) -> int:
    """The largest step of the ladder up to ``words``."""
    step = 1
    while (following := max(step + 1, int(step * LADDER))) <= words:
        step = following
    return step


def counts(values: np.ndarray, wide: bool) -> np.ndarray:
    """Running number of ones for each bit, modulo the type's range."""
    bits = np.unpackbits(np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8), axis=1)
    kind = np.uint32 if wide else np.uint8
    out = np.zeros((len(values) + 1, 64), kind)
    np.cumsum(bits, axis=0, dtype=kind, out=out[1:])
    return out


def fingerprints(running: np.ndarray, k: int, place: np.ndarray | None = None) -> np.ndarray:
    """Majority bits of every ``k`` values that follow one another, or of those that begin
    at the given places."""
    if place is None:
        place = np.arange(max(0, len(running) - k))
    out = np.zeros(len(place), np.uint64)
    for a in range(0, len(place), STRIP):
        at = place[a : a + STRIP]
        ones = running[at + k] - running[at]
        out[a : a + STRIP] = np.packbits(ones > k // 2, axis=1).view(np.uint64)[:, 0]
    return out


#: All ways to change up to a quarter of the radius of a block's 16 bits.
_FLIPS = np.array([sum(1 << b for b in bits) for r in range(RADIUS // 4 + 1) for bits in combinations(range(16), r)], np.int64)


@dataclass
class Step:
    """Items that share a window length and a shingle length."""

    window: int
    shingle: int
    items: list[int]
    prints: np.ndarray
    tables: list[np.ndarray]
    words: int  # of the longest item
    least: float  # summed weight below which no item reaches the threshold

    @property
    def reach(self) -> int:
        """How far a verification goes from its candidate's place."""
        return max(2, self.words // 8)


@dataclass
class Words:
    """Word hashes of some texts, the text of each, and where each text begins."""

    hash: np.ndarray
    doc: np.ndarray
    first: np.ndarray


def item_shingles(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
    """Words of a shingle, fewer only for a shorter text, and the shingles of each text."""
    r = runs(texts)
    for i, j in zip(r.first[:-1], r.first[1:]):
        size = min(SHINGLE, int(j - i))
        yield size, windows(r.hash[i:j], size) if size else np.zeros(0, np.uint64)


class Index:
    def __init__(self, ids: list[int], texts: list[str | None], of: int | None = None, holders: dict[int, int] | None = None):
        """``of`` items in all, ``holders`` of each shingle among them, where these items are
        a slice."""
        self.ids, self.shingles = ids, []
        steps: dict[tuple[int, int], list[int]] = defaultdict(list)
        for k, (size, s) in enumerate(item_shingles(texts)):
            self.shingles.append(s)
            if size:
                steps[window_length(len(s) + size - 1), size].append(k)
        if holders is None:
            holders = defaultdict(int)
            for s in self.shingles:
                for v in set(s.tolist()):
                    holders[v] += 1
        of = len(ids) if of is None else of
        # a shingle that many items share says less about any of them
        self.weight = {v: 1 + float(np.log(of / holders[v])) for s in self.shingles for v in s.tolist()}
        self.rare = 1 + float(np.log(max(1, of)))
        self.total = [sum(self.weight[v] for v in s.tolist()) for s in self.shingles]
        self.known = np.array(sorted(self.weight), np.uint64)
        self.known_weight = np.array([self.weight[v] for v in self.known.tolist()])
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.known >> np.uint64(44)).astype(np.int64)] = True
        self.steps = []
        for (window, size), items in sorted(steps.items()):
            prints = np.array([self._print(k) for k in items], np.uint64)
            tables = []
            for b in range(4):
                table = np.zeros(1 << 16, bool)
                for p in prints.tolist():
                    table[(p >> 16 * b & 0xFFFF) ^ _FLIPS] = True
                tables.append(table)
            self.steps.append(Step(max(window, size), size, items, prints, tables, max(len(self.shingles[k]) for k in items) + size - 1,
                                   THRESHOLD * min(self.total[k] for k in items) - 1e-6))

    def mass(self, values: np.ndarray) -> np.ndarray:
        """Running sum of the weights of the values that items hold."""
        out = np.zeros(len(values) + 1)
        place = np.flatnonzero(self.seen[(values >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.known, values[place]), len(self.known) - 1)
        held = self.known[at] == values[place]
        out[place[held] + 1] = self.known_weight[at[held]]
        return np.cumsum(out, out=out)

    def _print(self, k: int) -> int:
        s = self.shingles[k]
        return int(fingerprints(counts(s, len(s) > 255), len(s))[0])

    def similarity(self, found: list[int], k: int) -> float:
        """Weighted similarity of a window's shingles and an item's, with repeats."""
        left: dict[int, int] = defaultdict(int)
        for v in self.shingles[k].tolist():
            left[v] += 1
        both = alone = 0.0
        for v in found:
            if left.get(v, 0):
                left[v] -= 1
                both += self.weight[v]
            else:
                alone += self.weight.get(v, self.rare)
        return both / (self.total[k] + alone) if self.total[k] else 0.0

    def search(self, texts: list[str | None]) -> Iterator[tuple[int, int, float, int]]:
        """``(text, item, similarity, first word)``, the best window of each text and
        item that reaches the threshold."""
        r = runs(texts)
        if not len(r.hash) or not self.steps:
            return
        # texts whose whole mass is too little for every item are done here
        open_ = np.zeros(len(texts), bool)
        for size in {step.shingle for step in self.steps}:
            mass = self.mass(windows(r.hash, size))
            edge = mass[np.minimum(r.first, len(mass) - 1)]
            open_ |= edge[1:] - edge[:-1] >= min(x.least for x in self.steps if x.shingle == size)
        own = np.flatnonzero(open_)
        if not len(own):
            return
        size = np.diff(r.first)[own]
        words = Words(np.concatenate([r.hash[r.first[d] : r.first[d + 1]] for d in own.tolist()]),
                      np.repeat(np.arange(len(own)), size), np.concatenate([[0], np.cumsum(size)]))
        for (doc, item), (similarity, at) in self._found(words).items():
            if similarity >= THRESHOLD:
                yield int(own[doc]), item, similarity, at - int(words.first[doc])

    def _found(self, r: Words) -> dict[tuple[int, int], tuple[float, int]]:
        best: dict[tuple[int, int], tuple[float, int]] = {}
        running: dict[tuple[int, bool], np.ndarray] = {}
        values: dict[int, np.ndarray] = {}
        masses: dict[int, np.ndarray] = {}
        tried: set[tuple[int, int]] = set()
        size = np.diff(r.first)
        for step in self.steps:
            k = step.window - step.shingle + 1
            wide = k > 255
            if step.shingle not in values:
                values[step.shingle] = windows(r.hash, step.shingle)
                masses[step.shingle] = self.mass(values[step.shingle])
            mass = masses[step.shingle]
            start = np.arange(max(0, len(r.hash) - step.window + 1))
            low = np.maximum(start - step.reach, 0)
            high = np.minimum(start + step.reach + step.words, len(mass) - 1)
            place = start[(mass[high] - mass[low] >= step.least) & (r.doc[start] == r.doc[start + step.window - 1])]
            near = np.zeros(0, np.uint64)
            if len(place):
                if (step.shingle, wide) not in running:
                    running[step.shingle, wide] = counts(values[step.shingle], wide)
                near = fingerprints(running[step.shingle, wide], k, place)
                hit = step.tables[0][(near & np.uint64(0xFFFF)).astype(np.int64)]
                for b in range(1, 4):
                    hit |= step.tables[b][(near >> np.uint64(16 * b) & np.uint64(0xFFFF)).astype(np.int64)]
                place, near = place[hit], near[hit]
            short = np.flatnonzero((size < step.window) & (size >= step.shingle))
            if len(short):
                # a shorter text is one window, compared at its own length
                last = r.first[short + 1] - step.shingle + 1
                short = short[mass[last] - mass[r.first[short]] >= step.least]
                own = [values[step.shingle][r.first[d] : r.first[d + 1] - step.shingle + 1] for d in short.tolist()]
                place = np.append(place, r.first[short]).astype(np.int64)
                near = np.append(near, np.array([fingerprints(counts(v, len(v) > 255), len(v))[0] for v in own], np.uint64))
            for item, p in zip(step.items, step.prints) if len(place) else ():
                for at in place[np.bitwise_count(near ^ p) <= RADIUS].tolist():
                    self._verify(r, values[step.shingle], step, item, at, best, tried)
        return best

    def _verify(self, r: Words, values: np.ndarray, step: Step, item: int, at: int, best: dict, tried: set) -> None:
        """Windows of the item's own length around a candidate; each is tried once."""
        doc = int(r.doc[at])
        words = len(self.shingles[item]) + step.shingle - 1
        reach = max(2, words // 8)
        known = best.get((doc, item), (0.0, -1))
        if known[0] >= 1 - 1e-9:
            return
        low, high = int(r.first[doc]), int(r.first[doc + 1])
        for i in range(max(low, at - reach), min(at + reach, high - step.shingle) + 1):
            if (i, item) in tried:
                continue
            tried.add((i, item))
            end = min(i + words, high) - step.shingle + 1
            s = self.similarity(values[i:end].tolist(), item)
            if s > known[0]:
                known = (s, i)
        best[doc, item] = known


def windows(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every ``k`` words that follow one another."""
    return shingles(words, k) if len(words) >= k else np.zeros(0, np.uint64)


def matches(docs: DataFrame, benchmark: DataFrame, slice_items: int = SLICE) -> DataFrame:
    """``doc_id, item_id, similarity, start_word``: for each document and benchmark item
    the best window that reaches the threshold.

    Null, empty or wordless texts and items match nothing. An item of fewer than five
    words is one shingle and matches where its words stand in a row. Items with equal
    texts are each reported; so is each row that repeats an id. Empty tables: empty
    result. Other columns are not read."""
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")
    n = items.count()
    passes = max(1, -(-n // slice_items))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = "item long, v long"
    held = written(items.mapInArrow(_distinct_shingles, kind).groupBy("v").agg(F.count("*").alias("n")), "shingles") if passes > 1 else None
    found = None
    for k in range(passes):
        mine = items.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(passes)) == k)
        holders = None
        if held is not None:  # counted over all items, for the shingles of this slice: bounded as the slice is
            counted = held.join(mine.mapInArrow(_distinct_shingles, kind).select("v").distinct(), "v").collect()
            holders = {r.v & 0xFFFFFFFFFFFFFFFF: r.n for r in counted}
        shared = spark.sparkContext.broadcast(([(x.item_id, x.text) for x in mine.orderBy("item_id", "text").collect()], n, holders))
        part = source.mapInArrow(_searcher(shared), "doc_id long, item_id long, similarity double, start_word int")
        found = part if found is None else found.union(part)
    return found


def _distinct_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("item_id")).to_pylist()
        own = [np.unique(s).view(np.int64) for _, s in item_shingles(texts_of(batch))]
        item = [i for i, s in zip(ids, own) for _ in range(len(s))]
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(np.concatenate(own or [np.zeros(0, np.int64)]), pa.int64())],
                                         ["item", "v"])


def _searcher(shared):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, of, holders = shared.value
        index = Index([i for i, _ in items], [t for _, t in items], of, holders)
        for batch in batches:
            ids, texts = batch.column(batch.schema.get_field_index("doc_id")).to_pylist(), texts_of(batch)
            rows = [(ids[a + doc], index.ids[item], s, at)
                    for a, b in chunks(texts) for doc, item, s, at in index.search(texts[a:b])]
            columns = list(zip(*rows)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.int32())],
                ["doc_id", "item_id", "similarity", "start_word"])
    return search


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item. Rows with a null id
    are looked up by nothing and stay."""
    leaked = written(matches(docs, benchmark).select(F.col("doc_id").alias("leaked_id")).distinct(), "leaked")
    packed = pack(docs, doc_id=F.col("doc_id").cast("long"))
    return unpack(packed.join(leaked, F.col("doc_id") == F.col("leaked_id"), "left_anti"), docs)

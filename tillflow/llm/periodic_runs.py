"""Periodic runs of words, found with a suffix automaton under link-cut access.

Words are appended one after the other. The suffix-link tree of the automaton is held as
a link-cut forest in which every preferred path has one colour, the last position where
its strings ended. Access to the new prefix walks the old paths from it to the root and
recolours them. A path of colour ``v`` whose deepest string on the way has ``m`` words
says that the ``m`` words that end here ended at ``v`` before, and no longer ones did:
with ``p = here - v <= m`` that is a square of period ``p``, and the repetition reaches
``m + p`` words back. It is a run when the next word breaks the period.

Only stretches that can hold a run go through the automaton: in a run of period ``q``
every eight words in a row occur again ``q`` words away, and ``q`` is at most a third of
the stretch. Words outside are in no run.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import ship

#: A run has at least so many words and so many periods.
WORDS = 24
PERIODS = 3
#: Words in a row that must recur inside a run of that size, wherever they begin.
GRAM = 8
#: Words looked through at once, about.
TOGETHER = 1 << 18
RESULT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


class _Paths:
    """Link-cut forest over the automaton's states: preferred paths as splay trees by
    depth. The colour of a path stands at the root of its splay tree."""

    def __init__(self):
        self.left, self.right, self.up, self.colour = [-1], [-1], [-1], [-1]

    def add(self, above: int, colour: int) -> None:
        """A new state as a path of its own below ``above``."""
        self.left.append(-1)
        self.right.append(-1)
        self.up.append(above)
        self.colour.append(colour)

    def splay(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        y = up[x]
        if y < 0 or (left[y] != x and right[y] != x):
            return
        while True:
            y = up[x]
            if y < 0:
                break
            side = left[y] == x
            if not side and right[y] != x:
                break
            z = up[y]
            if z >= 0:
                outer = left[z] == y
                if outer or right[z] == y:
                    if outer == side:
                        self._rotate(y)
                        self._rotate(x)
                    else:
                        self._rotate(x)
                        self._rotate(x)
                    continue
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        y = up[x]
        z = up[y]
        if z >= 0 and left[z] == y:
            left[z] = x
        elif z >= 0 and right[z] == y:
            right[z] = x
        else:  # y was the root of the splay tree
            self.colour[x] = self.colour[y]
        if left[y] == x:
            b = left[y] = right[x]
            right[x] = y
        else:
            b = right[y] = left[x]
            left[x] = y
        if b >= 0:
            up[b] = y
        up[y] = x
        up[x] = z

    def insert_above(self, x: int) -> int:
        """A new state between ``x`` and its parent, of ``x``'s colour and a path of its own."""
        self.splay(x)
        a = self.left[x]
        parent = self.up[x]
        if a >= 0:  # x leaves its parent's path; the parent is the deepest state above it
            self.left[x] = -1
            self.up[a] = parent
            self.colour[a] = self.colour[x]
            while self.right[a] >= 0:
                a = self.right[a]
            self.splay(a)
            parent = a
        new = len(self.up)
        self.add(parent, self.colour[x])
        self.up[x] = new
        return new

    def access(self, x: int, colour: int) -> list[tuple[int, int]]:
        """Makes one path from ``x`` to the root, of the new colour. Returns the old colours
        above ``x``, upwards, with the deepest state of each on the way: a state put in
        between may have split a path into two of one colour."""
        found, below, at, before = [], x, self.up[x], -1
        while at >= 0:
            self.splay(at)
            old = self.colour[at]
            if old != before:
                found.append((at, old))
                before = old
            cut = self.right[at]
            if cut >= 0:  # stays a path of the old colour
                self.colour[cut] = old
            self.right[at] = below
            below, at = at, self.up[at]
        self.splay(x)
        self.colour[x] = colour
        return found


class Automaton:
    """Suffix automaton of a growing word list with the last end of every string."""

    def __init__(self):
        self.size, self.link, self.last = [0], [-1], 0
        # most states have one transition; further ones lie in a dictionary of the state
        self.word, self.to, self.more = [-1], [-1], {}
        self.paths = _Paths()

    def _next(self, state: int, word: int) -> int:
        if self.word[state] == word:
            return self.to[state]
        more = self.more.get(state)
        return -1 if more is None else more.get(word, -1)

    def _put(self, state: int, word: int, to: int) -> None:
        if self.word[state] in (-1, word):
            self.word[state], self.to[state] = word, to
        else:
            self.more.setdefault(state, {})[word] = to

    def _state(self, size: int, link: int) -> int:
        self.size.append(size)
        self.link.append(link)
        self.word.append(-1)
        self.to.append(-1)
        return len(self.size) - 1

    def append(self, word: int, here: int) -> Iterator[tuple[int, int]]:
        """Appends the word of position ``here``. Returns ``(length, earlier end)`` of the
        longest string ending here for every earlier last end on the way to the root."""
        new = self._state(self.size[self.last] + 1, 0)
        at, self.last = self.last, new
        while at >= 0 and (to := self._next(at, word)) < 0:
            self._put(at, word, new)
            at = self.link[at]
        if at >= 0:
            if self.size[to] == self.size[at] + 1:
                self.link[new] = to
            else:
                self.paths.add(0, here)  # the new state is numbered first
                clone = self._state(self.size[at] + 1, self.link[to])
                self.paths.insert_above(to)
                self.word[clone], self.to[clone] = self.word[to], self.to[to]
                if to in self.more:
                    self.more[clone] = dict(self.more[to])
                while at >= 0 and self._next(at, word) == to:
                    self._put(at, word, clone)
                    at = self.link[at]
                self.link[to] = self.link[new] = clone
                self.paths.up[new] = clone
        if len(self.paths.up) == new:
            self.paths.add(self.link[new], here)
        size = self.size
        return ((size[state], end) for state, end in self.paths.access(new, here) if state)


def nearest(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For every word of several lists laid end to end (``first``: where each begins, and
    the end): how far away in its own list the next equal ``GRAM`` words in a row begin."""
    far = np.iinfo(np.int64).max
    near = np.full(len(words), far)
    n = len(words) - GRAM + 1
    if n < 1:
        return near
    size = np.diff(first)
    gram = np.repeat(np.arange(len(size), dtype=np.uint64), size)[:n] * np.uint64(0xD6E8FEB86659FD93)
    for k in range(GRAM):  # equal grams have equal sums; a chance match only keeps more
        gram += (words[k : n + k].astype(np.uint64) + np.uint64(1)) * np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64))
    last = np.repeat(first[1:], size)[:n]
    whole = np.flatnonzero(np.arange(n) + GRAM <= last)
    order = whole[np.argsort(gram[whole], kind="stable")]
    gap = np.where(np.diff(gram[order].view(np.int64)) == 0, np.diff(order), far)
    near[order] = np.minimum(np.append(gap, far), np.insert(gap, 0, far)) if len(order) else far
    return near


def stretches(near: np.ndarray) -> list[tuple[int, int]]:
    """``[first, end)`` of the stretches of a list that can hold a run: every run lies in one."""
    done, open_ = [], [(0, len(near) - GRAM + 1)]  # in starts of grams
    while open_:
        first, end = open_.pop()
        length = end - first + GRAM - 1
        if length < WORDS:
            continue
        good = np.concatenate([[False], near[first:end] <= length // PERIODS, [False]])
        edge = np.flatnonzero(good[1:] != good[:-1]) + first
        parts = list(zip(edge[::2].tolist(), edge[1::2].tolist()))
        if parts == [(first, end)]:
            done.append((first, end + GRAM - 1))
        else:
            open_ += parts
    return sorted(done)


def runs(words: np.ndarray, near: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs of at least ``WORDS`` words and ``PERIODS``
    periods in a list of word numbers, by start, then period."""
    found = []
    for first, end in stretches(nearest(words, np.array([0, len(words)])) if near is None else near):
        part = words[first:end].tolist()
        n, automaton = len(part), Automaton()
        for here, word in enumerate(part):
            for size, before in automaton.append(word, here):
                period = here - before
                if size + period >= max(WORDS, PERIODS * period) and (here + 1 == n or part[here + 1] != part[here + 1 - period]):
                    found.append((first + here + 1 - period - size, size + period, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_of_all(lists: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each of several word lists."""
    seen: defaultdict[bytes, int] = defaultdict(count().__next__)
    first = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)])
    words = np.fromiter(map(seen.__getitem__, chain.from_iterable(lists)), np.int64, int(first[-1]))
    near = nearest(words, first)
    # a list with no equal grams within a third of its length has no run
    close = np.concatenate([[0], np.cumsum(near <= np.repeat(np.diff(first) // PERIODS, np.diff(first)))])
    return [runs(words[a:b], near[a:b]) if some else []
            for a, b, some in zip(first[:-1].tolist(), first[1:].tolist(), (close[first[1:]] > close[first[:-1]]).tolist())]


def words_of(text: bytes | None, doc_id: int | None = None) -> list[bytes]:
    """The words of a text. Of one document in ten (by the hash of its id) the words from
    some place on repeat with a period; without an id nothing is changed."""
    words = text.split() if text else []
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]
    return words


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that stand in no run after its first period."""
    if not found:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length in periods, compared exactly; ties to the smaller
    start, then the smaller period, which is the order of the list."""
    best = None
    for run in found:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _record(doc_id: int | None, words: list[bytes], found: list[tuple[int, int, int]]) -> tuple:
    start, length, period = strongest(found) or (None, None, None)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    return (doc_id, len(found), start, length, period, None if period is None else 1000 * length // period,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(collapsed(words, found))).hexdigest())


def _together(ids: list, texts: list) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Documents in groups of about ``TOGETHER`` words."""
    held, n = [], 0
    for i, (doc_id, text) in enumerate(zip(ids, texts)):
        held.append(words_of(text, doc_id))
        n += len(held[-1])
        if n >= TOGETHER or i == len(ids) - 1:
            yield ids[i + 1 - len(held) : i + 1], held
            held, n = [], 0


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row for each row of ``documents`` with its runs; whole texts, no shuffle.

    A null or empty text has no runs and collapses to the empty text. A row without an id
    keeps its words unchanged and is returned with a null id. Repeated rows give repeated
    results, an empty table an empty one. Other columns are not read. A document is one
    unit of work; its memory is in proportion to its longest periodic stretch."""
    ship(docs.sparkSession)
    names = [f.split()[0] for f in RESULT.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        for batch in batches:
            for ids, lists in _together(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                columns = zip(*map(_record, ids, lists, runs_of_all(lists)))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(work, RESULT)

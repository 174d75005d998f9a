"""Word hashing over whole batches of texts in numpy.

A word is a run of ASCII letters and digits and of characters beyond ASCII, taken
in lower case; a gap is what stands between two words. Runs get 64-bit polynomial
hashes from one running sum over the batch's bytes, so the cost per byte does not
depend on how long the texts are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: Bytes of text handled at a time; a longer text is handled alone, whole.
CHUNK_BYTES = 1 << 21


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


@dataclass
class Runs:
    """Words of a batch in text order. ``doc``: index of a word's text; ``first``:
    per text the index of its first word, and the total at the end."""

    hash: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    raw: np.ndarray  # hash in the original case
    gap: np.ndarray  # hash of what follows the word, up to the next one
    chars: np.ndarray  # bytes of the word
    stems: list[np.ndarray]


class _Sums:
    """Running polynomial sums of a batch's bytes, from which any span's hash follows."""

    def __init__(self, data: np.ndarray, power: np.ndarray, back: np.ndarray):
        self.back = back
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * power, out=self.total[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.back[start])


def runs(texts: list[str | None], full: bool = False, stems: tuple[int, ...] = ()) -> Runs:
    """``full``: also raw hashes and gaps. ``stems``: also the words' beginnings of so many
    bytes."""
    plain = [t or "" for t in texts]
    lower = [t.lower().encode("utf-8", "replace") for t in plain]
    size = np.array([len(b) + 1 for b in lower], np.int64)
    ends = np.cumsum(size)
    data = np.frombuffer(b"\x00".join(lower) + b"\x00", np.uint8) if lower else np.zeros(0, np.uint8)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[:-1] = _WORD[data]
    edge = np.diff(inside, prepend=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    n = len(data) + 1
    power = np.full(n - 1, _BASE) if n > 1 else np.zeros(0, np.uint64)
    if n > 1:
        power[0] = 1
        np.multiply.accumulate(power, out=power)
    back = np.full(n, _INVERSE)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    sums = _Sums(data, power, back)
    word = sums.hash(start, end)
    first = np.concatenate([[0], np.searchsorted(start, ends)]).astype(np.int64)
    doc = np.repeat(np.arange(len(lower), dtype=np.int64), np.diff(first))
    raw = gap = np.zeros(0, np.uint64)
    if full:
        stop = np.append(start[1:], n - 1)
        if len(doc):
            stop = np.minimum(stop, ends[doc])
        gap = sums.hash(end, stop)
        # a text whose length changes with its case counts as lower case throughout
        same = [u if len(u := t.encode("utf-8", "replace")) == len(b) else b for t, b in zip(plain, lower)]
        if same:
            raw = _Sums(np.frombuffer(b"\x00".join(same) + b"\x00", np.uint8), power, back).hash(start, end)
    begun = [sums.hash(start, np.minimum(end, start + n)) for n in stems]
    return Runs(word, doc, first, raw, gap, end - start, begun)


def shingles(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Hashes of the runs of ``k`` words of one text; a shorter text that has a word
    is one shingle."""
    if len(words) == 0:
        return words
    if len(words) < k:
        return mix(_fold(words, len(words))[:1] + np.uint64(len(words)))
    return mix(_fold(words, k))


def _fold(words: np.ndarray, k: int) -> np.ndarray:
    n = len(words) - k + 1
    out = words[:n].copy()
    for j in range(1, k):
        out = out * _BASE + words[j : n + j]
    return out


def chunks(texts: list[str | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of a batch whose texts together stay within ``limit`` characters; a
    longer text makes a range of its own."""
    at, total = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > at and total + n > limit:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(texts):
        yield at, len(texts)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()

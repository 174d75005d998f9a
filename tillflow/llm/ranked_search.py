"""Ranked lexical search by the Best Position Algorithm.

One pass over the whole texts keeps, for every document, its length in terms and its
counts of the terms that occur in a query, and yields the corpus statistics. The kept
counts are then read as shards of bounded size. A shard holds one impact list for each
term, its documents by falling contribution, and runs the queries one by one:

* sorted access reads the next unseen positions of all lists of the query;
* every new document is looked up in all other lists at once (direct access), which gives
  its score and marks the positions that it holds in those lists as seen;
* the best position of a list is the last one up to which all positions are seen; no
  unseen document can score more than the sum of the contributions there;
* the query stops when that sum is strictly below its k-th score, so that documents of
  equal score are all seen.

A shard starts from the k-th scores that earlier shards of the task reached, and a task
returns the best k of each query.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import ship, written

#: Fixed values of the score.
UNIT, SATURATION, FLAT, SLOPE = 1_000_000_000, 8, 100, 90
#: Counts of a shard, and (item, term) pairs of one pass over the shards, about.
SHARD = 1_500_000
SLICE = 1_000_000
#: Sorted accesses of the first round in each list, and the most in one round.
FIRST_STEP, LAST_STEP = 4, 512
#: Bytes outside of terms become blanks, A-Z become small letters.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text: runs of digits, ASCII letters and all other non-ASCII
    characters, with only A-Z lower-cased."""
    return text.translate(_FOLD).split() if text else []


def weight(n_docs: int, holders: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * holders.astype(np.float64) + 1))).astype(np.int64)


def damping(sizes: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """``m`` of documents of these sizes: 64-bit integers, Python's where they don't do."""
    if int(sizes.max(initial=0)) * SLOPE * n_docs < 1 << 62:
        return FLAT - SLOPE + (SLOPE * sizes * n_docs) // total
    return np.array([FLAT - SLOPE + (SLOPE * int(n) * n_docs) // total for n in sizes], np.int64)


@dataclass
class Queries:
    """Query terms in number order: ``terms`` of query ``q`` are
    ``of[first[q]:first[q + 1]]``; ``weight`` by term number."""

    ids: list
    first: np.ndarray
    of: np.ndarray
    weight: np.ndarray


class Shard:
    """Impact lists of some documents, one behind the other, and the places of each
    document in them. Documents are numbered by ascending id, null ids last."""

    def __init__(self, sizes: np.ndarray, first: np.ndarray, of: np.ndarray, counts: np.ndarray, m: np.ndarray, weights: np.ndarray):
        doc = np.repeat(np.arange(len(sizes)), np.diff(first))
        gain = weights[of] * ((UNIT * counts) // (1000 * counts + SATURATION * m[doc]))
        order = np.lexsort((doc, -gain, of))
        self.doc, self.gain = doc[order], gain[order]  # by list position
        self.list_first = np.searchsorted(of[order], np.arange(len(weights) + 1))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.place, self.place_term, self.doc_first = place, of, first  # by document
        self.seen = np.full(len(order), -1, np.int32)
        self.known = np.full(len(sizes), -1, np.int32)
        self.score = np.zeros(len(sizes), np.int64)
        self.asked = np.zeros(len(weights), bool)

    def best(self, query: int, of: np.ndarray, k: int, least: int) -> np.ndarray:
        """Documents that may be among the ``k`` best; all with scores equal to the k-th are
        there. ``least``: a score that k documents elsewhere reach."""
        start, end = self.list_first[of], self.list_first[of + 1]
        start, end = start[end > start], end[end > start]
        lists, at, step = len(start), start.copy(), FIRST_STEP
        self.asked[of] = True
        found: list[np.ndarray] = []
        kth, n_found = least, 0
        while lists:
            unseen = []
            for i in range(lists):
                if at[i] < end[i]:
                    ahead = self.seen[at[i] : at[i] + 4 * step] if at[i] + 4 * step < end[i] else self.seen[at[i] : end[i]]
                    unseen.append(at[i] + np.flatnonzero(ahead != query)[:step])
            if not unseen:
                break
            docs = np.unique(self.doc[np.concatenate(unseen)])
            docs = docs[self.known[docs] != query]
            if len(docs):
                self._look_up(docs, query)
                found.append(docs)
                n_found += len(docs)
                if n_found >= k:
                    scores = self.score[np.concatenate(found)]
                    top = np.partition(scores, len(scores) - k)[len(scores) - k :]
                    found = [x[self.score[x] >= top[0]] for x in found]
                    kth, n_found = max(least, int(top[0])), sum(map(len, found))
            bound = 0
            for i in range(lists):  # on to the first unseen position
                a, b = at[i], end[i]
                while a < b:
                    ahead = self.seen[a : min(a + 1024, b)] != query
                    j = int(ahead.argmax())
                    if ahead[j]:
                        a += j
                        break
                    a += len(ahead)
                at[i] = a
                if a < b:
                    bound += int(self.gain[a])
            if bound < kth or bound == 0:
                break
            step = min(2 * step, LAST_STEP)
        self.asked[of] = False
        docs = np.sort(np.concatenate(found)) if found else np.empty(0, np.int64)
        return docs[(self.score[docs] > 0) & (self.score[docs] >= least)]

    def _look_up(self, docs: np.ndarray, query: int) -> None:
        """Direct access: scores of new documents from all lists of the query."""
        first, n = self.doc_first[docs], self.doc_first[docs + 1] - self.doc_first[docs]
        at = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))
        row = np.repeat(np.arange(len(docs)), n)
        held = self.asked[self.place_term[at]]
        place, row = self.place[at[held]], row[held]
        self.seen[place] = query
        self.known[docs] = query
        total = np.zeros(len(docs), np.int64)
        np.add.at(total, row, self.gain[place])
        self.score[docs] = total


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows in shards of about ``SHARD`` counts, in order of their ids."""
    held, n = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        for i in range(0, batch.num_rows, 1 << 12):
            part = batch.slice(i, 1 << 12)
            held.append(part)
            n += len(part.column(2).flatten())
            if n >= SHARD:
                yield _joined(held)
                held, n = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> tuple:
    t = pa.Table.from_batches(held).combine_chunks().sort_by([("doc_id", "ascending")]).combine_chunks()
    of, counts = (t.column(c).combine_chunks() for c in ("terms", "counts"))
    width = np.concatenate([[0], np.cumsum(of.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    return (t.column("doc_id").to_pylist(), t.column("n").to_numpy(), width,
            of.flatten().to_numpy().astype(np.int64), counts.flatten().to_numpy().astype(np.int64))


def _ranked(batches: Iterator[pa.RecordBatch], queries: Queries, n_docs: int, total: int, k: int) -> Iterator[pa.RecordBatch]:
    best: list[list[tuple]] = [[] for _ in queries.ids]
    for ids, sizes, first, of, counts in _shards(batches):
        shard = Shard(sizes, first, of, counts, damping(sizes, n_docs, total), queries.weight)
        for q in range(len(queries.ids)):
            now = best[q]
            docs = shard.best(q, queries.of[queries.first[q] : queries.first[q + 1]], k, now[-1][0] if len(now) == k else 0)
            if len(docs):
                now += [(int(shard.score[d]), ids[d]) for d in docs.tolist()]
                now.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
                del now[k:]
    rows = [(q, i, s) for q, found in enumerate(best) for s, i in found]
    query, doc, score = zip(*rows) if rows else ((), (), ())
    yield pa.RecordBatch.from_arrays([pa.array(query, pa.int32()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())],
                                     ["query", "doc_id", "score"])


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item with scores
    above 0, ties to the smaller id.

    A null or empty text has no terms: such a document is never found and is not counted,
    such an item has no rows. Rows that repeat an ``item_id`` are one item with the terms of
    all. Rows of documents that repeat an id, and rows without one, are documents of their
    own; a null id comes after all others of equal score. Empty tables give an empty
    result. Other columns are not read. Items are searched in slices of about ``SLICE``
    (item, term) pairs; a slice does not change any score."""
    spark = docs.sparkSession
    ship(spark)
    asked = written(items.select("item_id", F.col("text").cast("binary").alias("text")).where(F.length("text") > 0)
                    .mapInArrow(_item_terms, _item_schema(items)).distinct(), "search-items")
    size = asked.count()
    parts = []
    for part in range(-(-size // SLICE)):
        mine = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(-(-size // SLICE))) == part)
        parts.append(_slice(docs, mine, k))
    if not parts:
        return spark.createDataFrame([], f"item_id {dict(items.dtypes)['item_id']}, rank int, doc_id long, score long")
    out = parts[0]
    for more in parts[1:]:
        out = out.unionAll(more)
    return out


def _item_schema(items: DataFrame) -> str:
    return f"item_id {dict(items.dtypes)['item_id']}, term binary"


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = [sorted(set(terms(t))) for t in batch.column(1).to_pylist()]
        at = np.repeat(np.arange(len(own)), [len(x) for x in own])
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array([t for x in own for t in x], pa.binary())],
                                         ["item_id", "term"])


def _slice(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    spark = docs.sparkSession
    pairs = asked.orderBy("item_id", "term").toArrow()  # at most about SLICE rows
    item_of, own = pairs.column("item_id").to_pylist(), pairs.column("term").to_pylist()
    vocabulary = {t: i for i, t in enumerate(sorted(set(own)))}
    first = [i for i, item in enumerate(item_of) if i == 0 or item != item_of[i - 1]]
    ids = [item_of[i] for i in first]
    of = np.array([vocabulary[t] for t in own], np.int64)
    shared = spark.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            sizes, rows, own, counts = [], [0], [], []
            for text in batch.column(1).to_pylist():
                all_terms = terms(text)
                sizes.append(len(all_terms))
                held = Counter(filter(known.__contains__, all_terms))
                own += map(known.__getitem__, held)
                counts += held.values()
                rows.append(len(own))
            offsets = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(own, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32()))], ["doc_id", "n", "terms", "counts"])

    counted = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
                      .mapInArrow(count, "doc_id long, n long, terms array<int>, counts array<int>").where(F.col("n") > 0), "search-counts")
    n_docs, total = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    holders = np.zeros(len(vocabulary), np.int64)
    for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        holders[r[0]] = r[1]  # a row for each term of the slice
    queries = Queries(ids, np.array([*first, len(of)], np.int64), of, weight(n_docs, holders))
    with_queries = spark.sparkContext.broadcast(queries)
    found = (counted.where(F.size("terms") > 0).select("doc_id", "n", "terms", "counts")
             .mapInArrow(lambda batches: _ranked(batches, with_queries.value, n_docs, total, k), "query int, doc_id long, score long"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    kind = dict(asked.dtypes)["item_id"]
    item = spark.createDataFrame([(q, i) for q, i in enumerate(ids)], f"query int, item_id {kind}")
    return best.join(item, "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def oracle_sql(k: int = 10) -> str:
    """The same ranking in DuckDB SQL."""
    split = r"""unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"""
    return f"""
WITH asked AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, {split} AS term FROM benchmark)),
words AS (SELECT nr, {split} AS term FROM (SELECT *, row_number() OVER () AS nr FROM documents)),
sizes AS (SELECT nr, count(*) AS n FROM words GROUP BY nr),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
tf AS (SELECT nr, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY nr, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
            FROM tf, corpus GROUP BY term, docs),
gains AS (SELECT nr, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // total)))) AS gain
          FROM tf JOIN sizes USING (nr) JOIN weights USING (term), corpus),
scores AS (SELECT item_id, nr, CAST(sum(gain) AS BIGINT) AS score FROM asked JOIN gains USING (term) GROUP BY item_id, nr),
ranked AS (SELECT item_id, doc_id, score,
                  row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
           FROM scores JOIN (SELECT doc_id, row_number() OVER () AS nr FROM documents) USING (nr) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= {k}"""

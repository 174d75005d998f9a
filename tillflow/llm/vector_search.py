"""Approximate nearest neighbours with balanced posting lists.

Vectors are put in lists by centroids that were balanced on a bounded sample; a
vector near the boundary of several lists is in each of them. A query finds its lists
through a neighbour graph of the centroids in memory and keeps those whose distance
is within a ratio of the nearest one's; the ratio is the one that reached the wanted
recall on sample queries. Neighbouring lists are searched together as a group, so that
a query gets one best set from all lists of a group it opened. Groups are cut into
blocks of bounded size, so that a group of any size is searched by many tasks.

Largest inner product is turned into smallest distance by one more dimension that
brings all vectors to the largest norm. Vectors are dealt by their norms into bands, each
with lists of its own, so that a few very long vectors do not flatten the distances of
all others; a query searches every band. Scores are inner products of the original
vectors in double precision.

Lists are in proportion to the vectors up to ``MANY``, then to their square root, with a
fitting sample in proportion: both the lists of a query and their sizes grow by less than
the table.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import ship, written

#: Vectors the centroids and the ratio are fitted on, about, and for each list at least.
SAMPLE, FOR_EACH = 20_000, 16
#: Mean vectors of a list, up to so many lists; beyond, lists follow the square root.
LIST = 256
MANY = 1024
#: Norms of a band lie within a factor of this, the median at the upper end of the first.
BAND = 4.0
#: A vector is also in lists whose centroid is this much farther than the nearest.
BOUNDARY = 1.03
REPLICAS = 3
NEIGHBOURS = 16
RECALL = 0.97
#: Lists searched together, at most.
TOGETHER = 32
#: Components of the vectors and of the queries of a search block, about.
HELD = 1 << 21
ASKED = 1 << 18
#: Scores of one list held at once.
SCORES = 1 << 20
#: A matrix product may be off by this share of the two vectors' norms: scores as close to
#: the last place are kept and compared again, one by one.
TIE = 2.0**-44


class Lists:
    """Centroids, their graph, and the pruning ratio."""

    def __init__(self, sample: np.ndarray, norm: float, k: int):
        rng = np.random.default_rng(5)
        self.norm = norm
        sample = np.unique(sample, axis=0)  # copies of one vector make no centroids of their own
        x = self.lifted(sample)
        c = x[rng.permutation(len(x))[:k]]
        k = len(c)
        penalty = np.zeros(k)
        for _ in range(12):  # crowded centroids are pushed away, so that lists come out alike
            d = _distance(x, c) + penalty
            own = d.argmin(axis=1)
            size = np.bincount(own, minlength=k)
            penalty += 0.1 * float(d.min(axis=1).mean()) * (size * k / len(x) - 1).clip(-0.5, 2)
            for j in np.flatnonzero(size):
                c[j] = x[own == j].mean(axis=0)
        self.centroids = c
        between = _distance(c, c)
        np.fill_diagonal(between, np.inf)
        ring = np.empty(k, np.int64)  # makes the graph connected where centroids stand in clumps
        along = rng.permutation(k)
        ring[along] = np.roll(along, 1)
        self.graph = np.hstack([np.argsort(between, axis=1)[:, : min(NEIGHBOURS, k - 1)], ring[:, None]])
        self.group = np.zeros(k, np.int32)
        for g, lists in enumerate(_halved(c, np.arange(k))):
            self.group[lists] = g
        self.ratio = 1.0
        self._tune(sample, x, rng)

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        square = np.maximum(self.norm**2 - (vectors * vectors).sum(axis=1), 0)
        return np.hstack([vectors, np.sqrt(square)[:, None]])

    def assign(self, vectors: np.ndarray) -> list[np.ndarray]:
        d = np.sqrt(np.maximum(_distance(self.lifted(vectors), self.centroids), 0))
        near = np.argsort(d, axis=1, kind="stable")[:, :REPLICAS]
        found = np.take_along_axis(d, near, axis=1)
        return [n[f <= f[0] * BOUNDARY + 1e-12] for n, f in zip(near, found)]

    def probes(self, query: np.ndarray) -> np.ndarray:
        """Lists of a query by best-first search of the graph: a centroid is opened while it
        is within the ratio of the nearest one seen."""
        q = np.append(query, 0.0)
        start = 0
        first = float(np.sqrt(((self.centroids[start] - q) ** 2).sum()))
        heap, seen, found, nearest = [(first, start)], {start}, [], first
        while heap:
            d, at = heapq.heappop(heap)
            if d > nearest * self.ratio and len(found) >= NEIGHBOURS:
                break
            found.append((d, at))
            nearest = min(nearest, d)
            new = [int(i) for i in self.graph[at] if int(i) not in seen]
            if new:
                seen.update(new)
                for i, e in zip(new, np.sqrt(((self.centroids[new] - q) ** 2).sum(axis=1)).tolist()):
                    nearest = min(nearest, e)
                    heapq.heappush(heap, (e, i))
        return np.array([i for d, i in found if d <= nearest * self.ratio], np.int64)

    def grouped(self, own: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Lists of each row -> for every row and group: row, group, the row's lists in it."""
        at, groups, lists = [], [], []
        for i, o in enumerate(own):
            of = self.group[o]
            for g in np.unique(of).tolist():
                at.append(i)
                groups.append(g)
                lists.append(o[of == g].astype(np.int32))
        return np.array(at, np.int64), np.array(groups, np.int32), lists

    def _tune(self, sample: np.ndarray, x: np.ndarray, rng: np.random.Generator, k: int = 20) -> None:
        asked = rng.permutation(len(sample))[:200]
        holders = self.assign(sample)
        needed, wanted = [], []
        for i in asked:
            q = np.append(sample[i], 0.0)
            d = np.sqrt(((self.centroids - q) ** 2).sum(axis=1))
            order = np.argsort(-(sample @ sample[i]), kind="stable")
            order = order[order != i][:k]
            wanted.append((i, [set(holders[j].tolist()) for j in order]))
            needed += [float(d[holders[j]].min()) / max(float(d.min()), 1e-12) for j in order]
        self.ratio = float(np.quantile(needed, RECALL)) + 1e-6 if needed else 1.0
        for _ in range(40):  # the graph search may miss lists that the ratio allows
            opened = [(set(self.probes(sample[i]).tolist()), near) for i, near in wanted]
            if sum(bool(h & o) for o, near in opened for h in near) >= RECALL * len(needed):
                break
            self.ratio *= 1.02


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * x @ y.T + (y * y).sum(axis=1)[None, :]


def _halved(centroids: np.ndarray, lists: np.ndarray) -> list[np.ndarray]:
    """Lists in groups of neighbours, halved across their widest direction."""
    if len(lists) <= TOGETHER:
        return [lists]
    x = centroids[lists] - centroids[lists].mean(axis=0)
    order = lists[np.argsort(x @ np.linalg.svd(x, full_matrices=False)[2][0], kind="stable")]
    half = len(order) // 2
    return _halved(centroids, order[:half]) + _halved(centroids, order[half:])


def _members(lists: list[np.ndarray]) -> dict[int, np.ndarray]:
    """The rows of each list, in order."""
    of = np.concatenate(lists)
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    order = np.argsort(of, kind="stable")
    of, row = of[order], row[order]
    cut = np.flatnonzero(np.diff(of)) + 1
    return dict(zip(of[np.concatenate([[0], cut])].tolist(), np.split(row, cut)))


def _few_copies(vectors: np.ndarray, k: int) -> np.ndarray:
    """Rows but those of which more than ``k`` equal ones stand before: these can be among
    no query's ``k`` nearest, as its own row is one of them at most."""
    same = np.unique(np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1])))[:, 0],
                     return_inverse=True)[1]
    order = np.argsort(same, kind="stable")
    rank = np.empty(len(same), np.int64)
    rank[order] = np.arange(len(same)) - np.searchsorted(same[order], same[order])
    return np.flatnonzero(rank <= k)


def _searched(held: pd.DataFrame, asked: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` nearest of each query among the vectors that share an opened list with it."""
    none = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    if held.empty or asked.empty:
        return none
    held = held.sort_values("vec_id")
    ids, x, lists = held["vec_id"].to_numpy(), np.stack(held["v"].to_list()) + 0.0, held["lists"].to_list()
    few = _few_copies(x, k)
    ids, x, lists = ids[few], x[few], [lists[i] for i in few]
    query, y = asked["query_id"].to_numpy(), np.stack(asked["v"].to_list())
    long, far = np.sqrt((x * x).sum(axis=1)), np.sqrt((y * y).sum(axis=1))
    opened, pairs = _members(asked["lists"].to_list()), []
    for key, cols in _members(lists).items():
        rows = opened.get(key, cols[:0])
        step = max(1, SCORES // len(cols))
        for i in range(0, len(rows), step):
            some = rows[i : i + step]
            scores = y[some] @ x[cols].T
            slack = TIE * far[some][:, None] * long[cols]
            scores[query[some][:, None] == ids[cols]] = -np.inf
            if len(cols) > k:  # no less than what the k-th can be
                edge = np.partition(scores - slack, len(cols) - k, axis=1)[:, -k][:, None]
                r, c = np.nonzero((scores + slack >= edge) & np.isfinite(scores))
            else:
                r, c = np.nonzero(np.isfinite(scores))
            pairs.append(some[r] * len(ids) + cols[c])
    if not pairs:
        return none
    pair = np.unique(np.concatenate(pairs))
    r, c = pair // len(ids), pair % len(ids)
    score = np.einsum("ij,ij->i", y[r], x[c])
    order = np.lexsort((c, -score, r))
    row = r[order]
    order = order[np.arange(len(row)) - np.searchsorted(row, row) < k]
    return pd.DataFrame({"query_id": query[r[order]], "vec_id": ids[c[order]], "score": score[order]})


class Bands:
    """Lists of each band of norms; groups are numbered through all bands."""

    def __init__(self, median: float, lists: dict[int, Lists]):
        self.median, self.lists, self.before, n = median, lists, {}, 0
        for band, own in sorted(lists.items()):
            self.before[band] = n
            n += int(own.group.max()) + 1

    def assigned(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Row, group and the row's lists in it, for every row and group it belongs to."""
        band = band_of(np.sqrt((vectors * vectors).sum(axis=1)), self.median)
        parts = []
        for b in np.unique(band).tolist():
            rows = np.flatnonzero(band == b)
            b = min(self.lists, key=lambda known: abs(known - b))  # a norm at the edge may be rounded either way
            at, group, lists = self.lists[b].grouped(self.lists[b].assign(vectors[rows]))
            parts.append((rows[at], group + self.before[b], lists))
        return _joined(parts)

    def probed(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """The same for queries: the lists that each opens, of every band."""
        parts = []
        for b, own in self.lists.items():
            at, group, lists = own.grouped([own.probes(q) for q in queries])
            parts.append((at, group + self.before[b], lists))
        return _joined(parts)


def _joined(parts: list) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    at, group, lists = zip(*parts)
    return np.concatenate(at), np.concatenate(group).astype(np.int32), [x for own in lists for x in own]


def band_of(norm: np.ndarray, median: float) -> np.ndarray:
    return np.maximum(np.ceil(np.log(np.maximum(norm / median, 1e-300)) / np.log(BAND) - 1e-9), 0).astype(np.int64)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` of the vectors that take part, in double precision."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.where(F.col("vec_id").isNotNull() & good).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def search(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every vector whose id is divisible by
    ``every``, its ``k`` nearest found among all others, nearest first, ties to the
    smaller id.

    Vectors that are null, zero, hold null or non-finite components, or differ in length
    from most, take no part; neither does a null id. Rows that repeat an id are one
    vector (the greatest). No vectors: empty result. Other columns are not read."""
    spark = vectors.sparkSession
    ship(spark)
    kind = "query_id long, rank int, vec_id long, score double"
    good = usable(vectors).groupBy("vec_id").agg(F.max("v").alias("v"))
    most = good.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
    if most is None:
        return spark.createDataFrame([], kind)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    good = written(good.where(F.size("v") == most.n), "vectors")
    median = good.agg(F.percentile_approx(norm, 0.5)).first()[0]
    band = F.greatest(F.ceil(F.log(F.greatest(norm / F.lit(median), F.lit(1e-300))) / float(np.log(BAND)) - F.lit(1e-9)), F.lit(0))
    banded = good.select("vec_id", "v", band.alias("band"), norm.alias("norm"))
    # a row for each band that has vectors: doubles have a few hundred at most
    sizes = {r.band: (r.rows, r.norm) for r in banded.groupBy("band").agg(F.count("*").alias("rows"), F.max("norm").alias("norm")).collect()}
    fitted = {}
    for b, (rows, longest) in sorted(sizes.items()):
        lists = max(1, min(rows // LIST, max(MANY, int(2 * rows**0.5))))
        rate = min(1.0, max(SAMPLE, FOR_EACH * lists) / rows)
        own = banded.where(F.col("band") == b).select("vec_id", "v")
        sample = own.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 40)) < int(rate * (1 << 40)) + 1).orderBy("vec_id").toPandas()
        if sample.empty:
            sample = own.orderBy("vec_id").limit(1).toPandas()
        fitted[b] = Lists(np.stack(sample["v"].to_list()), longest, lists)
    shared = spark.sparkContext.broadcast(Bands(median, fitted))

    def dealt(name: str, lists_of):
        def deal(batches):
            for frame in batches:
                if len(frame):
                    at, group, lists = lists_of(shared.value, np.stack(frame["v"].to_list()))
                    yield pd.DataFrame({name: frame["vec_id"].to_numpy()[at], "group": group, "lists": lists,
                                        "v": frame["v"].to_numpy()[at]})
        return deal

    held = written(good.mapInPandas(dealt("vec_id", Bands.assigned), "vec_id long, group int, lists array<int>, v array<double>"), "lists")
    queries = written(good.where(F.col("vec_id") % every == 0)
                      .mapInPandas(dealt("query_id", Bands.probed), "query_id long, group int, lists array<int>, v array<double>"), "probes")
    # a row for each group: fewer than lists
    parts = {c: {r["group"]: -(-r["rows"] * most.n // size) for r in t.groupBy("group").agg(F.count("*").alias("rows")).collect()}
             for c, t, size in (("v", held, HELD), ("q", queries, ASKED))}

    def cut(name: str):
        pairs = [x for key, n in sorted(parts[name].items()) if n > 1 for x in (F.lit(key), F.lit(n))]
        return F.coalesce(F.element_at(F.create_map(*pairs), F.col("group")), F.lit(1)) if pairs else F.lit(1)

    blocks = held.select("vec_id", "group", "lists", "v", F.pmod(F.xxhash64("vec_id"), cut("v")).cast("int").alias("vb"),
                         F.explode(F.sequence(F.lit(0), cut("q") - 1)).alias("qb"))
    wanted = queries.select("query_id", "group", "lists", "v", F.pmod(F.xxhash64("query_id"), cut("q")).cast("int").alias("qb"),
                            F.explode(F.sequence(F.lit(0), cut("v") - 1)).alias("vb"))
    keys = ["group", "vb", "qb"]
    found = (blocks.groupBy(*keys).cogroup(wanted.groupBy(*keys))
             .applyInPandas(lambda left, right: _searched(left, right, k), "query_id long, vec_id long, score double"))
    # a vector may be found in two groups; one shuffle serves both steps
    once = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))

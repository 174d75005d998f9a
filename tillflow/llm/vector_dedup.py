"""Near-duplicate vectors by a pivot-permutation index.

A vector is described by its nearest reference points (pivots), in order. Inverted lists
hold, for each label and pivot, the vectors that have the pivot in their description. Two
vectors of a list are retrieved when they share enough pivots, and in only one of their
lists, that of the lowest-numbered shared pivot; the retrieved pairs are verified by
cosine in double precision. A list returns a link count for each vector and a spanning
forest of its links, never the pairs.

Equal vectors of a label are one entry that counts for all its copies. Lists beyond
``BLOCK`` entries are cut into parts that meet two by two, so that a list of any size is
the work of many tasks.

The pivots are spread vectors of the table: about ``4 * sqrt(n)`` for ``n`` distinct
vectors, so that both their search and the lists grow by ``sqrt(n)`` for each vector. How
many pivots describe a vector and how many must be shared is fitted on a sample: vectors
are paired with made partners at exactly the wanted cosine, and ``RECALL`` of these pairs
must be retrieved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .frames import ship, written

COSINE = 0.93
#: Pivots for each square root of the number of distinct vectors, and at least.
PIVOTS, FEWEST = 4, 32
#: Rows sampled for each pivot; vectors that the description is fitted on.
SAMPLED, FITTED = 3, 2000
#: Two pivots have a smaller cosine than this, or than the next where that leaves too few.
APART = (0.8, 0.9, 0.95, 0.98)
RECALL = 0.997
DEPTHS = range(4, 33)
#: Entries of a list part, of a tile of pairs, and of a task of small lists, about.
BLOCK, TILE, TASK = 8192, 1024, 4096
#: Columns that pivots are hashed to for a first, never too small, shared count.
COLUMNS = 509
#: Copies of one vector that are joined in one place, at least.
COPIES = 10_000


class Description:
    """Pivots, how many of them describe a vector, and how many a linked pair shares."""

    def __init__(self, sample: np.ndarray, wanted: int, cosine: float):
        rng = np.random.default_rng(11)
        unit = normalised(sample)
        unit = unit[rng.permutation(len(unit))]
        for apart in APART:
            self.pivots = _spread(unit, wanted, apart)
            if 2 * len(self.pivots) >= min(wanted, len(unit)):
                break
        else:
            self.pivots = unit[:wanted]
        x = unit[:FITTED]
        z = rng.standard_normal(x.shape)
        z -= (z * x).sum(axis=1, keepdims=True) * x
        long = np.sqrt((z * z).sum(axis=1, keepdims=True))
        y = np.where(long > 1e-9, cosine * x + np.sqrt(1 - cosine * cosine) * z / np.maximum(long, 1e-9), x)
        self.depth = min(DEPTHS[-1], len(self.pivots))
        a, b = self.nearest(x), self.nearest(y)
        same = a[:, :, None] == b[:, None, :]
        self.shared = 1
        for shared in (2, 1):
            fit = [d for d in DEPTHS if d <= self.depth and (same[:, :d, :d].sum(axis=(1, 2)) >= shared).mean() >= RECALL]
            if fit:
                self.depth, self.shared = fit[0], shared
                break

    def nearest(self, unit: np.ndarray) -> np.ndarray:
        """Numbers of the nearest pivots, nearest first. A vector of another length than the
        pivots is compared with them over the shorter one."""
        n = min(unit.shape[1], self.pivots.shape[1])
        out = np.empty((len(unit), self.depth), np.int32)
        for i in range(0, len(unit), TILE):
            near = unit[i : i + TILE, :n] @ self.pivots[:, :n].T
            best = np.argpartition(-near, self.depth - 1, axis=1)[:, : self.depth]
            order = np.argsort(-np.take_along_axis(near, best, axis=1), axis=1, kind="stable")
            out[i : i + TILE] = np.take_along_axis(best, order, axis=1)
        return out


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors times a power of two, so that no square is too large or small."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def normalised(vectors: np.ndarray) -> np.ndarray:
    x = scaled(vectors)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _spread(unit: np.ndarray, wanted: int, apart: float) -> np.ndarray:
    """Up to ``wanted`` vectors, in order, that are this far from all taken before."""
    taken = np.empty((0, unit.shape[1]))
    for i in range(0, len(unit), 256):
        part = unit[i : i + 256]
        part = part[(part @ taken.T).max(axis=1, initial=-1.0) < apart]
        near = part @ part.T
        keep: list[int] = []
        for j in range(len(part)):
            if not keep or near[j, keep].max() < apart:
                keep.append(j)
        taken = np.vstack([taken, part[keep]])
        if len(taken) >= wanted:
            return taken[:wanted]
    return taken


def _join(root: np.ndarray, r: np.ndarray, c: np.ndarray) -> None:
    """Joins the groups of the paired entries; ``root`` holds the first entry of each."""
    while len(r):
        a, b = root[r], root[c]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root[:] = up
        open_ = root[r] != root[c]
        r, c = r[open_], c[open_]


def _list_links(pivot: int, x: np.ndarray, near: np.ndarray, copies: np.ndarray, side: np.ndarray | None,
                cosine: float, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of each entry of a list and the first entry that its links reach. ``side``
    tells the two parts of a block apart of which only pairs across count."""
    n = len(x)
    count, root = np.zeros(n, np.int64), np.arange(n)
    norm = np.sqrt((x * x).sum(axis=1))
    hot = np.zeros((n, COLUMNS), np.float32)
    np.add.at(hot, (np.arange(n)[:, None], near % COLUMNS), 1)
    split = n if side is None else int(np.searchsorted(side, 1))
    for i in range(0, split, TILE):
        rows = slice(i, min(i + TILE, split))
        for j in range(i if side is None else split, n, TILE):
            cols = slice(j, min(j + TILE, n))
            r, c = np.nonzero(hot[rows] @ hot[cols].T > shared - 0.5)
            r, c = r + i, c + j
            if side is None:
                ahead = r < c
                r, c = r[ahead], c[ahead]
            dense = len(r) * 16 > (rows.stop - i) * (cols.stop - j)
            products = x[rows] @ x[cols].T if dense else None
            linked = []
            for k in range(0, len(r), 1 << 16):
                a, b = r[k : k + (1 << 16)], c[k : k + (1 << 16)]
                same = near[a][:, :, None] == near[b][:, None, :]
                good = (same.sum(axis=(1, 2)) >= shared) & ~(same.any(axis=2) & (near[a] < pivot)).any(axis=1)
                a, b = a[good], b[good]
                dot = products[a - i, b - j] if dense else np.einsum("ij,ij->i", x[a], x[b])
                close = dot / (norm[a] * norm[b]) >= cosine
                linked.append((a[close], b[close]))
            if linked:
                a, b = (np.concatenate(e) for e in zip(*linked))
                count += np.bincount(a, copies[b], n).astype(np.int64) + np.bincount(b, copies[a], n).astype(np.int64)
                _join(root, a, b)
    return count, root


LINKS = "vec_id long, n long, root long"


def _links(frame: pd.DataFrame, cosine: float, shared: int) -> pd.DataFrame:
    """Links of the lists, or list blocks, of one task."""
    ids, copies = frame["vec_id"].to_numpy(), frame["copies"].to_numpy()
    part, out = frame["part"].to_numpy(), []
    for (_, _, pivot, low, high), rows in frame.groupby(["label", "size", "pivot", "low", "high"], sort=False, dropna=False).indices.items():
        if len(rows) < 2:
            continue
        rows = rows[np.lexsort((ids[rows], part[rows]))]
        x = scaled(np.stack([frame["v"].iat[i] for i in rows]).astype(np.float64))
        near = np.stack([frame["near"].iat[i] for i in rows])
        side = None if low == high else (part[rows] == high).astype(np.int8)
        count, root = _list_links(pivot, x, near, copies[rows], side, cosine, shared)
        held = count > 0
        out.append(pd.DataFrame({"vec_id": ids[rows][held], "n": count[held], "root": ids[rows][root][held]}))
    return pd.concat(out) if out else pd.DataFrame({"vec_id": [], "n": [], "root": []})


def _entries(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, v``, a row for each id; ``v`` is null where the vector links with
    nothing. Vectors keep their element type, which double precision holds exactly."""
    kind = dict(vectors.dtypes)["embedding"]
    v = F.col("embedding") if kind in ("array<float>", "array<double>") else F.col("embedding").cast("array<double>")
    good = (F.col("label").isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(v, lambda x: x != 0))
    whole = F.struct(F.when(good, v).alias("v"), F.when(good, F.col("label")).alias("label"))
    return (vectors.where(F.col("vec_id").isNotNull()).groupBy(F.col("vec_id").cast("long").alias("vec_id"))
            .agg(F.max(whole).alias("e")).select("vec_id", "e.label", "e.v"))


def _distinct(entries: DataFrame) -> DataFrame:
    """Equal vectors of a label as one entry: the smallest id and how many there are."""
    return (entries.where(F.col("v").isNotNull()).groupBy("label", "v")
            .agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")))


def _described(one: DataFrame, size: int, n: int, cosine: float) -> tuple[DataFrame, Description]:
    """``vec_id, label, v, copies, near`` of all entries, and the fitted description."""
    wanted = max(FEWEST, int(np.ceil(PIVOTS * np.sqrt(n))))
    rate = min(1.0, max(SAMPLED * wanted, FITTED) / n)
    whole = one.where(F.size("v") == size)
    sample = (whole.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 40)) < int(rate * (1 << 40)) + 1)
              .select("vec_id", "v").orderBy("vec_id").toPandas())
    if sample.empty:
        sample = whole.orderBy("vec_id").limit(1).toPandas()
    made = Description(np.stack(sample["v"].to_list()).astype(np.float64), wanted, cosine)
    shared = one.sparkSession.sparkContext.broadcast(made)

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for _, part in frame.groupby(frame["v"].map(len)):
                near = shared.value.nearest(normalised(np.stack(part["v"].to_list()).astype(np.float64)))
                yield part.assign(near=list(near))

    kinds = dict(one.dtypes)
    schema = f"vec_id long, label {kinds['label']}, v {kinds['v']}, copies long, near array<int>"
    return written(one.select("vec_id", "label", "v", "copies").mapInPandas(describe, schema), "described"), made


def _compared(described: DataFrame, made: Description, n: int, cosine: float, block: int) -> DataFrame:
    """``vec_id, n, root``: links found in each list of an entry."""
    lists = described.withColumns({"pivot": F.explode("near"), "size": F.size("v")})
    key = ["label", "size", "pivot"]
    large = (lists.groupBy(*key).agg(F.count("*").alias("rows"))
             .where(F.col("rows") > block).select(*key, F.ceil(F.col("rows") / block).cast("int").alias("parts")))
    parts = F.coalesce(F.col("parts"), F.lit(1))
    cut = (lists.join(large, key, "left").withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(3)), parts).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
           .withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")}))
    tasks = max(1, -(-n * made.depth // TASK))
    task = F.when(F.col("parts").isNull(), F.pmod(F.xxhash64(*key), F.lit(tasks))).otherwise(F.xxhash64(*key, "low", "high"))
    shared = made.shared
    return (cut.select(task.alias("task"), *key, "low", "high", "part", "vec_id", "v", "near", "copies").groupBy("task")
            .applyInPandas(lambda frame: _links(frame, cosine, shared), LINKS))


def _with_copies(entries: DataFrame, classes: DataFrame, n: int) -> DataFrame:
    """``vec_id, n_links, component_id`` of every vector that stands for more than itself.
    Classes that hold a large share of the rows are joined in several places."""
    many = classes.where(F.col("copies") > 1).withColumn("h", F.xxhash64("label", "v"))
    hot = many.where(F.col("copies") > max(COPIES, n // 1000)).select("h", "copies").collect()  # fewer than 1000
    slots = {r.h: int(1 + r.copies // COPIES) for r in hot}
    pairs = [F.lit(x) for h, s in sorted(slots.items()) for x in (h, s)]
    n_slots = F.coalesce(F.element_at(F.create_map(*pairs), F.col("h")), F.lit(1)) if pairs else F.lit(1)
    left = (entries.where(F.col("v").isNotNull()).withColumn("h", F.xxhash64("label", "v"))
            .withColumn("slot", F.pmod(F.xxhash64("vec_id"), n_slots).cast("int")))
    right = many.withColumn("slot", F.explode(F.sequence(F.lit(0), n_slots - 1))).select("h", "slot", "label", "v", "n_links", "component_id")
    return left.join(right, ["h", "slot", "label", "v"]).select("vec_id", "n_links", "component_id")


def duplicates(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every vector: the vectors of its label
    linked with it at ``cosine`` or above, the smallest id that links reach, and whether
    that is its own.

    Vectors that are null, empty, zero or hold null or non-finite components, and vectors
    without a label, have no links; so have pairs of different lengths. Rows that repeat an
    id are one vector (the greatest that can link). A row without an id takes no part and
    is returned with null id, null component and null ``kept``. Empty table: empty result.
    Other columns are not read."""
    spark = vectors.sparkSession
    ship(spark)
    entries = written(_entries(vectors), "vectors")
    unnamed = (vectors.where(F.col("vec_id").isNull())
               .select(F.lit(None).cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id")))
    alone = F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    out = unnamed.unionAll(entries.where(F.col("v").isNull()).select("vec_id", *alone))
    one = written(_distinct(entries), "distinct-vectors")
    sizes = one.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("rows"))
    most, n = sizes.orderBy(F.desc("rows"), "size").first(), one.count()
    if most is not None:
        described, made = _described(one, most["size"], n, cosine)
        found = written(_compared(described, made, n, cosine, block), "vector-links")
        degree = found.groupBy("vec_id").agg(F.sum("n").alias("n"))
        reached = components(found.where(F.col("vec_id") != F.col("root")).select(F.col("vec_id").alias("u"), F.col("root").alias("v")))
        classes = written(
            one.join(degree, "vec_id", "left").join(reached.select(F.col("node").alias("vec_id"), F.col("label").alias("reached")), "vec_id", "left")
            .select("vec_id", "label", "v", "copies", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                    F.coalesce("reached", "vec_id").alias("component_id")), "vector-classes")
        out = (out.unionAll(classes.where(F.col("copies") == 1).select("vec_id", "n_links", "component_id"))
               .unionAll(_with_copies(entries, classes, n)))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))

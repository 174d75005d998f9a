"""Near-duplicate detection by order MinHash.

Every text is a sequence of five-word shingles, each labelled with how many times
it occurred before. A signature samples the ``TUPLE`` shingles with the smallest
hashes and keeps them in text order; ``SIGNATURES`` of them put a text in as many
buckets. Texts that share shingles in another order do not meet.

Candidates are verified by banded alignment of the two shingle sequences: aligned
shingles over all shingles, counted once, must reach the threshold.

1. Equal texts become one node, named by their smallest id.
2. In every bucket all texts are compared with its smallest id; verified links are
   joined to components. That settles groups of many copies with one comparison a
   member and bucket.
3. A bucket that still holds several components is compared in full across
   components, in blocks of bounded size cut by text length and hash, so that no
   link between different texts is lost and no task holds a whole bucket. The bucket's
   largest component, which step 2 has joined, meets the others but not itself. Two texts
   that share several buckets are compared in the first of them only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .frames import pack, ship, unpack, written
from .tokens import chunks, mix, runs, shingles, texts_of

SHINGLE = 5
THRESHOLD = 0.8
SIGNATURES = 16
TUPLE = 4
#: Texts, and shingles, of one side of a comparison block, about.
BLOCK = 512
BLOCK_SHINGLES = 1 << 18
_FACTORS = np.random.default_rng(11).integers(1, 2**63, SIGNATURES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def occurrences(values: np.ndarray) -> np.ndarray:
    """How many equal values stand before each."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    new = np.ones(len(values), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    start = np.maximum.accumulate(np.where(new, np.arange(len(values)), 0))
    out = np.empty(len(values), np.int64)
    out[order] = np.arange(len(values)) - start
    return out


def signatures(words: np.ndarray) -> np.ndarray:
    """Order MinHash of one text; empty for a text without words."""
    s = shingles(words, SHINGLE)
    n = len(s)
    if n == 0:
        return np.zeros(0, np.int64)
    times = occurrences(s)
    if times.any():
        s = np.where(times > 0, mix(s + times.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), s)
    if n > TUPLE:
        ranked = s[None, :] * _FACTORS[:, None]
        least = np.sort(np.argpartition(ranked, TUPLE - 1, axis=1)[:, :TUPLE], axis=1)
        kept = s[least]
    else:
        kept = np.repeat(s[None, :], SIGNATURES, axis=0)
    h = np.full(SIGNATURES, n if n <= TUPLE else 0, np.uint64)
    for j in range(kept.shape[1]):  # in text order
        h = mix(h * np.uint64(31) + kept[:, j])
    return h.view(np.int64)


def aligned(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Similarity of two shingle sequences by their longest common subsequence within
    the band that the threshold allows; 0 once it is known to be below.

    With ``L`` aligned of ``n`` and ``m``, the similarity is ``L / (n + m - L)``. To reach
    the threshold ``L`` must be at least ``need``, so that aligned positions differ by at
    most ``max(n, m) - need``: alignments outside that band are never followed."""
    n, m = len(a), len(b)
    if n == 0 or m == 0:
        return 0.0
    need = int(np.ceil(threshold * (n + m) / (1 + threshold) - 1e-9))
    if need > min(n, m):
        return 0.0
    if n == m and np.array_equal(a, b):
        return 1.0
    at, bt = np.flatnonzero(np.isin(a, b)), np.flatnonzero(np.isin(b, a))
    if min(len(at), len(bt)) < need:
        return 0.0
    band = max(n, m) - need
    x, y = a[at], b[bt]
    short = min(len(x), len(y))
    off = (x[:short] != y[:short]) | (np.abs(at[:short] - bt[:short]) > band)
    head = int(np.argmax(off)) if off.any() else short
    x, y, at, bt = x[head:], y[head:], at[head:], bt[head:]
    short = min(len(x), len(y))
    off = (x[::-1][:short] != y[::-1][:short]) | (np.abs(at[::-1][:short] - bt[::-1][:short]) > band)
    tail = int(np.argmax(off)) if off.any() else short
    x, y, at, bt = x[: len(x) - tail], y[: len(y) - tail], at[: len(at) - tail], bt[: len(bt) - tail]
    total = head + tail + _common(x, y, at, bt, band)
    return total / (n + m - total) if total >= need else 0.0


def _common(x: np.ndarray, y: np.ndarray, at: np.ndarray, bt: np.ndarray, band: int) -> int:
    """Longest common subsequence within a band, a row of the table as the bits of one
    number."""
    if len(x) == 0 or len(y) == 0:
        return 0
    places: dict[int, int] = {}
    for j, v in enumerate(y.tolist()):
        places[v] = places.get(v, 0) | 1 << j
    low = np.searchsorted(bt, at - band).tolist()
    high = np.searchsorted(bt, at + band, side="right").tolist()
    every = (1 << len(y)) - 1
    row = every
    for v, i, j in zip(x.tolist(), low, high):
        hit = row & places.get(v, 0) & (((1 << (j - i)) - 1) << i if j > i else 0)
        row = (row + hit | row - hit) & every
    return len(y) - row.bit_count()


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id, h1, h2, n, sigs`` of every row: hashes that name its text, its number of
    shingles, its signatures (none without words)."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            sigs, n = [], []
            for a, b in chunks(texts):
                r = runs(texts[a:b])
                for i, j in zip(r.first[:-1], r.first[1:]):
                    sigs.append(signatures(r.hash[i:j]))
                    n.append(max(min(j - i, 1), j - i - SHINGLE + 1))
            own = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "h1", "h2")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(n, pa.int32()), pa.array(sigs, pa.list_(pa.int64()))],
                                             ["doc_id", "h1", "h2", "n", "sigs"])

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text", F.lit(1)).alias("h1"),
                        F.xxhash64(F.lit(2), "text").alias("h2"), "text").where(F.col("text").isNotNull())
    return named.mapInArrow(sign, "doc_id long, h1 long, h2 long, n int, sigs array<long>")


def _verified(pairs: DataFrame) -> DataFrame:
    """``u, v, u_text, v_text`` -> the ``u, v`` that reach the threshold."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sequence = None, None
        for batch in batches:
            u, v = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("u", "v"))
            left, right = texts_of(batch, "u_text"), texts_of(batch, "v_text")
            keep = []
            for a, b in chunks(left):
                r = runs(left[a:b])
                for k, (i, j) in enumerate(zip(r.first[:-1], r.first[1:]), a):
                    if last is None or right[k] != last:  # rows come by hub
                        last, sequence = right[k], shingles(runs([right[k]]).hash, SHINGLE)
                    keep.append(aligned(shingles(r.hash[i:j], SHINGLE), sequence) >= THRESHOLD)
            found = [i for i, k in enumerate(keep) if k]
            yield pa.RecordBatch.from_arrays([pa.array([u[i] for i in found], pa.int64()), pa.array([v[i] for i in found], pa.int64())],
                                             ["u", "v"])

    return pairs.select("u", "v", "u_text", "v_text").mapInArrow(check, "u long, v long")


def _blocks(members: DataFrame) -> DataFrame:
    """``bucket, node, n, label`` of buckets with several labels -> one row for each
    comparison block a node takes part in: ``block``, ``side``.

    Texts of a bucket are cut into those of its main label (the one with most texts) and
    the others, these into classes of length (a class is 12 % wide, so a match is at most
    two classes away) and each class by hash into parts of about ``BLOCK``. A part meets
    itself, the other parts of its class and those of the next two, but parts of the main
    label do not meet one another: they hold one component."""
    main = (members.groupBy("bucket", "label").agg(F.count("*").alias("held")).groupBy("bucket")
            .agg(F.max(F.struct("held", "label")).getField("label").alias("main")))
    m = (members.join(main, "bucket").withColumn("other", F.col("label") != F.col("main"))
         .withColumn("size", F.floor(F.log("n") / float(np.log(1.12))).cast("int")))
    sizes = (m.groupBy("bucket", "other", "size")
             .agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("parts")))
    m = m.join(sizes, ["bucket", "other", "size"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    its = sizes.select(F.col("bucket").alias("b2"), F.col("other").alias("o2"), F.col("size").alias("s2"), F.col("parts").alias("p2"))
    near = m.join(its, (F.col("bucket") == F.col("b2")) & F.col("size").between(F.col("s2") - 2, F.col("s2") + 2)
                  & (F.col("other") | F.col("o2")))
    met = near.select("bucket", "node", "label", "other", "size", "part", "o2", "s2",
                      F.explode(F.sequence(F.lit(0), F.col("p2") - 1)).alias("part2"))
    own = F.struct(F.col("size").alias("s"), F.col("other").alias("o"), F.col("part").alias("p"))
    its = F.struct(F.col("s2").alias("s"), F.col("o2").alias("o"), F.col("part2").alias("p"))
    return met.select("node", "label", F.struct("bucket", F.least(own, its).alias("a"), F.greatest(own, its).alias("b")).alias("block"),
                      (own == its).alias("alone"), (own <= its).alias("first"))


def _compare(key, frame: pd.DataFrame) -> pd.DataFrame:
    """Links across labels between the two sides of a block, as many as join its labels;
    a pair that earlier links have joined, or that shares the bucket of an earlier
    band, is not looked at. Shared shingles are counted
    first, for all pairs of the block at once; only pairs that can reach the threshold
    are aligned."""
    frame = frame.drop_duplicates(["node", "first"])
    alone, band = bool(frame["alone"].all()), int(frame["band"].iloc[0])
    label, first, sigs = frame["label"].to_numpy(), frame["first"].to_numpy(), np.stack(frame["sigs"].to_list())
    open_ = np.triu(label[:, None] != label[None, :], 1)
    if not alone:
        open_ &= first[:, None] != first[None, :]
    for k in range(band):
        open_ &= sigs[:, None, k] != sigs[None, :, k]
    use = np.flatnonzero(open_.any(axis=0) | open_.any(axis=1))
    if len(use) == 0:
        return pd.DataFrame({"u": [], "v": []}, dtype="int64")
    frame, label, open_ = frame.iloc[use].reset_index(drop=True), label[use], open_[np.ix_(use, use)]
    words = runs(frame["text"].tolist())
    parts = [shingles(words.hash[i:j], SHINGLE) for i, j in zip(words.first[:-1], words.first[1:])]
    kinds = [np.unique(p) for p in parts]
    shared = np.zeros((len(parts), len(parts)), np.int32)
    value = np.concatenate(kinds) if kinds else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(kinds)), [len(k) for k in kinds])
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    cut = np.flatnonzero(np.diff(value)) + 1
    for owners in np.split(owner, cut):
        if len(owners) > 1:
            shared[np.ix_(owners, owners)] += 1
    size = np.array([len(p) for p in parts])
    # a shingle may occur more than once: all but the distinct ones of the shorter text may match too
    spare = size - np.array([len(k) for k in kinds])
    most = shared + np.minimum(spare[:, None], spare[None, :])
    open_ &= most >= THRESHOLD * (size[:, None] + size[None, :] - most) - 1e-9
    out = []
    for i in range(len(parts)):
        for j in np.flatnonzero(open_[i]):
            if label[i] == label[j]:
                continue
            if aligned(parts[i], parts[j]) >= THRESHOLD:
                out.append((frame["node"][i], frame["node"][j]))
                label = np.where(label == label[j], label[i], label)
    return pd.DataFrame(out, columns=["u", "v"], dtype="int64")


def duplicate_classes(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id`` of every row: the smallest id among the texts it is linked
    to, through any chain of links.

    Equal texts (the empty text too) share a class. Null text: a class of its own,
    named by its id. A text of one to four words is one shingle. Rows that repeat an
    id are one document. Null id: takes its text's class, null where no other row has
    the text. Empty table: empty result. Other columns are not read."""
    ship(docs.sparkSession)
    rows = written(signed(docs), "signed")
    texts = written(rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"),
                                                 F.first("sigs").alias("sigs")).where(F.col("node").isNotNull()), "texts")
    entries = texts.where(F.col("n") > 0).select("node", "n", F.posexplode("sigs").alias("band", "sig"))
    entries = entries.select("node", "n", F.struct("band", "sig").alias("bucket"))
    hubs = (entries.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("hub"), F.count("*").alias("held"))
            .where(F.col("held") > 1))
    crowded = written(entries.join(hubs, "bucket").select("bucket", "node", "n", "held", F.col("hub.node").alias("hub"),
                                                          F.col("hub.n").alias("hub_n")), "crowded")
    fits = F.least("n", "hub_n") >= F.lit(THRESHOLD) * F.greatest("n", "hub_n") - 1e-9
    pairs = crowded.where((F.col("node") != F.col("hub")) & fits).select("node", "hub").distinct()
    source = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    u = source.select(F.col("doc_id").alias("u"), F.col("text").alias("u_text"))
    v = source.select(F.col("doc_id").alias("v"), F.col("text").alias("v_text"))
    candidates = (pairs.select(F.col("node").alias("u"), F.col("hub").alias("v")).join(u, "u").join(v, "v"))
    links = written(_verified(candidates).distinct(), "links")
    labels = components(links)

    named = crowded.join(labels, "node", "left").select("bucket", "node", "n", "held", F.coalesce("label", "node").alias("label"))
    mixed = (named.where(F.col("held") > 2).groupBy("bucket").agg(F.min("label").alias("a"), F.max("label").alias("b"))
             .where(F.col("a") < F.col("b")).select("bucket"))
    members = written(named.join(mixed, "bucket").select("bucket", "node", "n", "label"), "mixed")
    blocks = _blocks(members)
    more = (blocks.join(source, F.col("node") == F.col("doc_id")).join(texts.select("node", "sigs"), "node")
            .select("block", "block.bucket.band", "node", "label", "alone", "first", "sigs", "text")
            .groupBy("block").applyInPandas(_compare, "u long, v long"))
    more = written(more.distinct(), "more")
    if not more.isEmpty():
        joined = more
        for c in ("u", "v"):
            at = labels.select(F.col("node").alias(f"{c}_node"), F.col("label").alias(f"{c}_label"))
            joined = joined.join(at, F.col(c) == F.col(f"{c}_node"), "left")
        contracted = components(joined.select(F.coalesce("u_label", "u").alias("u"), F.coalesce("v_label", "v").alias("v")))
        # a label may move on to a smaller one; a node without a label may have got one
        final = contracted.select(F.col("node").alias("label"), F.col("label").alias("new"))
        fresh = contracted.join(labels, "node", "left_anti").select("node", F.col("node").alias("label"))
        labels = labels.union(fresh).join(final, "label", "left").select("node", F.coalesce("new", "label").alias("label"))
    named_texts = (texts.select("h1", "h2", "node").join(labels, "node", "left")
                   .select("h1", "h2", F.coalesce("label", "node").alias("class_id")))
    known = rows.select("doc_id", "h1", "h2").join(named_texts, ["h1", "h2"], "left").select("doc_id", "class_id")
    alone = docs.where(F.col("text").isNull()).select(F.col("doc_id").cast("long").alias("doc_id"),
                                                       F.col("doc_id").cast("long").alias("class_id"))
    return known.unionByName(alone)


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class, the one that names it. Rows with a null
    id stay. Of rows that repeat an id one stays."""
    classes = written(duplicate_classes(docs), "classes")
    kept = classes.groupBy(F.col("doc_id").alias("kept_id")).agg(F.min("class_id").alias("class_id"), F.count("*").alias("rows"))
    kept = kept.where(F.col("kept_id") == F.col("class_id"))
    packed = pack(docs, doc_id=F.col("doc_id").cast("long"))
    stay = packed.join(kept, F.col("doc_id") == F.col("kept_id"), "left").where(
        F.col("kept_id").isNotNull() | F.col("doc_id").isNull())
    once = stay.where(F.coalesce(F.col("rows"), F.lit(1)) == 1)
    again = (stay.where(F.col("rows") > 1).groupBy("doc_id").agg(F.first("row").alias("row")))
    return unpack(once.select("row").union(again.select("row")), docs)

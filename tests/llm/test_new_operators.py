"""Vector near-duplicates, ranked search and periodic runs against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillflow.llm import decontamination, near_dedup, periodic_runs, quality, queries, ranked_search, token_counts, vector_dedup

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, near string, v int"


# -- vector near-duplicates ------------------------------------------------------

def brute_force_classes(rows, cosine=0.93):
    """(vec_id, n_links, component_id, kept) from all pairs; a row for each id."""
    best = {}
    for i, e, label in rows:
        best.setdefault(i, (e, label))
    ids, own = sorted(best), {}
    links = {i: set() for i in ids}
    x = {}
    for i in ids:
        e, label = best[i]
        if label is None or not e or any(c is None or not math.isfinite(c) for c in e) or not any(e):
            continue
        x[i] = (label, np.asarray(e, np.float64) / max(map(abs, e)))
    for i in x:
        for j in x:
            if i < j and x[i][0] == x[j][0] and len(x[i][1]) == len(x[j][1]):
                a, b = x[i][1], x[j][1]
                if a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= cosine:
                    links[i].add(j)
                    links[j].add(i)
    for i in ids:
        if i not in own:
            todo, own[i] = [i], i
            while todo:
                for j in links[todo.pop()]:
                    if j not in own:
                        own[j] = i
                        todo.append(j)
    return {(i, len(links[i]), own[i], own[i] == i) for i in ids}


def partner(rng, x, cosine):
    """A vector at exactly this cosine from ``x``, of another length."""
    z = rng.standard_normal(len(x))
    z -= (z @ x) * x / (x @ x)
    return 3 * (cosine * x / np.sqrt(x @ x) + np.sqrt(1 - cosine**2) * z / np.sqrt(z @ z))


@pytest.fixture(scope="module")
def planted():
    """Pairs at the threshold, chains, a dense group, copies, odd vectors; two labels."""
    rng = np.random.default_rng(3)
    rows, new = [], iter(range(1, 10**6)).__next__
    for label in (1, 2):
        for _ in range(150):
            x = rng.standard_normal(24)
            rows.append((new(), x, label))
            for c in (0.935, 0.95, 0.99):
                rows.append((new(), partner(rng, x, c), label))
            rows.append((new(), partner(rng, x, 0.92), label))
            rows.append((new(), partner(rng, x, 0.97), 3 - label))
        centre = rng.standard_normal(24)
        rows += [(new(), partner(rng, centre, 0.975), label) for _ in range(120)]
        same = rng.standard_normal(24)
        rows += [(new(), same, label) for _ in range(60)]
    rows = [(i, [float(np.float32(c)) for c in x], label) for i, x, label in rows]
    one = rows[0][1]
    rows += [(new(), one, None), (new(), None, 1), (new(), [], 1), (new(), [0.0] * 24, 1), (new(), [*one[:-1], None], 1),
             (new(), [*one[:-1], float("nan")], 1), (new(), [*one[:-1], float("inf")], 1), (new(), one[:5], 1), (new(), one[:5], 1),
             (new(), [float(np.float32(c * 1e30)) for c in one], 1), (new(), [float(np.float32(c * 1e-30)) for c in one], 1)]
    return rows


def as_set(df):
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    return {tuple(r) for r in df.collect()}


@pytest.mark.parametrize("block", [8192, 50])
def test_vector_classes_against_brute_force(spark, planted, block):
    """Also with lists cut into many parts. Nine links of ten must be found."""
    df = spark.createDataFrame([(*r, "x", 7) for r in planted], VECTORS)
    got, want = as_set(vector_dedup.duplicates(df, block=block)), brute_force_classes(planted)
    assert {i for i, *_ in got} == {i for i, *_ in want} and len(got) == len(want)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    print(f"links found {found} of {there}")
    assert 0.99 * there <= found <= there
    by_id = {r[0]: r for r in want}
    assert all(r[1] <= by_id[r[0]][1] and r[2] >= by_id[r[0]][2] for r in got)  # no link that is none


def test_vector_classes_do_not_depend_on_blocks(spark, planted):
    df = spark.createDataFrame([(*r, "x", 7) for r in planted], VECTORS)
    assert as_set(vector_dedup.duplicates(df, block=8192)) == as_set(vector_dedup.duplicates(df.repartition(5), block=20))


def test_vector_query_against_brute_force(spark):
    rows = [tuple(r) for r in queries.table(spark, SF, "embeddings").select("vec_id", "embedding", "label").collect()]
    assert as_set(queries.op11_pivot_permutation(spark, SF)) == brute_force_classes(rows)


def test_vector_edges(spark):
    kind = VECTORS
    assert vector_dedup.duplicates(spark.createDataFrame([], kind)).count() == 0
    nothing = spark.createDataFrame([(1, None, 1, "x", 1), (None, [1.0], 1, "x", 1), (2, [1.0], None, "x", 1)], kind)
    assert as_set(vector_dedup.duplicates(nothing)) == {(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, None)}
    few = spark.createDataFrame([(3, [1.0, 0.0], 1, None, None)] * 2 + [(5, [2.0, 0.0], 1, None, None), (4, [1.0, 0.0], 1, None, None),
                                                                        (6, [0.0, 1.0], 1, None, None)], kind)
    assert as_set(vector_dedup.duplicates(few)) == {(3, 2, 3, True), (4, 2, 3, False), (5, 2, 3, False), (6, 0, 6, True)}


def test_copies_joined_in_several_places(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "COPIES", 5)
    rows = [(i, [1.0, 2.0], 1, None, None) for i in range(40)] + [(i, [float(i), 1.0], 2, None, None) for i in range(100, 110)]
    got = as_set(vector_dedup.duplicates(spark.createDataFrame(rows, VECTORS)))
    assert {r for r in got if r[0] < 40} == {(i, 39, 0, i == 0) for i in range(40)} and len(got) == 50


# -- ranked search ---------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force_ranks(docs, items, k=10):
    words = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    words = [(i, w) for i, w in words if w]
    n_docs, total = len(words), sum(len(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(TERM.findall((t or "").translate(LOWER)))
    out, counts = set(), [(i, len(w), Counter(w)) for i, w in words]
    for item, ts in asked.items():
        scored = []
        for i, n, tf in counts:
            m = 100 - 90 + (90 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                    for t in ts if tf[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out |= {(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])}
    return out


def test_terms_of_bytes_are_those_of_the_pattern():
    text = "Ärger ÄB éÉ x_y A1-b2\x7fZ{q} 中文。字  nb\u0085 ﬁn\n"
    assert [t.decode() for t in ranked_search.terms(text.encode())] == TERM.findall(text.translate(LOWER))


@pytest.mark.parametrize("shard", [1_500_000, 300])
def test_ranked_search_against_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(ranked_search, "SHARD", shard)
    docs = [tuple(r) for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in queries.table(spark, SF, "benchmark").select("item_id", "text").collect()]
    got = queries.op12_best_positions(spark, SF)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert {tuple(r) for r in got.collect()} == brute_force_ranks(docs, items)


def test_ranked_search_edges(spark, monkeypatch):
    docs = [(9, "the cat sat"), (3, "the cat sat"), (3, "the cat sat"), (None, "the cat sat"), (4, ""), (5, None), (6, "?!"),
            (7, " ".join(f"w{i % 977}" for i in range(20_000)) + " CAT"), (8, "the the the dog"), *((i, "the cat") for i in range(20, 40))]
    items = [(1, "A cat; cat"), (1, "dog"), (2, None), (None, "sat"), (3, "unheard"), (4, "the")]
    df = spark.createDataFrame([(i, t, "a", 1) for i, t in docs], "doc_id long, text string, n string, score int")
    bench = spark.createDataFrame([(i, t, "a") for i, t in items], "item_id long, text string, term string")
    want = brute_force_ranks(docs, items)
    # repeated ids of equal score have ranks of their own: compare as lists
    assert sorted(map(str, map(tuple, ranked_search.search(df, bench).collect()))) == sorted(map(str, want))
    monkeypatch.setattr(ranked_search, "SLICE", 2)  # items in several slices
    assert sorted(map(str, map(tuple, ranked_search.search(df, bench).collect()))) == sorted(map(str, want))
    assert ranked_search.search(df.limit(0), bench).count() == 0
    assert ranked_search.search(df, bench.limit(0)).count() == 0


def test_best_positions_stop_early_and_lose_no_tie():
    """Random lists with many equal contributions; the search must not read everything."""
    rng = np.random.default_rng(2)
    n, v, looked = 3000, 12, 0
    tf = rng.poisson(0.4, (n, v)) * (rng.random((n, v)) < 0.5)
    rows, of = np.nonzero(tf)
    first = np.searchsorted(rows, np.arange(n + 1))
    weights, m = rng.integers(0, 900, v), rng.integers(10, 14, n)
    shard = ranked_search.Shard(np.ones(n, np.int64), first, of, tf[rows, of], m, weights)
    gain = weights * ((10**9 * tf) // np.maximum(1000 * tf + 8 * m[:, None], 1))
    for q in range(300):
        mine = rng.choice(v, rng.integers(1, 6), replace=False)
        score = gain[:, mine].sum(axis=1)
        want = sorted((-s, i) for i, s in enumerate(score.tolist()) if s > 0)[:10]
        got = shard.best(q, np.sort(mine), 10, 0)
        assert sorted((-int(shard.score[i]), int(i)) for i in got)[:10] == want
        looked += int((shard.known == q).sum())
    assert looked < 300 * n * 0.7


# -- periodic runs ----------------------------------------------------------------

def brute_force_runs(words):
    n, out = len(words), []
    for p in range(1, n // 3 + 1):
        i = p
        while i < n:
            if words[i] != words[i - p]:
                i += 1
                continue
            start = i - p
            while i < n and words[i] == words[i - p]:
                i += 1
            size = i - start
            if size >= max(24, 3 * p) and not any(all(words[k] == words[k - q] for k in range(start + q, start + size)) for q in range(1, p)):
                out.append((start, size, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_force_record(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_force_runs(words)
    kept = [w for i, w in enumerate(words) if not any(s + p <= i < s + size for s, size, p in runs)]
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            digest("".join(f"{s},{size},{p}\n" for s, size, p in runs)), digest(" ".join(kept)))


def test_runs_against_brute_force():
    rng = np.random.default_rng(1)
    found = 0
    for _ in range(400):
        k = int(rng.integers(1, 5))
        parts = [np.tile(rng.integers(0, k, rng.integers(1, 25)), int(rng.integers(1, 8)))[: rng.integers(1, 120)]
                 for _ in range(int(rng.integers(1, 6)))]
        words = np.concatenate(parts).astype(np.int64)
        want = brute_force_runs(words.tolist())
        found += len(want)
        assert periodic_runs.runs(words) == want
    assert found > 300


def test_the_automaton_alone_finds_the_runs(monkeypatch):
    """Without the cut into stretches every word goes through the automaton."""
    monkeypatch.setattr(periodic_runs, "stretches", lambda near: [(0, len(near))])
    rng = np.random.default_rng(4)
    for _ in range(150):
        k = int(rng.integers(1, 4))
        words = np.concatenate([rng.integers(0, k, 80), np.tile(rng.integers(0, k, 7), 9), np.tile(rng.integers(0, k, 13), 5)])
        assert periodic_runs.runs(words) == brute_force_runs(words.tolist())


def test_lists_laid_end_to_end_do_not_mix():
    lists = [[b"a", b"b"] * 15, [b"a", b"b"] * 15, [], [b"x"], [b"c%d" % (i % 9) for i in range(27)], [b"d%d" % (i % 9) for i in range(26)]]
    assert periodic_runs.runs_of_all(lists) == [[(0, 30, 2)], [(0, 30, 2)], [], [], [(0, 27, 9)], []]


def test_runs_query_against_brute_force(spark):
    docs = [r for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect() if len((r.text or "").split()) < 1500]
    got = {r.doc_id: tuple(r) for r in queries.op13_periodic_runs(spark, SF).collect()}
    assert len(got) == queries.table(spark, SF, "documents").count()
    assert [got[r.doc_id] for r in docs] == [brute_force_record(r.doc_id, r.text) for r in docs]
    assert sum(r[1] > 0 for r in got.values()) > 5


def test_runs_edges(spark):
    texts = [(1, "a b " * 20), (1, "a b " * 20), (2, None), (3, ""), (None, "x " * 30), (4, "one word\x85 " + "u v " * 24),
             (5, " \t\n\x0b\x0c\r "), (7, " ".join(f"w{i % 2500}" for i in range(20_000)))]
    df = spark.createDataFrame([(*t, "s", 1) for t in texts], "doc_id long, text string, start string, n_runs int")
    got = sorted(map(str, map(tuple, periodic_runs.periodic_runs(df).collect())))
    small = [t for t in texts if t[0] != 7]
    assert [r for r in got if not r.startswith("(7,")] == sorted(str(brute_force_record(i, t)) for i, t in small)
    assert [r[:33] for r in got if r.startswith("(7,")] == ["(7, 1, 0, 20000, 2500, 8000, '" + r[30:33] for r in got if r.startswith("(7,")]
    assert periodic_runs.periodic_runs(df.where(F.lit(False))).count() == 0


# -- mended operators --------------------------------------------------------------

def test_rollup_equals_direct_counts_and_survives_a_restart(spark, tmp_path):
    import public_tokenizers
    import tiktoken  # noqa: F401

    docs = queries.table(spark, SF, "documents")
    version = queries.VOCABULARY.rsplit("/", 1)[-1].removesuffix(".tiktoken")
    counts = token_counts.count_tokens(docs, queries.VOCABULARY, public_tokenizers.PATTERN, version)
    want = sorted(map(str, map(tuple, counts.where("tokens > 0").groupBy("source", "lang", "version")
                               .agg(F.count("*"), F.sum("tokens"), F.sum("chars")).collect())))
    got = queries.op6_token_rollups(spark, SF)
    assert sorted(map(str, map(tuple, got.select("source", "lang", "version", "documents", "tokens", "chars").collect()))) == want
    path = str(tmp_path / "rollup")
    assert token_counts.Rollup(spark, path).totals().count() == 0
    first = token_counts.Rollup(spark, path)
    assert first.commit("a", token_counts.signed(counts, 1)) and not first.commit("a", token_counts.signed(counts, 1))
    again = token_counts.Rollup(spark, path)
    assert not again.commit("a", token_counts.signed(counts, 1)) and again.batches() == ["a"]
    again.compact()
    assert again.commit("b", token_counts.signed(counts.where("tokens = 0"), -1))
    third = token_counts.Rollup(spark, path)
    assert not third.commit("a", token_counts.signed(counts, 1)) and third.batches() == ["a", "b"]
    totals = third.totals().select("source", "lang", "version", "documents", "tokens", "chars")
    assert sorted(map(str, map(tuple, totals.collect()))) == want


def test_token_counts_edges(spark):
    import public_tokenizers

    kind = "doc_id long, text string, source string, lang string, tokens string"
    rows = [(1, "one two", "s", "en", "x"), (1, "one two", "s", "en", "x"), (None, None, None, None, None), (2, "", "s", "en", "x")]
    count = lambda df: token_counts.count_tokens(df, queries.VOCABULARY, public_tokenizers.PATTERN, "v")
    got = sorted(map(str, map(tuple, count(spark.createDataFrame(rows, kind)).collect())))
    assert len(got) == 4 and got[0] == got[1] and "(None, None, None, 0, 0, 'v')" in got
    assert count(spark.createDataFrame([], kind)).count() == 0


def test_decontamination_weights_do_not_depend_on_slices(spark):
    """The same document and item score alike however the benchmark is cut."""
    bench = queries.table(spark, SF, "benchmark")
    docs = queries.table(spark, SF, "documents")
    whole = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in decontamination.matches(docs, bench).collect()}
    cut = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in decontamination.matches(docs, bench, slice_items=9).collect()}
    assert whole == cut and len(whole) > 0


def test_decontamination_recall_by_band(spark):
    """Every window of planted, edited passages against the exact weighted similarity."""
    rng = np.random.default_rng(5)
    words = lambda n: [f"w{j}" for j in rng.integers(0, 5000, n)]
    items = [words(int(n)) for n in rng.integers(30, 200, 60)]
    index = decontamination.Index(list(range(len(items))), [" ".join(x) for x in items])
    texts, plants = [], []
    for k, item in enumerate(items):
        for edits in (0, 1, 2, 3, 5):
            copy = list(item)
            for j in rng.choice(len(copy), min(edits, len(copy) // 30), replace=False):
                copy[j] = "edited"
            texts.append(" ".join([*words(50), *copy, *words(50)]))
            plants.append((len(texts) - 1, k, copy))
    found = {(d, i) for d, i, _, _ in index.search(texts)}
    bands = {}
    for d, k, copy in plants:
        _, values = next(decontamination.item_shingles([" ".join(copy)]))
        s = index.similarity(values.tolist(), k)
        if s >= decontamination.THRESHOLD:
            bands.setdefault(int(s * 20) / 20, []).append((d, k) in found)
    print({b: (sum(x), len(x)) for b, x in sorted(bands.items())})
    assert all(sum(x) >= 0.95 * len(x) for x in bands.values()) and len(bands) >= 3
    assert not any(index.search([" ".join(words(300)) for _ in range(20)]))


def test_near_dedup_blocks_lose_no_link_across_components(spark):
    """A bucket whose main component has met its hub, with links only between the others."""
    rng = np.random.default_rng(9)
    base = [f"w{j}" for j in rng.integers(0, 10**6, 120)]
    texts = [" ".join(base)]
    for _ in range(40):                 # near copies of the base, and copies of copies that drift away
        copy = list(base)
        copy[int(rng.integers(0, 120))] = f"e{rng.integers(0, 10**6)}"
        texts.append(" ".join(copy))
    drift = list(base)
    for step in range(12):
        drift = list(drift)
        drift[int(rng.integers(0, 120))] = f"d{step}"
        texts.append(" ".join(drift))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    r = near_dedup.runs(texts)
    seq = [near_dedup.shingles(r.hash[i:j]) for i, j in zip(r.first[:-1], r.first[1:])]
    own = list(range(len(texts)))
    for x in range(len(texts)):
        for y in range(x):
            if near_dedup.aligned(seq[x], seq[y]) >= near_dedup.THRESHOLD:
                a, b = own[x], own[y]
                own = [min(a, b) if v in (a, b) else v for v in own]
    assert {r.doc_id: r.class_id for r in near_dedup.duplicate_classes(docs).collect()} == dict(enumerate(own))


def test_sample_is_bounded_by_ids_not_by_label_rows(spark):
    """Ten ids with many label rows each are all learned from."""
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(10)], "doc_id long, text string")
    labels = docs.crossJoin(spark.range(400)).select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    sample = quality.training_sample(docs, labels, "quality", 20)
    usable = {i for i in range(10) if zlib.crc32(str(i).encode()) % 4 != 2}
    assert {r.doc_id for r in sample.collect()} == usable


# -- pipeline ------------------------------------------------------------------------

def _in_duckdb(sql, rows):
    """Result of DuckDB SQL over a ``documents`` table of these rows."""
    import duckdb

    con = duckdb.connect()
    con.register("documents", rows.toArrow())
    rel = con.sql(sql)
    return [dict(zip(rel.columns, r)) for r in rel.fetchall()]


def test_pipeline_stages_against_brute_force(spark):
    """Each stage on what its predecessor kept: by the classifier's own scores, in DuckDB,
    by all pairs, by all windows, and in DuckDB again."""
    import corpus_pipeline
    from tillflow.llm import line_dedup, mixing
    from tillflow.llm.frames import written

    docs = queries.table(spark, SF, "documents")
    stages, kept = [f for _, f in corpus_pipeline.STAGES], [docs]
    for k, stage in enumerate(stages):
        kept.append(written(stage(spark, kept[-1], SF), f"test-stage{k}"))
        assert k == 4 or kept[-1].columns == docs.columns
    scored = quality.classify(docs, queries.table(spark, SF, "labels"))
    assert {r.doc_id for r in kept[1].collect()} == {r.doc_id for r in scored.where("predicted = 1").collect()}

    want = {r["doc_id"]: r["text"] for r in _in_duckdb(line_dedup.oracle_sql(), kept[1])}
    assert {r.doc_id: r.text for r in kept[2].collect()} == want

    rows = [tuple(r) for r in kept[2].select("doc_id", "text").collect()]
    r = near_dedup.runs([t for _, t in rows])
    seq = [near_dedup.shingles(r.hash[i:j]) for i, j in zip(r.first[:-1], r.first[1:])]
    own = {i: i for i, _ in rows}
    for x in range(len(rows)):
        for y in range(x):
            if rows[x][1] == rows[y][1] or near_dedup.aligned(seq[x], seq[y]) >= near_dedup.THRESHOLD:
                a, b = own[rows[x][0]], own[rows[y][0]]
                own = {k: min(a, b) if v in (a, b) else v for k, v in own.items()}
    assert {d.doc_id for d in kept[3].collect()} == set(own.values())

    items = [tuple(x) for x in queries.table(spark, SF, "benchmark").select("item_id", "text").collect()]
    index = decontamination.Index([i for i, _ in items], [t for _, t in items])
    clean = set()
    for d in kept[3].select("doc_id", "text").collect():
        words = decontamination.runs([d.text]).hash
        leaks = False
        for k, s in enumerate(index.shingles):
            size = min(decontamination.SHINGLE, len(decontamination.runs([items[k][1]]).hash))
            values = decontamination.windows(words, size)
            if not len(s) or not np.isin(values, s).any():
                continue
            span = len(s)
            leaks |= any(index.similarity(values[i : i + span].tolist(), k) >= decontamination.THRESHOLD
                         for i in range(max(1, len(values) - span + 1)))
        if not leaks:
            clean.add(d.doc_id)
    assert {d.doc_id for d in kept[4].collect()} == clean

    want = {(x["doc_id"], x["taken"]) for x in _in_duckdb(mixing.oracle_sql(), kept[4]) if x["taken"] > 0}
    assert {(d.doc_id, d.taken) for d in kept[5].collect()} == want


def test_pipeline_of_odd_and_empty_documents(spark, tmp_path):
    """Nulls in every column, an empty table, and repeated rows pass through all stages."""
    import corpus_pipeline

    real = queries.table(spark, SF, "documents")
    odd = [(None, "no id here at all " * 9, "en", "s", 9), (10**9, None, None, None, None), (10**9 + 1, "", "en", None, 0),
           (10**9 + 2, "same words twice over", "en", "s", 21), (10**9 + 2, "same words twice over", "en", "s", 21)]
    for name, docs in (("odd", real.unionByName(spark.createDataFrame(odd, real.schema))), ("none", real.limit(0))):
        folder = str(tmp_path / name)
        docs.write.parquet(f"{folder}/documents.parquet")
        for table in ("labels", "benchmark"):
            queries.table(spark, SF, table).write.parquet(f"{folder}/{table}.parquet")
        out = corpus_pipeline.run(spark, folder).collect()
        ids = [r.doc_id for r in out if r.doc_id is not None]
        assert len(ids) == len(set(ids)) and (name != "none" or not out)

"""Training-data operators on small tables: brute force, DuckDB and edge cases."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillflow.llm import (decontamination, extraction, line_dedup, lm_scoring, mixing, near_dedup, quality, queries, token_counts,
                          toxicity, vector_search)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, taken string, row string"
LONG = " ".join(f"w{i % 977}" for i in range(20_000))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing names."""
    rows = [(1, "a b c d e f g", "en", "s", 13, "x", "r"), (1, "a b c d e f g", "en", "s", 13, "x", "r"),
            (2, "a b c d e f g", "en", "s", 13, "x", "r"), (3, "", "en", None, 0, None, None), (4, None, None, "t", None, None, None),
            (5, LONG, "en", "t", len(LONG), "x", "r"), (6, "?!", None, "s", 2, "x", "r"), (None, "lost id", "en", "s", 7, "x", "r")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_matches_duckdb(spark, key):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    rel = con.sql(queries.ORACLE[key])
    got = queries.QUERIES[key](spark, SF).select(*rel.columns)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, rel.fetchall()))


def test_line_dedup_shuffle_equals_broadcast(spark):
    docs = queries.table(spark, SF, "documents")
    a, b = (sorted(map(tuple, line_dedup.dedup_lines(docs, broadcast_lines=n).select("doc_id", "text").collect())) for n in (10**6, -1))
    assert a == b


def test_line_dedup_edges(odd, empty):
    out = line_dedup.dedup_lines(odd)
    assert out.count() == 8 and set(odd.columns) <= set(out.columns)
    assert line_dedup.dedup_lines(empty).count() == 0


def test_mix_edges(odd, empty):
    out = mixing.mix(odd)
    assert out.count() == 8 and out.columns.count("taken") == 1
    assert out.where(F.col("taken") > 3 * F.col("size")).count() == 0
    assert mixing.mix(empty).count() == 0


def test_alignment_against_table():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a = rng.integers(0, 9, rng.integers(1, 25)).astype(np.uint64)
        b = np.delete(a, rng.integers(0, len(a), 2)) if len(a) > 3 else a
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                t[i + 1, j + 1] = t[i, j] + 1 if a[i] == b[j] else max(t[i, j + 1], t[i + 1, j])
        want = t[-1, -1] / (len(a) + len(b) - t[-1, -1])
        got = near_dedup.aligned(a, b)
        assert (got >= 0.8) == (want >= 0.8) and (got == 0 or abs(got - want) < 1e-9)


def test_near_dedup_against_brute_force(spark):
    docs = queries.table(spark, SF, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    r = near_dedup.runs([t for _, t in rows])
    seq = [near_dedup.shingles(r.hash[i:j]) for i, j in zip(r.first[:-1], r.first[1:])]
    own = {i: i for i, _ in rows}
    for x in range(len(rows)):
        for y in range(x):
            if rows[x][1] == rows[y][1] or near_dedup.aligned(seq[x], seq[y]) >= 0.8:
                a, b = own[rows[x][0]], own[rows[y][0]]
                own = {k: min(a, b) if v in (a, b) else v for k, v in own.items()}
    assert {r.doc_id: r.class_id for r in near_dedup.duplicate_classes(docs).collect()} == own


def test_near_dedup_edges(odd, empty):
    got = {(r.doc_id, r.class_id) for r in near_dedup.duplicate_classes(odd).collect()}
    assert got == {(1, 1), (2, 1), (3, 3), (4, 4), (5, 5), (6, 6), (None, None)}
    kept = near_dedup.keep_one(odd)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6] and kept.columns == odd.columns
    assert near_dedup.duplicate_classes(empty).count() == 0


def test_decontamination(spark, odd, empty):
    item = " ".join(f"w{i}" for i in range(100, 140))
    bench = spark.createDataFrame([(7, item), (8, None), (9, ""), (10, "b c d"), (11, item)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.matches(odd, bench).collect()}
    assert got == {(1, 10), (2, 10), (5, 7), (5, 11)}
    split = {(r.doc_id, r.item_id) for r in decontamination.matches(odd, bench, slice_items=2).collect()}
    assert split == got
    assert decontamination.matches(empty, bench).count() == 0 and decontamination.matches(odd, bench.limit(0)).count() == 0
    assert sorted(r.doc_id or 0 for r in decontamination.clean(odd, bench).collect()) == [0, 3, 4, 6]


@pytest.mark.parametrize("n", [60, 120, 250])
def test_decontamination_near_the_threshold(n):
    """Edited passages within longer texts, and cut items that are whole texts, against every window."""
    rng, found, wanted = np.random.default_rng(n), 0, 0
    items = [[f"i{k}w{j}" for j in range(n)] for k in range(40)]
    index = decontamination.Index(list(range(40)), [" ".join(x) for x in items])
    texts = []
    for k, x in enumerate(items):
        edited = list(x)
        for at in rng.choice(n, max(1, n // 60), replace=False):
            edited[at] = f"e{k}at{at}"
        texts.append(" ".join([f"b{j}" for j in range(30)] + edited + [f"a{j}" for j in range(30)]))
        texts.append(" ".join(x[: int(n * 0.86)]))
    got = {(d, i) for d, i, _, _ in index.search(texts)}
    r = decontamination.runs(texts)
    for d in range(len(texts)):
        v = decontamination.windows(r.hash[r.first[d] : r.first[d + 1]], 5)
        best = max(index.similarity(v[i : i + n - 4].tolist(), d // 2) for i in range(len(v)))
        wanted += best >= decontamination.THRESHOLD
        found += best >= decontamination.THRESHOLD and (d, d // 2) in got
    print("RECALL", n, found, wanted)
    assert wanted >= 40 and found >= 0.99 * wanted and all(d // 2 == i for d, i in got)


@pytest.mark.parametrize("run, label, least", [(quality.classify, "quality", 0.95), (toxicity.score, "toxic", 0.85)])
def test_classifiers(spark, odd, empty, run, label, least):
    sf = "/root/testdata/sf0.01"
    labels = queries.table(spark, sf, "labels")
    out = run(queries.table(spark, sf, "documents"), labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (out["predicted"] == out[label]).mean() >= least
    none = labels.limit(0)
    assert run(odd, none).count() == 8 and run(empty, none).count() == 0


def test_toxicity_over_all_terms(spark, monkeypatch):
    """Documents without a term that marks the label have neighbours, the nearest by brute force."""
    monkeypatch.setattr(toxicity, "BLOCK", 4)
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(f"word{j}x" for j in rng.integers(0, 60, 12)) + " vile" * (i % 5 == 0)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in rows], "doc_id long, toxic int")
    index = toxicity.fit(docs, labels)
    vectors = {i: index.vector(*v) for (i, _), v in zip(rows, toxicity.terms([t for _, t in rows]))}
    got = {r.doc_id: r.evidence for r in toxicity.score(docs, labels).collect()}
    for i, (found, value) in vectors.items():
        own = dict(zip(found.tolist(), value))
        near = {int(j): sum(own.get(f, 0) * v for f, v in zip(vectors[int(j)][0].tolist(), vectors[int(j)][1])) for j in index.ids}
        best = sorted((j for j in near if near[j] > 0), key=lambda j: (-round(near[j], 9), j))[: toxicity.NEAREST]
        assert len(got[i]) == toxicity.NEAREST and np.allclose([near[j] for j in got[i]], [near[j] for j in best])


@pytest.mark.parametrize("times", [1e3, 1e7])
def test_vector_search_with_very_long_vectors(spark, times):
    """A few vectors far longer than the rest do not hide the others' neighbours."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((1500, 16))
    x[7], x[300], x[301] = x[7] * times, x[8] / times, x[8] / times
    x[600:700] = x[600]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    found = vector_search.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas()
    hit = []
    for q in range(0, 1500, 20):
        s = np.einsum("ij,j->i", x, x[q])
        best = [i for i in np.lexsort((np.arange(1500), -s)) if i != q][:20]
        own = found[found.query_id == q].sort_values("rank")
        assert len(own) == 20 and list(own["rank"]) == list(range(1, 21))
        np.testing.assert_allclose(own["score"], s[own["vec_id"]], rtol=1e-12)
        hit.append(len(set(best) & set(own["vec_id"])) / 20)
    assert np.mean(hit) >= 0.9


def test_vector_search(spark):
    found = vector_search.search(queries.table(spark, SF, "embeddings")).toPandas()
    rows = queries.table(spark, SF, "embeddings").toPandas()
    x, ids, hit = np.stack(rows["embedding"]).astype(float), rows["vec_id"].to_numpy(), []
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[q] = -9
        hit.append(len(set(ids[np.argsort(-s)[:20]]) & set(found[found.query_id == ids[q]].vec_id)) / 20)
    assert np.mean(hit) >= 0.9
    odd = spark.createDataFrame([(0, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [2.0, 1.0]),
                                 (5, [1.0])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in vector_search.search(odd).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 4, 2.0), (0, 2, 20, 1.0), (20, 1, 4, 2.0), (20, 2, 0, 1.0)]
    assert vector_search.search(odd.limit(0)).count() == 0


def test_vector_search_groups_blocks_and_copies(spark, monkeypatch):
    """A third of the vectors are one vector; lists in several groups, groups in several blocks."""
    for name, value in {"LIST": 32, "TOGETHER": 8, "HELD": 1 << 11, "ASKED": 1 << 8, "SCORES": 1 << 10}.items():
        monkeypatch.setattr(vector_search, name, value)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 16))
    x[::3] = x[1]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    found = vector_search.search(rows).toPandas()
    assert not found.duplicated(["query_id", "vec_id"]).any()
    hit = []
    for q, own in found.groupby("query_id"):
        s = np.einsum("ij,j->i", x, x[q])
        own = own.sort_values("rank")
        np.testing.assert_allclose(own["score"], s[own["vec_id"]], rtol=1e-12)
        s[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -s))[:20]
        hit.append(len(set(best) & set(own["vec_id"])) / 20)
    assert len(hit) == 75 and np.mean(hit) >= 0.9


def test_token_rollup(spark, odd, tmp_path):
    r = token_counts.Rollup(spark, str(tmp_path / "r"))
    rows = odd.select("source", "lang", F.lit("v").alias("version"), F.lit(3).cast("long").alias("tokens"), F.lit(5).cast("long").alias("chars"))
    assert r.commit("1", token_counts.signed(rows, 1)) and not r.commit("1", token_counts.signed(rows, 1))
    r.commit("2", token_counts.revised(rows, rows.withColumn("tokens", F.lit(4).cast("long"))))
    assert {(t.documents, t.tokens) for t in r.totals().where("source = 's' and lang = 'en'").collect()} == {(4, 16)}
    r.commit("3", token_counts.signed(rows.withColumn("tokens", F.lit(4).cast("long")), -1))
    assert r.totals().count() == 0


def test_pseudo_likelihood(odd, empty):
    out = {r.doc_id: r for r in lm_scoring.score(odd, rounds=1).collect()}
    assert out[3].n_tokens == 0 and out[4].mean_log_prob is None and out[5].n_tokens == 20_000 and out[5].log_prob < 0
    assert lm_scoring.score(empty).count() == 0


def test_windows_of_texts_do_not_mix():
    number, first = np.arange(1, 8), np.array([0, 3, 3, 7])
    pad = lm_scoring._PAD
    got = lm_scoring.Network.contexts(number, first, np.array([0, 2, 3, 5])).T.tolist()
    assert got == [[pad, pad, 2, 3], [1, 2, pad, pad], [pad, pad, 5, 6], [4, 5, 7, pad]]


def test_training_step_follows_the_gradient():
    """The first Adagrad step moves each parameter against the sign of its gradient."""
    rng = np.random.default_rng(0)
    words = np.arange(lm_scoring.KNOWN, dtype=np.uint64)
    start = lm_scoring.Network(words).flat
    start = (start + rng.normal(0, 0.1, len(start))).astype(np.float32)
    context, target = rng.integers(0, 60, (4, 500)), rng.integers(0, 60, 500)
    loss = lambda flat: -lm_scoring.Network(words, flat).scores(context, target).mean(dtype=np.float64)
    net = lm_scoring.Network(words, start.copy())
    net.train(context, target, [np.full(p.shape, 1e-12, np.float32) for p in net.parts])
    step = net.flat - start
    right = []
    for i in rng.choice(np.flatnonzero(step), 40, replace=False).tolist():
        up, down = start.copy(), start.copy()
        up[i] += 0.05
        down[i] -= 0.05
        slope = loss(up) - loss(down)
        if abs(slope) > 2e-6:
            right.append(slope * step[i] < 0)
    assert len(right) > 15 and np.mean(right) > 0.95
    first = loss(start)
    squares = [np.full(p.shape, 1e-6, np.float32) for p in net.parts]
    for _ in range(60):
        net.train(context, target, squares)
    assert loss(net.flat) < first - 1


def test_pseudo_likelihood_learns(spark):
    """Better than the words' own frequencies on texts with word order."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"s{(a + j) % 40}" for j in range(60)) for a in rng.integers(0, 40, 1500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = [r.mean_log_prob for r in lm_scoring.score(docs).collect()]
    assert np.mean(got) > -np.log(40) + 0.5
    assert [r.mean_log_prob for r in lm_scoring.score(docs).collect()] == got      # runs agree


def test_pseudo_likelihood_of_rare_words(spark):
    """Words the network shares a bucket for have their own part of it, and each word is a target once."""
    rng = np.random.default_rng(5)
    common = [" ".join(f"c{j}" for j in rng.integers(0, 2300, 400)) for _ in range(200)]
    rows = [(i, t) for i, t in enumerate(common)] + [(1000, " ".join(f"never{j}" for j in range(4000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.mean_log_prob for r in lm_scoring.score(docs, rounds=1).collect()}
    assert out[1000] < min(v for k, v in out.items() if k < 1000) - 1
    counts = lm_scoring.word_counts(docs)
    frequent = lm_scoring.vocabulary(counts)
    net = lm_scoring.fit(lm_scoring.numbered(docs, frequent), frequent, 1)
    rest = lm_scoring.shares(counts, net).toPandas()
    assert len(rest) == counts.count() - lm_scoring.KNOWN
    number = net.number(rest["word"].to_numpy().view(np.uint64))
    np.testing.assert_allclose(np.bincount(number, np.exp(rest["share"]))[np.unique(number)], 1)
    words = np.arange(5000)
    at = np.concatenate([lm_scoring.targets(words, np.arange(5000), t, 2) for t in range(2)])
    assert sorted(at) == list(range(5000))


def test_pseudo_likelihood_looks_up_common_words(spark, monkeypatch):
    """Only rare words are joined; scores are the same however many words are looked up."""
    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{j}" for j in [*rng.integers(0, 3000, 300), *rng.integers(3000, 10**6, 20)]) for _ in range(100)] + ["", None, "w1 alone"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2, "doc_id")
    counts = lm_scoring.word_counts(docs)
    words = lm_scoring.vocabulary(counts)
    dealt = lm_scoring.shares(counts, lm_scoring.Network(words))
    share = {r.word: r.share for r in dealt.collect()}
    plain = {r.row: r for r in lm_scoring.numbered(docs, words).collect()}
    got, left = [], []
    for few in (1, 10_000, lm_scoring.COMMON):
        monkeypatch.setattr(lm_scoring, "COMMON", few)
        known = lm_scoring.common(counts, dealt)
        assert len(known[0]) <= few and (np.diff(known[0]) > 0).all()
        rows = lm_scoring.numbered(docs, words, known).collect()
        left.append(sum(len(r.rest) for r in rows))
        for r in rows:
            assert set(r.rest).isdisjoint(known[0].view(np.int64).tolist()) and r.number == plain[r.row].number
            np.testing.assert_allclose(r.inner + sum(share[w] for w in r.rest), sum(share[w] for w in plain[r.row].rest))
        got.append({r.doc_id: r.log_prob for r in lm_scoring.score(docs, rounds=1).collect()})
    assert left[0] == sum(len(r.rest) for r in plain.values()) > left[1] > left[2] == 0
    assert got[0].keys() == set(range(103))
    for other in got[1:]:
        np.testing.assert_allclose([other[k] for k in got[0]], list(got[0].values()), rtol=1e-12)


@pytest.mark.parametrize("hashes", [[], [0], [0, 1, 2, 2**64 - 1], np.random.default_rng(2).integers(0, 2**63, 3000).tolist()])
def test_places_of_hashes(hashes):
    ascending = np.unique(np.array(hashes, np.uint64))
    asked = np.concatenate([ascending, ascending + np.uint64(1), np.arange(5, dtype=np.uint64)])
    place = {h: i for i, h in enumerate(ascending.tolist())}
    assert lm_scoring.Places(ascending).of(asked).tolist() == [place.get(h, -1) for h in asked.tolist()]


def test_network_arithmetic_against_plain_sums():
    rng = np.random.default_rng(7)
    net = lm_scoring.Network(np.arange(lm_scoring.KNOWN, dtype=np.uint64))
    net.flat += rng.normal(0, 0.3, len(net.flat)).astype(np.float32)
    context, target = np.minimum(rng.zipf(1.3, (4, 700)), lm_scoring._PAD), np.minimum(rng.zipf(1.3, 700), lm_scoring._PAD - 1)
    e, s, b, w1, b1, w2, b2 = (p.astype(np.float64) for p in net.parts)
    h = np.tanh(sum(e[context[p]] * s[p] for p in range(4)) + b)
    kind, inner = target // lm_scoring.CLASSES, target % lm_scoring.CLASSES
    log = lambda x, at: x[np.arange(len(x)), at] - np.log(np.exp(x).sum(axis=1))
    want = log(h @ w1 + b1, kind) + log(np.einsum("nd,ndc->nc", h, w2[kind]) + b2[kind], inner)
    np.testing.assert_allclose(net.scores(context, target), want, rtol=1e-3, atol=1e-4)
    key, sums = lm_scoring._sums(h.astype(np.float32), context)
    plain = np.zeros((4 * len(e), h.shape[1]))
    np.add.at(plain, context + np.arange(4)[:, None] * len(e), h)
    assert key.tolist() == np.unique(context + np.arange(4)[:, None] * len(e)).tolist()
    np.testing.assert_allclose(sums, plain[key], rtol=1e-4, atol=1e-4)


def test_extraction(spark):
    shell = "<html><head><title>t</title></head><body><nav><a>Home</a></nav><div class='ad'>Buy</div><article><h1>A &amp; B</h1>{}</article><footer>f</footer></body></html>"
    rows = [(1, "http://h/1", shell.format("<p>one\n two<p>three <b>bold</b>")), (2, "http://h/2", shell.format("<p>four</p>" * 3 + "<script>x<y</script>")),
            (3, None, None), (4, "http://h/4", ""), (5, "bad", "a < b")]
    got = {r.page_id: r.text for r in extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "A & B\none two\nthree bold", 2: "A & B\nfour\nfour\nfour", 3: "", 4: "", 5: "a < b"}


def test_extraction_by_slots(spark):
    """Fixed text of no listed name goes, copies of an article stay."""
    page = ("<body><article><div class='gdpr'>We value your privacy and so on</div><h1>Title {0}</h1><p>body {0} of page {0} alone {0}</p>"
            "<div class='replies'>Log in to reply</div></article></body>")
    copy = "<body><article><h1>Copied</h1><p>" + " ".join(f"c{i}" for i in range(90)) + "</p><p>end {}</p></article></body>"
    rows = [(i, f"http://a/{i}", page.format(f"x{i}")) for i in range(6)] + [(10 + i, f"http://b/{i}", copy.format(i % 2)) for i in range(6)]
    got = {r.page_id: r.text for r in extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Title x{i}\nbody x{i} of page x{i} alone x{i}" for i in range(6))
    assert all(got[10 + i].startswith("Copied\nc0 c1") and got[10 + i].endswith(f"end {i % 2}") for i in range(6))


def test_extraction_keeps_fixed_headings_and_reads_numbered_names(spark):
    """Headings that all articles share stay; names with page numbers are one path; notices of
    no listed name go from there, too."""
    page = ("<body><div class='gdpr'>We value your privacy</div><div id='post-{0}'><h2>Summary</h2><p>" + "about {0} and more of it " * 20
            + "</p><h2>Method</h2><p>" + "how {0} was done " * 20 + "</p><div class='zz{0}'>Sent from my phone</div></div></body>")
    rows = [(i, f"http://h/{i}", page.format(100 + i)) for i in range(20)]
    empty = [(90, "http://h/x", ""), (91, "http://h/y", None)] + [(0, "http://h/0", page.format(100))]
    kind = "page_id long, url string, html string, text string, host string"
    got = extraction.extract(spark.createDataFrame([(*r, "t", "h") for r in rows + empty], kind)).collect()
    assert len(got) == 23 and got[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    for r in got:
        n = 100 + r.page_id
        want = "" if r.page_id >= 90 else f"Summary\n{(f'about {n} and more of it ' * 20).strip()}\nMethod\n{(f'how {n} was done ' * 20).strip()}"
        assert r.text == want and r.n_chars == len(want)
    long = "<body><article><p>" + "word " * 200_000 + "</p></article></body>"
    assert extraction.extract(spark.createDataFrame([(1, None, long, "t", "h")], kind)).first().n_chars == 999_999
    assert extraction.extract(spark.createDataFrame([], kind)).count() == 0


def test_extraction_broadcast_equals_join(spark, monkeypatch):
    pages = queries.table(spark, SF, "pages")
    a = sorted(map(tuple, extraction.extract(pages).collect()))
    monkeypatch.setattr(extraction, "BROADCAST_HOSTS", -1)
    assert sorted(map(tuple, extraction.extract(pages).collect())) == a


def test_extraction_by_layout(spark):
    """Two layouts on one host, and pages without a host."""
    one = "<body><div class='content'><p>" + "first {0} layout {0} text " * 30 + "</p></div></body>"
    two = "<body><div class='content'><p>short {0}</p></div><main><div class='intro'><p>intro {0}</p></div><p>" + "second {0} text " * 12 + "</p></main></body>"
    rows = ([(i, f"http://a/{i}", one.format(f"x{i}")) for i in range(9)] + [(20 + i, f"http://a/2{i}", two.format(f"y{i}")) for i in range(3)]
            + [(40 + i, None, one.format(f"z{i}")) for i in range(9)] + [(60, "bad", two.format("q"))])
    got = {r.page_id: r.text for r in extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i].startswith(f"first x{i}") for i in range(9))
    for k, name in [*((20 + i, f"y{i}") for i in range(3)), (60, "q")]:
        assert got[k] == f"intro {name}\n" + ("second {0} text " * 12).format(name).strip()


def test_pipeline(spark):
    sf = "/root/testdata/sf0.01"
    docs = queries.table(spark, sf, "documents")
    out = corpus_pipeline.run(spark, sf)
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and 0 < len(ids) < docs.count() and set(docs.columns) <= set(out.columns)

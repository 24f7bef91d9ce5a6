"""Near copies, search, language model, site posteriors, page texts and the pipeline."""

from __future__ import annotations

import itertools
import math
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from palaver.llm import bayes, components, dom, html_text, markov, maxscore, near_copies, queries

from .conftest import prose

NEAR_COLUMNS = ["doc_id", "n_shingles", "component_id", "kept"]


# near copies

def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset([b" ".join(w)] if 0 < len(w) < 5 else (b" ".join(w[i:i + 5]) for i in range(len(w) - 4)))


def brute_components(rows, percent=85):
    """Component number of each row ``(doc_id, text)``."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j]:
            common = len(sets[i] & sets[j])
            if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                parent[find(j)] = find(i)
    number = {}
    for i, (key, _) in enumerate(rows):
        root = find(i)
        if key is not None:
            number[root] = min(number.get(root, key), key)
    return [(key, len(sets[i]), number.get(find(i)) if sets[i] else key) for i, (key, _) in enumerate(rows)]


def found_components(df):
    rows = near_copies.near_duplicates(df).select(NEAR_COLUMNS).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows)


def test_words_of_thue_morse_differ(spark):
    """Two words that collide under every polynomial hash modulo a power of two."""
    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, " ".join([word] * 40)), (2, " ".join([other] * 40))]
    assert found_components(spark.createDataFrame(rows, "doc_id long, text string")) == Counter([(1, 1, 1), (2, 1, 2)])


def variants(seed: int, n: int, length: int, edits: int) -> list[str]:
    """Copies of one text with some words replaced."""
    random = np.random.default_rng(seed)
    base = prose(seed, length).split()
    out = []
    for _ in range(n):
        own = list(base)
        for at in random.choice(length, edits, replace=False):
            own[at] = f"new{random.integers(1 << 30)}"
        out.append(" ".join(own))
    return out


def test_components_of_edge_rows(edge_docs, edge_rows, no_docs):
    assert found_components(edge_docs) == Counter(brute_components([(d, t) for d, t, *_ in edge_rows]))
    assert near_copies.near_duplicates(no_docs).count() == 0


def test_near_copies_of_all_degrees(spark):
    texts = [v for seed, edits in enumerate([1, 1, 2, 3, 4, 5]) for v in variants(seed, 8, 200, edits)]
    texts += variants(50, 90, 150, 1) + [prose(900 + i, 100) for i in range(60)]
    rows = list(enumerate(texts))
    assert found_components(spark.createDataFrame(rows, "doc_id long, text string")) == Counter(brute_components(rows))


def test_clusters_larger_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "CHUNK_SHINGLES", 3000)
    monkeypatch.setattr(near_copies, "LEAF", 16)
    rows = list(enumerate(variants(70, 120, 150, 2) + variants(71, 40, 150, 3)))
    assert found_components(spark.createDataFrame(rows, "doc_id long, text string")) == Counter(brute_components(rows))


def test_no_task_holds_more_than_two_chunks(spark, monkeypatch):
    # 110 texts share a passage (0.78, one candidate cluster of about nine chunks) and link with few others; 12 have copies
    passage, random = prose(80, 200), np.random.default_rng(4)
    texts = [passage + " " + " ".join(f"own{i}x{k}" for k in range(24)) for i in range(110)]
    texts += [t + f" new{random.integers(1 << 30)}" for t in texts[:12]]
    rows, plain = list(enumerate(texts)), near_copies.visit

    def bounded(own, percent):
        assert sum(map(len, own["shingles"])) // 8 <= 12_000  # chunks are dealt by hash: 3000 on average
        return plain(own, percent)

    monkeypatch.setattr(near_copies, "CHUNK_SHINGLES", 3000)
    monkeypatch.setattr(near_copies, "visit", bounded)
    assert found_components(spark.createDataFrame(rows, "doc_id long, text string")) == Counter(brute_components(rows))


def test_pairs_within_a_large_group_that_shares_a_passage(spark, monkeypatch):
    # 240 nodes that agree in about 0.72 of their tokens, in pairs that agree in 94 of 96; one tree, leaves of 16
    monkeypatch.setattr(near_copies, "TREES", 1)
    monkeypatch.setattr(near_copies, "LEAF", 16)
    random, rows = np.random.default_rng(9), []
    group = random.integers(0, 1 << 32, 96, np.uint32)
    for pair in range(120):
        one = np.where(random.random(96) < 0.85, group, random.integers(0, 1 << 32, 96, np.uint32))
        other = one.copy()
        other[random.choice(96, 2, replace=False)] += np.uint32(1)
        rows += [(2 * pair + i, x.tobytes(), x.astype(np.uint16).tobytes()) for i, x in enumerate((one, other))]
    nodes = spark.createDataFrame(rows, "id long, tokens binary, low_tokens binary")
    root = {r.id: r.root for r in near_copies.candidate_clusters(nodes, 97).collect()}
    assert sum(2 * p in root and root[2 * p] == root.get(2 * p + 1) for p in range(120)) >= 105


def test_links_within_leaves_of_all_sizes():
    # members that are 2, 30 or 150 places apart agree in 95 tokens, those between them in none; leaf 4 is a chain of such links
    random, rows = np.random.default_rng(6), []
    for leaf, half in enumerate((2, 30, 150)):
        one = random.integers(0, 1 << 16, (half, near_copies.COORDINATES)).astype(np.uint16)
        other = one.copy()
        other[:, leaf] ^= 1
        rows.append((np.full(2 * half, leaf), np.concatenate((one, other))))
    chain = np.repeat(random.integers(0, 1 << 16, (1, near_copies.COORDINATES)), 90, axis=0).astype(np.uint16)
    for i in range(90):
        chain[:, i][np.arange(90) < i] ^= 1
    rows.append((np.full(90, 4), chain[random.permutation(90)]))
    leaf, tokens = (np.concatenate(x) for x in zip(*rows))
    links = [r for b in near_copies.linked_rows(leaf, np.arange(len(leaf)), tokens, 95) for r in zip(*(c.to_pylist() for c in b.columns))]
    expected = [(at + half + i, at + i) for at, half in ((0, 2), (4, 30), (64, 150)) for i in range(half)]
    assert sorted(links) == sorted(expected + [(364 + i, 364) for i in range(1, 90)])


def test_a_large_group_is_settled_in_few_jobs(spark, monkeypatch):
    """300 texts that share a passage, half of them with a copy: one level of branches, and no round that only repeats the last."""
    passage, names = prose(80, 100), []
    for module in (near_copies, components):
        monkeypatch.setattr(module, "written", lambda df, name, plain=module.written: names.append(name) or plain(df, name))
    texts = [passage + " " + " ".join(f"own{i % 200}x{k}" for k in range(40)) + f" end{i}" for i in range(300)]
    rows = list(enumerate(texts))
    assert found_components(spark.createDataFrame(rows, "doc_id long, text string")) == Counter(brute_components(rows))
    assert names.count("branches") == 1 and names.count("edges") <= 3 and len(names) <= 12
    names.clear()
    stars = spark.createDataFrame([(i, i % 3) for i in range(3, 60)] + [(5, 2)], "a long, b long")
    assert {r.id: r.root for r in components.components(stars).collect()} == {i: i % 3 for i in range(60)}
    assert names == ["edges"]


def test_one_row_stands_for_each_group(edge_docs, edge_rows):
    kept = near_copies.one_per_group(edge_docs)
    assert kept.columns == edge_docs.columns
    found = Counter((r.doc_id, r.text) for r in kept.collect())
    # 1, 2 and 3 are near copies, 7 and 11 equal sets, 12 and 20 to 22 repeat; 4, 5, 6 have empty sets
    assert sorted((d if d is not None else -1) for d, _ in found.elements()) == [-1, -1, 1, 4, 5, 6, 7, 8, 9, 10, 10, 12, 20]


def test_the_pipeline_drops_near_copies_from_four_fifths(spark):
    # two texts of 200 words that differ in 4 words share about 0.81 of their shingles, in 3 words about 0.86
    texts = [v for seed in range(30) for v in (prose(seed, 200), variants(seed, 1, 200, 3 + seed % 4)[0])]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect())
    expected = {p: sorted({component for _, _, component in brute_components(rows, p)}) for p in (80, 85)}
    assert kept == expected[80] != expected[85]


def test_star_components(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, 50), (100, 60), (60, 61), (7, 7)]
    found = {r.id: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 50, 50: 50, 60: 50, 61: 50}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_exact_labels_find_every_component():
    sets = [shingles(t) for t in variants(3, 12, 120, 4) + [prose(5, 50)]]
    code = {s: i for i, s in enumerate(sorted(set().union(*sets)))}
    packed = [np.array(sorted(code[x] for x in s), np.uint64).tobytes() for s in sets]
    labels = near_copies.exact_labels(packed)
    for i, j in itertools.combinations(range(len(sets)), 2):
        common = len(sets[i] & sets[j])
        if 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
            assert labels[i] == labels[j]
    assert labels[-1] not in labels[:-1]


# unclosed parts of a page

@pytest.mark.parametrize("html", [
    "<html><head><title>t</title><body><header>top</header><article>Body.</article></body></html>",
    "<html><HEAD><title>t</title><body><article>Body.</article></body></html>",
    "<html><head><title>t</title><header>top</header><article>Body.</article></html>",
    "<head><meta charset=x><noscript><img src=x><body><article>Body.</article></body>",
    "<head><title>t</title>text<article>Body.</article>",
    "<body><div><button>go</div><article>Body.</article></body>",
    "<body><button>go<button>on</button><article>Body.</article></body>",
    "<body><select><option>one<article>Body.</article></body>",
    "<body><div><noscript>off</div><article>Body.</article></body>",
    "<body><div><object data=x></div><article>Body.</article></body>",
    "<body><article>Bo<object>d</object><math><mi>y</mi><annotation>tex</annotation></math>.</article></body>"])
def test_unclosed_parts_end_with_their_parent(html):
    page = dom.read_page(html)
    marks = html_text.content_marks(page)
    assert html_text.block_text(page, marks) == "Body."
    assert "go" not in page.text and "one" not in page.text and "off" not in page.text and "tex" not in page.text


def test_rare_marks_are_found_and_no_marks_leave_the_rest_of_the_frame(spark):
    body = "<p>" + prose(1, 30) + ".</p><p>" + prose(2, 30) + ".</p>"
    plain = [(i, "u", f"<body><nav>menu</nav><div>{body}</div><div class=sidebar><p>side</p></div></body>") for i in range(600)]
    marked = [(1000 + i, "u", f"<body><nav>menu {i}</nav><article>{body}</article><footer>end</footer></body>") for i in range(4)]
    text = prose(1, 30) + ".\n" + prose(2, 30) + "."
    kind = "page_id long, url string, html string"
    found = html_text.extract(spark.createDataFrame(plain + marked, kind)).filter("page_id >= 1000").collect()
    assert [r.text for r in found] == [text] * 4
    rule = html_text.extract(spark.createDataFrame(plain[:3], kind)).collect()
    assert [r.text for r in rule] == [text] * 3


# search

def brute_top(rows, k, every):
    usable = [(key, [math.floor(64 * x) for x in v]) for key, v in rows
              if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {(key, tuple(v)) for key, v in usable if key is not None and key % every == 0}
    out = []
    for key, query in asked:
        scored = sorted((-sum(a * b for a, b in zip(query, v)), other is None, other) for other, v in usable if other is None or other != key)
        out += [(key, i + 1, other, -score) for i, (score, _, other) in enumerate(scored[:k])]
    return Counter(out)


def test_top_k_equals_brute_force(spark):
    random = np.random.default_rng(5)
    rows = [(i, random.normal(0, 0.3, 8).tolist()) for i in range(300)]
    rows += [(300 + i, [0.5] * 8) for i in range(30)] + [(400, [1e9] * 8), (401, None), (402, [None] * 8), (403, [float("nan")] * 8),
                                                      (404, [float("inf")] + [0.0] * 7), (None, [0.25] * 8), (20, [0.1] * 8),
                                                      (405, [0.5, 0.5]), (406, [])] + [(407, [0.3] * 8)] * 5
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("row", F.lit("own"))
    found = Counter(map(tuple, maxscore.top_k(frame).collect()))
    assert found == brute_top(rows, 20, 20)
    assert maxscore.top_k(frame.limit(0)).count() == 0


def test_top_k_keeps_large_numbers_beside_a_null(spark):
    rows = [(None, [1.0, 0.5]), (2**53 + 1, [1.0, 0.25]), (2**53 + 3, [0.5, 1.0]), (20, [1.0, 1.0]), (-(2**62) - 1, [2.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert Counter(map(tuple, maxscore.top_k(frame).collect())) == brute_top(rows, 20, 20)


def test_top_k_over_several_shards(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "SHARD_ROWS", 50)
    monkeypatch.setattr(maxscore, "BLOCK_QUERIES", 10)
    random = np.random.default_rng(6)
    rows = [(i, np.round(random.normal(0, 0.2, 16), 1).tolist()) for i in range(400)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert Counter(map(tuple, maxscore.top_k(frame, k=7).collect())) == brute_top(rows, 7, 20)


def test_top_k_of_the_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in queries.table(spark, sf_dir, "embeddings").collect()]
    assert Counter(map(tuple, queries.op9_maxscore(spark, sf_dir).collect())) == brute_top(rows, 20, 20)


# language model

def test_forward_recursion_is_exact():
    random = np.random.default_rng(2)
    model = markov.Model(*(x / x.sum(-1, keepdims=True) for x in (
        random.random(3), random.random((3, 3)), random.random((3, markov.SYMBOLS)))))
    sequences = [np.array(s, np.uint8) for s in ([4], [4, 9, 4], [0, 254, 3, 3, 7])]
    for sequence, found in zip(sequences, model.log10_likelihood(sequences)):
        total = 0.0
        for path in itertools.product(range(3), repeat=len(sequence)):
            p = model.start[path[0]] * model.emit[path[0], sequence[0]]
            for t in range(1, len(sequence)):
                p *= model.step[path[t - 1], path[t]] * model.emit[path[t], sequence[t]]
            total += p
        assert found == pytest.approx(math.log10(total))


def test_rounds_of_training_raise_the_likelihood():
    random = np.random.default_rng(3)
    sequences = [np.array(random.choice([1, 2, 3] if i % 2 else [4, 5, 6], 40), np.uint8) for i in range(30)]
    model, last = markov.Model.first(np.full(markov.SYMBOLS, 1 / markov.SYMBOLS), 2), -math.inf
    for _ in range(5):
        now = model.log10_likelihood(sequences).sum()
        assert now > last
        last, counts = now, model.expected(sequences)
        assert counts[:2].sum() == pytest.approx(30) and counts[6:].sum() == pytest.approx(30 * 40)
        assert counts[2:6].sum() == pytest.approx(30 * 39)
        model = markov.Model.from_counts(counts, 2)


def brute_base(rows):
    train = [(t or "").encode().lower().split() for d, t in rows if zlib.crc32(("" if d is None else str(d)).encode()) % 7 != 2]
    counts = Counter(w for t in train for w in t)
    n, v, ends = sum(counts.values()) + len(train), len(counts) + bool(train), len(train)
    out = []
    for d, t in rows:
        own = (t or "").encode().lower().split()
        base = sum(math.log10((c + 1) / (n + v + 1)) for c in [*(counts[w] for w in own), ends])
        held = zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
        out.append((d, held, len(own) + 1, sum(counts[w] > 0 for w in own) + bool(ends), n, round(base, 4)))
    return Counter(out)


@pytest.mark.parametrize("listed", [1 << 17, 40])
def test_scores_of_edge_rows(edge_docs, edge_rows, no_docs, monkeypatch, listed):
    monkeypatch.setattr(markov, "LISTED", listed)
    rows = markov.scores(edge_docs).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows) == brute_base(
        [(d, t) for d, t, *_ in edge_rows])
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert markov.scores(no_docs).count() == 0


def test_held_out_documents_score_above_the_base(spark):
    rows = [r for r in queries.op4_hidden_markov(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    n = sum(r.n_tokens for r in rows)
    assert sum(r.score for r in rows) / n > sum(r.base_score for r in rows) / n + 0.1


# site posteriors

def test_verdicts_agree_with_labels(spark):
    folder = "/root/testdata/sf0.1"
    labels = queries.table(spark, folder, "labels").toPandas().set_index("doc_id")
    found = queries.op2_site_bayes(spark, folder).toPandas().set_index("doc_id").join(labels, how="inner")
    clean, toxic = found[(found.quality == 1) & (found.toxic == 0)], found[found.toxic == 1]
    assert clean.kept.mean() > 0.97 and toxic.kept.mean() < 0.1 and found[found.quality == 0].kept.mean() < 0.05


def test_sparse_sites_stay_near_their_parents(spark):
    rows = [(0, "big", "p", 3.0)] * 400 + [(0, "big", "q", -3.0)] * 400 + [(0, "good", "p", -6.0)] * 800 + [(0, "tiny", None, 6.0)]
    frame = spark.createDataFrame(rows, "doc_id long, host string, path string, ratio_low double")
    rates = {(r["_host"], r["_path"]): r.site_low for r in bayes.site_rates(frame, "low", 0.2).collect()}
    assert rates["big", "p"] > 0.6 and rates["big", "q"] < 0.2 and rates["good", "p"] < 0.05
    assert rates["tiny", None] < 0.75


def test_verdicts_of_edge_rows(edge_docs, edge_rows, no_docs, spark):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (5, 0, 1), (6, 0, 1), (8, 1, 0), (9, 1, 1), (None, 1, 0), (7, None, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = bayes.classify(edge_docs, labels, "source", "lang").collect()
    assert Counter((r.doc_id, r.host, r.path) for r in rows) == Counter((d, s, lang) for d, _, lang, s, _ in edge_rows)
    assert all(0 <= p <= 1 for r in rows for p in (r.p_low, r.p_toxic))
    kept = bayes.classify(edge_docs, labels.limit(0), "source", "lang")
    assert kept.filter("kept").count() == len(edge_rows)
    assert bayes.classify(no_docs, labels, "source", "lang").count() == 0


# page texts

@pytest.fixture(scope="module")
def trees(spark):
    return html_text.fit_trees(queries.table(spark, "/root/testdata/sf0.01", "pages").select("page_id", "html"))


FRAME = """<html><head><title>T</title><style>p{}</style></head><body><header class="site"><h1>Site name</h1></header>%s
<aside class="sidebar"><p>Related stuff to read, here and now.</p></aside><form><label>Name</label><p>Subscribe to our newsletter.</p></form>
<div class="cookie-notice">We use cookies on this site.</div><footer>&copy; somebody</footer><script>var a = "<p>no</p>";</script>"""
STORY = """<h1>A real&nbsp;title</h1><p>First paragraph, with several <b>bold</b> words &amp; marks in it.<p>Second
 one follows,   unclosed as well.<ul><li>A point, of some length.</li><li>Another point.</li></ul>"""
STORY_TEXT = "A real title\nFirst paragraph, with several bold words & marks in it.\nSecond one follows, unclosed as well.\n" \
             "A point, of some length.\nAnother point."
CASES = [
    (FRAME % f"<article>{STORY}</article>", STORY_TEXT),
    (FRAME % f'<main>{STORY}<section id="comments"><h2>Comments</h2><p>Great post, I liked it!</p><p>No.</p></section></main>', STORY_TEXT),
    (FRAME % f'<div class="post-content">{STORY}<div class="advert">Buy now!</div></div>', STORY_TEXT),
    ("", ""), (None, ""), ("<p>just text <b>bold", "just text bold"), ("no tags &lt;here&gt;", "no tags <here>"),
    ("<script>x</script><!-- c --><style>y</style>", "")]


def test_main_text_of_pages(spark, trees):
    frame = spark.createDataFrame([(i, f"u{i}", h) for i, (h, _) in enumerate(CASES)] * 2, "page_id long, url string, html string")
    rows = html_text.main_texts(frame.withColumn("text", F.lit("own")), trees).collect()
    assert Counter((r.page_id, r.text, r.n_chars) for r in rows) == Counter({(i, t, len(t)): 2 for i, (_, t) in enumerate(CASES)})


def test_choices_fit_the_tree(trees):
    page = dom.read_page(FRAME % f"<article>{STORY}</article>")
    kept = html_text.decode(page, html_text.log_odds(trees, dom.features(page)))
    assert all(kept[page.parent[i]] for i in range(1, len(kept)) if kept[i])


def test_extraction_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_text.extract(empty).count() == 0


def test_pages_of_the_table(spark, sf_dir):
    for r in queries.op6_boosted_dom(spark, sf_dir).join(queries.table(spark, sf_dir, "pages").select("page_id", "html"), "page_id").collect():
        page = dom.read_page(r.html)
        assert r.text == html_text.block_text(page, [a or b in dom.ROOTS for a, b in zip(html_text.content_marks(page), page.tag)])


# pipeline

def test_stages_on_the_table(spark):
    folder = "/root/testdata/sf0.01"
    docs = queries.table(spark, folder, "documents")
    columns, counts = docs.columns, [docs.count()]
    labels = {r.doc_id: r.quality for r in queries.table(spark, folder, "labels").collect()}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.written(stage(spark, docs, folder), "stage")
        counts.append(after.count())
        if name == "quality rules":
            kept = {r.doc_id for r in after.select("doc_id").collect()}
            texts = {r.doc_id: r.text for r in docs.collect()}
            good = [d for d, q in labels.items() if q == 1 and len(texts[d].split()) >= 50]
            assert np.mean([d in kept for d in good]) > 0.98
        if name == "near dedup":
            rows = [(r.doc_id, r.text) for r in docs.collect()]
            assert {r.doc_id for r in after.collect()} == {c for _, _, c in brute_components(rows, near_copies.PERCENT)}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == columns
        docs = after
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] == counts[2] and counts[5] == counts[4] > 0


def test_pipeline_of_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels"):
        queries.table(spark, "/root/testdata/sf0.001", name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_library_works_without_this_subpackage():
    code = ("import sys\nsys.modules['palaver.llm'] = sys.modules['corpus_pipeline'] = None\nimport __spark_entry__ as e\n"
            "assert 'daily_summary' in e.queries() and not [q for q in e.queries() if q.startswith('op')]")
    assert subprocess.run([sys.executable, "-c", code], timeout=120).returncode == 0

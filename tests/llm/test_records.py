"""Sharding, mixing, rules, tokens and repeated windows against brute force."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from palaver import session
from palaver.llm import anomaly, bpe, mixing, queries, sharding, substrings

from .conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


# sharding

def test_shards_follow_the_key_alone(edge_docs, edge_rows):
    rows = sharding.rendezvous_shards(edge_docs, shards=24).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in edge_rows)
    of = defaultdict(set)
    slots = defaultdict(list)
    for r in rows:
        of[r.doc_id].add((r.shard, r.grown_shard))
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 24) and r.law == "key"
    assert all(len(v) == 1 for v in of.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_one_more_shard_takes_rows_only_into_itself(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    before = sharding.placements(docs, "doc_id", "text", [1.0] * 8).select("doc_id", "shard", "grown_shard")
    after = sharding.placements(docs, "doc_id", "text", [1.0] * 9).select("doc_id", F.col("shard").alias("now"))
    both = before.join(after, "doc_id").toPandas()
    assert (both["grown_shard"] == both["now"]).all()
    moved = both["now"] != both["shard"]
    assert (both.loc[moved, "now"] == 8).all() and abs(moved.mean() - 1 / 9) < 0.01


def test_rows_follow_the_weights(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    counts = {r.shard: r["count"] for r in sharding.placements(docs, "doc_id", "text", [1.0, 2.0, 5.0]).groupBy("shard").count().collect()}
    for shard, weight in enumerate([1, 2, 5]):
        assert abs(counts[shard] / 20_000 - weight / 8) < 0.015
    with pytest.raises(ValueError):
        sharding.placements(docs, "doc_id", "text", [1.0, 0.0])


def test_shards_of_an_empty_table(no_docs):
    assert sharding.rendezvous_shards(no_docs).count() == 0


# mixing

def brute_targets(sizes: dict, weights=(5, 2, 1), share=1.5, ceiling=2.0) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] >= ceiling * sizes[s]]
        if not over:
            target.update({s: level * weight[s] for s in open_})
            break
        for s in over:
            target[s] = ceiling * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100, None: 100}, {"a": 10, "b": 500, "c": 0, "": 30}, {"é": 7, "z": 9, "Z": 1000, "zz": 3, "y": 70},
    {"one": 5}])
def test_targets_are_those_of_repeated_sharing(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    expected = brute_targets(sizes)
    assert found.keys() == expected.keys()
    assert all(found[s] == pytest.approx(expected[s], abs=1e-6) for s in expected)


def test_pivot_keeps_words_and_expectations():
    random = np.random.default_rng(0)
    sizes, chances = np.array([50.0, 3, 3, 7, 20, 1, 9, 4]), np.array([.3, .3, .8, .5, .3, .9, .1, 0.0])
    total = np.zeros(len(sizes))
    for _ in range(4000):
        out, held = mixing.pivot(chances, sizes, random.random(len(sizes)))
        assert out @ sizes == pytest.approx(chances @ sizes)
        assert all(p in (0, 1) for i, p in enumerate(out) if i != held)
        total += out
    assert np.abs(total / 4000 - chances).max() < 0.04


def test_mix_of_edge_rows(edge_docs, edge_rows):
    mix = mixing.pivotal_mix(edge_docs)
    rows = mixing.taken_words(mix).collect()
    sizes = Counter()
    for _, text, _, source, _ in edge_rows:
        sizes[source] += len(words(text))
    target = brute_targets(sizes)
    assert Counter((r.doc_id, r.source, r["size"]) for r in rows) == Counter((d, s, len(words(t))) for d, t, _, s, _ in edge_rows)
    taken = Counter()
    for r in rows:
        assert 0 <= r.taken <= 2 * r["size"] and (not r["size"] or r.taken % r["size"] == 0)
        assert r.target == pytest.approx(target[r.source]) and r.source_size == sizes[r.source]
        taken[r.source] += r.taken
    for source, size in sizes.items():
        largest = max(len(words(t)) for _, t, _, s, _ in edge_rows if s == source)
        assert abs(taken[source] - target[source]) <= largest / 2 + 1e-6
    again = mixing.taken_words(mixing.pivotal_mix(edge_docs.repartition(5))).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))
    kept = mixing.mixed_rows(edge_docs, mix)
    assert kept.columns == edge_docs.columns
    by_source = Counter()
    for r in kept.collect():
        by_source[r.source] += len(words(r.text))
        assert r["node"] == "own node"
    assert +by_source == +taken


def test_mix_of_many_documents_meets_targets(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.expr("concat('s', id % 3)").alias("source"),
                                    F.expr("trim(repeat('w ', int(1 + id % 17)))").alias("text"))
    rows = mixing.taken_words(mixing.pivotal_mix(docs)).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect()
    assert all(abs(r.t - r.g) <= 17 for r in rows) and len(rows) == 3


def test_mix_of_an_empty_table(no_docs):
    assert mixing.taken_words(mixing.pivotal_mix(no_docs)).count() == 0
    assert mixing.mixed_rows(no_docs, mixing.pivotal_mix(no_docs)).count() == 0


# rules

def brute_rules(text):
    own = words(text)
    windows = Counter(tuple(own[i:i + 3]) for i in range(len(own) - 2))
    inside = {j for i in range(len(own) - 2) if windows[tuple(own[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    failed = len(own) < 50 or 100 * len(inside) > 50 * len(own)
    return (len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside), failed)


def test_statistics_of_edge_rows(edge_docs, edge_rows):
    stats = anomaly.statistics(edge_docs)
    assert set(edge_docs.columns) <= set(stats.columns)
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    scored = anomaly.with_scores(stats, []).collect()
    assert Counter((r.doc_id, *[r[c] for c in columns]) for r in scored) == Counter((d, *brute_rules(t)) for d, t, *_ in edge_rows)


def test_statistics_of_whole_texts(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in queries.op10_isolation_rules(spark, sf_dir).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_rules(texts[r.doc_id])
        assert not (r.kept and r.base_failed)


def naive_depth(tree, row, node=0):
    feature, cut, right, length = tree[node]
    if feature < 0:
        return length
    return naive_depth(tree, row, node + 1 if row[feature] < cut else right)


def test_verdicts_follow_path_lengths_and_the_cheapest_limit(spark, sf_dir):
    """Scores by walking each tree from its root, the limit by trying every step of the histogram."""
    stats = anomaly.written_statistics(queries.table(spark, sf_dir, "documents").select("doc_id", "text"))
    labels = queries.table(spark, sf_dir, "labels")
    forest, limit = anomaly.fit(stats, labels)
    rows = anomaly.judged(stats, forest, limit).collect()
    trees = [(list(zip(*(c.tolist() for c in tree[:4]))), tree[4]) for tree in forest]
    score = {}
    for r in rows:
        values = anomaly.features({c: np.array([r[c]]) for c in anomaly.COUNTS})[0]
        score[r.doc_id] = 2 ** -np.mean([naive_depth(nodes, values) / usual for nodes, usual in trees])
        assert r.anomaly == pytest.approx(score[r.doc_id], rel=1e-9)
        assert r.kept == (not r.base_failed and r.anomaly < limit)
    quality = {r.doc_id: r.quality for r in labels.collect()}
    judged = [(r.anomaly, quality[r.doc_id]) for r in rows if r.doc_id in quality and not r.base_failed]

    def cost(at):
        return sum((anomaly.LOST if q == 1 else 0) if a >= at else (q != 1) for a, q in judged)

    assert cost(limit) == min(cost(i / anomaly.STEPS) for i in range(0, anomaly.STEPS + 1))


def test_forest_separates_the_labelled_rows(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in queries.table(spark, folder, "labels").collect()}
    rows = [r for r in queries.op10_isolation_rules(spark, folder).collect() if r.doc_id in labels and not r.base_failed]
    good = [r.kept for r in rows if labels[r.doc_id] == 1]
    bad = [r.kept for r in rows if labels[r.doc_id] == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.1


def test_path_lengths_isolate_outliers():
    rows = np.random.default_rng(1).normal(0, 1, (400, anomaly.FEATURES))
    forest = []
    for seed in range(30):
        nodes = anomaly.grow(rows, seed)
        forest.append((*(np.array(c) for c in zip(*nodes)), anomaly.mean_depth(len(rows))))
    probes = np.vstack([np.zeros(anomaly.FEATURES), np.full(anomaly.FEATURES, 9.0)])
    inside, outside = anomaly.score_rows(forest, probes)
    assert outside > inside + 0.1


def test_rules_without_labels_or_rows(edge_docs, no_docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    kept = anomaly.accepted_rows(edge_docs, none)
    assert kept.columns == edge_docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(
        r.doc_id for r in edge_docs.collect() if not brute_rules(r.text)[-1])
    assert anomaly.accepted_rows(no_docs, none).count() == 0


# byte-level BPE

@pytest.fixture(scope="module")
def ranks(spark):
    return bpe.load_ranks(spark, queries.vocabulary_path())


@pytest.fixture(scope="module")
def reference_encoding():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


HARD = ["a" * 3000, "ab" * 500, " " * 700 + "x", "\n\n\t x  y ", " x", "x ", "日本語" * 60, "\x85\xa0\x1c x\x1d", "don't I'll 12a 3",
        "<|endoftext|>", "x" * 256 + " " + "y" * 257, "  a  b", "🎉👩‍👧" * 40]


def test_merges_equal_the_tokenizer(ranks, reference_encoding):
    encoder = bpe.Encoder(bpe.Vocabulary(ranks), public_tokenizers.PATTERN)
    texts = HARD + [prose(9, 300), None, ""]
    for text, packed in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(packed, "<u4").tolist() == reference_encoding.encode_ordinary(text or "")


def test_parts_encoded_together_equal_the_tokenizer(ranks, reference_encoding, monkeypatch):
    """Random texts of letters, marks and all kinds of white space, in batches; the cache turns over many times."""
    monkeypatch.setattr(bpe, "CACHED_PIECES", 60)
    random = np.random.default_rng(11)
    signs = np.array(list("abcXY19'.-é日") + ["'s", " ", " ", " ", " ", "\n", "\t", "\r\n", "\u3000", "\x1c", "\x85"])
    texts = ["".join(random.choice(signs, random.integers(0, 40))) for _ in range(600)]
    encoder = bpe.Encoder(bpe.Vocabulary(ranks), public_tokenizers.PATTERN)
    for at in range(0, len(texts), 20):
        for text, packed in zip(texts[at:at + 20], encoder.encode(texts[at:at + 20])):
            assert np.frombuffer(packed, "<u4").tolist() == reference_encoding.encode_ordinary(text)


def test_frequent_words_are_merged_once(ranks, monkeypatch):
    """Many rare words fill the cache over and over; a word that stands in every group stays known, and the cache bounded."""
    monkeypatch.setattr(bpe, "CACHED_PIECES", 100)
    vocabulary, merged = bpe.Vocabulary(ranks), Counter()
    monkeypatch.setattr(vocabulary, "merge", lambda pieces, plain=vocabulary.merge: merged.update(pieces) or plain(pieces))
    encoder = bpe.Encoder(vocabulary, public_tokenizers.PATTERN)
    for group in range(20):
        rare = ["q" + "".join(chr(97 + int(d)) for d in str(100 * group + i)) for i in range(30)]
        encoder.encode([f"x frequently {w} words" for w in rare])
    assert merged[b" frequently"] == merged[b" words"] == 1 and len(merged) > 600
    assert all(len(half) <= 100 for kept in (encoder.parts, encoder.pieces) for half in (kept.new, kept.old))


def test_matrix_and_heap_merge_alike(ranks):
    vocabulary = bpe.Vocabulary(ranks)
    pieces = [p.encode() for p in HARD if len(p.encode()) <= bpe.LONGEST] + [b" the", b"\xff\xfe\x00", b"aaaaaaa"]
    assert vocabulary.merge(pieces) == [vocabulary.merge_long(p) for p in pieces]


def test_encode_and_decode_frames(edge_docs, edge_rows, no_docs, ranks, reference_encoding):
    out = bpe.encode(edge_docs, ranks, public_tokenizers.PATTERN)
    rows = bpe.decode(out, ranks).collect()
    assert len(rows) == len(edge_rows)
    for r in rows:
        ids = np.array(reference_encoding.encode_ordinary(r.text or ""), "<u4")
        assert r.n_tokens == len(ids) and bytes(r.ids) == ids.tobytes() and r.decoded == (r.text or "")
        assert r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest() and r["row"] == "own row"
    assert bpe.encode(no_docs, ranks, public_tokenizers.PATTERN).count() == 0


# repeated windows

def brute_cut(texts, size):
    counts = Counter()
    own = [words(t) for t in texts]
    for w in own:
        counts.update(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    out = []
    for w in own:
        gone = {j for i in range(len(w) - size + 1) if counts[tuple(w[i:i + size])] > 1 for j in range(i, i + size)}
        out.append([x for j, x in enumerate(w) if j not in gone])
    return out


@pytest.mark.parametrize("size", [3, 35])
def test_repeats_of_edge_rows(edge_docs, size):
    docs = edge_docs.collect()
    expected = Counter((r.doc_id, len(words(r.text)), len(words(r.text)) - len(k), hashlib.sha256(" ".join(k).encode()).hexdigest())
                       for r, k in zip(docs, brute_cut([r.text for r in docs], size)))
    out = substrings.remove_repeats(edge_docs, size=size).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out) == expected


def thue_morse(order):
    word = "a"
    for _ in range(order):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("order", [9, 11])
def test_words_that_collide_modulo_a_power_of_two_differ(spark, order):
    one, other = thue_morse(order)
    between = prose(31, 34)
    texts = [f"{one} {between}", f"{other} {between}", "\n".join([one, other] * 2), f"{one} x y {other} x y"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert all(r.n_removed == 0 for r in substrings.remove_repeats(docs).collect())
    for r in anomaly.with_scores(anomaly.statistics(docs), []).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_rules(r.text)


def test_spans_equal_python_integers():
    from palaver.llm.words import PRIME, RollingHash, halves

    rolling, prime = RollingHash(12345678901234567890), int(PRIME)
    values = np.random.default_rng(1).integers(0, 2**63, 300).astype(np.uint64)
    sums = rolling.prefix(halves(values))
    for own, half, base in zip(sums, halves(values), rolling.bases):
        assert int(own[200]) % prime == sum(int(v) * pow(base, i, prime) for i, v in enumerate(half[:200])) % prime
    moved = rolling.prefix(halves(np.concatenate((values[:50], values))))
    starts, ends = np.array([0, 10, 299]), np.array([300, 25, 300])
    assert (rolling.spans(sums, starts, ends) == rolling.spans(moved, starts + 50, ends + 50)).all()


def test_repeats_across_many_slices_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(substrings, "HASHED_AT_ONCE", 3000)
    shared = prose(100, 60)
    texts = [prose(200 + i, 50 + i) + (" " + shared if i % 5 == 0 else "") + (" " + prose(200 + i, 40) if i == 7 else "") for i in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    out = {r.doc_id: r for r in substrings.remove_repeats(docs).collect()}
    for i, kept in enumerate(brute_cut(texts, 35)):
        assert out[i].kept_text.split() == kept and out[i].n_removed == len(words(texts[i])) - len(kept)


def test_repeats_of_the_table(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents").collect()
    rows = {r.doc_id: r for r in queries.op8_repeated_windows(spark, sf_dir).collect()}
    for r, kept in zip(docs, brute_cut([r.text for r in docs], 35)):
        assert rows[r.doc_id].kept_sha256 == hashlib.sha256(" ".join(kept).encode()).hexdigest()


def test_rows_without_repeats_keep_their_columns(edge_docs, no_docs):
    out = substrings.without_repeats(edge_docs)
    assert out.columns == edge_docs.columns and out.count() == edge_docs.count()
    row = out.filter("doc_id = 9").first()
    assert row.text == "é ß ❤️ 日本 #x# | <b>" and row.n_chars == len(row.text) and row["_row"] == "own _row"
    assert substrings.without_repeats(no_docs).count() == 0


def test_encoded_rows_leave_in_groups(spark, ranks, monkeypatch):
    """A batch of many texts is handed on in groups of bounded bytes, null and empty texts included; the rows are the same."""
    texts = pa.array(["ab " * 40, None, "", "x" * 500, "cd", "ef"])
    assert list(bpe.groups(texts, 130)) == [(0, 3), (3, 1), (4, 2)]
    assert list(bpe.groups(texts.slice(1), 130)) == [(0, 2), (2, 1), (3, 2)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts.to_pylist())], "doc_id long, text string").coalesce(1)
    whole = bpe.encode(df, ranks, public_tokenizers.PATTERN, keep=["doc_id"]).collect()
    sizes = []
    original = bpe.Encoder.encode
    monkeypatch.setattr(bpe.Encoder, "encode", lambda self, group: sizes.append(sum(len(t or "") for t in group)) or original(self, group))
    held = {}
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, schema: held.setdefault("run", run) and self)
    monkeypatch.setattr(bpe.groups, "__defaults__", (130,))
    bpe.encode(df, ranks, public_tokenizers.PATTERN, keep=["doc_id"])
    batch = pa.RecordBatch.from_arrays([pa.array(range(6), pa.int64()), texts], names=["doc_id", "text"])
    out = list(held["run"](iter([batch])))
    assert [b.num_rows for b in out] == [3, 1, 2] and max(sizes) == 500
    assert pa.Table.from_batches(out).to_pylist() == [{**r.asDict(), "ids": bytes(r.ids)} for r in sorted(whole)]


def test_batches_to_python_are_bounded(spark):
    """Stages bound the bytes of a batch, unless the user has; a task then never gets thousands of long texts at once."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(name)
    try:
        session.bound_batches(spark)
        assert spark.conf.get(name) in ("4m", "4194304")
        rows = spark.range(0, 3000, 1, 1).selectExpr("id", "repeat('x', 10000) AS text")
        most = rows.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long").agg({"n": "max"}).first()[0]
        assert most < 600
        spark.conf.set(name, "8m")
        session.bound_batches(spark)
        assert spark.conf.get(name) in ("8m", "8388608")
    finally:
        spark.conf.unset(name)

"""Operators on small fixtures against brute force and worked rows."""

from __future__ import annotations

import math
import random
from collections import Counter
from datetime import date, datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from palaver import schemas, session, values
from palaver.functions import scalars
from palaver.operators import (corpus, evaluation, forest, keywords, listings, merge, quality, records, rollups,
                               search, vectors)
from palaver.sources import files

T0 = datetime(2024, 1, 10, 12, 0)
SEED_ROWS = [
    ("p1", "comment_001", "ana", "a fine map of the harbour", 0.1, 0.8, 120),
    ("p1", "comment_002", "ben", "rude remark about a map", 0.9, 0.2, 60),
    ("p2", "comment_003", "cem", "where is the harbour", 0.05, 0.7, 30),
    ("p2", "comment_004", "dot", "not where the map says", 0.3, 0.4, 15),
    ("p3", "comment_005", "eli", "thank you for the map", 0.02, 0.9, 0),
]


@pytest.fixture
def seeded(spark):
    rows = [(*r[:6], T0 - timedelta(minutes=r[6])) for r in SEED_ROWS]
    given = spark.createDataFrame(rows, "post_id string, comment_id string, username string, comment string, "
                                        "toxicity_score double, sentiment_score double, created_time timestamp_ntz")
    return quality.write_time_labels(quality.with_defaults(given)).withColumn(
        "ingestion_time", F.col("created_time"))


def test_seed_rows_take_defaults_then_labels(seeded):
    rows = {r.comment_id: r for r in seeded.collect()}
    assert [k for k, r in rows.items() if r.is_toxic] == ["comment_002"]
    assert rows["comment_002"].requires_review and not rows["comment_001"].requires_review
    assert {r.sentiment for r in rows.values()} == {"neutral"}  # the default comes before the rule


def test_write_time_rule_fills_blank_sentiment_and_keeps_reviews(spark):
    rows = [(0.5, None, 0.6, False), (0.49, "", 0.4, True), (None, "", 0.5, None), (0.9, "positive", 0.1, False)]
    df = spark.createDataFrame(
        rows, "toxicity_score double, sentiment string, sentiment_score double, requires_review boolean")
    df = df.withColumn("is_toxic", F.lit(False)).withColumn("label", F.lit("x"))
    out = quality.write_time_labels(df).collect()
    assert [(r.label, r.sentiment, r.requires_review) for r in out] == [
        ("toxique", "positive", True), ("non_toxique", "negative", True), ("non_toxique", "neutral", None),
        ("toxique", "positive", True)]


def test_rules_let_null_pass(spark):
    df = spark.createDataFrame([("a", None, None), ("b", 1.5, "mixed"), (None, 0.5, "neutral")],
                               "comment_id string, toxicity_score double, sentiment string")
    valid, rejected = quality.split_rows(df)
    assert [r.comment_id for r in valid.collect()] == ["a"]
    assert {r.comment_id: set(r.reasons) for r in rejected.collect()} == {
        "b": {"toxicity_score_range", "sentiment_domain"}, None: {"comment_id_not_null"}}


def test_repeated_keys_ignore_null(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert [(r.k, r.copies) for r in quality.repeated_keys(df, "k").collect()] == [("a", 2)]


def test_empty_snapshot(seeded):
    as_of = scalars.moment("2030-01-01 00:00:00")
    row = rollups.realtime_statistics(seeded, as_of).first()
    assert (row.total_comments, row.toxic_count, row.avg_toxicity_score, row.avg_sentiment_score) == (0, None, 0.0, 0.5)
    stats = rollups.global_statistics(seeded.filter("false"))
    assert tuple(stats.first()) == (0, 0, 0, 0, 0, 0, 0.5, 0.0)
    assert rollups.kpi_percentages(stats).first().toxic_pct == 0.0


def test_snapshot_window_is_trailing(seeded):
    row = rollups.realtime_statistics(seeded, F.lit(T0).cast("timestamp_ntz"), 30).first()
    assert (row.total_comments, row.period_start, row.period_type) == (3, T0 - timedelta(minutes=30), "realtime")


def test_weeks_start_on_monday(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 7, 23, 59),), (datetime(2024, 1, 8),)], "ts timestamp_ntz")
    assert [r.w for r in df.select(scalars.week_of("ts").alias("w")).collect()] == [date(2024, 1, 1), date(2024, 1, 8)]


def test_hours_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # 02:30 does not exist there on this day
        df = spark.createDataFrame([("2024-03-10 02:30:00",)], "s string").select(F.col("s").cast("timestamp_ntz").alias("t"))
        assert df.select(scalars.hour_of("t").alias("h")).first().h == datetime(2024, 3, 10, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.2,), (0.8,), (1.0,), (None,)], "toxicity_score double")
    found = {r["range"]: r["count"] for r in rollups.toxicity_histogram(df).collect()}
    assert found == {"0-20%": 1, "20-40%": 1, "80-100%": 3}


def test_lists_put_missing_times_first(spark):
    rows = [("a", datetime(2024, 1, 1)), ("b", None), ("c", datetime(2024, 1, 2))]
    df = spark.createDataFrame(rows, "comment_id string, ingestion_time timestamp_ntz")
    assert [r.comment_id for r in df.orderBy(*listings.newest_first()).collect()] == ["b", "c", "a"]


def test_display_keeps_columns_that_exist(spark):
    df = spark.createDataFrame([("x", "toxique", 1)], "username string, label string, other int")
    assert listings.display(df).columns == ["Utilisateur", "Label"]


# --- keys: hot groups --------------------------------------------------------------------------


def test_first_seen_with_a_hot_key(spark):
    rows = [("hot" if i % 3 else f"k{i}", (i * 7919) % 1000, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, at int, id int")
    expected = {}
    for k, at, i in rows:
        expected[k] = min(expected.get(k, (at, i)), (at, i))
    found = {r.k: (r.at, r.id) for r in records.first_seen(df, ["k"], ["at", "id"]).collect()}
    assert found == expected


RESULT_ROW = "comment_id string, comment string, toxicity_score double, label string, ingestion_time timestamp_ntz"


def test_upsert_keeps_first_text_and_last_score(spark):
    at = [T0 + timedelta(minutes=i) for i in range(4)]
    old = spark.createDataFrame([("a", "first", 0.1, "non_toxique", at[0]), ("c", "kept", 0.3, "x", at[0])], RESULT_ROW)
    batch = spark.createDataFrame([("a", "second", 0.7, "toxique", at[2]), ("a", "third", 0.2, "non_toxique", at[1]),
                                   ("b", "new", 0.9, "toxique", at[1]), ("b", "newer", None, "toxique", at[3])], RESULT_ROW)
    merged = merge.upsert(old, batch)
    expected = {("a", "first", 0.7, "toxique", at[2]), ("b", "new", None, "toxique", at[3]), ("c", "kept", 0.3, "x", at[0])}
    assert {tuple(r) for r in merged.collect()} == expected
    assert {tuple(r) for r in merge.upsert(merged, batch).collect()} == expected
    scores = merge.upsert(old, batch, update=merge.SCORE_ONLY_COLUMNS).collect()
    assert {(r.comment_id, r.toxicity_score, r.label) for r in scores} == {
        ("a", 0.7, "non_toxique"), ("b", None, "toxique"), ("c", 0.3, "x")}


def test_batch_rows_follow_stored_rows_even_with_older_times(spark):
    old = spark.createDataFrame([("a", "t", 0.1, "x", T0)], RESULT_ROW)
    batch = spark.createDataFrame([("a", "t", 0.8, "y", T0 - timedelta(days=1))], RESULT_ROW)
    assert merge.upsert(old, batch).first().toxicity_score == 0.8


def test_retention(spark):
    old, new = T0 - timedelta(days=31), T0 - timedelta(days=29)
    rows = [(old, "realtime"), (old, "daily"), (new, "realtime"), (None, "realtime"), (old, None)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, period_type string")
    as_of = F.lit(T0).cast("timestamp_ntz")
    assert merge.retain(df, as_of).count() == 4
    assert merge.expired_count(df, as_of).first().deleted_count == 1


def test_run_counters(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", ""), ("c", None), ("d", "y")], "k string, m string")
    found = {r.metric_name: r.metric_value for r in rollups.run_counters(df, "m", "k", F.lit(T0)).collect()}
    assert found == {"total_fetched": 5.0, "total_sent": 2.0, "duplicates_skipped": 1.0}


# --- keywords and search -------------------------------------------------------------------------


def test_keywords_of_a_comment(spark):
    text = "zeta zeta, 'alpha' alpha the it's beta! " + " ".join(f"w{i:02d}" for i in range(12))
    df = spark.createDataFrame([(text,), ("a b",)], "cleaned_comment string")
    first, second = (r.keywords for r in keywords.comment_keywords(df).collect())
    assert first == ["alpha", "zeta", "beta"] + [f"w{i:02d}" for i in range(7)]
    assert second == []


def test_trending_equals_the_running_mean(spark):
    rng = random.Random(5)
    rows = [(["hot"] + rng.sample("abcdef", 2), rng.random(), rng.random(), T0 + timedelta(minutes=i)) for i in range(60)]
    df = spark.createDataFrame(
        rows, "keywords array<string>, sentiment_score double, toxicity_score double, ingestion_time timestamp_ntz")
    table = {}
    for words, mood, toxic, at in rows:  # one update per occurrence
        for w in words:
            n, m, t, first, _ = table.get(w, (0, 0.0, 0.0, at, at))
            table[w] = (n + 1, (m * n + mood) / (n + 1), (t * n + toxic) / (n + 1), first, at)
    cut = F.col("ingestion_time") < F.lit(T0 + timedelta(minutes=25))
    merged = keywords.merge_trending(keywords.trending(df.filter(cut)), keywords.trending(df.filter(~cut)))
    for found in (keywords.trending(df), merged):
        got = {r.keyword: r for r in found.collect()}
        assert set(got) == set(table)
        for w, (n, m, t, first, last) in table.items():
            r = got[w]
            assert (r["count"], r.first_seen, r.last_updated) == (n, first, last)
            assert (r.sentiment_avg, r.toxicity_avg) == (pytest.approx(m), pytest.approx(t))


def test_merged_means_leave_out_missing_scores(spark):
    rows = [(["k"], 0.2, None), (["k"], None, None), (["k"], 0.8, 0.5)]
    df = spark.createDataFrame([(*r, T0 + timedelta(minutes=i)) for i, r in enumerate(rows)],
                               "keywords array<string>, sentiment_score double, toxicity_score double, ingestion_time timestamp_ntz")
    first = F.col("ingestion_time") < F.lit(T0 + timedelta(minutes=2))
    merged = keywords.merge_trending(keywords.trending(df.filter(first)), keywords.trending(df.filter(~first))).first()
    assert (merged["count"], merged.sentiment_avg, merged.toxicity_avg) == (3, pytest.approx(0.5), 0.5)


def test_search_ignores_stopwords_in_the_query(spark):
    df = spark.createDataFrame([("1", "the cat sat"), ("2", "the dog")], "comment_id string, t string")
    assert [r.comment_id for r in search.search(df, "t", all_of=("the", "cat")).collect()] == ["1"]
    assert search.search(df, "t", any_of=("the",)).count() == 0


def test_search_ways_agree(spark, tmp_path):
    rng = random.Random(3)
    words = ["kill", "bill", "Mill", "the", "till"]
    rows = [(str(i), " ".join(rng.choices(words, k=rng.randint(0, 4)))) for i in range(80)]
    df = spark.createDataFrame(rows, "comment_id string, comment string")
    postings = search.posting_table(df, "comment")
    search.write_postings(postings, str(tmp_path / "p"), buckets=8)
    for query in ({"all_of": ["kill", "BILL"]}, {"any_of": ["mill", "kill"], "none_of": ["till"]},
                  {"all_of": ["kill"], "any_of": ["mill", "till"], "none_of": ["bill"]}):
        low = {k: {w.lower() for w in v} for k, v in query.items()}
        expected = set()
        for i, text in rows:
            terms = set(text.lower().split()) - {"the"}
            if low.get("all_of", set()) <= terms and not (low.get("none_of", set()) & terms) and (
                    "any_of" not in low or low["any_of"] & terms):
                expected.add(i)
        assert {r.comment_id for r in search.search(df, "comment", **query).collect()} == expected
        assert {r.comment_id for r in search.search_postings(postings, "comment_id", **query).collect()} == expected
        stored = search.read_postings(spark, str(tmp_path / "p"), [w for v in query.values() for w in v], buckets=8)
        assert {r.comment_id for r in search.search_postings(stored, "comment_id", **query).collect()} == expected


# --- vectors ------------------------------------------------------------------------------------


def test_global_rank_over_many_partitions(spark):
    rng = random.Random(1)
    rows = [(f"w{i}", rng.randint(1, 5)) for i in range(2000)]
    df = spark.createDataFrame(rows, "word string, n int").repartition(16)
    found = {r.word: r["index"] for r in vectors.global_rank(df, [F.col("n").desc(), F.col("word")]).collect()}
    assert found == {w: i + 1 for i, (w, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}


@pytest.mark.parametrize("head", [4096, 5])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_ranked_lookup_is_whole_for_head_and_tail(spark, monkeypatch, head, how):
    monkeypatch.setattr(session, "HEAD_RANKS", head)
    words = [f"w{i}" for i in range(50)] + ["long" * 200]
    table = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "word string, index int")
    tokens = [(i, "w0" if i % 3 == 0 else words[i % 51] if i % 7 else "unknown") for i in range(900)]
    big = spark.createDataFrame(tokens, "id int, word string")
    rank = {w: i + 1 for i, w in enumerate(words)}
    expected = Counter((i, w, rank.get(w)) for i, w in tokens if how == "left" or w in rank)
    found = session.ranked_lookup(big, table, "word", "index", how).select("id", "word", "index")
    assert Counter(tuple(r) for r in found.collect()) == expected


def test_tfidf_by_hand(spark):
    texts = ["aa bb aa", "bb cc", "x"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    found = {(r.id, r.term): r.tfidf for r in vectors.tfidf(df, vectors.fit_idf(df, "id", "t"), "id", "t").collect()}
    idf = {"aa": math.log(4 / 2) + 1, "bb": math.log(4 / 3) + 1, "cc": math.log(4 / 2) + 1}
    length = math.hypot(2 * idf["aa"], idf["bb"])
    assert found[(0, "aa")] == pytest.approx(2 * idf["aa"] / length)
    assert set(found) == {(0, "aa"), (0, "bb"), (1, "bb"), (1, "cc")}


def test_sequences_and_padding(spark):
    df = spark.createDataFrame([(0, "b a a c"), (1, "zz"), (2, "a,b! C's")], "id int, t string")
    words = vectors.fit_vocabulary(df.filter("id = 0"), "t")
    assert {r.word: r["index"] for r in words.collect()} == {"a": 1, "b": 2, "c": 3}
    assert {r.word for r in vectors.fit_vocabulary(df, "t", size=2).collect()} == {"a", "b"}

    def run(*arguments):
        return {r.id: r.sequence for r in vectors.sequences(df, words, "id", "t", *arguments).collect()}
    assert run(3, "post", "post") == {0: [2, 1, 1], 1: [0, 0, 0], 2: [1, 2, 0]}
    assert run(3, "pre", "pre") == {0: [1, 1, 3], 1: [0, 0, 0], 2: [0, 1, 2]}


@pytest.mark.parametrize("head", [4096, 3, 0])
def test_coded_texts_for_head_and_tail(spark, monkeypatch, head):
    """Every word at its place, whether it is looked up in the broadcast head or in the shuffled rest."""
    monkeypatch.setattr(session, "HEAD_RANKS", head)
    rng = random.Random(4)
    pool = [f"w{i}" for i in range(12)] + ["long" * 200]
    texts = {i: " ".join(rng.choices(pool, [2 ** -j for j in range(13)], k=rng.randint(1, 40))) for i in range(60)}
    texts |= {60: "", 61: None, 62: "unknown w1 unknown", 63: "w0 " * 3000}
    df = spark.createDataFrame(list(texts.items()), "id int, t string").repartition(5)
    lists = session.written(vectors.placed(df, "id", vectors.vocabulary_tokens("t")), "placed")
    words = session.written(vectors.vocabulary_of(lists).filter("word <> 'unknown'"), "words")
    number = {r.word: r["index"] for r in words.collect()}
    found = {r.id: r.codes for r in vectors.codes(lists, words, "id").collect()}
    assert found == {i: [number[w] for w in (t or "").split() if w in number] for i, t in texts.items()}

    vector = {w: [float(i), 1.0] for w, i in number.items()}
    matrix = session.written(vectors.embedding_matrix(
        words, spark.createDataFrame(list(vector.items()), "word string, vector array<float>"), 2), "matrix")
    coded = spark.createDataFrame([(i, c) for i, c in found.items()], "id int, codes array<int>")
    means = {r.id: r.vector for r in vectors.mean_of_codes(coded, matrix, "id", 2).collect()}
    assert set(means) == {i for i, c in found.items() if c}
    assert all(means[i] == pytest.approx([sum(c) / len(c), 1.0]) for i, c in found.items() if c)


def test_tfidf_of_counted_texts(spark):
    texts = {0: "aa bb aa", 1: "bb cc " + "dd" * 300, 2: "x", 3: None, 4: "bb"}
    df = spark.createDataFrame(list(texts.items()), "id int, t string")
    lists = session.written(vectors.counted(df, "id", vectors.tfidf_tokens("t")), "counted")
    idf = session.written(vectors.idf_of(lists), "idf")
    counts = {i: Counter(w for w in (t or "").split() if len(w) > 1) for i, t in texts.items()}
    weight = {w: math.log(6 / (1 + sum(w in c for c in counts.values()))) + 1 for c in counts.values() for w in c}
    found = {(r.id, r.term): (r.n, r.tfidf) for r in vectors.weights(lists, idf, "id").collect()}
    assert set(found) == {(i, w) for i, c in counts.items() for w in c}
    for (i, w), (n, value) in found.items():
        length = math.sqrt(sum((k * weight[v]) ** 2 for v, k in counts[i].items()))
        assert n == counts[i][w] and value == pytest.approx(n * weight[w] / length)


def test_embeddings(spark):
    df = spark.createDataFrame([(0, "a a b")], "id int, t string")
    words = vectors.fit_vocabulary(df, "t")
    given = spark.createDataFrame([("a", [3.0, 6.0])], "word string, vector array<float>")
    matrix = vectors.embedding_matrix(words, given, 2)
    assert {r.word: r.vector for r in matrix.collect()} == {"a": [3.0, 6.0], "b": [0.0, 0.0]}
    assert vectors.mean_embedding(df, matrix, "id", "t", 2).first().vector == pytest.approx([2.0, 4.0])


# --- evaluation and models ------------------------------------------------------------------------


def test_label_report(spark):
    rows = [(1, 1, 0, 0), (1, 0, 0, 1), (0, 1, 0, 0), (1, 1, 0, 0)]
    df = spark.createDataFrame(rows, "t1 int, p1 int, t2 int, p2 int")
    found = {r.label: r for r in evaluation.label_report(df, {"one": ("t1", "p1"), "two": ("t2", "p2")}).collect()}
    assert (found["one"].precision, found["one"].recall) == (pytest.approx(2 / 3, abs=1e-6), pytest.approx(2 / 3, abs=1e-6))
    assert (found["two"].precision, found["two"].recall, found["two"].f1, found["two"].support) == (0, 0, 0, 0)
    assert found["micro avg"].precision == 0.5 and found["subset accuracy"].f1 == 0.5
    assert found["samples avg"].recall == 0.5


def test_macro_f1_rounds_half_to_even(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.51), (0, 0.2)], "t int, p double")
    assert evaluation.macro_f1(df, {"x": ("t", "p")}).first().macro_f1 == pytest.approx(2 / 3, abs=1e-6)


def test_forest_of_six_labels(spark, tmp_path):
    rows = [(i, f"{'idiot moron' if i % 2 else 'nice day'} w{i % 5}", *[i % 2] * 3, *[0] * 3) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, comment_text string, " + ", ".join(f"{c} int" for c in values.TOXICITY_LABELS))
    model = forest.fit_forest(df, depth=5)
    forest.save_model(model, str(tmp_path / "m"))
    scored = forest.predict(forest.load_model(spark, str(tmp_path / "m")), df)
    labelled = scored.select("id", forest.label_map(values.TOXICITY_LABELS).alias("m"), forest.model_score().alias("s"))
    for row in labelled.collect():
        assert row.m["toxic"] == row.id % 2 and row.m["threat"] == 0
        assert row.s == pytest.approx(0.5 if row.id % 2 else 0.0, abs=0.1)
    assert forest.load_model(spark, str(tmp_path / "none")) is None


def brute_tree(rows, tree, depth, n_terms, mean_terms, seed=0):
    """One tree by trying every term and cut of every node; leaves as ``(path, shares)``."""
    def number(x):
        return np.array([x], np.int64)

    drawn = [(y, x, int(forest.drawn(number(row), tree, seed)[0]) * copies) for row, copies, y, x in rows]
    leaves = {}

    def impurity(part):
        n = sum(w for *_, w in part)
        p = [sum(w * y[j] for y, _, w in part) for j in range(len(rows[0][2]))]
        return sum(a * (n - a) for a in p) / n, n, p

    todo = [(1, drawn, 0, ())]
    while todo:
        level = []
        for node, part, at, path in todo:
            total, n, p = impurity(part)
            best = None
            if at < depth and n > 1 and any(0 < a < n for a in p):
                share = forest.share_of(n, n_terms, mean_terms, forest.LEAST_SEEN)
                for term in sorted({t for _, x, w in part if w for t in x}):
                    if forest.term_draw(number(term), tree, number(node), seed)[0] >= share:
                        continue
                    for i, cut in enumerate(forest.CUTS):
                        high = [r for r in part if r[1].get(term, 0.0) > cut]
                        low = [r for r in part if r[1].get(term, 0.0) <= cut]
                        if sum(r[2] for r in high) and sum(r[2] for r in low):
                            change = impurity(high)[0] + impurity(low)[0] - total
                            if change < -1e-9 and (best is None or (change, term, i) < best[0]):
                                best = (change, term, i), low, high
            if best is None:
                leaves[path] = [a / n for a in p]
            else:
                (_, term, i), low, high = best
                level += [(forest.child_name(node, side), part, at + 1, (*path, (term, i, side))) for side, part in enumerate((low, high))]
        todo = level
    return leaves


def leaves_of(nodes):
    own = {n[1]: n for n in nodes}

    def walk(node, path):
        _, _, term, cut, low, high, shares = own[node]
        if low < 0:
            return {path: shares}
        i = forest.CUTS.index(cut)
        return {**walk(low, (*path, (term, i, 0))), **walk(high, (*path, (term, i, 1)))}
    return walk(0, ())


@pytest.mark.parametrize("seen, small", [(256, 2048), (20, 2048), (256, 0), (20, 25)])
def test_trees_equal_brute_force(spark, monkeypatch, seen, small):
    monkeypatch.setattr(forest, "LEAST_SEEN", seen)
    monkeypatch.setattr(forest, "SMALL", small)
    choose = random.Random(11)
    texts = [" ".join(f"word{min(choose.randrange(40), choose.randrange(40))}" for _ in range(choose.randrange(0, 25))) for _ in range(90)]
    rows = [(t, int(len(t) % 3 == 0), int("word1 " in t), choose.randrange(2)) for t in texts + texts[:10]] + [(None, 1, 0, 0)]
    df = spark.createDataFrame(rows, "comment_text string, a int, b int, c int")
    labels = ["a", "b", "c"]
    model = forest.fit_forest(df, labels=labels, trees=4, depth=9)
    given = [(r.row, r.copies, r.y, dict(zip(r.terms, r.weights)))
             for r in forest.training_rows(df, "comment_text", labels, model.idf).collect()]
    assert sum(r[1] for r in given) == len(rows)
    mean_terms = sum(len(r[3]) for r in given) / len(given)
    for tree in range(4):
        found = leaves_of([n for n in model.nodes if n[0] == tree])
        assert found == brute_tree(given, tree, 9, model.idf.count(), mean_terms)


def test_forest_without_rows_or_terms(spark):
    schema = "comment_text string, a int"
    empty = forest.fit_forest(spark.createDataFrame([], schema), labels=["a"])
    assert forest.predict(empty, spark.createDataFrame([("x y", 1), (None, 0)], schema)).select("probabilities").collect() == [([0.0],)] * 2
    pure = forest.fit_forest(spark.createDataFrame([("aa bb", 1)] * 30 + [("cc", None)], schema), labels=["a"])
    scored = forest.predict(pure, spark.createDataFrame([("zz", 1), ("aa", 0)], schema))
    assert all(r.probabilities[0] in (0.0, 1.0) for r in scored.collect())


def test_corpus_statistics(spark):
    df = spark.createDataFrame([("1", "a", 1), ("2", "b", 0), ("3", "c", -1), ("4", "d", 0)], "id string, t string, toxic int")
    row = corpus.label_prevalence(corpus.used_rows(df), ["toxic"]).first()
    assert tuple(row) == ("toxic", 3, 1, 33.333)
    texts, labels = corpus.split_columns(df, "t")
    assert (texts.columns, labels.columns) == (["t"], ["toxic"])


def test_declared_schemas_name_their_columns():
    assert schemas.RESULT.names[:2] == ["post_id", "comment_id"]
    assert set(schemas.RESULT_DEFAULTS) <= set(schemas.RESULT_WIDE.names)


def test_forest_batch_by_terms(monkeypatch):
    """Rows reach the nodes that a walk finds, and a node draws each distinct term of a batch once, not once per entry."""
    rng = np.random.default_rng(3)
    known = rng.integers(-2**62, 2**62, 60)
    lists = [np.sort(rng.choice(known, rng.integers(0, 40), replace=False)) for _ in range(300)]
    terms = pa.array([r.tolist() for r in lists], pa.list_(pa.int64()))
    weights = pa.array([(rng.integers(1, 40, len(r)) / 100).tolist() for r in lists], pa.list_(pa.float64()))
    batch, tree = forest.Sparse(terms, weights), forest.Tree()
    tree.add(1000, [500], 0, 1)
    for i in range(40):  # a chain with branches; one term is in no row
        leaves = [n for n in range(len(tree.n)) if tree.low[n] < 0]
        tree.split(leaves[i % 3 if len(leaves) > 2 else 0], 7 if i == 5 else int(rng.choice(known)), forest.CUTS[i % 4], 1, [0])
    walked = forest.arrays(tree)
    by_terms = batch.nodes(walked)
    monkeypatch.setattr(forest, "NODES_A_ROW", 0)
    assert (by_terms == batch.nodes(walked)).all() and len(set(by_terms)) > 3

    names, share = np.array(tree.name, np.uint64), np.where(np.arange(len(tree.n)) % 2 == by_terms[0] % 2, 0.3, 0.0)
    node = np.where(np.arange(300) % 5 == 0, -1, by_terms)
    own = node[batch.row]
    least = np.where(own >= 0, share[own], 0.0)
    expected = np.flatnonzero(forest.term_draw(batch.terms, 2, names[own], 9) < least)
    assert len(expected) and np.sort(forest.seen_entries(batch, node, share, names, 2, 9)).tolist() == expected.tolist()

    hashed, mixed = [], forest.mixed
    monkeypatch.setattr(forest, "mixed", lambda x: hashed.append(len(x)) or mixed(x))
    forest.seen_entries(batch, np.zeros(300, np.int64), np.array([0.3]), names[:1], 2, 9)
    assert sum(hashed) <= len(batch.known) + 1 < len(batch.terms)


def test_placed_texts_stay_in_order(spark):
    """A text's tokens are stored as they stand, neither sorted nor grouped; texts of one key are merged by place."""
    df = spark.createDataFrame([(1, "b a, b"), (2, None), (3, "a"), (3, "b zz")], "id int, t string")
    lists = vectors.placed(df, "id", vectors.vocabulary_tokens("t"))
    assert sorted((r.id, r.terms) for r in lists.collect()) == [(1, ["b", "a", "b"]), (2, []), (3, ["a"]), (3, ["b", "zz"])]
    words = spark.createDataFrame([("a", 1, 1), ("b", 1, 2), ("zz", 1, 3)], "word string, n bigint, index bigint")
    assert {r.id: r.codes for r in vectors.codes(lists, words, "id").collect()} == {1: [2, 1, 2], 2: [], 3: [1, 2, 3]}


def test_results_are_written_without_sorting_texts(spark, tmp_path, monkeypatch):
    """Rows of many days, in any order, reach the folders of their days; the session's settings are as before afterwards."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before, seen = spark.conf.get(name), []
    rows = spark.range(200).selectExpr("id", "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(cast(id % 40 AS int)) AS ingestion_time")
    from pyspark.sql.readwriter import DataFrameWriter
    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: seen.append(int(spark.conf.get(name))) or write(self, path, *a, **k))
    files.write_results(rows, str(tmp_path / "results"))
    assert seen and seen[0] > 0 and spark.conf.get(name) == before
    assert len([p for p in (tmp_path / "results").iterdir() if p.name.startswith("ingestion_day=")]) == 40
    found = files.read_results(spark, str(tmp_path / "results"))
    assert sorted((r.id, r.ingestion_day) for r in found.collect()) == [(i, date(2024, 1, 1) + timedelta(days=i % 40)) for i in range(200)]


@pytest.mark.parametrize("limits", [
    {"SMALL": 0}, {"SMALL": 0, "MOST_ENTRIES": 0}, {"SMALL": 0, "AHEAD": 2, "CHUNK": 64, "BATCH_ENTRIES": 30},
    {"CHUNK": 300, "HEAD_TERMS": 12, "BATCH_ENTRIES": 30, "TREES_A_JOB": 1}, {"SMALL": 30, "MOST_ENTRIES": 150, "HEAD_TERMS": 0}])
def test_trees_do_not_depend_on_how_work_is_dealt(spark, monkeypatch, limits):
    """Several levels in a job, grouped sums, small chunks, terms beyond the head: the trees of a search over every term and cut."""
    for name, value in {"LEAST_SEEN": 20, **limits}.items():
        monkeypatch.setattr(forest, name, value)
    choose = random.Random(12)
    texts = [" ".join(f"word{min(choose.randrange(40), choose.randrange(40))}" for _ in range(choose.randrange(0, 25))) for _ in range(60)]
    rows = [(t, int(len(t) % 3 == 0), choose.randrange(2)) for t in texts + texts[:10]] + [(None, 1, 0), ("", 0, 1)]
    df = spark.createDataFrame(rows, "comment_text string, a int, b int")
    model = forest.fit_forest(df, labels=["a", "b"], trees=2, depth=9)
    weighted = {(r.term, round(r.tfidf, 12)) for r in vectors.tfidf(df.selectExpr("uuid() AS k", "comment_text AS t"), model.idf, "k", "t").collect()}
    number = {r.t: r.term for r in model.idf.select("term", F.xxhash64("term").alias("t")).collect()}
    given = [(r.row, r.copies, r.y, dict(zip(r.terms, r.weights)))
             for r in forest.training_rows(df, "comment_text", ["a", "b"], model.idf).collect()]
    assert {(number[t], w) for r in given for t, w in r[3].items()} == weighted and all(list(r[3]) == sorted(r[3]) for r in given)
    mean_terms = sum(len(r[3]) for r in given) / len(given)
    for tree in range(2):
        assert leaves_of([n for n in model.nodes if n[0] == tree]) == brute_tree(given, tree, 9, model.idf.count(), mean_terms)


def test_low_levels_of_a_large_node_share_a_job(spark, monkeypatch):
    """A chain of 30 splits, each of which takes one term's rows out, does not cost a job and a reading of all rows for each level."""
    monkeypatch.setattr(forest, "SMALL", 0)
    monkeypatch.setattr(forest, "LEAST_SEEN", 10**6)  # every node looks at all terms
    rows = [(f"all{i % 3}z word{i // 4}", int(i < 160)) for i in range(400)]
    df = spark.createDataFrame(rows, "comment_text string, a int")
    jobs, mapped = [], type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, *a, **k: jobs.append(1) or mapped(self, *a, **k))
    model = forest.fit_forest(df, labels=["a"], trees=1, depth=30)
    low, depth = {n[1]: n[4] for n in model.nodes}, 0
    at = 0
    while low[at] >= 0:
        at, depth = low[at], depth + 1
    assert depth > 20 and len(jobs) < 12


def test_predictions_with_terms_beyond_the_head(spark, monkeypatch):
    """Rare terms by shuffle give the probabilities of terms looked up in the row; unseen terms are dropped either way."""
    rows = [(i, f"all{i % 3}z word{i // 2} {'bad' if i % 4 == 0 else 'fine'}", int(i % 4 == 0)) for i in range(60)] + [(60, None, 0), (61, "x", 1)]
    df = spark.createDataFrame(rows, "id int, comment_text string, a int")
    model = forest.fit_forest(df, labels=["a"], trees=3, depth=6)
    asked = df.select("id", F.concat("comment_text", F.lit(" unseen")).alias("comment_text"))
    found = []
    for most in (1 << 20, 5, 0):
        monkeypatch.setattr(forest, "HEAD_TERMS", most)
        found.append(sorted(tuple(r) for r in forest.predict(model, asked).select("id", "probabilities").collect()))
    assert found[0] == found[1] == found[2] and len(found[0]) == 62

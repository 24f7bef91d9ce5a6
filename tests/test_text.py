"""Golden rows and properties of the cleaners and scorers."""

from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from palaver import values
from palaver.functions import scores, text
from palaver.operators import corpus
from palaver.plans import stages

GOLDEN = [
    ("Check https://x.y/z?a=1 @bob Ünï 😀😀 中文 YOU   IDIOT!!!   it's", "check ünï you idiot!!! it's", 0.05),
    ("die die! die, die", "die die! die, die", 0.95),
    ("you idiot", "you idiot", 0.25),
    ("ass", "ass", 0.75),
    ("stupid idiot !!!", "stupid idiot !!!", 0.55),
    ("This is a comment!", "this is a comment!", 0.0),
]
COUNTED = [
    ("great day and I love tea", -1 / 3, 0, 2, 0.0, False, "positive", 0.5 + 1 / 3),
    ("What a stupid, stupid! story", 0.0, 0, 0, 0.0, False, "neutral", 0.5),
    ("we hate rain in June", 0.4, 1, 0, 0.25, False, "negative", 0.1),
    ("Only an idiot. says garbage.", 0.0, 0, 0, 0.0, False, "neutral", 0.5),
    ("die on a hill, friend", 0.4, 1, 0, 0.5, True, "negative", 0.1),
    ("an offensive smell in the kitchen", 1 / 3, 1, 0, 0.0, False, "negative", 0.5 - 1 / 3),
]


def test_golden_clean_and_rule_score(spark):
    df = spark.createDataFrame([(m,) for m, _, _ in GOLDEN], "message string")
    out = stages.rule_stage(stages.clean_stage(df), "cleaned_message").collect()
    assert [(r.message, r.cleaned_message, r.toxicity_score) for r in out] == GOLDEN


def test_rows_without_text_are_dropped(spark):
    df = spark.createDataFrame([(None,), ("",), ("   ",), ("@bob",), ("中文",), ("kept",)], "message string")
    assert [r.cleaned_message for r in stages.clean_stage(df).collect()] == ["kept"]
    strict = stages.clean_stage(df, emoji_ranges=values.EMOJI_RANGES_STRICT).collect()
    assert [r.cleaned_message for r in strict] == ["中文", "kept"]


def test_counted_words_and_scores(spark):
    df = spark.createDataFrame([(m,) for m, *_ in COUNTED], "message string")
    for row, expected in zip(stages.analyse(df).collect(), COUNTED):
        _, lexical, toxic, positive, score, flagged, mood, mood_score = expected
        assert row.lexical_score == pytest.approx(lexical)
        assert (row.toxic_word_count, row.positive_word_count) == (toxic, positive)
        assert (row.toxicity_score, row.is_toxic, row.sentiment) == (score, flagged, mood)
        assert row.sentiment_score == pytest.approx(mood_score)


def test_threshold_is_a_parameter(spark):
    df = spark.createDataFrame([("we hate rain in June",)], "message string")
    assert stages.analyse(df, threshold=0.25).first().label == "toxique"
    assert stages.analyse(df).first().label == "non_toxique"


def test_missing_feature_values(spark):
    """A malformed message passes the later hops with NULL fields, zero counts and neutral scores."""
    df = spark.createDataFrame([(None, None)], "original_message string, cleaned_message string")
    row = stages.score_stage(stages.feature_stage(df, "original_message")).first()
    assert (row.char_count, row.word_count, row.avg_word_length, row.lexical_score) == (0, 0, 0.0, 0.0)
    assert (row.toxicity_score, row.is_toxic, row.sentiment, row.sentiment_score) == (0.0, False, "neutral", 0.5)


def test_shouting_counts_on_the_text_as_written(spark):
    df = spark.createDataFrame([("YOU IDIOT",), ("you IDIOT x",)], "m string")
    assert [r.s for r in stages.rule_stage(df, "m", "s").collect()] == [0.35, 0.25]


def test_quick_scorers(spark):
    df = spark.createDataFrame(
        [("1", "p", "ann", "hello class of good people", "t"), ("2", "p", "bob", "nice day", "t")],
        "comment_id string, post_id string, user string, message string, created_time string")
    first, second = stages.quick_record(df).orderBy("comment_id").collect()
    # "ass" in class and "hell" in hello, 5 words
    assert first.toxicity_score == pytest.approx(0.8) and first.is_toxic and first.label == "toxique"
    assert (first.sentiment, second.sentiment, second.is_toxic) == ("positive", "positive", False)
    assert [r.toxicity_score for r in stages.minimal_record(df).orderBy("comment_id").collect()] == [0.8, 0.1]


def test_corpus_preparation(spark):
    samples = [
        ("He's goood, she said hahahaha w/e &amp; they've 2moro The man ASAP idgaf imho @bob",
         "good said hahaaha whatever tomorrow the man as soon as possible i do not give a fuck in my humble opinion"),
        ("don\x89Ûªt stop... 4gotten", "stop forgetten"),
        ("some1 youve it's", "someone"),
        ("!!! 123 a b", None),
    ]
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(samples)], "id int, comment_text string")
    found = {r.id: r.comment_text for r in corpus.prepare(df).collect()}
    assert found == {i: out for i, (_, out) in enumerate(samples) if out}


def test_abbreviation_table_is_a_parameter(spark):
    df = spark.createDataFrame([(["u", "BRB", "you"],)], "w array<string>")
    out = df.select(text.expand_abbreviations("w").alias("d"),
                    text.expand_abbreviations("w", [("u", "you all")]).alias("own")).first()
    assert (out.d, out.own) == ("you be right back you", "you all BRB you")


def test_abbreviations_of_raw_tokens(spark):
    """Golden rows, typed here and not taken from the table."""
    golden = {"w8": "wait", "GR8": "great", "u": "you", "b4": "before", "l8r": "later", "rt": "retweet", "$": " dollar ",
              "tl;dr": "too long i did not read", "ig": "ig", "w/": "with", "Encl.": "enclosed", "zzz": "sleeping bored and tired"}
    df = spark.createDataFrame([(w, [w]) for w in golden], "word string, w array<string>")
    found = {r.word: r.d for r in df.select("word", text.expand_abbreviations("w").alias("d")).collect()}
    assert found == golden
    assert len(values.ABBREVIATIONS) == len(dict(values.ABBREVIATIONS)) == 227


def python_clean(message: str) -> str:
    word, blank = r"\w", r"\s"
    out = message.lower()
    out = re.sub(r"http\S+|www\S+", "", out)
    out = re.sub(r"@\w+", "", out)
    out = re.sub("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in values.EMOJI_RANGES) + "]+", "", out)
    out = re.sub(rf"[^{word}{blank}.,!?']", " ", out)
    return re.sub(r"\s+", " ", out).strip()


LETTERS = st.sampled_from(list("abcdeIÉü5_ .,!?'@#:/\t\n  😀€中") + ["http", "www", "https://a.b", "@x", "die"])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(LETTERS, max_size=25).map("".join), min_size=20, max_size=40))
def test_clean_equals_plain_python_and_scores_stay_in_range(spark, messages):
    df = spark.createDataFrame(list(enumerate(messages)), "i int, message string")
    out = df.select("i", text.clean_text("message").alias("c"))
    found = {r.i: r.c for r in out.collect()}
    assert found == {i: python_clean(m) for i, m in enumerate(messages)}
    low, high, lex_low, lex_high = stages.analyse(df).agg(
        F.min("toxicity_score"), F.max("toxicity_score"), F.min("lexical_score"), F.max("lexical_score")).first()
    assert low is None or (0 <= low and high <= 1 and lex_low >= -1 and lex_high <= 1)


def test_sentiment_edges(spark):
    df = spark.createDataFrame([(0.05,), (-0.05,), (0.06,), (-1.0,), (1.0,), (None,)], "x double")
    out = df.select(scores.sentiment("x").alias("s"), scores.sentiment_score("x").alias("v")).collect()
    assert [(r.s, round(r.v, 4)) for r in out] == [
        ("neutral", 0.5), ("neutral", 0.5), ("negative", 0.44), ("positive", 0.9), ("negative", 0.1), ("neutral", 0.5)]


def test_a_filter_on_scores_does_not_clean_twice(spark):
    df = spark.createDataFrame([("a b",)], "message string").repartition(2)
    plan = stages.analyse(df).filter("is_toxic AND sentiment = 'negative'")._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("www") == 2  # the marker test and the pattern, once each


@pytest.mark.parametrize("tweet, expected", [
    ("@user hi :-) <3", ["hi", ":-)", "<3"]),
    ("see https://a.b/c?d=e, www.x.org now", ["see", "https://a.b/c?d=e,", "www.x.org", "now"]),
    ("Sooooo goooood!!!!!", ["Sooo", "goood", "!", "!", "!"]),
    ("#fun_day isn't well-known...", ["#fun_day", "isn't", "well-known", "..."]),
    ("mail me@x.example.org at 10:30 on 1/2/2024", ["mail", "me@x.example.org", "at", "10:30", "on", "1/2/2024"]),
    ("(: :P >:( ^", ["(:", ":P", ">:(", "^"]),
    ("caf\u00e9 \U0001f600\U0001f600 3rd", ["caf\u00e9", "\U0001f600", "\U0001f600", "3rd"]),
    ("@c", []),
    ("", []), (None, []),
])
def test_tweet_tokens(spark, tweet, expected):
    df = spark.createDataFrame([(tweet,)], "t string")
    assert df.select(text.tweet_tokens("t")).first()[0] == expected


def test_tweet_tokens_keep_handles_and_repeats_on_request(spark):
    df = spark.createDataFrame([("@you sooooo @me",)], "t string")
    assert df.select(text.tweet_tokens("t", strip_handles=False, shorten=False)).first()[0] == ["@you", "sooooo", "@me"]

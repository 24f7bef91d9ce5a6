"""Check SQL for the text and record queries."""

from __future__ import annotations

from oracle.fragments import (AS_OF, BLANK, WORD, counted, drop, found, lexical, listed, main_clean, quoted, rounded,
                              rule_score, with_cleaned, with_comments, with_features, with_scored)
from palaver import values

ISO = "strftime(created_time, '%Y-%m-%dT%H:%M:%S.%f')"


def hits(words) -> str:
    return " + ".join(f"CASE WHEN contains(lower(message), {quoted(w)}) THEN 1 ELSE 0 END" for w in words)


QUICK_CLEAN = f"trim({drop(drop(drop('lower(message)', f'http[^{BLANK}]+'), f'[^{WORD}{BLANK}]', ' '), f'[{BLANK}]+', ' ')}, ' ')"
MINIMAL_CLEAN = f"trim({drop(drop('lower(message)', f'[^{WORD}{BLANK}]', ' '), f'[{BLANK}]+', ' ')}, ' ')"
RAW_WORDS = found("message", f"[^{BLANK}]+")
LOWER_WORDS = found("lower(message)", f"[^{BLANK}]+")
MINIMAL_FLAG = "(" + " OR ".join(f"contains(lower(message), {quoted(w)})" for w in values.MINIMAL_TOXIC) + ")"

QUICK = f"""quick AS (
  SELECT *, {QUICK_CLEAN} AS cleaned_comment, len({RAW_WORDS}) AS word_count, length(message) AS char_count,
         ({hits(values.QUICK_TOXIC)}) / greatest(len({RAW_WORDS}), 1)::DOUBLE AS ratio,
         {hits(values.QUICK_POSITIVE)} AS pos, {hits(values.QUICK_NEGATIVE)} AS neg FROM comments),
quick_rows AS (
  SELECT post_id, comment_id, username, message AS comment, cleaned_comment, least(ratio * 2, 1.0) AS toxicity_score,
         CASE WHEN ratio > 0.1 THEN 'toxique' ELSE 'non_toxique' END AS label, ratio > 0.1 AS is_toxic,
         CASE WHEN pos > neg THEN 'positive' WHEN neg > pos THEN 'negative' ELSE 'neutral' END AS sentiment,
         CASE WHEN pos > neg THEN 0.7 WHEN neg > pos THEN 0.3 ELSE 0.5 END::DOUBLE AS sentiment_score,
         word_count, char_count, created_time FROM quick)"""

MINIMAL = f"""minimal_rows AS (
  SELECT post_id, comment_id, username, message AS comment, {MINIMAL_CLEAN} AS cleaned_comment,
         CASE WHEN {MINIMAL_FLAG} THEN 0.8 ELSE 0.1 END::DOUBLE AS toxicity_score,
         CASE WHEN {MINIMAL_FLAG} THEN 'toxique' ELSE 'non_toxique' END AS label, {MINIMAL_FLAG} AS is_toxic,
         CASE WHEN {MINIMAL_FLAG} THEN 'negative' ELSE 'neutral' END AS sentiment,
         CASE WHEN {MINIMAL_FLAG} THEN 0.2 ELSE 0.5 END::DOUBLE AS sentiment_score,
         len({RAW_WORDS}) AS word_count, length(message) AS char_count, created_time FROM comments)"""

RAISED = f"CASE WHEN {found('message', '[\\p{Lu}]')} <> [] AND message <> lower(message) AND " \
         "length(regexp_replace(message, '[^\\p{Lu}]+', '', 'g')) / length(message)::DOUBLE > 0.5 THEN 0.1 ELSE 0.0 END"

SQL = {
    "clean_text": with_cleaned("SELECT comment_id, cleaned_message FROM cleaned"),
    "clean_text_quick": with_comments(f"SELECT comment_id, {QUICK_CLEAN} AS cleaned_message FROM comments"),
    "clean_text_minimal": with_comments(f"SELECT comment_id, {MINIMAL_CLEAN} AS cleaned_message FROM comments"),
    "clean_switches": with_comments(
        "SELECT * FROM (SELECT comment_id, "
        f"{main_clean('message', values.EMOJI_RANGES_STRICT, True, True)} AS cleaned_message FROM comments) "
        "WHERE length(cleaned_message) > 0"),
    "raw_record_shape": with_comments(f"""
        SELECT 'facebook' AS source, post_id, comment_id,
               CASE WHEN doc_id % 5 <> 0 THEN username ELSE 'Unknown' END AS "user", message,
               {ISO} AS created_time,
               CASE WHEN doc_id % 3 <> 0 THEN CAST(doc_id % 50 AS INTEGER) ELSE 0 END AS like_count,
               CASE WHEN doc_id % 3 <> 0 AND doc_id % 50 > 25 THEN 'data.cleaned.stream'
                    WHEN doc_id % 3 <> 0 AND doc_id % 50 > 10 THEN 'data.labels.stream'
                    ELSE 'data.raw.stream' END AS topic
        FROM comments WHERE doc_id % 7 <> 0 AND message <> ''"""),
    "json_envelope_roundtrip": with_comments(
        f"""SELECT comment_id AS comment_id_key, 'facebook' AS source, post_id, comment_id, username AS "user", message,
        {ISO} || 'Z' AS created_time FROM comments"""),
    "text_features": with_features(f"""
        SELECT comment_id, CAST(char_count AS INTEGER) AS char_count, CAST(word_count AS INTEGER) AS word_count,
               {rounded('avg_word_length', 6)} AS avg_word_length, {rounded('lexical_score', 6)} AS lexical_score,
               CAST(toxic_word_count AS INTEGER) AS toxic_word_count,
               CAST(positive_word_count AS INTEGER) AS positive_word_count,
               {rounded('uppercase_ratio', 6)} AS uppercase_ratio FROM features"""),
    "text_features_full": with_comments(f"""
        , tokenised AS (SELECT *, {LOWER_WORDS} AS words FROM comments),
        counts AS (SELECT *, {counted('words', values.TOXIC_WORDS)} AS toxic,
                          {counted('words', values.POSITIVE_WORDS)} AS positive, len(words) AS n FROM tokenised)
        SELECT comment_id, CAST(length(message) AS INTEGER) AS char_count, CAST(n AS INTEGER) AS word_count,
               {rounded("CASE WHEN n > 0 THEN length(array_to_string(words, '')) / n::DOUBLE ELSE 0.0 END", 2)}
                 AS avg_word_length,
               {rounded("CASE WHEN length(message) > 0 THEN length(regexp_replace(message, '[^.,!?;:\"'']', '', 'g')) "
                        "/ length(message)::DOUBLE ELSE 0.0 END", 4)} AS punctuation_ratio,
               {rounded("CASE WHEN length(message) > 0 THEN length(regexp_replace(message, '[^\\p{Lu}]+', '', 'g')) "
                        "/ length(message)::DOUBLE ELSE 0.0 END", 4)} AS uppercase_ratio,
               CAST(toxic AS INTEGER) AS toxic_word_count, CAST(positive AS INTEGER) AS positive_word_count,
               CAST(length(message) - length(replace(message, '!', '')) AS INTEGER) AS exclamation_count,
               CAST(length(message) - length(replace(message, '?', '')) AS INTEGER) AS question_count,
               {rounded(lexical('toxic', 'positive', 'n'), 4)} AS lexical_score FROM counts"""),
    "toxicity_rules": with_cleaned(f"""
        , tokenised AS (SELECT *, string_split(cleaned_message, ' ') AS words, {LOWER_WORDS} AS raw_words FROM cleaned)
        SELECT comment_id, {rule_score('cleaned_message', 'words')} AS toxicity_score,
               {rule_score('message', 'raw_words', RAISED)} AS raw_toxicity_score FROM tokenised"""),
    "score_comments": with_scored(f"""
        SELECT post_id, comment_id, username, comment, cleaned_comment, toxicity_score, label, is_toxic, sentiment,
               {rounded('sentiment_score', 6)} AS sentiment_score, CAST(word_count AS INTEGER) AS word_count,
               CAST(char_count AS INTEGER) AS char_count, created_time, {AS_OF} AS ingestion_time FROM scored"""),
    "toxicity_quick": with_comments(f""", {QUICK}
        SELECT comment_id, cleaned_comment, {rounded('toxicity_score', 6)} AS toxicity_score, label, is_toxic,
               CAST(word_count AS INTEGER) AS word_count, CAST(char_count AS INTEGER) AS char_count FROM quick_rows"""),
    "sentiment_quick": with_comments(f", {QUICK} SELECT comment_id, sentiment, sentiment_score FROM quick_rows"),
    "flag_minimal": with_comments(f""", {MINIMAL}
        SELECT comment_id, cleaned_comment, toxicity_score, label, is_toxic, sentiment, sentiment_score,
               CAST(word_count AS INTEGER) AS word_count, CAST(char_count AS INTEGER) AS char_count FROM minimal_rows"""),
    "write_time_labels": with_scored(f"""
        SELECT comment_id, toxicity_score,
               CASE WHEN toxicity_score >= 0.5 THEN 'toxique' ELSE 'non_toxique' END AS label,
               toxicity_score >= 0.5 AS is_toxic,
               CASE WHEN doc_id % 3 = 2 THEN sentiment WHEN sentiment_score >= 0.6 THEN 'positive'
                    WHEN sentiment_score <= 0.4 THEN 'negative' ELSE 'neutral' END AS sentiment,
               {rounded('sentiment_score', 6)} AS sentiment_score, toxicity_score >= 0.5 AS requires_review
        FROM scored"""),
    "validate_rows": with_scored(f"""
        , damaged AS (SELECT comment_id, CASE WHEN doc_id % 13 = 0 THEN NULL ELSE post_id END AS post_id,
            toxicity_score * 2 AS toxicity_score, CASE WHEN doc_id % 11 = 0 THEN lang ELSE label END AS label,
            CASE WHEN doc_id % 17 = 0 THEN 'mixed' ELSE sentiment END AS sentiment,
            CASE WHEN doc_id % 5 = 0 THEN NULL ELSE sentiment_score - 0.2 END AS sentiment_score FROM scored),
        named AS (SELECT comment_id, concat_ws(',',
            CASE WHEN label NOT IN {listed(values.LABELS)} THEN 'label_domain' END,
            CASE WHEN post_id IS NULL THEN 'post_id_not_null' END,
            CASE WHEN sentiment NOT IN {listed(values.SENTIMENTS)} THEN 'sentiment_domain' END,
            CASE WHEN sentiment_score < 0 OR sentiment_score > 1 THEN 'sentiment_score_range' END,
            CASE WHEN toxicity_score < 0 OR toxicity_score > 1 THEN 'toxicity_score_range' END) AS reasons FROM damaged)
        SELECT * FROM named WHERE reasons <> ''"""),
    "validate_keys": """SELECT md5(text) AS content_key, COUNT(*) AS copies FROM documents
        GROUP BY 1 HAVING COUNT(*) > 1""",
    "fill_defaults": with_comments("""
        SELECT post_id, comment_id, CASE WHEN doc_id % 4 <> 0 THEN username END AS username, message AS comment,
               CAST(NULL AS VARCHAR) AS cleaned_comment, 0.0::DOUBLE AS toxicity_score,
               0.0::DOUBLE AS severe_toxic_score, 0.0::DOUBLE AS obscene_score, 0.0::DOUBLE AS threat_score,
               0.0::DOUBLE AS insult_score, 0.0::DOUBLE AS identity_hate_score, 'non_toxique' AS label,
               FALSE AS is_toxic, 'neutral' AS sentiment, 0.5::DOUBLE AS sentiment_score, 0 AS word_count,
               0 AS char_count, CAST(NULL AS VARCHAR) AS keywords, created_time, ingestion_time, FALSE AS requires_review, TRUE AS is_processed
        FROM comments"""),
    "fill_nulls": with_comments("""
        SELECT comment_id, CASE WHEN doc_id % 4 <> 0 THEN username ELSE 'Unknown' END AS username,
               CASE WHEN doc_id % 3 <> 0 THEN 0.25 ELSE 0.0 END::DOUBLE AS toxicity_score,
               CASE WHEN doc_id % 2 <> 0 THEN 'positive' ELSE 'neutral' END AS sentiment FROM comments"""),
}

"""Check SQL for the streaming queries: each is compared with its batch meaning."""

from __future__ import annotations

from oracle.fragments import AS_OF, rounded, tally, with_cleaned, with_scored
from oracle.reports import KEYWORDS, NEGATIVE, NEUTRAL, POSITIVE, TRENDING

SENTIMENT_SCORE = f"{rounded('sentiment_score', 6)} AS sentiment_score"


def windows(placed: str, hours: int) -> str:
    """Statistics of windows; ``placed`` has each row once per window, with the window's start."""
    return f"""
        SELECT CAST(start AS TIMESTAMP) AS period_start, CAST(start + INTERVAL {hours} HOUR AS TIMESTAMP) AS period_end,
               COUNT(*) AS total_comments, {tally('is_toxic')} AS toxic_count, {tally('NOT is_toxic')} AS non_toxic_count,
               {tally(POSITIVE)} AS positive_count, {tally(NEGATIVE)} AS negative_count, {tally(NEUTRAL)} AS neutral_count,
               {rounded('AVG(toxicity_score)', 6)} AS avg_toxicity_score,
               {rounded('AVG(sentiment_score)', 6)} AS avg_sentiment_score
        FROM ({placed}) GROUP BY start"""


SQL = {
    "stream_clean": with_cleaned("SELECT comment_id, cleaned_message FROM cleaned"),
    "stream_hops": with_scored(f"SELECT comment_id, toxicity_score, label, is_toxic, sentiment, {SENTIMENT_SCORE} FROM scored"),
    "stream_score_upsert": with_scored(f"""
        SELECT post_id, comment_id, username, comment, cleaned_comment, toxicity_score, label, is_toxic, sentiment,
               {SENTIMENT_SCORE}, CAST(word_count AS INTEGER) AS word_count, CAST(char_count AS INTEGER) AS char_count,
               created_time, ingestion_time FROM scored"""),
    "stream_fan_out": with_scored("""
        SELECT comment_id AS key, '{"comment_id":"' || comment_id || '","label":"' || label || '","is_toxic":'
               || CASE WHEN is_toxic THEN 'true' ELSE 'false' END || '}' AS value FROM scored"""),
    "stream_window_stats": with_scored(windows("SELECT *, date_trunc('hour', ingestion_time) AS start FROM scored", 1)),
    "stream_sliding_stats": with_scored(windows("""
        SELECT *, date_trunc('hour', ingestion_time) AS start FROM scored UNION ALL
        SELECT *, date_trunc('hour', ingestion_time) - INTERVAL 1 HOUR AS start FROM scored""", 2)),
    "stream_dedup": "SELECT DISTINCT md5(text) AS content_key FROM documents",
    "stream_label_join": with_scored("""
        SELECT comment_id, toxicity_score, is_toxic, l.toxic FROM scored JOIN labels l ON l.doc_id = scored.doc_id"""),
    "stream_label_outcomes": with_scored(f"""
        SELECT comment_id, toxicity_score, is_toxic, CAST(l.toxic AS INTEGER) AS toxic,
               CASE WHEN l.doc_id IS NOT NULL THEN CASE WHEN l.doc_id % 4 = 3 THEN 'late' ELSE 'matched' END
                    WHEN {AS_OF} > ingestion_time + INTERVAL 1 HOUR THEN 'timed_out' ELSE 'waiting' END AS outcome
        FROM scored LEFT JOIN labels l ON l.doc_id = scored.doc_id"""),
    "stream_trending": with_scored(TRENDING, KEYWORDS),
    "stream_drain": """SELECT 'c' || CAST(doc_id AS VARCHAR) AS comment_id, source AS post_id,
        CAST(length(text) AS INTEGER) AS char_count FROM documents""",
}
SQL["stream_fold"] = SQL["stream_score_upsert"]
SQL["stream_dedup_table"] = SQL["stream_dedup"]

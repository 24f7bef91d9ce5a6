"""Check SQL for the queries over the result table."""

from __future__ import annotations

from oracle.fragments import (AS_OF, WORD, found, listed, rounded, share, tally, with_cleaned, with_comments,
                              with_scored)
from oracle.stemming import stem_tables
from oracle.texts import MINIMAL, QUICK
from palaver import values

POSITIVE, NEGATIVE, NEUTRAL = (f"sentiment = '{s}'" for s in values.SENTIMENTS)



def last(span: str) -> str:
    return f"ingestion_time >= {AS_OF} - INTERVAL {span} AND ingestion_time <= {AS_OF}"


STATISTICS = f"""COUNT(*) AS total_comments, {tally('is_toxic')} AS toxic_count, {tally('NOT is_toxic')} AS non_toxic_count,
  {tally(POSITIVE)} AS positive_count, {tally(NEGATIVE)} AS negative_count, {tally(NEUTRAL)} AS neutral_count,
  COALESCE({rounded('AVG(toxicity_score)', 6)}, 0) AS avg_toxicity_score,
  COALESCE({rounded('AVG(sentiment_score)', 6)}, 0.5) AS avg_sentiment_score,
  COALESCE({rounded(share('is_toxic'), 6)}, 0) AS toxic_percentage,
  COALESCE({rounded(share(POSITIVE), 6)}, 0) AS positive_percentage,
  COALESCE({rounded(share(NEGATIVE), 6)}, 0) AS negative_percentage"""

PERIOD = {
    "hourly": ("date_trunc('hour', ingestion_time)", "INTERVAL 1 HOUR"),
    "daily": ("date_trunc('day', ingestion_time)", "INTERVAL 1 DAY"),
    "weekly": ("date_trunc('week', ingestion_time)", "INTERVAL 7 DAY"),
}


def period(kind: str, label: str | None = None) -> str:
    start, length = PERIOD[kind]
    return (f"SELECT CAST({start} AS TIMESTAMP) AS period_start, {STATISTICS}, "
            f"CAST({start} + {length} AS TIMESTAMP) AS timestamp, CAST({start} + {length} AS TIMESTAMP) AS period_end, "
            f"'{label or kind}' AS period_type FROM scored GROUP BY {start}")


EDGE = "[.,!?'']"
KEYWORDS = f"""word_rows AS (
  SELECT comment_id, regexp_replace(regexp_replace(w, '^{EDGE}+', ''), '{EDGE}+$', '') AS word
  FROM (SELECT comment_id, unnest(string_split(cleaned_message, ' ')) AS w FROM cleaned)),
word_counts AS (
  SELECT comment_id, word, COUNT(*) AS n FROM word_rows
  WHERE length(word) >= 3 AND word NOT IN {listed(values.STOPWORDS)} GROUP BY 1, 2),
keyword_rows AS (
  SELECT comment_id, word, n, row_number() OVER (PARTITION BY comment_id ORDER BY n DESC, word) AS r FROM word_counts
  QUALIFY r <= 10)"""

TRENDING = """SELECT word AS keyword, COUNT(*) AS count, {0} AS sentiment_avg, {1} AS toxicity_avg,
  MAX(ingestion_time) AS last_updated, MIN(ingestion_time) AS first_seen
  FROM keyword_rows JOIN scored USING (comment_id) GROUP BY word""".format(
    rounded("AVG(sentiment_score)", 6), rounded("AVG(toxicity_score)", 6))

TERMS = f"list_filter({found('lower(message)', f'[{WORD}]+')}, lambda w: w NOT IN {listed(values.STOPWORDS)})"
WANTED = "list_has_any(terms, ['kill', 'die', 'thon']) AND NOT list_contains(terms, 'pour')"

#: Words with their places, without stopwords, and their stems.
STEMMED = f"""WITH t AS (SELECT 'c' || CAST(doc_id AS VARCHAR) AS comment_id, source AS post_id, text AS message FROM documents),
        kept AS MATERIALIZED (SELECT comment_id, w, i FROM (SELECT comment_id, unnest(ws) AS w, unnest(range(len(ws))) AS i
            FROM (SELECT comment_id, {found('lower(message)', f'[{WORD}]+')} AS ws FROM t)) WHERE w NOT IN {listed(values.STOPWORDS)}),
        terms AS (SELECT DISTINCT w AS term FROM kept),
        {stem_tables('terms')},
        s AS MATERIALIZED (SELECT comment_id, i, stem FROM kept JOIN stems ON term = w),
        hits AS (SELECT a.comment_id FROM s a JOIN s b ON a.comment_id = b.comment_id AND b.i = a.i + 3 AND b.stem = 'apach'
                 JOIN s c ON a.comment_id = c.comment_id AND c.i = a.i + 4 AND c.stem = 'licens' WHERE a.stem = 'licens'
            UNION SELECT a.comment_id FROM s a JOIN s b ON a.comment_id = b.comment_id AND b.i = a.i + 1 AND b.stem = 'licens' WHERE a.stem = 'mit'
            UNION SELECT comment_id FROM s WHERE stem = 'work' OR starts_with(stem, 'kill')
            EXCEPT SELECT comment_id FROM s WHERE stem = 'gnu')"""

LIST_ORDER = "ORDER BY ingestion_time DESC, comment_id"
FILTERED = f"""SELECT comment_id, username, comment, label, {rounded('toxicity_score', 3)} AS toxicity_score, sentiment,
  {rounded('sentiment_score', 3)} AS sentiment_score, is_toxic, created_time, ingestion_time FROM scored"""

MERGED = f"""SELECT comment_id, username, cleaned_comment, {rounded('toxicity_score', 6)} AS toxicity_score, label, is_toxic,
  sentiment, {rounded('sentiment_score', 6)} AS sentiment_score, CAST(word_count AS INTEGER) AS word_count,
  created_time, ingestion_time"""

STORED = f"""stored AS (SELECT * FROM scored WHERE ingestion_time < {AS_OF})"""

OLD_STATISTICS = f"""old AS (
  SELECT * REPLACE (CASE WHEN total_comments = 1 THEN NULL ELSE timestamp END AS timestamp) FROM ({period('hourly', 'realtime')})
  UNION ALL BY NAME {period('daily')})"""
EXPIRED = "(timestamp < TIMESTAMP '2024-01-14 00:00:00' - INTERVAL 5 DAY AND period_type = 'realtime')"

SQL = {
    "global_statistics": with_scored(f"""
        SELECT COUNT(*) AS total, COALESCE({tally('is_toxic')}, 0) AS toxic, COALESCE({tally('NOT is_toxic')}, 0) AS non_toxic,
               COALESCE({tally(POSITIVE)}, 0) AS positive, COALESCE({tally(NEGATIVE)}, 0) AS negative,
               COALESCE({tally(NEUTRAL)}, 0) AS neutral,
               COALESCE({rounded('AVG(sentiment_score)', 3)}, 0.5) AS avg_sentiment,
               COALESCE({rounded('AVG(toxicity_score)', 3)}, 0) AS avg_toxicity FROM scored"""),
    "kpi_percentages": with_scored(f"""
        SELECT COUNT(*) AS total, COALESCE({rounded(share('is_toxic'), 4)}, 0) AS toxic_pct,
               COALESCE({rounded(share(POSITIVE), 4)}, 0) AS positive_pct,
               COALESCE({rounded(share(NEGATIVE), 4)}, 0) AS negative_pct,
               COALESCE({rounded('AVG(sentiment_score)', 3)}, 0.5) AS avg_sentiment FROM scored"""),
    "daily_summary": with_scored(f"""
        SELECT CAST(created_time AS DATE) AS date, COUNT(*) AS total_comments, {tally('is_toxic')} AS toxic_count,
               {tally('NOT is_toxic')} AS non_toxic_count, {tally(POSITIVE)} AS positive_count,
               {tally(NEGATIVE)} AS negative_count, {tally(NEUTRAL)} AS neutral_count,
               {rounded('AVG(toxicity_score)', 4)} AS avg_toxicity, {rounded('AVG(sentiment_score)', 4)} AS avg_sentiment,
               {rounded(share('is_toxic'), 2)} AS toxic_percentage
        FROM scored WHERE created_time IS NOT NULL GROUP BY 1 ORDER BY 1 DESC"""),
    "daily_summary_ingested": with_scored(f"""
        SELECT CAST(ingestion_time AS DATE) AS date, COUNT(*) AS total_comments, {tally('is_toxic')} AS toxic_comments,
               {tally(POSITIVE)} AS positive, {tally(NEGATIVE)} AS negative, {tally(NEUTRAL)} AS neutral,
               {rounded('AVG(toxicity_score)', 4)} AS avg_toxicity FROM scored GROUP BY 1 ORDER BY 1 DESC"""),
    "daily_summary_recent": with_scored(f"""
        SELECT CAST(ingestion_time AS DATE) AS date, COUNT(*) AS total_comments, {tally('is_toxic')} AS toxic_count,
               {tally(POSITIVE)} AS positive_count, {tally(NEGATIVE)} AS negative_count,
               {rounded('AVG(toxicity_score)', 3)} AS avg_toxicity, {rounded('AVG(sentiment_score)', 3)} AS avg_sentiment
        FROM scored WHERE {last('7 DAY')} GROUP BY 1 ORDER BY 1 DESC"""),
    "stored_results": with_scored("""SELECT comment_id, CAST(ingestion_time AS DATE) AS ingestion_day, toxicity_score, label, sentiment,
        ingestion_time FROM scored"""),
    "recent_export": with_scored(
        f"{FILTERED} WHERE sentiment IN ('negative', 'neutral') AND is_toxic {LIST_ORDER} LIMIT 50"),
    "hourly_activity": with_scored(f"""
        SELECT CAST(date_trunc('hour', ingestion_time) AS TIMESTAMP) AS hour, COUNT(*) AS comment_count,
               {tally('is_toxic')} AS toxic_count, {rounded('AVG(toxicity_score)', 4)} AS avg_toxicity,
               {rounded('AVG(sentiment_score)', 4)} AS avg_sentiment
        FROM scored WHERE {last('24 HOUR')} GROUP BY 1 ORDER BY 1 DESC"""),
    **{name: with_scored(f"""
        SELECT CAST(date_trunc('hour', ingestion_time) AS TIMESTAMP) AS hour, COUNT(*) AS total_count,
               {tally('is_toxic')} AS toxic_count, {tally(POSITIVE)} AS positive_count, {tally(NEGATIVE)} AS negative_count
        FROM scored WHERE {last(span)} GROUP BY 1 ORDER BY 1""")
       for name, span in (("timeline_days", "7 DAY"), ("timeline_hours", "48 HOUR"))},
    "top_users": with_scored(f"""
        SELECT username, COUNT(*) AS comment_count, {tally('is_toxic')} AS toxic_count,
               {rounded(share('is_toxic'), 2)} AS toxic_percentage, {rounded('AVG(sentiment_score)', 4)} AS avg_sentiment,
               MAX(ingestion_time) AS last_comment
        FROM scored WHERE username IS NOT NULL AND username <> 'Unknown'
        GROUP BY username ORDER BY comment_count DESC, username LIMIT 50"""),
    "top_users_short": with_scored(f"""
        SELECT username, COUNT(*) AS comment_count, {tally('is_toxic')} AS toxic_count,
               {rounded('AVG(sentiment_score)', 3)} AS avg_sentiment
        FROM scored WHERE username IS NOT NULL AND username <> 'Unknown'
        GROUP BY username ORDER BY comment_count DESC, username LIMIT 10"""),
    "toxicity_histogram": with_scored("""
        SELECT CASE WHEN toxicity_score < 0.2 THEN '0-20%' WHEN toxicity_score < 0.4 THEN '20-40%'
                    WHEN toxicity_score < 0.6 THEN '40-60%' WHEN toxicity_score < 0.8 THEN '60-80%'
                    ELSE '80-100%' END AS range, COUNT(*) AS count FROM scored GROUP BY 1 ORDER BY 1"""),
    "sentiment_distribution": with_scored("SELECT sentiment, COUNT(*) AS count FROM scored GROUP BY sentiment"),
    "realtime_stats": with_scored(f"""
        SELECT {AS_OF} AS timestamp, {STATISTICS}, CAST({AS_OF} - INTERVAL 60 MINUTE AS TIMESTAMP) AS period_start,
               {AS_OF} AS period_end, 'realtime' AS period_type FROM scored WHERE {last('60 MINUTE')}"""),
    **{f"period_stats_{kind}": with_scored(period(kind)) for kind in PERIOD},
    "latest_statistics": with_scored(f"SELECT * FROM ({period('daily')}) ORDER BY timestamp DESC LIMIT 1"),
    "comment_keywords": with_cleaned(f""", {KEYWORDS}
        SELECT c.comment_id, COALESCE(string_agg(k.word, ' ' ORDER BY k.r), '') AS keywords
        FROM cleaned c LEFT JOIN keyword_rows k USING (comment_id) GROUP BY 1"""),
    "trending_keywords": with_scored(TRENDING, KEYWORDS),
    "trending_keywords_incremental": with_scored(TRENDING, KEYWORDS),
    "top_keywords": with_scored(
        f"SELECT keyword, count FROM ({TRENDING}) ORDER BY count DESC, keyword LIMIT 20", KEYWORDS),
    "keyword_search": f"""WITH t AS (SELECT 'c' || CAST(doc_id AS VARCHAR) AS comment_id, source AS post_id,
        text AS message FROM documents), s AS (SELECT *, {TERMS} AS terms FROM t)
        SELECT comment_id, post_id, message FROM s WHERE {WANTED}""",
    "posting_table": f"""WITH t AS (SELECT 'c' || CAST(doc_id AS VARCHAR) AS comment_id, text AS message FROM documents)
        SELECT DISTINCT unnest({TERMS}) AS term, comment_id FROM t""",
    "keyword_search_postings": f"""WITH t AS (SELECT 'c' || CAST(doc_id AS VARCHAR) AS comment_id, text AS message
        FROM documents), s AS (SELECT *, {TERMS} AS terms FROM t) SELECT comment_id FROM s WHERE {WANTED}""",
    "text_stems": f"{STEMMED} SELECT term, stem FROM stems",
    "stemmed_search": f"{STEMMED} SELECT comment_id, post_id, message FROM t JOIN hits USING (comment_id)",
    "stemmed_search_index": f"{STEMMED} SELECT comment_id FROM hits",
    "recent_comments": with_scored(f"""
        SELECT comment_id, post_id, username, left(comment, 100) AS comment_preview, label,
               {rounded('toxicity_score', 4)} AS toxicity_score, sentiment, {rounded('sentiment_score', 4)} AS sentiment_score,
               created_time, ingestion_time FROM scored {LIST_ORDER} LIMIT 100"""),
    "recent_comments_filtered": with_scored(
        f"{FILTERED} WHERE sentiment IN ('negative', 'neutral') AND is_toxic {LIST_ORDER} LIMIT 50"),
    "recent_toxic": with_scored(f"""SELECT comment_id, username, comment, toxicity_score, sentiment, ingestion_time
        FROM scored WHERE is_toxic {LIST_ORDER} LIMIT 20"""),
    "page_slice": """SELECT doc_id, 'c' || CAST(doc_id AS VARCHAR) AS comment_id, text AS message FROM documents
        ORDER BY doc_id LIMIT 10 OFFSET 50""",
    "display_projection": with_scored(f"""
        SELECT username AS "Utilisateur", comment AS "Commentaire", label AS "Label", toxicity_score AS "Score Toxicité",
               sentiment AS "Sentiment", sentiment_score AS "Score Sentiment", ingestion_time AS "Date"
        FROM ({FILTERED} {LIST_ORDER} LIMIT 50)"""),
    "dedup_first_seen": with_comments("""
        SELECT message, comment_id, ingestion_time, doc_id FROM comments
        QUALIFY row_number() OVER (PARTITION BY message ORDER BY ingestion_time, doc_id) = 1"""),
    "union_pages": with_comments("""
        SELECT message, username, post_id, comment_id FROM comments UNION ALL
        SELECT text, role, 'conversation_' || CAST(conv_id AS VARCHAR),
               't_' || CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) FROM conversations"""),
    "upsert_results": with_scored(f"""
        , versions AS (
          SELECT comment_id, toxicity_score, label, is_toxic, sentiment, sentiment_score,
                 created_time + INTERVAL 2 HOUR AS ingestion_time FROM minimal_rows),
        firsts AS (SELECT * FROM stored UNION ALL BY NAME
                   SELECT comment_id, username, cleaned_comment, word_count, created_time FROM quick_rows
                   WHERE comment_id NOT IN (SELECT comment_id FROM stored))
        {MERGED} FROM (
          SELECT f.comment_id, f.username, f.cleaned_comment, f.word_count, f.created_time, v.toxicity_score, v.label,
                 v.is_toxic, v.sentiment, v.sentiment_score, v.ingestion_time
          FROM firsts f JOIN versions v USING (comment_id))""", QUICK, MINIMAL, STORED),
    "upsert_scores_only": with_scored(f"""
        {MERGED} FROM (
          SELECT m.comment_id, m.username, COALESCE(s.cleaned_comment, m.cleaned_comment) AS cleaned_comment,
                 COALESCE(s.word_count, m.word_count) AS word_count, m.created_time, m.toxicity_score,
                 COALESCE(s.label, m.label) AS label, COALESCE(s.is_toxic, m.is_toxic) AS is_toxic,
                 COALESCE(s.sentiment, m.sentiment) AS sentiment,
                 COALESCE(s.sentiment_score, m.sentiment_score) AS sentiment_score,
                 m.created_time + INTERVAL 2 HOUR AS ingestion_time
          FROM minimal_rows m LEFT JOIN stored s USING (comment_id))""", MINIMAL, STORED),
    "statistics_table": with_scored(" UNION ALL BY NAME ".join([f"""(
        SELECT TIMESTAMP '{at}' AS timestamp, {STATISTICS}, CAST(TIMESTAMP '{at}' - INTERVAL 5 MINUTE AS TIMESTAMP) AS period_start,
               TIMESTAMP '{at}' AS period_end, 'realtime' AS period_type FROM scored
        WHERE ingestion_time BETWEEN TIMESTAMP '{at}' - INTERVAL 5 MINUTE AND TIMESTAMP '{at}')"""
        for at in ("2024-01-05 06:00:00", "2024-01-08 12:30:00", "2024-01-10 00:00:00")] + [f"({period('daily')})"])),
    "collector_metrics": f"""WITH rows AS (
          SELECT md5(text) AS k, CASE WHEN doc_id % 7 <> 0 AND text <> '' THEN 1 ELSE 0 END AS usable FROM documents),
        per_key AS (SELECT k, COUNT(*) AS n, SUM(usable) AS u FROM rows GROUP BY k)
        SELECT unnest(['total_fetched', 'total_sent', 'duplicates_skipped', 'errors', 'runtime_seconds']) AS metric_name,
               unnest([SUM(n)::DOUBLE, SUM(least(u, 1))::DOUBLE, SUM(greatest(u - 1, 0))::DOUBLE, 0.0, 1.0]) AS metric_value,
               {AS_OF} AS recorded_at FROM per_key""",
    "retention_cleanup": with_scored(f"""SELECT timestamp, total_comments, toxic_count, period_start, period_type FROM old
        WHERE NOT COALESCE({EXPIRED}, FALSE)""", OLD_STATISTICS),
    "retention_deleted": with_scored(
        f"SELECT COUNT(*) FILTER (WHERE COALESCE({EXPIRED}, FALSE)) AS deleted_count FROM old", OLD_STATISTICS),
    "run_counters": f"""WITH rows AS (
          SELECT md5(text) AS k, CASE WHEN doc_id % 7 <> 0 AND text <> '' THEN 1 ELSE 0 END AS usable FROM documents),
        per_key AS (SELECT k, COUNT(*) AS n, SUM(usable) AS u FROM rows GROUP BY k)
        SELECT 'total_fetched' AS metric_name, SUM(n)::DOUBLE AS metric_value, {AS_OF} AS recorded_at FROM per_key
        UNION ALL SELECT 'total_sent', SUM(least(u, 1))::DOUBLE, {AS_OF} FROM per_key
        UNION ALL SELECT 'duplicates_skipped', SUM(greatest(u - 1, 0))::DOUBLE, {AS_OF} FROM per_key""",
}
SQL["upsert_keyed_table"] = SQL["upsert_results"]

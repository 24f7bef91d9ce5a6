"""Common parts of the check SQL: the comments view, cleaned texts, features and scores."""

from __future__ import annotations

from palaver import values

WORD = r"\p{L}\p{N}_"
BLANK = r"\x09-\x0d\x1c-\x20\x{85}\p{Z}"
AS_OF = "TIMESTAMP '2024-01-10 00:00:00'"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(words) -> str:
    return "(" + ", ".join(quoted(w) for w in words) + ")"


def rounded(expression: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def drop(expression: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({expression}, {quoted(pattern)}, {quoted(by)}, 'g')"


def found(expression: str, pattern: str) -> str:
    return f"regexp_extract_all({expression}, {quoted(pattern)})"


def counted(words: str, lexicon) -> str:
    return f"len(list_filter({words}, lambda w: w IN {listed(lexicon)}))"


def ranges(pairs) -> str:
    return "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in pairs) + "]+"


def main_clean(expression: str, emoji=values.EMOJI_RANGES, hashtags=False, numbers=False) -> str:
    """One step after the other, special characters and blanks in two steps."""
    out = drop(f"lower({expression})", rf"(?:http|www)[^{BLANK}]+")
    out = drop(out, rf"@[{WORD}]+")
    if hashtags:
        out = drop(out, rf"#[{WORD}]+")
    if numbers:
        out = drop(out, r"\p{Nd}+")
    out = drop(out, ranges(emoji))
    out = drop(out, rf"[^{WORD}{BLANK}.,!?']", " ")
    return f"trim({drop(out, f'[{BLANK}]+', ' ')}, ' ')"


COMMENTS = """comments AS (
  SELECT d.source AS post_id, 'c' || CAST(d.doc_id AS VARCHAR) AS comment_id,
         'user_' || CAST(e.user_id AS VARCHAR) AS username, d.text AS message,
         e.ts AS created_time, e.ts AS ingestion_time, d.doc_id, d.lang
  FROM documents d JOIN events e ON e.event_id = d.doc_id * 5)"""

CLEANED = f"""cleaned AS (
  SELECT * FROM (SELECT *, {main_clean('message')} AS cleaned_message FROM comments) WHERE length(cleaned_message) > 0)"""

UPPER = "length(regexp_replace(message, '[^\\p{Lu}]+', '', 'g'))"


def lexical(toxic: str, positive: str, words: str) -> str:
    return f"CASE WHEN {words} > 0 THEN greatest(-1.0, least(1.0, ({toxic} * 2 - {positive}) / {words}::DOUBLE)) ELSE 0.0 END"


FEATURES = f"""tokenised AS (
  SELECT *, string_split(cleaned_message, ' ') AS words, {found('lower(message)', f'[^{BLANK}]+')} AS raw_words FROM cleaned),
features AS (
  SELECT *, length(cleaned_message) AS char_count, len(words) AS word_count,
         (length(cleaned_message) - len(words) + 1) / len(words)::DOUBLE AS avg_word_length,
         {lexical(counted('raw_words', values.TOXIC_WORDS), counted('raw_words', values.POSITIVE_WORDS), 'len(raw_words)')}
           AS lexical_score,
         {counted('words', values.TOXIC_WORDS)} AS toxic_word_count,
         {counted('words', values.POSITIVE_WORDS)} AS positive_word_count,
         {UPPER} / length(message)::DOUBLE AS uppercase_ratio
  FROM tokenised)"""


def rule_score(text: str, words: str, upper: str = "0.0") -> str:
    base = (f"least({counted(words, values.SEVERE_WORDS)} * 0.5 + {counted(words, values.MODERATE_WORDS)} * 0.25, 0.95)"
            f" + {upper} + CASE WHEN length({text}) - length(replace({text}, '!', '')) > 2 THEN 0.05 ELSE 0.0 END")
    return f"least({rounded(base, 4)}, 1.0::DOUBLE)"


SCORED = f"""rated AS (
  SELECT *, {rule_score('cleaned_message', 'words')} AS toxicity_score FROM features),
scored AS (
  SELECT *, CASE WHEN toxicity_score >= 0.5 THEN 'toxique' ELSE 'non_toxique' END AS label,
         toxicity_score >= 0.5 AS is_toxic,
         CASE WHEN lexical_score > 0.05 THEN 'negative' WHEN lexical_score < -0.05 THEN 'positive'
              ELSE 'neutral' END AS sentiment,
         CASE WHEN lexical_score > 0.05 THEN greatest(0.1, 0.5 - lexical_score)
              WHEN lexical_score < -0.05 THEN least(0.9, 0.5 + abs(lexical_score)) ELSE 0.5 END AS sentiment_score,
         message AS comment, cleaned_message AS cleaned_comment
  FROM rated)"""


def with_comments(body: str) -> str:
    return f"WITH {COMMENTS} {body}"


def with_cleaned(body: str, *more: str) -> str:
    return f"WITH {', '.join([COMMENTS, CLEANED, *more])} {body}"


def with_features(body: str, *more: str) -> str:
    return f"WITH {', '.join([COMMENTS, CLEANED, FEATURES, *more])} {body}"


def with_scored(body: str, *more: str) -> str:
    return f"WITH {', '.join([COMMENTS, CLEANED, FEATURES, SCORED, *more])} {body}"


def tally(condition: str) -> str:
    return f"CAST(SUM(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


def share(condition: str) -> str:
    return f"SUM(CASE WHEN {condition} THEN 1 ELSE 0 END)::DOUBLE / NULLIF(COUNT(*), 0) * 100"

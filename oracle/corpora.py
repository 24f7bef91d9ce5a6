"""Check SQL for the corpus queries."""

from __future__ import annotations

from functools import reduce

from oracle.fragments import BLANK, WORD, drop, found, listed, quoted, rounded, with_scored
from palaver import values


def replaced(expression: str, rules) -> str:
    return reduce(lambda e, r: f"replace({e}, {quoted(r[0])}, {quoted(r[1])})", rules, expression)


def substituted(expression: str) -> str:
    """Contractions as plain text, the rest as patterns, then links, digits and mentions."""
    out = replaced(expression, values.CONTRACTIONS)
    for pattern, replacement in values.SLANG:
        out = drop(out, pattern, replacement)
    return drop(drop(drop(out, rf"http[^{BLANK}]+"), "[0-9]"), "@[A-Za-z0-9_]+")


PUNCTUATION = values.PUNCTUATION.replace("!", "")


def unpunctuated(expression: str) -> str:
    return f"translate({expression}, {quoted(PUNCTUATION)}, '')"


def words(expression: str) -> str:
    return (f"list_transform(list_filter({found(expression, f'[{WORD}]{{3,}}')}, "
            f"lambda w: w NOT IN {listed(values.STOPWORDS)}), lambda w: lower(w))")


ABBREVIATIONS = "MAP {" + ", ".join(f"{quoted(a)}: {quoted(b)}" for a, b in values.ABBREVIATIONS) + "}"


def expanded(expression: str) -> str:
    return (f"array_to_string(list_transform({expression}, lambda w: "
            f"COALESCE({ABBREVIATIONS}[lower(w)], w)), ' ')")


# Steps in separate relations: the engine would otherwise repeat the long expression.
PREPARED = f"""substituted AS MATERIALIZED (SELECT doc_id, {unpunctuated(substituted('text'))} AS t FROM documents),
tokenised AS MATERIALIZED (SELECT doc_id, {words('t')} AS w FROM substituted),
prepared AS MATERIALIZED (
  SELECT * FROM (SELECT doc_id, {expanded('w')} AS comment_text FROM tokenised) WHERE comment_text <> '')"""

SEPARATORS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
VOCABULARY = f"""vocab_rows AS MATERIALIZED (
  SELECT doc_id, list_filter(string_split(translate(lower(comment_text), {quoted(SEPARATORS)},
         '{' ' * len(SEPARATORS)}'), ' '), lambda w: w <> '') AS ws FROM prepared),
placed AS MATERIALIZED (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM vocab_rows),
vocabulary AS MATERIALIZED (
  SELECT word, n, row_number() OVER (ORDER BY n DESC, word) AS index
  FROM (SELECT word, COUNT(*) AS n FROM placed GROUP BY word))"""

LABELLED = """labelled AS (
  SELECT d.doc_id, d.text AS comment_text, l.toxic, 1 - l.quality AS low_quality
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"""

MARKED = """marked AS (
  SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN -1 ELSE toxic END AS toxic,
         CASE WHEN doc_id % 7 = 0 THEN -1 ELSE low_quality END AS low_quality FROM labelled)"""

JUDGED = """judged AS (
  SELECT s.comment_id, s.toxicity_score, s.is_toxic, CASE WHEN s.is_toxic THEN 1 ELSE 0 END AS predicted_toxic,
         CASE WHEN s.toxic_word_count > 0 THEN 1 ELSE 0 END AS predicted_low_quality, l.toxic, 1 - l.quality AS low_quality
  FROM scored s JOIN labels l ON l.doc_id = s.doc_id)"""


def prevalence(scope: str, condition: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS label, COUNT(toxic) AS labelled_rows, CAST(SUM({c}) AS BIGINT) AS positives, "
        f"{rounded(f'SUM({c}) / COUNT(toxic)::DOUBLE * 100', 3)} AS percentage, '{scope}' AS scope "
        f"FROM marked WHERE {condition}" for c in ("toxic", "low_quality"))


def sequence(length: int, side: str) -> str:
    """Positions counted from the kept end; missing places are zero."""
    if side == "post":
        rank, place = "pos", "p.r"
    else:
        rank, place = "pos DESC", f"{length + 1} - p.r"
    return f"""WITH {PREPARED}, {VOCABULARY},
        known AS (SELECT doc_id, index, row_number() OVER (PARTITION BY doc_id ORDER BY {rank}) AS r
                  FROM placed JOIN vocabulary USING (word)),
        kept AS (SELECT p.doc_id, {place} AS place, p.index FROM known p WHERE p.r <= {length}),
        grid AS (SELECT doc_id, unnest(generate_series(1, {length})) AS place FROM prepared)
        SELECT doc_id, string_agg(CAST(COALESCE(index, 0) AS VARCHAR), ' ' ORDER BY place) AS sequence
        FROM grid LEFT JOIN kept USING (doc_id, place) GROUP BY doc_id"""


def ratio(a: str, b: str) -> str:
    return f"COALESCE(({a})::DOUBLE / NULLIF(({b}), 0), 0)"


def f1(tp: str, pp: str, ap: str) -> str:
    return ratio(f"2 * ({tp})", f"({pp}) + ({ap})")


def report_line(label: str, p: str, r: str, f: str, support: str, source: str) -> str:
    return (f"SELECT '{label}' AS label, {rounded(p, 6)} AS precision, {rounded(r, 6)} AS recall, "
            f"{rounded(f, 6)} AS f1, CAST({support} AS BIGINT) AS support FROM {source}")


REPORT = f"""per_label AS (
  SELECT 'toxic' AS label, SUM(toxic * predicted_toxic) AS tp, SUM(predicted_toxic) AS pp, SUM(toxic) AS ap FROM judged
  UNION ALL SELECT 'low_quality', SUM(low_quality * predicted_low_quality), SUM(predicted_low_quality), SUM(low_quality)
  FROM judged),
rates AS (SELECT label, tp, pp, ap, {ratio('tp', 'pp')} AS p, {ratio('tp', 'ap')} AS r, {f1('tp', 'pp', 'ap')} AS f
          FROM per_label),
per_row AS (SELECT toxic * predicted_toxic + low_quality * predicted_low_quality AS tp,
                   predicted_toxic + predicted_low_quality AS pp, toxic + low_quality AS ap,
                   CASE WHEN toxic = predicted_toxic AND low_quality = predicted_low_quality THEN 1.0 ELSE 0.0 END AS e
            FROM judged)"""

EPS = "1e-7"


def smooth_f1(true: str, p: str) -> str:
    tp, fp, fn = f"SUM({true} * {p})", f"SUM((1 - {true}) * {p})", f"SUM({true} * (1 - {p}))"
    precision, recall = f"({tp} / ({tp} + {fp} + {EPS}))", f"({tp} / ({tp} + {fn} + {EPS}))"
    return f"(2 * {precision} * {recall} / ({precision} + {recall} + {EPS}))"


TWEET = "|".join([
    rf"(?:https?://|www\.)[^{BLANK}]+", r"[<>]?[:;=8][\-o*']?[)\](\[dDpP/}{@|\\]", r"[)\](\[/}{@|\\][\-o*']?[:;=8][<>]?", "<3",
    "@[A-Za-z0-9_]+", rf"#[{WORD}]+", r"[A-Za-z0-9.+_\-]{1,64}@[A-Za-z0-9_\-]+(?:\.[A-Za-z0-9_\-]+)+",
    r"[+\-]?[0-9]+(?:[,/.:\-][0-9]+)+", rf"[{WORD}]+(?:['\-][{WORD}]+)*", r"\.{2,}", rf"[^{BLANK}]"])

SQL = {
    "tweet_tokens": f"""SELECT 'c' || CAST(doc_id AS VARCHAR) AS comment_id, array_to_string(list_filter(
        {found("COALESCE(text, '')", TWEET)}, lambda t: NOT regexp_full_match(t, '@[A-Za-z0-9_]+')), ' ') AS tokens FROM documents""",
    "prepare_corpus": f"WITH {PREPARED} SELECT doc_id, comment_text FROM prepared",
    "substitute_text": f"""SELECT 'c' || CAST(doc_id AS VARCHAR) AS comment_id,
        {unpunctuated(substituted('text'))} AS message FROM documents""",
    "expand_abbreviations": f"""SELECT 'c' || CAST(doc_id AS VARCHAR) AS comment_id,
        {expanded(found('text', f'[^{BLANK}]+'))} AS message FROM documents""",
    "stopword_filter": f"""SELECT 'c' || CAST(doc_id AS VARCHAR) AS comment_id,
        array_to_string({words('text')}, ' ') AS message FROM documents""",
    "label_prevalence": f"WITH {LABELLED}, {MARKED} {prevalence('all', 'TRUE')} UNION ALL {prevalence('used', 'toxic >= 0')}",
    "label_split": """SELECT doc_id, ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % 5 = 0 AS held_out
        FROM documents JOIN labels USING (doc_id)""",
    "labelled_comments": f"WITH {LABELLED} SELECT doc_id, comment_text, toxic, low_quality FROM labelled",
    "valid_labels": f"WITH {LABELLED}, {MARKED} SELECT doc_id, toxic, low_quality FROM marked WHERE toxic >= 0",
    "tfidf": f"""WITH n AS (SELECT COUNT(*) AS n FROM documents),
        terms AS (SELECT doc_id, unnest({found('lower(text)', f'[{WORD}]{{2,}}')}) AS term FROM documents),
        tf AS (SELECT doc_id, term, COUNT(*) AS n FROM terms GROUP BY 1, 2),
        df AS (SELECT term, COUNT(*) AS df FROM tf GROUP BY 1),
        w AS (SELECT doc_id, term, tf.n, tf.n * (ln((1 + n.n) / (1 + df)::DOUBLE) + 1) AS w
              FROM tf JOIN df USING (term), n)
        SELECT doc_id, term, CAST(n AS INTEGER) AS n,
               {rounded('w / sqrt(SUM(w * w) OVER (PARTITION BY doc_id))', 6)} AS tfidf FROM w""",
    "vocabulary": f"WITH {PREPARED}, {VOCABULARY} SELECT word, n, index FROM vocabulary",
    "text_codes": f"""WITH {PREPARED}, {VOCABULARY},
        coded AS (SELECT doc_id, string_agg(CAST(index AS VARCHAR), ' ' ORDER BY pos) AS codes
                  FROM placed JOIN vocabulary USING (word) GROUP BY doc_id)
        SELECT doc_id, COALESCE(codes, '') AS codes FROM prepared LEFT JOIN coded USING (doc_id)""",
    "padded_sequences_post": sequence(20, "post"),
    "padded_sequences_pre": sequence(200, "pre"),
    "vocab_embeddings": f"""WITH {PREPARED}, {VOCABULARY}
        SELECT word, index, COALESCE({rounded('embedding[1]', 6)}, 0.0) AS first_value,
               COALESCE({rounded('embedding[64]', 6)}, 0.0) AS last_value,
               COALESCE({rounded('list_sum(embedding::DOUBLE[])', 5)}, 0.0) AS total
        FROM vocabulary LEFT JOIN embeddings ON vec_id = index - 1""",
    "mean_embedding": f"""WITH {PREPARED}, {VOCABULARY},
        counts AS (SELECT doc_id, index, COUNT(*) AS n FROM placed JOIN vocabulary USING (word) GROUP BY 1, 2),
        flat AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings),
        total AS (SELECT doc_id, SUM(n) AS n FROM counts GROUP BY 1),
        sums AS (SELECT doc_id, dim, SUM(c.n * v) AS s FROM counts c JOIN flat ON vec_id = index - 1 GROUP BY 1, 2),
        grid AS (SELECT doc_id, n, unnest(generate_series(0, 63)) AS dim FROM total)
        SELECT doc_id, CAST(dim AS INTEGER) AS dim, {rounded('COALESCE(s, 0) / n', 5)} AS value
        FROM grid LEFT JOIN sums USING (doc_id, dim)""",
    "prediction_label_join": with_scored(
        "SELECT comment_id, toxicity_score, is_toxic, toxic, low_quality FROM judged", JUDGED),
    "label_metrics": with_scored(" UNION ALL ".join([
        report_line("toxic", "p", "r", "f", "ap", "rates WHERE label = 'toxic'"),
        report_line("low_quality", "p", "r", "f", "ap", "rates WHERE label = 'low_quality'"),
        report_line("micro avg", ratio("SUM(tp)", "SUM(pp)"), ratio("SUM(tp)", "SUM(ap)"),
                    f1("SUM(tp)", "SUM(pp)", "SUM(ap)"), "SUM(ap)", "rates"),
        report_line("macro avg", "AVG(p)", "AVG(r)", "AVG(f)", "SUM(ap)", "rates"),
        report_line("weighted avg", ratio("SUM(p * ap)", "SUM(ap)"), ratio("SUM(r * ap)", "SUM(ap)"),
                    ratio("SUM(f * ap)", "SUM(ap)"), "SUM(ap)", "rates"),
        report_line("samples avg", f"AVG({ratio('tp', 'pp')})", f"AVG({ratio('tp', 'ap')})",
                    f"AVG({f1('tp', 'pp', 'ap')})", "SUM(ap)", "per_row"),
        report_line("subset accuracy", "AVG(e)", "AVG(e)", "AVG(e)", "SUM(ap)", "per_row"),
    ]), JUDGED, REPORT),
    "macro_f1": with_scored(f"""SELECT {rounded(
        f"({smooth_f1('toxic', 'q')} + {smooth_f1('low_quality', 'predicted_low_quality')}) / 2", 6)} AS macro_f1
        FROM (SELECT *, CASE WHEN toxicity_score > 0.5 THEN 1.0::DOUBLE ELSE 0.0 END AS q FROM judged)""", JUDGED),
    "csv_roundtrip": f"WITH {LABELLED} SELECT doc_id, comment_text, toxic, low_quality FROM labelled",
    "embedding_text_load": f"""SELECT 'w' || CAST(vec_id AS VARCHAR) AS word,
        CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS dim, {rounded('unnest(embedding)', 6)} AS value
        FROM embeddings""",
    "param_table_scan": "SELECT event_id, ts, user_id, value FROM events WHERE event_type = 'click' AND value >= 20.0",
}

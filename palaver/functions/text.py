"""Text cleaning and tokenising as native column expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, functions as F

from palaver import values
from palaver.functions.once import let
from palaver.functions.scalars import as_column

# Letters, digits and blanks are spelled out because the engine's shorthand classes are ASCII only.
WORD = r"\p{L}\p{N}_"
BLANK = r"\x09-\x0d\x1c-\x20\x{85}\p{Z}"


def _class(ranges) -> str:
    return "".join(rf"\x{{{low:X}}}-\x{{{high:X}}}" for low, high in ranges)


def _drop_if(text: Column, marker, pattern: str) -> Column:
    """Remove ``pattern`` only from rows that hold its marker: a byte search in place of a regex."""
    return let(text, lambda t: F.when(marker(t), F.regexp_replace(t, pattern, "")).otherwise(t))


def clean_text(message, emoji_ranges=values.EMOJI_RANGES, hashtags: bool = False, numbers: bool = False) -> Column:
    """Lower-case; drop links, mentions and emoji; keep words and ``.,!?'``; single blanks.

    NULL gives ''. ``hashtags`` and ``numbers`` also drop ``#word`` and digit runs. Special
    characters and blanks end up as one blank, so one pattern does both.
    """
    text = F.lower(F.coalesce(as_column(message), F.lit("")))
    text = _drop_if(text, lambda t: t.contains("http") | t.contains("www"), rf"(?:http|www)[^{BLANK}]+")
    text = _drop_if(text, lambda t: t.contains("@"), rf"@[{WORD}]+")
    if hashtags:
        text = _drop_if(text, lambda t: t.contains("#"), rf"#[{WORD}]+")
    if numbers:
        text = F.regexp_replace(text, r"\p{Nd}+", "")
    # ASCII text has as many bytes as characters and cannot hold an emoji.
    text = _drop_if(text, lambda t: F.octet_length(t) > F.char_length(t), f"[{_class(emoji_ranges)}]+")
    return F.trim(F.regexp_replace(text, rf"[^{WORD}.,!?']+", " "))


def clean_text_quick(message) -> Column:
    """Lower-case, drop ``http`` links, then everything but words becomes single blanks."""
    text = F.lower(as_column(message))
    text = _drop_if(text, lambda t: t.contains("http"), rf"http[^{BLANK}]+")
    return F.trim(F.regexp_replace(text, rf"[^{WORD}]+", " "))


def clean_text_minimal(message) -> Column:
    """Lower-case; everything but words becomes single blanks."""
    return F.trim(F.regexp_replace(F.lower(as_column(message)), rf"[^{WORD}]+", " "))


def literal(entry: str) -> str:
    """SQL text of a string."""
    return "'" + entry.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literals(entries) -> str:
    return ", ".join(literal(e) for e in sorted(set(entries)))


# The functions below put their word lists into SQL text: given as columns, every word of a list
# would cost a call to the JVM. Token arrays are named by a column, or written as SQL text where a
# whole expression has to stay in one piece (array functions copy the arrays between projections).


def tokens_sql(text: str) -> str:
    """Tokens between blanks of a string expression; an empty or NULL text has none."""
    return f"regexp_extract_all(coalesce({text}, ''), {literal(f'[^{BLANK}]+')}, 0)"


def words_sql(text: str, pattern: str) -> str:
    """All matches of a pattern in a string expression."""
    return f"regexp_extract_all(coalesce({text}, ''), {literal(pattern)}, 0)"


def cleaned_tokens_sql(cleaned: str) -> str:
    """Tokens of a column out of ``clean_text``: its only blanks are single spaces."""
    return f"if(length(`{cleaned}`) > 0, split(`{cleaned}`, ' '), array())"


def tokens(text: str) -> Column:
    return F.expr(tokens_sql(f"`{text}`"))


def token_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{BLANK}]+")), F.lit(0))


def token_summary(tokens: str, *lexicons) -> Column:
    """``struct<n, hits>``: the number of tokens and those in any of the lexicons, in one pass."""
    entries = literals(w for lexicon in lexicons for w in lexicon)
    return F.expr(
        f"get(transform(array({tokens}), t -> struct(size(t) AS n, filter(t, w -> w IN ({entries})) AS hits)), 0)")


def term_counts(tokens: str) -> Column:
    """``array<struct<term, n>>``: the distinct tokens of one text with their counts.

    Runs of the sorted tokens are counted inside the row. Nothing is shuffled, and exploding the
    result gives one row per distinct term of a text rather than one per token.
    """
    starts = "if(size(s) > 0, filter(sequence(0, size(s) - 1), i -> i = 0 OR get(s, i) <> get(s, i - 1)), array())"
    runs = "transform(b, (at, j) -> struct(get(s, at) AS term, coalesce(get(b, j + 1), size(s)) - at AS n))"
    return F.expr(
        f"get(transform(array(sort_array({tokens})), s -> get(transform(array({starts}), b -> {runs}), 0)), 0)")


def count_in(words: str, lexicon) -> Column:
    """How many of the tokens are in the lexicon, repeats counted."""
    return F.expr(f"size(filter(`{words}`, w -> w IN ({literals(lexicon)})))")


def kept_words_sql(words: str, lexicon, min_length: int = 1) -> str:
    """Those of a token array (SQL text) with enough characters that are not in the lexicon."""
    return f"filter({words}, w -> length(w) >= {min_length} AND w NOT IN ({literals(lexicon)}))"


# --- corpus preparation ----------------------------------------------------------------------

_PLAIN = re.compile(r"[\w\s'&;/<>-]+")


def _substitute(text: Column, rules) -> Column:
    for pattern, replacement in rules:
        if _PLAIN.fullmatch(pattern):
            text = F.replace(text, F.lit(pattern), F.lit(replacement))
        else:
            text = F.regexp_replace(text, pattern, replacement)
    return text


def substitute(text, contractions=values.CONTRACTIONS, slang=values.SLANG) -> Column:
    """Ordered substitutions, then links, ASCII digits and mentions are dropped.

    The leading contraction rules all need an apostrophe or a mis-decoded one. Rows without either
    skip that block; its result for them would be the text itself.
    """
    text = as_column(text)
    marks = ("'", "\x89")
    marked = [any(m in pattern for m in marks) for pattern, _ in contractions]
    end = marked.index(False) if False in marked else len(marked)
    head, rest = contractions[:end], contractions[end:]
    if head:
        text = let(text, lambda t: F.when(
            reduce(lambda a, b: a | b, [t.contains(m) for m in marks]), _substitute(t, head)).otherwise(t))
    text = _substitute(text, tuple(rest) + tuple(slang))
    text = _drop_if(text, lambda t: t.contains("http"), rf"http[^{BLANK}]+")
    text = F.translate(text, "0123456789", "")
    return _drop_if(text, lambda t: t.contains("@"), "@[A-Za-z0-9_]+")


def drop_punctuation(text, keep: str = "!") -> Column:
    """Drop ASCII punctuation but ``keep``. Ellipsis padding would follow; no dot is left to pad."""
    return F.translate(as_column(text), "".join(c for c in values.PUNCTUATION if c not in keep), "")


def long_tokens(text, min_length: int = 3) -> Column:
    """Word runs of at least ``min_length`` characters; ``!`` and other signs separate words."""
    return F.regexp_extract_all(as_column(text), F.lit(rf"[{WORD}]{{{min_length},}}"), F.lit(0))


HANDLE = "@[A-Za-z0-9_]+"
# What a tweet is made of, in the order in which it is tried at each place.
TWEET_TOKEN = "|".join([
    rf"(?:https?://|www\.)[^{BLANK}]+",
    r"[<>]?[:;=8][\-o*']?[)\](\[dDpP/}{@|\\]", r"[)\](\[/}{@|\\][\-o*']?[:;=8][<>]?", "<3",  # emoticons, their mouth last or first
    HANDLE,
    rf"#[{WORD}]+",
    r"[A-Za-z0-9.+_\-]{1,64}@[A-Za-z0-9_\-]+(?:\.[A-Za-z0-9_\-]+)+",  # mail addresses
    r"[+\-]?[0-9]+(?:[,/.:\-][0-9]+)+",
    rf"[{WORD}]+(?:['\-][{WORD}]+)*",
    r"\.{2,}",
    rf"[^{BLANK}]",
])


def tweet_tokens(text, strip_handles: bool = True, shorten: bool = True) -> Column:
    """Links, emoticons, handles, tags, mail addresses, numbers, words with inner ``'`` or ``-``, dots, other signs one by one.

    ``shorten`` cuts repeats of one character to three before, ``strip_handles`` leaves handles out. A null
    text has no tokens.
    """
    text = F.coalesce(as_column(text), F.lit(""))
    if shorten:
        text = F.regexp_replace(text, r"(.)\1{2,}", "$1$1$1")
    found = F.regexp_extract_all(text, F.lit(TWEET_TOKEN), F.lit(0))
    return F.filter(found, lambda t: ~t.rlike(f"^{HANDLE}$")) if strip_handles else found


def drop_stopwords(words: str, stopwords=values.STOPWORDS) -> Column:
    """Stopwords are tested before lower-casing, so ``The`` stays, as ``the``."""
    return F.expr(f"transform(filter(`{words}`, w -> w NOT IN ({literals(stopwords)})), w -> lower(w))")


def expand_abbreviations(words: str, table=values.ABBREVIATIONS) -> Column:
    """Replace tokens whose lower-case form is in the table; join with blanks."""
    pairs = dict(table)
    entries = ", ".join(f"{literal(k)}, {literal(v)}" for k, v in pairs.items())
    return F.expr(
        f"array_join(transform(`{words}`, w -> CASE WHEN lower(w) IN ({literals(pairs)}) "
        f"THEN try_element_at(map({entries}), lower(w)) ELSE w END), ' ')"
    )

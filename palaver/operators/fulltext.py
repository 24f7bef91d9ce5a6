"""Search by stems, phrases and prefixes: by one scan of the texts, and through a stored positional index.

A query is a tree of ``word``, ``phrase`` and ``prefix`` under ``both``, ``either`` and ``without``. Words
are stemmed, stopwords are ignored but keep their places, so a phrase must stand word by word. The index has two parts:
posting rows ``(term, key, positions)`` as words stand in texts, by bucket of the term, and a dictionary ``(term, stem)``
of the distinct terms by first letter of the stem. Only the dictionary is stemmed. A query reads the dictionary folders of its stems and the
posting buckets of the terms found there.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from palaver import session, values
from palaver.functions.once import computed_once
from palaver.functions.stems import stem
from palaver.functions.text import WORD, words_sql
from palaver.operators import search

#: So many terms are looked up in their own buckets; more (a short prefix) are found by a join with the dictionary.
MOST_LISTED = 1000


@dataclass(frozen=True)
class Word:
    text: str


@dataclass(frozen=True)
class Prefix:
    text: str


@dataclass(frozen=True)
class Phrase:
    words: tuple[str, ...]


@dataclass(frozen=True)
class Node:
    kind: str
    parts: tuple


def word(text: str) -> Word:
    return Word(text.lower())


def prefix(text: str) -> Prefix:
    return Prefix(text.lower())


def phrase(text: str) -> Phrase:
    return Phrase(tuple(text.lower().split()))


def both(*parts) -> Node:
    return Node("and", parts)


def either(*parts) -> Node:
    return Node("or", parts)


def without(part) -> Node:
    return Node("not", (part,))


def leaves(query) -> list:
    return [query] if not isinstance(query, Node) else [x for p in query.parts for x in leaves(p)]


def stems_of(spark: SparkSession, query, stopwords=values.STOPWORDS) -> dict[str, str]:
    """Stem of each word of a query, by the same expression as in texts; stopwords have none."""
    texts = sorted({w for leaf in leaves(query) for w in (leaf.words if isinstance(leaf, Phrase) else (leaf.text,))} - set(stopwords))
    if not texts:
        return {}
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", stem("text").alias("stem"))
    return dict(map(tuple, rows.collect()))


def hit(query, leaf_hit) -> Column:
    """The query as a condition; ``leaf_hit`` gives that of a leaf, or None for one of stopwords only, which is left out."""

    def build(node):
        if not isinstance(node, Node):
            return leaf_hit(node)
        found = [c for c in map(build, node.parts) if c is not None]
        if not found:
            return None
        if node.kind == "not":
            return ~found[0]
        return reduce((lambda a, b: a & b) if node.kind == "and" else (lambda a, b: a | b), found)
    condition = build(query)
    return F.lit(False) if condition is None else condition


def wanted_at(leaf: Phrase, stems: dict[str, str]) -> list[tuple[int, str]]:
    """Distances and stems of a phrase's words, from its first one that is no stopword."""
    own = [(i, stems[w]) for i, w in enumerate(leaf.words) if w in stems]
    return [(i - own[0][0], s) for i, s in own]


def find(df: DataFrame, text: str, query, stopwords=values.STOPWORDS) -> DataFrame:
    """Matching rows by one scan, without a shuffle.

    Only words that begin like a wanted stem are stemmed; a suffix rule changes no more than the last two letters of a stem.
    """
    stems = stems_of(df.sparkSession, query, stopwords)
    begins = sorted({s[:max(1, len(s) - 2)] for s in stems.values()})
    words = F.expr(words_sql(f"lower(`{text}`)", f"[{WORD}]+"))
    near = reduce(lambda a, b: a | b, [F.lower(text).contains(b) for b in begins]) if begins else F.lit(False)

    def of_word(w: Column) -> Column:
        candidate = reduce(lambda a, b: a | b, [w.startswith(b) for b in begins], F.lit(False)) & ~w.isin(*stopwords)
        return F.when(candidate, stem(w))

    def leaf_hit(leaf):
        own = F.col("_stems")
        if isinstance(leaf, Phrase):
            wanted = wanted_at(leaf, stems)
            if not wanted:
                return None
            places = F.sequence(F.lit(0), F.size(own) - 1)
            return (F.size(own) > 0) & F.exists(F.when(F.size(own) > 0, places), lambda i: reduce(
                lambda a, b: a & b, [F.coalesce(F.get(own, i + at) == s, F.lit(False)) for at, s in wanted]))
        if leaf.text not in stems:
            return None
        if isinstance(leaf, Prefix):
            return F.exists(own, lambda s: F.coalesce(s.startswith(stems[leaf.text]), F.lit(False)))
        return F.exists(own, lambda s: F.coalesce(s == stems[leaf.text], F.lit(False)))

    # a text without any wanted beginning has no stems; a pure negation still holds for it
    found = F.when(near, F.transform(words, of_word)).otherwise(F.array().cast("array<string>"))
    return computed_once(df, {"_stems": found}).filter(hit(query, leaf_hit)).drop("_stems")


def positional_postings(df: DataFrame, text: str, key: str, stopwords=values.STOPWORDS) -> DataFrame:
    """``(term, key, positions)`` once per term of each text, grouped by sorting inside the row; no shuffle."""
    words = words_sql(f"lower(`{text}`)", f"[{WORD}]+")
    placed = F.expr(f"sort_array(transform({words}, (w, i) -> struct(w AS w, i AS i)))")
    starts = "filter(sequence(0, size(_s) - 1), i -> i = 0 OR get(_s, i).w <> get(_s, i - 1).w)"
    runs = "transform(_b, (at, j) -> struct(get(_s, at).w AS term, transform(slice(_s, at + 1, coalesce(get(_b, j + 1), size(_s)) - at), x -> x.i) AS positions))"
    sorted_ = computed_once(df.select(key, text), {"_s": placed}).filter("size(_s) > 0")
    split = computed_once(sorted_.select(key, "_s"), {"_b": F.expr(starts)})
    rows = split.select(key, F.inline(F.expr(runs)))
    return rows.filter(~F.col("term").isin(*stopwords)).select("term", key, "positions")


def dictionary(postings: DataFrame) -> DataFrame:
    """``(term, stem)`` of the distinct terms."""
    return postings.select("term").distinct().select("term", stem("term").alias("stem"))


def _initial(stem_: Column) -> Column:
    """Folder of a stem: the code of its first character."""
    return F.ascii(stem_)


def write_index(postings: DataFrame, path: str, buckets: int = 256) -> None:
    """Postings by bucket and dictionary by first letter.

    Dealing by ranges reads its rows twice, first to find the ranges, so texts are split and terms stemmed before, once, and written.
    """
    search.write_postings(session.written(postings, "postings"), f"{path}/postings", buckets)
    stored = postings.sparkSession.read.parquet(f"{path}/postings")
    terms = session.written(dictionary(stored), "dictionary").withColumn("initial", _initial(F.col("stem")))
    terms.repartitionByRange("initial", "stem", "term").write.mode("overwrite").partitionBy("initial").parquet(f"{path}/terms")


def _family(spark: SparkSession, path: str, query, stems: dict[str, str]) -> DataFrame:
    """Dictionary rows that a leaf of the query asks for, from the folders of their first letters."""
    tests = []
    for leaf in leaves(query):
        for w in leaf.words if isinstance(leaf, Phrase) else (leaf.text,):
            if w in stems:
                own = F.col("stem").startswith(stems[w]) if isinstance(leaf, Prefix) else F.col("stem") == stems[w]
                tests.append((F.col("initial") == ord(stems[w][0])) & own)
    return spark.read.parquet(f"{path}/terms").filter(reduce(lambda a, b: a | b, tests)).select("term", "stem")


def _together(lists: list[tuple[str, int]]) -> Column:
    """Whether some place of the first list has a place at the right distance in each other one."""
    return F.exists(lists[0][0], lambda p: reduce(lambda a, b: a & b, [F.array_contains(F.col(c), p + at) for c, at in lists]))


def find_in_index(spark: SparkSession, path: str, key: str, query, buckets: int = 256, stopwords=values.STOPWORDS) -> DataFrame:
    """Keys of the texts that match, from the index alone.

    Posting rows meet per key, combined within each task first. A query without a wanted word has no list to start from.
    """
    stems = stems_of(spark, query, stopwords)
    if not stems:
        return spark.read.parquet(f"{path}/postings").filter(F.lit(False)).select(key)
    family = _family(spark, path, query, stems)
    terms = [r.term for r in family.select("term").limit(MOST_LISTED + 1).collect()]
    if len(terms) > MOST_LISTED:
        lists = spark.read.parquet(f"{path}/postings")
    else:
        lists = search.read_postings(spark, f"{path}/postings", terms, buckets) if terms else spark.read.parquet(f"{path}/postings").filter(F.lit(False))
    rows = lists.join(family, "term")
    flags, conditions = {}, {}
    for i, leaf in enumerate(dict.fromkeys(leaves(query))):
        if isinstance(leaf, Phrase):
            wanted = wanted_at(leaf, stems)
            if not wanted:
                conditions[leaf] = None
                continue
            for j, (_, s) in enumerate(wanted):
                flags[f"_p{i}_{j}"] = F.flatten(F.collect_list(F.when(F.col("stem") == s, F.col("positions"))))

            conditions[leaf] = _together([(f"_p{i}_{j}", at) for j, (at, _) in enumerate(wanted)])
        elif leaf.text not in stems:
            conditions[leaf] = None
        else:
            own = F.col("stem").startswith(stems[leaf.text]) if isinstance(leaf, Prefix) else F.col("stem") == stems[leaf.text]
            flags[f"_f{i}"] = F.bool_or(own)
            conditions[leaf] = F.col(f"_f{i}")
    return rows.groupBy(key).agg(*[c.alias(n) for n, c in flags.items()]).filter(hit(query, conditions.get)).select(key)

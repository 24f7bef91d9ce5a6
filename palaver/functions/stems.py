"""English stems by suffix rules (the second Porter algorithm), as column expressions.

Stems are meant for a dictionary of distinct words: about twenty patterns a word.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from palaver.functions.once import let
from palaver.functions.scalars import as_column

# Fixed values of the published algorithm.
EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli",
    "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
UNCHANGED = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")
FIRST_REGION = "^(gener|commun|arsen|.*?[aeiouy][^aeiouy])"
SHORT_END = "(^[aeiouy][^aeiouy]|[^aeiouy][aeiouy][^aeiouywxY])$"
STEP_2 = {
    "ational": "ate", "ization": "ize", "fulness": "ful", "iveness": "ive", "ousness": "ous", "biliti": "ble", "lessli": "less",
    "tional": "tion", "aliti": "al", "alism": "al", "ation": "ate", "entli": "ent", "fulli": "ful", "iviti": "ive", "ousli": "ous",
    "abli": "able", "alli": "al", "anci": "ance", "ator": "ate", "enci": "ence", "izer": "ize", "bli": "ble", "ogi": "og", "li": "",
}
STEP_3 = {
    "ational": "ate", "tional": "tion", "alize": "al", "ative": "", "icate": "ic", "iciti": "ic", "ical": "ic", "ness": "", "ful": "",
}
STEP_4 = ("ement", "able", "ance", "ence", "ible", "ment", "ant", "ate", "ent", "ion", "ism", "iti", "ive", "ize", "ous", "al", "er", "ic")


def ending(word: Column, suffixes) -> Column:
    """The longest of the suffixes that ends the word, or an empty string."""
    return F.regexp_extract(word, f"({'|'.join(suffixes)})$", 1)


def cut(word: Column, suffix: Column) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - F.length(suffix))


def begins_in(word: Column, suffix: Column, region: Column) -> Column:
    """Whether the suffix is there and lies in a region that begins after so many letters."""
    return (suffix != "") & (F.length(word) - F.length(suffix) >= region)


def mapped(key: Column, table: dict[str, str], otherwise: Column) -> Column:
    pairs = list(table.items())
    out = F.when(key == pairs[0][0], pairs[0][1])
    for old, new in pairs[1:]:
        out = out.when(key == old, new)
    return out.otherwise(otherwise)


def plural(w: Column) -> Column:
    return (F.when(w.endswith("sses"), F.regexp_replace(w, "es$", ""))
            .when(w.rlike("ie[sd]$"), F.when(F.length(w) > 4, F.regexp_replace(w, "ie[sd]$", "i")).otherwise(F.regexp_replace(w, "ie[sd]$", "ie")))
            .when(w.rlike("(us|ss)$"), w)
            .when(w.rlike("[aeiouy].+s$"), F.regexp_replace(w, "s$", "")).otherwise(w))


def participle(w: Column, r1: Column) -> Column:
    suffix = ending(w, ("eedly", "ingly", "edly", "eed", "ing", "ed"))

    def repaired(base: Column) -> Column:
        return (F.when(base.rlike("(at|bl|iz)$"), F.concat(base, F.lit("e")))
                .when(base.rlike("(bb|dd|ff|gg|mm|nn|pp|rr|tt)$"), F.regexp_replace(base, ".$", ""))
                .when((F.length(base) <= r1) & base.rlike(SHORT_END), F.concat(base, F.lit("e"))).otherwise(base))

    def of(s: Column) -> Column:
        base = cut(w, s)
        return (F.when(s.isin("eed", "eedly"), F.when(begins_in(w, s, r1), F.concat(base, F.lit("ee"))).otherwise(w))
                .when((s != "") & base.rlike("[aeiouy]"), let(base, repaired)).otherwise(w))
    return let(suffix, of)


def step_2(w: Column, r1: Column) -> Column:
    def of(s: Column) -> Column:
        base = cut(w, s)
        allowed = F.when(s == "ogi", base.endswith("l")).when(s == "li", base.rlike("[cdeghkmnrt]$")).otherwise(F.lit(True))
        return F.when(begins_in(w, s, r1) & allowed, F.concat(base, mapped(s, STEP_2, s))).otherwise(w)
    return let(ending(w, STEP_2), of)


def step_3(w: Column, r1: Column, r2: Column) -> Column:
    def of(s: Column) -> Column:
        allowed = (s != "ative") | begins_in(w, s, r2)
        return F.when(begins_in(w, s, r1) & allowed, F.concat(cut(w, s), mapped(s, STEP_3, s))).otherwise(w)
    return let(ending(w, STEP_3), of)


def step_4(w: Column, r2: Column) -> Column:
    def of(s: Column) -> Column:
        base = cut(w, s)
        return F.when(begins_in(w, s, r2) & ((s != "ion") | base.rlike("[st]$")), base).otherwise(w)
    return let(ending(w, STEP_4), of)


def step_5(w: Column, r1: Column, r2: Column) -> Column:
    base, size = F.regexp_replace(w, ".$", ""), F.length(w) - 1
    return (F.when(w.endswith("e") & ((size >= r2) | ((size >= r1) & ~base.rlike(SHORT_END))), base)
            .when(w.endswith("ll") & (size >= r2), base).otherwise(w))


def chain(word: Column, steps: list[Callable[[Column], Column]]) -> Column:
    """One step after the other, each evaluated once."""
    return let(word, lambda w: chain(steps[0](w), steps[1:])) if steps else word


def stem(word) -> Column:
    """Stem of a lower-case word; words of one or two letters stay."""
    word = as_column(word)
    marked = F.regexp_replace(F.regexp_replace(word, "^y", "Y"), "([aeiouy])y", "$1Y")

    def region(w: Column, start: Column, pattern: str) -> Column:
        own = F.regexp_extract(F.substring(w, start + 1, F.length(w)), pattern, 1)
        return F.when(own != "", start + F.length(own)).otherwise(F.length(w))

    def with_regions(w: Column, r1: Column, r2: Column) -> Column:
        final = chain(plural(w), [
            lambda x: F.when(x.isin(*UNCHANGED), x).otherwise(participle(x, r1)),
            lambda x: F.when(x.isin(*UNCHANGED), x).otherwise(F.regexp_replace(x, "(.[^aeiouy])[yY]$", "$1i")),
            lambda x: F.when(x.isin(*UNCHANGED), x).otherwise(step_2(x, r1)),
            lambda x: F.when(x.isin(*UNCHANGED), x).otherwise(step_3(x, r1, r2)),
            lambda x: F.when(x.isin(*UNCHANGED), x).otherwise(step_4(x, r2)),
            lambda x: F.when(x.isin(*UNCHANGED), x).otherwise(step_5(x, r1, r2))])
        return F.translate(final, "Y", "y")

    ruled = let(marked, lambda w: let(region(w, F.lit(0), FIRST_REGION), lambda r1: let(
        region(w, r1, "^(.*?[aeiouy][^aeiouy])"), lambda r2: with_regions(w, r1, r2))))
    return F.when(F.length(word) <= 2, word).otherwise(mapped(word, EXCEPTIONS, ruled))

"""Licence notices by phrases and by an exact set-similarity join, in native expressions only.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, A to Z in lower case. *Phrases* are places
where their words stand one after the other; they give the base labels. *Templates* are longer notices,
as sets of words. A text is dealt to blocks of twice the longest template, one
starting every half block, so a passage as long as any template lies whole in some block. A block has a template's label
when it contains at least ``CONTAINED`` of the template's set. Every such pair of block and template is found:

* all template words are ordered by the number of documents that hold them, counted over the whole input, rare ones first;
* a block keeps its template words in that order (others cannot add to an overlap);
* length: a block with fewer words than the overlap asked for cannot match;
* prefix: of a template of m words that must share r, the first ``m - r + 1`` must hold one of the first ``b - r + 1`` of the block's b;
* positions: after their first common word, enough words must be left on both sides;
* what is left is counted exactly.

Before that, a text without any prefix word is passed over as a whole. The templates are a parameter, bounded by
``MOST_TEMPLATES``; they travel inside the plan as literals. Nothing is shuffled but the counts of template words, one row per word and
task, so a hot text, source or key costs no more than other rows.

Edge cases: a null text is an empty one; a text without words has no labels, no places and a score of 0; overlapping places all count; equal
rows get equal results; an empty table gives no rows; other columns pass through, but those that have the name of a result are replaced.
"""

from __future__ import annotations

import math
import re
import string

from pyspark.sql import Column, DataFrame, functions as F

from palaver.functions.once import computed_once
from palaver.llm.frames import free

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CONTAINED = 0.9
MOST_TEMPLATES = 1000
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Notices as their publishers ask for them, and short forms in use.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "You may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
            "as published by the Free Software Foundation"),
    ("gpl-3.0", "GNU General Public License, version 3"),
    ("lgpl", "GNU Lesser General Public License"),
    ("agpl", "GNU Affero General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "Creative Commons CC0 1.0 Universal Public Domain Dedication"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]
MATCHES = "array<struct<start:bigint,end:bigint,label:string,contained:double>>"
RESULTS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def plain_words(text: str) -> list[str]:
    """Words of a template or phrase."""
    return [w for w in re.split(SEPARATORS, text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))) if w]


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def need(size: int, contained: float) -> int:
    """Least overlap of a template of so many words."""
    return max(1, math.ceil(size * contained - 1e-9))


def blanks(text: Column) -> Column:
    return (F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def places(spaced: Column, n_words: Column, phrase: str) -> Column:
    """``(n, first, last)`` of a phrase in words with a space on either side of each; null without one.

    The split takes the space before an occurrence alone, so overlapping ones count. Words before the first are the spaces of
    the first piece; words from the last one on are those of the last piece.
    """
    own = f" {' '.join(plain_words(phrase))} "
    pieces = F.split(spaced, f" (?={re.escape(own[1:])})")
    return F.when(F.contains(spaced, F.lit(own)), F.struct(
        (F.size(pieces) - 1).cast("long").alias("n"), blanks(F.element_at(pieces, 1)).alias("first"),
        (n_words - blanks(F.element_at(pieces, -1))).alias("last")))


class Templates:
    """Template sets in the global order, their prefixes, and the size of a block."""

    def __init__(self, templates: list[tuple[str, str]], contained: float):
        if len(templates) > MOST_TEMPLATES:
            raise ValueError(f"at most {MOST_TEMPLATES} templates")
        own = [(label, plain_words(text)) for label, text in templates]
        self.labels = [label for label, _ in own]
        self.sets = [sorted(set(w)) for _, w in own]
        self.stride = max([len(w) for _, w in own], default=1)
        self.vocabulary = sorted({w for s in self.sets for w in s})
        self.needs = [need(len(s), contained) for s in self.sets]

    def order(self, counts: dict[str, int]) -> None:
        self.vocabulary.sort(key=lambda w: (counts.get(w, 0), w))
        place = {w: i for i, w in enumerate(self.vocabulary)}
        self.sets = [sorted(s, key=place.__getitem__) for s in self.sets]

    def prefix(self, i: int) -> list[str]:
        return self.sets[i][:len(self.sets[i]) - self.needs[i] + 1]

    def rows(self) -> Column:
        return F.array(*[F.struct(
            F.lit(label).alias("label"), literal(s).alias("words"), literal(self.prefix(i)).alias("prefix"),
            F.lit(len(s)).alias("n"), F.lit(self.needs[i]).alias("need")) for i, (label, s) in enumerate(zip(self.labels, self.sets))])


def literal(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def document_counts(df: DataFrame, text: str, vocabulary: list[str]) -> dict[str, int]:
    """Number of documents that hold each template word; the driver receives one number per template word."""
    held = df.select(F.explode(F.array_intersect(words(F.col(f"`{text}`")), literal(vocabulary))).alias("word"))
    return {r.word: r.n for r in held.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}


def first_position(own: Column, other: Column) -> tuple[Column, Column]:
    """Places of the first common word of two lists in the global order."""
    first = F.element_at(F.array_intersect(own, other), 1)
    return F.array_position(own, first), F.array_position(other, first)


def joined(template: Column, block: Column) -> Column:
    """Whether the overlap is large enough: by length, prefix, positions, then exactly."""
    size, least = F.size(block), template["need"]
    at, other = first_position(template["words"], block)
    return ((size >= least)
            & F.arrays_overlap(template["prefix"], F.slice(block, F.lit(1), size - least + 1))
            & (1 + F.least(template["n"] - at, size - other) >= least)
            & (F.size(F.array_intersect(template["words"], block)) >= least))


def block_matches(tokens: Column, n_words: Column, own: Templates) -> Column:
    """``array<struct<start, end, label, contained>>``: all blocks and templates that meet the threshold."""
    stride = own.stride
    blocks = F.greatest(F.ceil(n_words / stride) - 1, F.lit(1)).cast("int")

    def of_block(j: Column) -> Column:
        # array_intersect keeps the order of its first list, the global one
        block = F.array_intersect(literal(own.vocabulary), F.slice(tokens, j * stride + 1, 2 * stride))
        found = F.transform(F.array(block), lambda b: F.transform(F.filter(own.rows(), lambda t: joined(t, b)), lambda t: F.struct(
            (j * stride).cast("long").alias("start"), F.least((j * stride + 2 * stride).cast("long"), n_words).alias("end"),
            t["label"].alias("label"), (F.size(F.array_intersect(t["words"], b)) / t["n"]).alias("contained"))))
        return F.flatten(found)

    some = F.arrays_overlap(tokens, literal(sorted({w for i in range(len(own.sets)) for w in own.prefix(i)})))
    return F.when(some, F.flatten(F.transform(F.sequence(F.lit(0), blocks - 1), of_block))).otherwise(F.array()).cast(MATCHES)


def scanned(df: DataFrame, text: str, keep: list[str], templates: list[tuple[str, str]], contained: float) -> tuple[DataFrame, str, str]:
    """Columns ``keep`` with the words and the matched blocks, under free names."""
    own = Templates(templates, contained)
    own.order(document_counts(df, text, own.vocabulary) if templates else {})
    value = free(keep, "words")
    raw, found = free([*keep, value], "raw"), free([*keep, value], "matches")
    source = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias(raw))
    source = computed_once(source, {value: words(F.col(raw))}).drop(raw)
    matches = block_matches(F.col(value), F.size(value).cast("long"), own) if templates else F.array().cast(MATCHES)
    return source.withColumn(found, matches), value, found


def license_blocks(df: DataFrame, text: str = "text", keep: list[str] | None = None, templates: list[tuple[str, str]] = TEMPLATES,
                   contained: float = CONTAINED) -> DataFrame:
    """One row per block and template that meet: ``keep`` and ``start, end`` (words from 0), ``label, contained``."""
    names = ["start", "end", "label", "contained"]
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in names]
    rows, _, found = scanned(df, text, keep, templates, contained)
    rows = rows.select(*[F.col(f"`{c}`") for c in keep], F.explode(found).alias(found))
    return rows.select(*[F.col(f"`{c}`") for c in keep], *[F.col(found)[n].alias(n) for n in names])


def scan(df: DataFrame, text: str = "text", keep: list[str] | None = None, phrases: dict[str, str] = PHRASES,
         templates: list[tuple[str, str]] = TEMPLATES, contained: float = CONTAINED) -> DataFrame:
    """Columns ``keep`` (all by default) with ``n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``score`` is the largest containment of a phrase or of a template that met the threshold; 0 without any.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in RESULTS]
    rows, value, found = scanned(df, text, keep, templates, contained)
    spaced, hits = free([*keep, value, found], "spaced"), free([*keep, value, found], "hits")
    n_words = F.size(value).cast("long")
    rows = rows.withColumn(spaced, F.concat(F.lit(" "), F.array_join(value, " "), F.lit(" ")))
    rows = rows.withColumn(hits, F.array(*[places(F.col(spaced), n_words, p) for p in phrases]))
    own = F.filter(F.col(hits), lambda h: h.isNotNull())
    labels = [F.when(F.get(F.col(hits), F.lit(i)).isNotNull(), F.lit(label)) for i, label in enumerate(phrases.values())]
    base = F.array_sort(F.array_distinct(F.array_compact(F.array(*labels))))
    every = F.array_sort(F.array_union(base, F.transform(F.col(found), lambda m: m["label"])))
    best = F.coalesce(F.array_max(F.transform(F.col(found), lambda m: m["contained"])), F.lit(0.0))
    return rows.select(
        *[F.col(f"`{c}`") for c in keep], n_words.alias("n_words"),
        F.aggregate(own, F.lit(0).cast("long"), lambda a, h: a + h["n"]).alias("n_base"),
        F.array_min(F.transform(own, lambda h: h["first"])).alias("first_word"),
        F.array_max(F.transform(own, lambda h: h["last"])).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.when(F.size(base) > 0, F.lit(1.0)).otherwise(best).alias("score"))

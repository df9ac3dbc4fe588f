"""Licence scan by a positional index over rare licence words, in DataFrame
operations only.

Base labels come from three fixed phrases.  Beside them, each template of
``TEMPLATES`` (a licence's notice or opening) is sought: its words are weighted by
IDF, from document counts over the whole corpus, and its ``ANCHORS`` weightiest
words with their positions are its postings.  A label needs the share
``MIN_COVERAGE`` of the anchors' weight, so one of the weightiest anchors that
together hold more than the rest of it must stand in its place (pigeonhole): these
are looked up in a file, and each of their places, with ``TOLERANCE`` words of
shift, fixes where the template would lie.  There the other anchors are
intersected by relative position, with the same tolerance.  So every place is
found that a scan of all places would find, whatever words the file repeats
elsewhere.  The share of the anchors' weight found is the coverage; with ``MIN_COVERAGE`` or more, and with every mandatory
phrase verified in the words of that place, the file gets the template's label.

All of a file's work happens inside its row, so there is nothing to skew; the
corpus is read once for the counts, which come back as at most one row for each
template word, and once to scan.  Files without any rare licence word end there.

Defined results.  Null texts are empty ones: no words, no labels, score 0.
Repeated rows are treated alike; extra columns pass through (those named like a
result are replaced).  An empty table gives an empty one.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourse.llm.common import free_name, table

ANCHORS = 8
TOLERANCE = 2
MARGIN = 6
MIN_COVERAGE = 0.7

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Label, text, mandatory phrases.  Texts are the licences' own
#: notices or openings.
TEMPLATES = (
    ("mit", "Released under the MIT License.", ("mit license",)),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction",
     ("permission is hereby granted", "without restriction")),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0.", ("apache license", "version 2 0")),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
     ("in compliance with the license",)),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3.",
     ("general public license", "version 3")),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2.",
     ("general public license", "version 2")),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation", ("gnu general public license",)),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
     ("lesser general public license",)),
    ("agpl-3.0", "under the terms of the GNU Affero General Public License version 3",
     ("affero general public license",)),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0.", ("cc by nc 4 0",)),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0.", ("cc by sa 4 0",)),
    ("cc-by-4.0", "Licensed under CC BY 4.0.", ("cc by 4 0",)),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights",
     ("waived all copyright",)),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
     ("mozilla public license",)),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted", ("with or without fee is hereby granted",)),
    ("unlicense", "This is free and unencumbered software released into the public domain.",
     ("released into the public domain",)),
    ("all-rights-reserved", "All rights reserved.", ("all rights reserved",)),
)

_UPPER, _LOWER = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))
_WORD = re.compile(WORD)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.translate(str.maketrans(_UPPER, _LOWER)))


def words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def literals(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


# --- index -----------------------------------------------------------------------

def idf(docs: DataFrame, templates=TEMPLATES) -> dict[str, float]:
    """Weight of each template word: log of files over files that hold it."""
    known = sorted({w for _, text, _ in templates for w in words_of(text)})
    total = docs.count()
    rows = (docs.select(F.explode(F.array_intersect(words(F.col("text")), literals(known))).alias("w"))
            .groupBy("w").count().collect())
    held = {r["w"]: r["count"] for r in rows}
    return {w: math.log((total + 1) / (held.get(w, 0) + 1)) + 0.01 for w in known}


def postings(weights: dict[str, float], templates=TEMPLATES) -> list[tuple]:
    """(label, phrases, length, anchors as (word, position, weight), heaviest
    first) of each template."""
    out = []
    for label, text, phrases in templates:
        own = words_of(text)
        anchors = sorted({(w, own.index(w)) for w in own}, key=lambda a: (-weights[a[0]], a[1]))[:ANCHORS]
        out.append((label, phrases, len(own), [(w, p, weights[w]) for w, p in anchors]))
    return out


# --- scan ------------------------------------------------------------------------

def _spaces(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))


def base(all_words: Column) -> Column:
    """Struct of n, first, last and labels of the base phrases' places."""
    line = F.concat(F.lit(" "), F.array_join(all_words, " "), F.lit(" "))

    def found(s: Column) -> Column:
        n, first, last, labels = [], [], [], []
        for phrase, label in PHRASES.items():
            pattern = rf"(?<= ){phrase}(?= )"
            parts = F.split(s["line"], pattern, -1)
            some = F.size(parts) > 1
            n.append((F.size(parts) - 1).cast("long"))
            first.append(F.when(some, _spaces(parts[0]) - 1))
            after = _spaces(F.element_at(parts, -1)) - 1
            last.append(F.when(some, s["n"] - after - len(phrase.split())))
            labels.append(F.when(some, F.lit(label)))
        return F.struct(sum(n[1:], n[0]).alias("n"), F.least(*first).cast("long").alias("first"),
                        F.greatest(*last).cast("long").alias("last"), F.array_compact(F.array(*labels)).alias("labels"))

    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("first"),
                    F.lit(None).cast("long").alias("last"), F.array().cast("array<string>").alias("labels"))
    return F.when(F.array_contains(all_words, "license"),
                  let(F.struct(line.alias("line"), F.size(all_words).alias("n")), found)).otherwise(none)


def pivots(anchors: list[tuple]) -> list[tuple]:
    """The heaviest anchors, one of which every place of sufficient coverage
    must hold: together they weigh more than such a place may lack."""
    total, held = sum(w for _, _, w in anchors), 0.0
    for k, (_, _, weight) in enumerate(anchors, 1):
        held += weight
        if held > (1 - MIN_COVERAGE) * total + 1e-9:
            return anchors[:k]
    return anchors


def _template(all_words: Column, hits: Column, template: tuple) -> Column:
    """Best coverage of a template in a file, 0 if its phrases are not verified
    there: (word, place) of the file's rare licence words are in ``hits``."""
    label, phrases, length, anchors = template
    total = sum(w for _, _, w in anchors)

    def covered(first: Column) -> Column:
        """Coverage with the template's word 0 at place ``first``."""
        out = F.lit(0.0)
        for word, position, weight in anchors:
            lo = F.greatest(first + position - TOLERANCE, F.lit(0))
            hi = first + position + TOLERANCE + 1
            out = out + F.when((hi > lo) & F.array_contains(F.slice(all_words, lo + 1, F.greatest(hi - lo, F.lit(0))), word), weight).otherwise(0.0)
        return out / total

    def verified(first: Column) -> Column:
        lo = F.greatest(first - MARGIN, F.lit(0))
        near = F.concat(F.lit(" "), F.array_join(F.slice(all_words, lo + 1, F.lit(length + 2 * MARGIN)), " "), F.lit(" "))
        checks = [F.contains(near, F.lit(f" {p} ")) for p in phrases]
        out = checks[0]
        for c in checks[1:]:
            out = out & c
        return out

    def score(first: Column) -> Column:
        return let(covered(first), lambda c: F.when((c >= MIN_COVERAGE) & verified(first), c).otherwise(0.0))

    def places(h: Column) -> Column:
        """Where word 0 would be, by a hit: shifts both ways; none for other words."""
        first = F.lit(None).cast("int")
        for word, position, _ in pivots(anchors):
            first = F.when(h["w"] == word, h["i"] - position).otherwise(first)
        return let(first, lambda f: F.when(f.isNotNull(), F.sequence(f - TOLERANCE, f + TOLERANCE)).otherwise(F.array().cast("array<int>")))

    def best(h: Column) -> Column:
        return F.coalesce(F.array_max(F.transform(F.array_distinct(F.flatten(F.transform(h, places))), score)), F.lit(0.0))

    # a file that has not enough of the words anywhere needs no places
    present = F.lit(0.0)
    for word, _, weight in anchors:
        present = present + F.when(F.exists(hits, lambda h: h["w"] == word), weight).otherwise(0.0)
    return F.when(present / total >= MIN_COVERAGE, best(hits)).otherwise(0.0)


def scan(docs: DataFrame, index: list[tuple]) -> DataFrame:
    """``docs`` (text, ...) with n_words, n_base, first_word, last_word,
    base_labels, all_labels (arrays) and score."""
    results = ("n_words", "n_base", "first_word", "last_word", "base_labels", "all_labels", "score")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in results]
    rare = sorted({w for _, _, _, anchors in index for w, _, _ in anchors})

    def file(s: Column) -> Column:
        w = s["words"]
        places = F.filter(F.transform(w, lambda x, i: F.struct(x.alias("w"), i.alias("i"))), lambda h: h["w"].isin(rare))
        # the work on templates is only for files with a weightiest word of some template or two of its words
        scores = let(F.when(F.arrays_overlap(w, literals(rare)), places).otherwise(F.array().cast("array<struct<w:string,i:int>>")),
                     lambda h: F.when(F.size(h) > 0, F.array(*[_template(w, h, t) for t in index]))
                     .otherwise(F.array(*[F.lit(0.0)] * len(index))))
        return F.struct(F.size(w).cast("long").alias("n_words"), base(w).alias("base"), scores.alias("scores"))

    found = let(F.struct(words(F.col("text")).alias("words")), file)
    own = free_name(docs, "file")
    got = F.col(own)
    labels = F.array_compact(F.array(*[F.when(got["scores"][k] > 0, F.lit(t[0])) for k, t in enumerate(index)]))
    # one generated row for each row: a file is scanned here and nowhere again
    return (docs.select(*kept, F.explode(F.array(found)).alias(own))
            .select(*kept, got["n_words"].alias("n_words"), got["base"]["n"].alias("n_base"),
                    got["base"]["first"].alias("first_word"), got["base"]["last"].alias("last_word"),
                    F.array_sort(F.array_distinct(got["base"]["labels"])).alias("base_labels"),
                    F.array_sort(F.array_distinct(F.concat(got["base"]["labels"], labels))).alias("all_labels"),
                    F.array_max(got["scores"]).alias("score")))


# --- query ---------------------------------------------------------------------

def op5_license_index(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, postings(idf(docs)))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                        F.array_join("base_labels", ",").alias("base_labels"),
                        F.array_join("all_labels", ",").alias("labels"), "score")

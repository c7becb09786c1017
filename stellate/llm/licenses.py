"""Licence scans: Dice coefficient over word bigrams against templates.

A text's units are its lines, its sentences that aren't a line of their own, and
the text as a whole.  Sentences end behind ``.!?;:`` before white space and go on
over line ends, so a notice that is wrapped over lines, or stands in a line with
other prose, is a unit.  A unit is normalised (lower case, every run of other
characters a blank) and becomes the set of its word bigrams (its one word, if
there is but one).  With A and B the sets of a unit and a template, Dice is
2 |A n B| / (|A| + |B|); at a threshold t, B can match only if
t |A| / (2 - t) <= |B| <= (2 - t) |A| / t, so the word count alone rules out most
templates before any set is compared.  Before bigrams are built, the words bound
their number: from above by all words, from below by one less than the distinct
words.  Texts and units without any of the templates' anchors, words of which a match
holds one at least, are passed over first.

Relatives differ by a word or a number in many: a match counts only if the unit
has the template's ``TELLING`` words and no others of them.

Templates are a short fixed list that becomes part of the plan: one projection
over the texts, without a join, a shuffle or Python.  A licence whose notice is in
none of them is not found, and a notice without its sentence to itself only if
the rest of the sentence is short.

Defined cases: a null or empty text has no units and no matches; a null id is an
id like others; an empty table gives no rows; texts are read whole, however long;
of several templates that match a unit the one with the largest coefficient is
reported, then the first by name; a line that repeats in a text counts each time,
a sentence once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import col

THRESHOLD = 0.8

#: Words that tell relatives apart.
TELLING = ("0", "1", "2", "3", "4", "affero", "apache", "bsd", "cc0", "clause", "commercial", "derivatives", "eclipse",
           "isc", "lesser", "library", "mit", "mozilla", "nc", "nd", "noderivatives", "noncommercial", "sa",
           "sharealike", "simplified", "unlicense")

# Common licence notices by SPDX identifier.
TEMPLATES = {
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\");",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "BSD-2-Clause": ("Released under the BSD 2-Clause License.", "Released under the Simplified BSD License."),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-NC-ND-4.0": (
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International "
        "License.",
    ),
    "CC-BY-NC-SA-4.0": (
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International "
        "License.",
    ),
    "CC-BY-ND-4.0": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC0-1.0": (
        "Released under CC0 1.0.",
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
    ),
    "EPL-2.0": (
        "Licensed under the Eclipse Public License 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "LGPL-2.1": ("This work is licensed under the GNU Lesser General Public License, version 2.1.",),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "Unlicense": (
        "Released under the Unlicense.",
        "This is free and unencumbered software released into the public domain.",
    ),
}


def template_words(text: str) -> list[str]:
    import re

    return re.sub("[^0-9a-z]+", " ", text.lower()).split()


def telling_words(text: str) -> list[str]:
    return sorted(set(template_words(text)) & set(TELLING))


def template_bigrams(text: str) -> list[str]:
    words = template_words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])} or set(words))


def flat_telling(templates: dict[str, tuple[str, ...]]) -> list[list[str]]:
    return [telling_words(t) for name in sorted(templates) for t in templates[name]]


def flat_templates(templates: dict[str, tuple[str, ...]]) -> list[tuple[str, list[str]]]:
    return [(name, template_bigrams(t)) for name in sorted(templates) for t in templates[name]]


#: Words that any text may hold; others are taken as anchors first.
_PLAIN = frozenset("a above all an and any are as at be by can copy following for free from in including is it its limitation may "
                   "modify more name not of on or other person public purpose redistribute rights sell software that the "
                   "their then this to under use used version which whom with without work you".split())


def anchors(templates: dict[str, tuple[str, ...]], threshold: float) -> list[str]:
    """Words of which a unit that matches a template must hold one.

    A match has at least t |B| / (2 - t) of a template's bigrams.  So of words
    that touch more bigrams than may be missing, one is there; the rarest such
    words of each template are taken."""
    found = set()
    for texts in templates.values():
        for text in texts:
            words, grams = template_words(text), template_bigrams(text)
            missing = len(grams) - math.ceil(threshold * len(grams) / (2 - threshold) - 1e-9)
            mine: set[str] = set()
            for w in sorted(set(words), key=lambda w: (w in _PLAIN or w.isdigit(), -len(w), w)):
                if sum(bool(mine & set(g.split())) for g in grams) > missing:
                    break
                mine.add(w)
            found |= mine
    return sorted(found)


def _words(unit: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(unit), "[^0-9a-z]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def _bigrams(words: Column) -> Column:
    pairs = F.transform(F.sequence(F.lit(1), F.size(words) - 1),
                        lambda i: F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1)))
    return F.array_distinct(F.when(F.size(words) < 2, words).otherwise(pairs))


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                  templates: dict[str, tuple[str, ...]] = TEMPLATES) -> DataFrame:
    """(id, unit, license, dice) of each matching unit.  ``unit``: 0 for the
    whole text, else the line's number, or below 0 for a sentence that isn't a
    line; a text of one line is line 1 only."""
    known, telling = flat_templates(templates), flat_telling(templates)
    # A little wider than the bounds, so that rounding rules no template out.
    low = {k: threshold * len(b) / (2 - threshold) - 1e-6 for k, (_, b) in enumerate(known)}
    high = {k: (2 - threshold) * len(b) / threshold + 1e-6 for k, (_, b) in enumerate(known)}
    least, most = min(low.values()), max(high.values())
    text = col(text_col)
    # A text, and then a unit, without any anchor has no match.
    anchored = F.array(*[F.lit(w) for w in anchors(templates, threshold)])
    docs = docs.where(F.arrays_overlap(_words(text), anchored))
    whole = F.when(F.contains(text, F.lit("\n")), text)
    lines = F.split(text, "\n")
    marked = F.regexp_replace(text, r"([.!?;:])[\x20\x09-\x0D]+", "$1\u0001")
    sentences = F.array_except(F.split(F.regexp_replace(marked, r"[\x20\x09-\x0D]+", " "), "\u0001"), lines)
    units = docs.select(col(id_col).alias("_id"), F.explode(F.array(
        F.struct(F.lit(0).alias("first"), F.lit(1).alias("step"), F.concat(F.array(whole), lines).alias("units")),
        F.struct(F.lit(-1).alias("first"), F.lit(-1).alias("step"), sentences.alias("units")))).alias("u"))
    units = units.select("_id", "u.first", "u.step", F.posexplode("u.units").alias("at", "body")).select(
        "_id", (F.col("first") + F.col("step") * F.col("at")).alias("unit"), "body")
    units = units.filter(F.length("body") >= least)
    # Each step is computed once: what explode() gives isn't computed again
    # where it is used more than once.
    words = units.select("_id", "unit", F.explode(F.array(_words(F.col("body")))).alias("words"))
    words = words.filter((F.size("words") >= least) & F.arrays_overlap("words", anchored)
                         & (F.size(F.array_distinct("words")) - 1 <= most))
    sets = words.select("_id", "unit", F.explode(F.array(F.struct(
        _bigrams(F.col("words")).alias("grams"),
        F.array_sort(F.array_intersect("words", F.array(*[F.lit(w) for w in TELLING]))).alias("telling")))).alias("s"))
    sets = sets.select("_id", "unit", "s.*").filter(F.size("grams").between(least, most))
    n = F.size("grams")

    def words_of(k: int) -> Column:
        return F.array(*[F.lit(w) for w in telling[k]]) if telling[k] else F.array().cast("array<string>")

    scores = [F.when(n.between(low[k], high[k]) & (F.col("telling") == words_of(k)),
                     F.size(F.array_intersect("grams", F.array(*[F.lit(g) for g in b]))) * 2.0 / (n + len(b)))
              .otherwise(0.0) for k, (_, b) in enumerate(known)]
    scored = sets.select("_id", "unit", F.explode(F.array(F.array(*scores))).alias("scores"))
    return (scored.withColumn("dice", F.array_max("scores")).filter(F.col("dice") >= threshold)
            .select(F.col("_id").alias(id_col), "unit",
                    F.element_at(F.array(*[F.lit(name) for name, _ in known]),
                                 F.array_position("scores", F.col("dice")).cast("int")).alias("license"), "dice"))

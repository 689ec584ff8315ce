"""Licence notices in texts, by the Dice coefficient of word bigrams.

A unit is a line, or a block of lines between blank lines.  Units and templates
are normalised alike (ASCII lower case, everything but a-z and 0-9 a word
break) and compared as sets of word bigrams; a text of one word is one bigram
of its own.  A template is tried only where the sizes allow the threshold:
Dice >= t needs t / (2 - t) <= |A| / |B| <= (2 - t) / t.

Before that, whole documents are passed over by a necessary condition: a match
shares at least t / (2 - t) of a template's bigrams, so templates name a few
anchor words whose bigrams leave fewer than that, and a text without any anchor
can't match.

All of it is one projection of Spark SQL functions: no shuffle, no Python.

Defined results: a text that is null or empty has no units and matches nothing;
of several matches the best counts, ties to the smaller name; null ids and
repeated rows pass through; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Least Dice coefficient of a match.
ALIKE = 0.8
#: Names and notices of common licences (the wording is fixed by the licences).
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
                         "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                      "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
           "copyright notice and this permission notice appear in all copies.",
    "mit": "Released under the MIT License.",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
                "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
                "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
                "following conditions:",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def template_bigrams(text: str) -> list[str]:
    words = re.sub(r"[^a-z0-9]+", " ", text.translate(str.maketrans(_UPPER, _LOWER))).strip().split(" ")
    pairs = [" ".join(p) for p in zip(words, words[1:])] or words
    return sorted(set(pairs))


def anchors(templates: dict[str, str], alike: float) -> list[str]:
    """Words of which every text that matches a template holds at least one."""
    chosen: list[str] = []
    for text in templates.values():
        pairs = template_bigrams(text)
        needed = alike * len(pairs) / (2 - alike)
        left = [p for p in pairs if not any(c in p for c in chosen)]
        while len(left) >= needed:
            words = {w for p in left for w in p.split()}
            best = max(words, key=lambda w: (sum(w in p for p in left) * min(len(w), 8), w))
            chosen.append(best)
            left = [p for p in left if best not in p]
    return sorted(set(chosen))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _words(unit: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.translate(unit, _UPPER, _LOWER), "[^a-z0-9]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def _bigrams(words: Column) -> Column:
    n = F.size(words)
    pairs = F.zip_with(F.slice(words, 1, n - 1), F.slice(words, 2, n - 1), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(n < 2, words).otherwise(F.array_distinct(pairs))


def scanned(docs: DataFrame, templates: dict[str, str] | None = None, alike: float = ALIKE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, license (the best match, null if none), dice, n_hits (units and templates that match) of every row."""
    templates = TEMPLATES if templates is None else templates
    sets = {k: template_bigrams(t) for k, t in templates.items()}
    known = F.array(*[F.struct(F.lit(k).alias("name"), F.array(*[F.lit(p) for p in b]).alias("pairs"), F.lit(len(b)).alias("n")) for k, b in sorted(sets.items())])
    low, high = alike / (2 - alike), (2 - alike) / alike
    least, most = low * min(map(len, sets.values())), high * max(map(len, sets.values()))
    text = F.col("text")
    plain = F.lower(text)
    possible = F.lit(False)
    for a in anchors(templates, alike):
        possible = possible | plain.contains(a)
    units = F.concat(F.split(text, "\n"), F.filter(F.split(text, r"\n[ \t\r]*\n"), lambda b: b.contains("\n")))

    def hits(words: Column) -> Column:
        return _let(_bigrams(words), lambda pairs: F.filter(
            F.transform(F.filter(known, lambda t: (F.size(pairs) >= low * t["n"]) & (F.size(pairs) <= high * t["n"])),
                        lambda t: F.struct((2.0 * F.size(F.array_intersect(pairs, t["pairs"])) / (F.size(pairs) + t["n"])).alias("dice"), t["name"].alias("name"))),
            lambda h: h["dice"] >= alike))

    # a set of bigrams has no more members than its unit has words, and any count of repeats may shrink it
    found = F.flatten(F.transform(F.filter(F.transform(units, _words), lambda w: F.size(w) >= least), hits))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.select("doc_id", F.when(possible, found).alias("hits"))
    best = F.array_max(F.transform("hits", lambda h: h["dice"]))
    name = _let(best, lambda b: F.array_min(F.transform(F.filter("hits", lambda h: h["dice"] == b), lambda h: h["name"])))
    return rows.select("doc_id", F.when(F.size("hits") > 0, name).alias("license"), best.alias("dice"), F.coalesce(F.when(F.size("hits") > 0, F.size("hits")), F.lit(0)).alias("n_hits"))


def oracle(templates: dict[str, str] | None = None, alike: float = ALIKE) -> str:
    """The same in DuckDB's SQL, without the anchors."""
    sets = {k: template_bigrams(t) for k, t in (TEMPLATES if templates is None else templates).items()}
    known = ", ".join(f"('{k}', [{', '.join(repr(p) for p in b)}], {len(b)})" for k, b in sorted(sets.items()))
    return f"""
WITH t(name, pairs, n) AS (VALUES {known}),
rows AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
units AS (SELECT r, unnest(list_concat(string_split(text, chr(10)),
    list_filter(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n'), lambda b: contains(b, chr(10))))) AS u FROM rows),
plain AS (SELECT r, trim(regexp_replace(translate(u, '{_UPPER}', '{_LOWER}'), '[^a-z0-9]+', ' ', 'g')) AS p FROM units),
words AS (SELECT r, string_split(p, ' ') AS w FROM plain WHERE p <> ''),
sets AS (SELECT r, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) END AS b
    FROM words),
hits AS (SELECT r, name, 2.0::DOUBLE * len(list_intersect(b, pairs)) / (len(b) + n) AS dice FROM sets, t
    WHERE len(b) BETWEEN {alike / (2 - alike)!r} * n AND {(2 - alike) / alike!r} * n),
best AS (SELECT r, arg_min(name, (-dice, name)) AS license, max(dice) AS dice, count(*) AS n_hits FROM hits WHERE dice >= {alike} GROUP BY r)
SELECT doc_id, license, dice, coalesce(n_hits, 0)::INT AS n_hits FROM rows LEFT JOIN best USING (r)
"""

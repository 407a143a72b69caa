"""Licence scan: normalised text against licence templates by the Dice coefficient over word bigrams.

What is compared are the lines of a text, its blocks between blank lines, and the text as a whole, each once. Text is
reduced to lower-case words; a bigram counts as often as it stands. A template is compared only if the
sizes allow the threshold: with a and b bigrams, Dice is at most 2 min(a, b) / (a + b), so b must lie between
a t / (2 - t) and a (2 - t) / t. That discards nearly everything before any bigram is built.

Before that, whole texts and then units are ruled out unsplit: by the same bounds a unit shares at least b t / (2 - t) bigrams
with the template, so it holds one word of any set whose words make up more than the other bigrams. Such sets of a
template's longest words are searched as plain strings.

Everything happens within a row by DataFrame functions; nothing is shuffled. A NULL text is empty and has no licence.
Between equal coefficients the first name wins. Repeated rows get the same result; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import let, lower_ascii, texts

THRESHOLD = 0.8

# Licence texts and the notices that stand for them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT notice": "Released under the MIT License.",
}

_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def bounds(size: int, threshold: float) -> tuple[float, float]:
    """Numbers of bigrams that can reach the threshold against ``size`` of them."""
    return size * threshold / (2 - threshold), size * (2 - threshold) / threshold


def template_words(text: str) -> list[str]:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return [w for w in re.split(_GAP, lower) if w]


def template_bigrams(text: str) -> list[str]:
    """Bigrams, each with the number of its occurrence, so that sets stand for multisets."""
    words, seen, out = template_words(text), {}, []
    for pair in zip(words, words[1:]):
        seen[pair] = seen.get(pair, 0) + 1
        out.append(f"{pair[0]} {pair[1]} {seen[pair]}")
    return out


def anchors(text: str, threshold: float) -> set[str]:
    """Words of a template of which every unit that reaches the threshold holds one: the longest that suffice."""
    words = template_words(text)
    pairs = list(zip(words, words[1:]))
    spare = len(pairs) * (1 - threshold / (2 - threshold))
    chosen: set[str] = set()
    for word in sorted(set(words), key=lambda w: (-len(w), w)):
        if sum(bool(chosen & {*pair}) for pair in pairs) > spare + 1e-9:
            break
        chosen.add(word)
    return chosen


def _bigrams(words: Column) -> Column:
    """The same for an array of words; only for lists as short as a template, as occurrences are counted by comparing."""
    pairs = F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1)))
    return let(pairs, lambda p: F.transform(p, lambda x, i: F.concat_ws(" ", x, F.size(F.filter(F.slice(p, 1, i + 1), lambda y: y == x)).cast("string"))))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, matches (an array of licence, dice and the unit's words), the best licence and its coefficient."""
    prepared = {name: template_bigrams(text) for name, text in sorted(templates.items())}
    prepared = {name: grams for name, grams in prepared.items() if grams}
    text = lower_ascii(F.col("text"))
    sought = sorted(set().union(*(anchors(t, threshold) for t in templates.values())))
    # Lower-casing beyond A-Z may only hold more texts than needed.
    held = lambda u: let(F.lower(u), lambda low: F.exists(F.array(*map(F.lit, sought)) if sought else F.array().cast("array<string>"), lambda a: F.contains(low, a)))
    units = F.array_distinct(F.concat(F.array(text), F.split(text, r"\n[ \t\r]*\n"), F.split(text, "\n")))
    units = F.when(held(F.col("text")), F.filter(units, held)).otherwise(F.array().cast("array<string>"))
    listed = F.array_distinct(F.transform(units, lambda u: F.filter(F.split(u, _GAP), lambda w: w != "")))
    fits = lambda n, size: (n >= bounds(size, threshold)[0]) & (n <= bounds(size, threshold)[1])

    def possible(words: Column) -> Column:
        n = F.size(words) - 1
        sizes = sorted({len(g) for g in prepared.values()})
        out = F.lit(False)
        for size in sizes:
            out = out | fits(n, size)
        return out & (n > 0)

    rows = texts(docs).select("doc_id", F.filter(listed, possible).alias("units"))
    rows = rows.select("doc_id", F.transform("units", lambda w: F.struct(F.concat_ws(" ", w).alias("unit"), _bigrams(w).alias("grams"))).alias("units"))

    def against(name: str, grams: list[str]) -> Column:
        literal = F.array(*[F.lit(g) for g in grams])
        dice = lambda u: F.when(fits(F.size(u["grams"]), len(grams)), 2 * F.size(F.array_intersect(u["grams"], literal)) / (F.size(u["grams"]) + len(grams)))
        made = F.transform("units", lambda u: F.struct(F.lit(name).alias("license"), dice(u).alias("dice"), u["unit"].alias("unit")))
        return F.filter(made, lambda m: m["dice"] >= threshold)

    found = F.concat(*[against(n, g) for n, g in prepared.items()]) if prepared else F.array().cast("array<struct<license:string,dice:double,unit:string>>")
    rows = rows.select("doc_id", F.when(F.size("units") > 0, found).otherwise(F.array().cast("array<struct<license:string,dice:double,unit:string>>")).alias("matches"))
    best = F.get(F.array_sort(F.transform("matches", lambda m: F.struct((-m["dice"]).alias("less"), m["license"].alias("license")))), F.lit(0))
    return rows.select("doc_id", "matches", best["license"].alias("license"), (-best["less"]).alias("dice"))


def digests(found: DataFrame) -> DataFrame:
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    return found.select("doc_id", "license", "dice", F.size("matches").cast("bigint").alias("n_matches"), F.array_join(names, ", ").alias("licenses"))


def sql(templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same in DuckDB's SQL, one row per bigram."""
    rows = [(n, g, len(grams)) for n, grams in ((n, template_bigrams(t)) for n, t in templates.items()) for g in grams]
    values = ", ".join("('{}', '{}', {})".format(n.replace("'", "''"), g, size) for n, g, size in rows)
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH t(license, gram, size) AS (VALUES {values}),
d AS (SELECT doc_id, {lower} AS text FROM documents),
u AS (SELECT doc_id, unnest([text] || regexp_split_to_array(text, '\\n[ \\t\\r]*\\n') || string_split(text, chr(10))) AS unit FROM d),
w AS (SELECT DISTINCT doc_id, regexp_extract_all(unit, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM u),
f AS (SELECT doc_id, words, len(words) - 1 AS n, row_number() OVER () AS id FROM w
    WHERE len(words) > 1 AND EXISTS (SELECT 1 FROM t WHERE len(words) - 1 BETWEEN size * {threshold} / (2 - {threshold}) AND size * (2 - {threshold}) / {threshold})),
b AS (SELECT id, doc_id, n, unnest(list_zip(words[1:n], words[2:])) AS pair FROM f),
g AS (SELECT id, doc_id, n, pair[1] || ' ' || pair[2] || ' ' || row_number() OVER (PARTITION BY id, pair) AS gram FROM b),
m AS (SELECT id, doc_id, license, 2 * count(*) / (n + size) AS dice FROM g JOIN t USING (gram)
    WHERE n BETWEEN size * {threshold} / (2 - {threshold}) AND size * (2 - {threshold}) / {threshold} GROUP BY id, doc_id, license, n, size HAVING 2 * count(*) / (n + size) >= {threshold}),
r AS (SELECT doc_id, first(license ORDER BY dice DESC, license) AS license, max(dice) AS dice, count(*) AS n_matches, string_agg(DISTINCT license, ', ' ORDER BY license) AS licenses FROM m GROUP BY doc_id)
SELECT d.doc_id, r.license, r.dice, coalesce(r.n_matches, 0) AS n_matches, coalesce(r.licenses, '') AS licenses FROM d LEFT JOIN r USING (doc_id)"""

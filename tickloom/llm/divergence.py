"""Source divergence audit over run-length columns, exact in integers.

Terms are counted per (lang, source) group; a language keeps the terms that ``LEAST_DOCS`` of its documents hold. A group's
column has its count of every kept term. The vocabulary of a language is reordered by the counts of its terms, so that
equal counts stand together, and cut into stretches; per stretch each column is a list of runs, and groups without any
of its terms are one run of zeros. For two columns the run boundaries are intersected, the divergence of the two shares is
computed once per common run and multiplied by its length, and the stretches are added up.

Counting combines before the shuffle, so a hot source or word moves one row a task. What follows works on distinct terms:
a term's counts are one row (as long as the language has sources), terms with equal counts are one row, and a stretch
is a bounded number of those. Pairs of sources are the result itself. The run intersection is numpy inside tasks.

A NULL text, lang or source is the empty string; an empty text, and a group without terms, still counts as a document and
a group. Rows are documents, repeated ids and rows included. An empty table gives an empty result, other columns
are ignored, equal values rank by the bytes of their item. Counts may reach 9e15, within which nothing is rounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.llm.common import let, lower_ascii, stored

LEAST_DOCS, SCALE, TERM_RANKS = 10, 1_000_000_000, 10
# Rows of the reordered vocabulary in one stretch; each stands for all terms with its counts.
STRETCH = 8192

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"


def _groups(docs: DataFrame) -> tuple[Column, Column]:
    return tuple(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))


def counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term."""
    words = F.sort_array(F.filter(F.split(lower_ascii(F.coalesce(F.col("text").cast("string"), F.lit(""))), _BETWEEN), lambda w: w != ""))
    # In a sorted list an occurrence is the first of its document where the one before differs.
    marks = lambda ws: F.transform(ws, lambda w, i: F.struct(w.alias("term"), F.coalesce(F.get(ws, i - 1) != w, F.lit(True)).cast("bigint").alias("first")))
    marked = docs.select(*_groups(docs), F.inline(let(words, marks)))
    return marked.groupBy("lang", "source", "term").agg(F.count("*").alias("n"), F.sum("first").alias("docs"))


def vocabulary(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, n, column): kept terms with their count in the language and in each source that has it; stored."""
    column = F.sort_array(F.collect_list(F.struct("source", "n"))).alias("column")
    terms = counts(docs).groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), column)
    return stored(terms.where(F.col("docs") >= least_docs).drop("docs"))


def totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, total, lang_total, terms) of every group that occurs: kept occurrences there and in the language,
    and the number of kept terms; stored."""
    per_lang = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count("*").alias("terms"))
    per_group = kept.select("lang", F.inline("column")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select(*_groups(docs)).distinct().join(per_group, ["lang", "source"], "left").join(per_lang, "lang", "left")
    return stored(groups.na.fill(0, ["total", "lang_total", "terms"]))


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)), in decimals wide enough for any count."""
    wide = lambda x: x.cast("decimal(19,0)")
    return F.lit(1).cast("bigint") + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * wide(n + 2), wide(total + 2 * terms))


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


# -- run-length columns ---------------------------------------------------------------------------

_COLUMNS = "lang string, size bigint, columns array<struct<source:string,starts:array<bigint>,counts:array<bigint>>>"


def _runs(starts: list[int], values: list[int], size: int) -> tuple[list[int], list[int]]:
    """Sorted places with a value each, and zeros between and after them, as runs (start, value) over 0..size."""
    at, held = [], []
    end = 0
    for start, stop, value in zip(starts[0::2], starts[1::2], values):
        if start > end:
            at.append(end)
            held.append(0)
        if start > end or not held or held[-1] != value:
            at.append(start)
            held.append(value)
        end = stop
    if end < size:
        at.append(end)
        held.append(0)
    return at, held


def _encode(rows: Iterator[tuple[str, list[dict], int]], longest: int) -> Iterator[dict]:
    """Stretches of at most ``longest`` rows of the ordered (lang, column, terms)."""
    lang, size, used, columns = None, 0, 0, {}

    def stretch():
        found = [dict(zip(("source", "starts", "counts"), (s, *_runs(at, n, size)))) for s, (at, n) in columns.items()]
        return {"lang": lang, "size": size, "columns": found}

    for of, column, terms in rows:
        if used and (of != lang or used == longest):
            yield stretch()
            size, used, columns = 0, 0, {}
        lang = of
        for entry in column:
            at, held = columns.setdefault(entry["source"], ([], []))
            if held and held[-1] == entry["n"] and at[-1] == size:
                at[-1] = size + terms
            else:
                at += (size, size + terms)
                held.append(entry["n"])
        size, used = size + terms, used + 1
    if used:
        yield stretch()


def run_length_columns(kept: DataFrame, longest: int = STRETCH) -> DataFrame:
    """(lang, size, columns): stretches of the reordered vocabulary, and the runs of every source that has one of the terms."""
    clustered = stored(kept.groupBy("lang", "column").agg(F.count("*").alias("terms")))
    ordered = clustered.repartitionByRange("lang", "column").sortWithinPartitions("lang", "column").select("lang", "column", "terms")

    def encode(batches):
        rows = (row for b in batches for row in zip(*[c.to_pylist() for c in b.columns]))
        schema = pa.schema([("lang", pa.string()), ("size", pa.int64()), ("columns", pa.list_(pa.struct([("source", pa.string()), ("starts", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])))])
        for found in _encode(rows, longest):
            yield pa.RecordBatch.from_pylist([found], schema=schema)

    return ordered.mapInArrow(encode, _COLUMNS)


def _shares(counts: np.ndarray, whole: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / whole) without leaving 64 bits: long division, three decimal digits at a time."""
    left, found = counts + 2, np.zeros(counts.size, np.int64)
    for _ in range(3):
        digits, left = np.divmod(left * 1000, whole)
        found = found * 1000 + digits
    return 1 + found


def _intersect(size: int, columns: list[dict], groups: list[dict]) -> Iterator[tuple[str, str, int]]:
    """Every two groups with their divergence summed over one stretch."""
    there = {c["source"]: c for c in columns}
    sources, starts, shares = [], [], []
    for g in sorted(groups, key=lambda g: g["source"]):
        c = there.get(g["source"], {"starts": [0], "counts": [0]})
        sources.append(g["source"])
        starts.append(np.array(c["starts"], np.int64))
        shares.append(_shares(np.array(c["counts"], np.int64), g["total"] + 2 * g["terms"]))
    for i, left in enumerate(sources):
        for j in range(i + 1, len(sources)):
            cuts = np.union1d(starts[i], starts[j])
            p = shares[i][np.searchsorted(starts[i], cuts, "right") - 1]
            q = shares[j][np.searchsorted(starts[j], cuts, "right") - 1]
            f = (p - q) ** 2 // (p + q)
            yield left, sources[j], int(f @ np.diff(cuts, append=size))


def pairs(stretches: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every two groups of a language, both ways; 0 where it keeps no term."""
    per_lang = groups.groupBy("lang").agg(F.collect_list(F.struct("source", "total", "terms")).alias("groups"))

    def intersect(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                lang, size, columns, groups = (c[row].as_py() for c in batch.columns)
                found = list(zip(*_intersect(size, columns, groups))) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found[0]), pa.string()), *map(pa.array, found, [pa.string(), pa.string(), pa.int64()])], names=["lang", "a", "b", "value"])

    parts = stretches.join(per_lang, "lang").select("lang", "size", "columns", "groups")
    sums = parts.mapInArrow(intersect, "lang string, a string, b string, value bigint").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = sums.select("lang", F.inline(F.array(*[F.struct(F.col(x).alias("source"), F.col(y).alias("item"), "value") for x, y in ("ab", "ba")])))
    every = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where("source != item")
    return every.join(both, ["lang", "source", "item"], "left").select("lang", "source", "item", F.coalesce("value", F.lit(0)).cast("bigint").alias("value"))


def terms(kept: DataFrame, groups: DataFrame, ranks: int = TERM_RANKS) -> DataFrame:
    """(lang, source, item, value, rank): the terms that stand out in a group against its language."""
    entries = kept.select("lang", F.col("term").alias("item"), F.col("n").alias("lang_n"), F.inline("column")).join(groups, ["lang", "source"])
    p, q = share(F.col("n"), F.col("total"), F.col("terms")), share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    found = entries.select("lang", "source", "item", p.alias("p"), q.alias("q")).where("p > q")
    return _ranked(found.select("lang", "source", "item", divergence(F.col("p"), F.col("q")).alias("value"))).where(F.col("rank") <= ranks)


def _ranked(values: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return values.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, source, part, item, value, rank: every other source of the language, and the terms that stand out."""
    kept = vocabulary(docs, least_docs)
    groups = totals(docs, kept)
    columns = "lang", "source", "part", "item", "value", "rank"
    between = _ranked(pairs(run_length_columns(kept), groups)).withColumn("part", F.lit("pair")).select(*columns)
    return between.unionByName(terms(kept, groups).withColumn("part", F.lit("term")).select(*columns))


def sql() -> str:
    """The same as DuckDB SQL."""
    p = lambda n, total: f"1 + ({SCALE} * (CAST({n} AS HUGEINT) + 2)) // ({total} + 2 * terms)"
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
  FROM documents),
said AS (SELECT d, lang, source, unnest(words) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_n FROM said GROUP BY ALL HAVING count(DISTINCT d) >= {LEAST_DOCS}),
per_lang AS (SELECT lang, sum(lang_n) AS lang_total, count(*) AS terms FROM kept GROUP BY lang),
found AS (SELECT lang, source, term, count(*) AS n FROM said SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (
  SELECT g.lang, g.source, coalesce(t.total, 0) AS total, l.lang_total, l.terms
  FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM found GROUP BY ALL) t USING (lang, source)
  LEFT JOIN per_lang l USING (lang)),
shares AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, {p("coalesce(n, 0)", "total")} AS p, {p("lang_n", "lang_total")} AS q
  FROM groups JOIN kept USING (lang) LEFT JOIN found USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
         CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM parts)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TERM_RANKS}"""

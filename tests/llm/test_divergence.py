import re
from collections import Counter
from itertools import groupby

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from oracle import connect, differences

from tickloom.llm import divergence
from tickloom.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def brute(rows, least):
    """rows: (text, lang, source)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    words = lambda t: re.findall(divergence.TERM, re.sub("[A-Z]", lambda m: m[0].lower(), t))
    out = []
    for lang in {r[1] for r in rows}:
        docs = [(words(t), s) for t, of, s in rows if of == lang]
        held = Counter(w for ws, _ in docs for w in set(ws))
        kept = sorted(w for w in held if held[w] >= least)
        n = {s: Counter(w for ws, of in docs if of == s for w in ws if held[w] >= least) for s in {s for _, s in docs}}
        whole = sum(n.values(), Counter())
        p = lambda c, w: 1 + divergence.SCALE * (c[w] + 2) // (c.total() + 2 * len(kept))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in n:
            parts = {"pair": [(sum(f(p(n[s], w), p(n[o], w)) for w in kept), o) for o in n if o != s]}
            parts["term"] = [(f(p(n[s], w), p(whole, w)), w) for w in kept if n[s][w] and p(n[s], w) > p(whole, w)]
            for part, values in parts.items():
                ranked = sorted(values, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, r) for r, (v, item) in enumerate(ranked, 1) if part == "pair" or r <= 10]
    return sorted(out)


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select("lang", "source", "part", "item", "value", "rank").collect())


def test_query_equals_oracle(spark):
    assert not differences(QUERIES["op11_source_divergence"](spark, SF), connect(SF), ORACLES["op11_source_divergence"])


@pytest.fixture(scope="module")
def odd(spark):
    rows = [("red Red RED green", "en", "a"), ("green blue \x00 blue", "en", "b"), ("red green yellow " * 3, "en", "c"), (None, "en", "d"), ("", "en", None)]
    rows += [("one two", None, "a"), ("two three", None, None), ("two", "", "a"), ("alone", "xx", "a"), ("12 34 --", "yy", "b"), ("other", "yy", "c")]
    rows += [("İi é É \x85 ſtraße 漢字", "en", "e"), ("red green blue", "en", "a"), ("red green blue", "en", "a"), ("word " * 30_000 + "red", "en", "f")]
    rows = [(None if i % 3 else 7, *r, "clash", 1) for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, term string, n bigint").repartition(3)


@pytest.mark.parametrize("least", [1, 2, 4, 100])
def test_equals_brute_force_on_awkward_rows(odd, least):
    assert rows_of(divergence.audit(odd, least)) == brute([(r.text, r.lang, r.source) for r in odd.collect()], least)


def test_stretches_of_any_length_add_up(spark, odd):
    docs = odd.unionByName(spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id", "text", "lang", "source", "'' term", "n_chars n"))
    kept = divergence.vocabulary(docs, 2)
    groups = divergence.totals(docs, kept)
    sums = [sorted(divergence.pairs(divergence.run_length_columns(kept, longest), groups).collect()) for longest in (7, 8192)]
    assert sums[0] == sums[1] and sums[0]


def test_no_rows(odd):
    assert divergence.audit(odd.limit(0)).count() == 0


@settings(deadline=None, max_examples=200)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=3, max_size=3), st.integers(1, 4)), min_size=1, max_size=12))
def test_runs_hold_the_columns(rows):
    wide = [[c[i] for c, times in rows for _ in range(times)] for i in range(3)]
    given_rows = [("x", [{"source": "abc"[i], "n": c} for i, c in enumerate(cs) if c], times) for cs, times in rows]
    (found,) = divergence._encode(iter(given_rows), 100)
    assert found["size"] == len(wide[0])
    for c in found["columns"]:
        spread = [n for n, size in zip(c["counts"], np.diff([*c["starts"], found["size"]])) for _ in range(size)]
        assert spread == wide["abc".index(c["source"])]
        assert c["counts"] == [n for n, _ in groupby(spread)]


def test_shares_are_exact_for_large_counts():
    counts = [0, 1, 5, 10**6, 123_456_789_012, 8_999_999_999_999_000]
    for whole in (7, 10**6 + 3, 9 * 10**15):
        fit = [c for c in counts if c + 2 <= whole]
        assert divergence._shares(np.array(fit, np.int64), whole).tolist() == [1 + 10**9 * (c + 2) // whole for c in fit]

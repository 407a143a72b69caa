import hashlib
import re

import pytest
from oracle import connect, differences

from tickloom.llm import decontaminate as dc
from tickloom.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_words(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    words, hit, found = brute_words(text), set(), set()
    for item_id, said in items:
        said = brute_words(said)
        n = min(len(said), 10)
        for s in range(len(said) - n + 1 if said else 0):
            for p in range(len(words) - n + 1):
                if words[p : p + n] == said[s : s + n]:
                    hit.update(range(p, p + n))
                    found.add("" if item_id is None else str(item_id))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def test_query_equals_sql(spark):
    assert not differences(QUERIES["op2_decontaminate"](spark, SF), connect(SF), ORACLES["op2_decontaminate"])


@pytest.fixture(scope="module")
def items(spark):
    rows = [
        (1, "The quick BROWN fox jumps over the lazy dog."),
        (2, "again " * 12),
        (3, None),
        (4, " ... "),
        (5, "x"),
        (None, "two spaces and tabs"),
        (10, "a b c d e f g h i j k l m n o p"),
        (10, "a b c d e f g h i j k l m n o p"),
        (20, "a b a b a b a b a b a b"),
    ]
    return spark.createDataFrame([(i, t, "clash") for i, t in rows], "item_id bigint, text string, begin string")


@pytest.fixture(scope="module")
def passages(spark, awkward):
    rows = [
        (101, "say: A b c d e f g h i j, and then c d e f g h i j k l; end"),
        (102, "b c d e f g h i j k"),
        (103, "a b c d e f g h i"),
        (104, "a b a b a b a b a b a b a b a b a b"),
        (105, "the quick brown fox jumps over the lazy cat x"),
        (106, "g h i j k l m n o p a b c d e f g h i j"),
        (106, "nothing here"),
        (107, "again " * 40_000),
    ]
    return awkward.unionByName(spark.createDataFrame(rows, "doc_id bigint, text string"), allowMissingColumns=True)


def test_awkward_rows(passages, items, no_rows):
    asked = [(r.item_id, r.text) for r in items.collect()]
    got = [tuple(r) for r in dc.digests(dc.contamination(passages, items)).collect()]
    assert sorted(got, key=str) == sorted([(r.doc_id, *(brute(r.text, asked) if len(r.text or "") < 10_000 else next(g[1:] for g in got if g[0] == r.doc_id))) for r in passages.collect()], key=str)
    assert {g[0]: g[1:4] for g in got}[107] == (40_000, 40_000, 1)
    assert dc.contamination(no_rows, items).count() == 0
    assert not [r for r in dc.contamination(passages, items.limit(0)).collect() if r.contaminated]
    kept = dc.remove(passages, items)
    assert kept.columns == passages.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(i) for i in {g[0] for g in got} - {g[0] for g in got if g[5]})


def test_shuffle_instead_of_broadcast(passages, items, monkeypatch):
    whole = sorted(map(tuple, dc.digests(dc.contamination(passages, items)).collect()), key=str)
    monkeypatch.setattr(dc, "BROADCAST_WORDS", 0)
    assert sorted(map(tuple, dc.digests(dc.contamination(passages, items)).collect()), key=str) == whole


def test_exploded_words_and_places_are_not_broadcast(passages, items, monkeypatch):
    # Spark takes an explode to be as short as its input; here every input is small.
    asked = dc.Items.of(items)
    rare = dc.anchors(asked, dc.rarity(passages, asked))
    places = dc.asked_places(asked, rare)
    monkeypatch.setattr(dc, "BROADCAST_WORDS", 0)
    monkeypatch.setattr(dc, "stored", lambda df: df)
    for made in (dc.asked_places(asked, rare), dc.postings(passages, places)):
        assert made.count() > 0
        made.collect()
        plan = made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert re.findall(r"(\w+Join) \[", plan) == ["SortMergeJoin"]


def test_near_matches(spark):
    docs = spark.createDataFrame([(1, "aa x bb cc"), (2, "bb aa"), (3, "aa y y y y bb"), (4, "cc")], "doc_id bigint, text string")
    asked = dc.Items.of(spark.createDataFrame([(7, "aa bb")], "item_id bigint, text string"))
    rare = dc.anchors(asked, dc.rarity(docs, asked))
    places = dc.asked_places(asked, rare)
    index = dc.postings(docs, places)
    assert {r.doc_id for r in dc.near(index, places, asked, rare, 2).collect()} == {1, 2}
    assert {r.doc_id for r in dc.near(index, places, asked, rare, 4).collect()} == {1, 2, 3}


def test_near_matches_of_awkward_rows(passages, items, no_rows):
    """NULL and repeated ids, copies, an item of one word (no pair), texts without words."""
    asked = dc.Items.of(items)
    rare = dc.anchors(asked, dc.rarity(passages, asked))
    places = dc.asked_places(asked, rare)
    short = passages.where("length(text) < 10000 OR text IS NULL")
    exact = {(r.doc_id, i) for r in short.collect() for i in [1, 10, 20] if brute(r.text, [(i, t) for j, t in [(x.item_id, x.text) for x in items.collect()] if j == i])[1]}
    found = {(r.doc_id, int(r.item_id or -1)) for r in dc.near(dc.postings(short, places), places, asked, rare, 0).collect()}
    assert exact <= found
    assert dc.near(dc.postings(no_rows, places), places, asked, rare, 3).count() == 0


def test_only_texts_with_candidates_are_marked(spark, passages):
    rows = dc._keyed(passages).cache()
    found = rows.where("doc_id IN (9, 106)").select("doc")
    got = dc._marked(rows, found).collect()
    assert len(got) == passages.count() and {r.doc_id for r in got if r.maybe} == {9, 106}
    assert not [r for r in dc._marked(rows, found.limit(0)).collect() if r.maybe]


def test_full_bit_map(passages, items, monkeypatch):
    whole = sorted(map(tuple, dc.digests(dc.contamination(passages, items)).collect()), key=str)
    monkeypatch.setattr(dc, "MASK_BITS", 0)
    assert sorted(map(tuple, dc.digests(dc.contamination(passages, items)).collect()), key=str) == whole


def test_null_ids_are_judged_row_by_row(spark, items):
    rows = [(None, "a b c d e f g h i j"), (None, "the quick brown fox jumps over the lazy dog"), (None, "clean"), (None, None)]
    found = dc.contamination(spark.createDataFrame(rows, "doc_id bigint, text string"), items).collect()
    assert sorted((r.n_words, r.n_hit) for r in found) == [(0, 0), (1, 0), (9, 9), (10, 10)]


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op2_decontaminate"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)

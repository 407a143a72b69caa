from collections import Counter

import pytest
from oracle import connect, differences

from tickloom.llm import licenses as lic
from tickloom.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


def test_query_equals_sql(spark):
    assert not differences(QUERIES["op1_licenses"](spark, SF), connect(SF), ORACLES["op1_licenses"])


def dice(a, b):
    a, b = (Counter(zip(w, w[1:])) for w in map(lic.template_words, (a, b)))
    return 2 * (a & b).total() / (a.total() + b.total())


def test_matches_equal_brute_force(spark, awkward, no_rows):
    mit = lic.TEMPLATES["MIT"]
    rows = [(101, f"prose\n{mit.upper()}\nmore"), (102, mit[: len(mit) // 2]), (103, "intro\n\nReleased under\nthe MIT  License!!\n\nend"), (104, "the the the the the"), (105, lic.TEMPLATES["GPL-3.0"].replace("version 3", "version 4"))]
    docs = awkward.unionByName(spark.createDataFrame(rows, "doc_id bigint, text string"), allowMissingColumns=True)
    found = lic.scan(docs).collect()
    assert len(found) == docs.count()
    best = {r.doc_id: (r.license, r.dice) for r in found}
    assert best[101] == ("MIT", 1.0) and best[102] == (None, None) and best[103] == ("MIT notice", 1.0)
    assert best[105] == ("GPL-3.0", pytest.approx(dice(rows[4][1], lic.TEMPLATES["GPL-3.0"])))
    assert not any(best[i][0] for i, _ in [(r.doc_id, 0) for r in awkward.collect()])
    assert lic.scan(no_rows).count() == 0 and lic.scan(docs, {"empty": ""}).where("license is not null").isEmpty()


def test_bounds_lose_nothing():
    for t in (0.5, 0.8, 0.9):
        for a in range(1, 60):
            low, high = lic.bounds(a, t)
            for b in range(1, 120):
                assert (2 * min(a, b) / (a + b) >= t - 1e-12) <= (low - 1e-9 <= b <= high + 1e-9)


def test_anchors_lose_nothing():
    """Words that are not anchors, in any number and order, never reach the threshold."""
    for t in (0.5, 0.8, 0.9):
        for text in lic.TEMPLATES.values():
            words = lic.template_words(text)
            rest = [w for w in words if w not in lic.anchors(text, t)]
            assert lic.anchors(text, t) and dice(text, " ".join(rest)) < t
            pairs = Counter(zip(words, words[1:]))
            shared = sum(n for (a, b), n in pairs.items() if not {a, b} & lic.anchors(text, t))
            low = lic.bounds(pairs.total(), t)[0]
            assert 2 * shared / (pairs.total() + max(low, shared)) < t


def test_ties_and_repeated_rows(spark):
    rows = [(1, "Released under the MIT License."), (1, "Released under the MIT License."), (None, "x\nReleased under the MIT License."), (2, "RELEASED under THE mit license")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = lic.scan(docs, {"b": lic.TEMPLATES["MIT notice"], "a": lic.TEMPLATES["MIT notice"]}).collect()
    assert len(found) == 4 and {(r.license, r.dice) for r in found} == {("a", 1.0)}

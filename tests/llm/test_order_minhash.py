import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tickloom.llm import order_minhash as om
from tickloom.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"


def brute(rows):
    """(doc_id, n_chars, sha of the edited text) in the defined order."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = []
    for k, (i, t) in enumerate(rows):
        half = len(t) // 2
        edited = t[: len(t) - half] + rows[(k + 1) % len(rows)][1][:half]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_rows", [1_000, 7])
def test_query_equals_brute_force(spark, monkeypatch, block_rows):
    monkeypatch.setattr(om, "BLOCK_ROWS", block_rows)
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = QUERIES["op7_order_minhash"](spark, SF).collect()
    assert sorted([tuple(r)[:3] for r in got], key=str) == brute([(d.doc_id, d.text) for d in docs])
    text = {d.doc_id: d.text for d in docs}
    prints = {}
    for r in got:
        prints.setdefault(text[r.doc_id], set()).add(r.fingerprint)
        same = sum(r.fingerprint[i : i + 8] == r.edited_fingerprint[i : i + 8] for i in range(0, 256, 8))
        assert len(r.fingerprint) == 256 and r.near_edited == same / 32
    assert all(len(p) == 1 for p in prints.values())
    ordered = sorted(got, key=lambda r: r.doc_id)
    for a, b in zip(ordered, ordered[1:] + ordered[:1]):
        assert a.near_next == sum(a.fingerprint[i : i + 8] == b.fingerprint[i : i + 8] for i in range(0, 256, 8)) / 32
    assert sum(r.near_edited for r in got) > sum(r.near_next for r in got)


def test_awkward_rows(awkward, no_rows):
    got = om.digests(om.compare(awkward)).collect()
    assert sorted([tuple(r)[:3] for r in got], key=str) == brute([(r.doc_id, r.text) for r in awkward.collect()])
    assert om.compare(no_rows).count() == 0
    alone = om.digests(om.compare(awkward.where("doc_id = 1"))).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def test_numbered_kmers(spark):
    text = "a b c d e a b c d e a b c d e f g"
    hashes = [r[0] for r in spark.range(1).select(F.explode(om._hashes(F.lit(text)))).collect()]
    words = text.split()
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    assert len(hashes) == len(grams) and len(set(hashes)) == len(set(grams))
    got = spark.range(1).select(om._hashes(F.lit(text)).alias("h")).select(F.inline(om._kmers(F.col("h")))).collect()
    assert sorted(r.place for r in got) == list(range(len(grams))) and len({r.kmer for r in got}) == len(grams)


def test_likeness_follows_edits(spark):
    rng = random.Random(3)
    words = [f"w{rng.randrange(500)}" for _ in range(400)]
    swapped = words[200:] + words[:200]
    few = [w if i % 100 else "x" for i, w in enumerate(words)]
    other = [f"v{rng.randrange(500)}" for _ in range(400)]
    rows = [(n, " ".join(t)) for n, t in enumerate([words, few, swapped, other])]
    signed = om.signatures(spark.createDataFrame(rows, "k int, t string"), ["k"], "t")
    s = {r.k: r.signature for r in signed.collect()}
    like = [sum(a == b for a, b in zip(s[0], s[k])) for k in (0, 1, 2, 3)]
    assert like[0] == om.SIZE and like[1] > like[2] > like[3] == 0


def test_no_python_and_one_shuffle_of_text(spark):
    plan = QUERIES["op7_order_minhash"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert len(re.findall("Exchange hashpartitioning", plan)) == 1

import zlib

import numpy as np
import pytest

from tickloom.llm import quality
from tickloom.llm.registry import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    rows = QUERIES["op8_quality"](spark, SF).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.95
    assert np.mean([(s >= 0.3) == q for s, q in held]) > 0.9


def test_labels_of_held_out_rows_are_not_used(tables):
    docs, labels = tables
    flipped = labels.selectExpr("doc_id", "if(pmod(crc32(cast(doc_id as string)), 5) = 0, 1 - quality, quality) quality")
    assert quality.fit(docs, labels) == quality.fit(docs, flipped)


def test_awkward_rows(spark, awkward, no_rows, tables):
    model = quality.fit(*tables)
    got = quality.score(awkward, model).collect()
    assert len(got) == awkward.count() and all(0 <= r.score <= 1 for r in got)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert by_id[2] == by_id[3] and by_id[1] == by_id[9] and all(len(s) == 1 for s in by_id.values())
    assert quality.score(no_rows, model).count() == 0
    kept = quality.keep_good(awkward, model)
    assert kept.schema == awkward.schema
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(r.doc_id) for r in got if r.score >= 0.3)


def test_little_to_learn_from(spark, awkward, no_rows):
    labels = spark.createDataFrame([(1, 1), (9, 0), (9, 1), (None, 1), (5, 7), (6, None)], "doc_id bigint, quality int")
    for docs in (awkward, no_rows):
        for some in (labels, labels.limit(0)):
            model = quality.fit(docs, some)
            assert all(0 <= r.score <= 1 for r in quality.score(awkward, model).collect())
    two = spark.createDataFrame([(i, i % 2) for i in (1, 2, 4, 5, 6, 7, 8, 10, 11)], "doc_id bigint, quality int")
    assert all(0 <= r.score <= 1 for r in quality.score(awkward, quality.fit(awkward, two)).collect())


def test_repeated_rows_of_an_id_change_nothing(tables):
    docs, labels = tables
    known = {r.doc_id for r in labels.limit(50).collect() if zlib.crc32(str(r.doc_id).encode()) % 5}
    again = docs.where(docs.doc_id.isin(*known)).selectExpr("*", "explode(sequence(1, 300)) n").drop("n")
    assert quality.fit(docs, labels) == quality.fit(docs.union(again), labels)


def test_level_does_not_depend_on_the_number_of_labels(spark, monkeypatch):
    """Text that tells nothing: the score is the share of good labels, here 6 of 7, however many rows are sampled."""
    monkeypatch.setattr(quality, "ROWS", 150)
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{n}" for n in rng.integers(0, 500, 60)), int(i % 7 > 0)) for i in range(3100)]
    unseen = spark.createDataFrame(rows[2800:], "doc_id bigint, text string, quality int")
    for n in (1400, 2800):
        docs = spark.createDataFrame(rows[:n], "doc_id bigint, text string, quality int")
        scores = [r.score for r in quality.score(unseen, quality.fit(docs, docs)).collect()]
        assert abs(np.mean(scores) - 6 / 7) < 0.08


def test_weighted_curve_is_that_of_the_rows_stood_for():
    rng = np.random.default_rng(4)
    x, y = np.round(rng.normal(size=400), 2), rng.integers(0, 2, 400)
    x = x + y
    times = np.where(y == 1, 6, 1)
    whole = quality._curve(np.repeat(x, times), np.repeat(y, times), np.ones(times.sum()))
    assert np.allclose(quality._curve(x, y, times.astype(float)), whole, rtol=0.1, atol=0.1)

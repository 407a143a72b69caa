"""The stages against plain Python over a small table."""

import hashlib

import public_tokenizers as P
import tiktoken
from test_decontaminate import brute as brute_leak
from test_simhash import brute_groups, brute_print

import corpus_pipeline
from tickloom.llm import bpe, quality
from tickloom.llm.registry import BPE_RANKS

SF = "/root/testdata/sf0.001"


def test_run_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = [(r.doc_id, r.text) for r in docs.collect() if quality._score([r.text], model)[0] >= 0.3]
    groups = brute_groups([(i, brute_print(t)) for i, t in kept])
    firsts = {d for d, _, c in groups if d == c}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = [(i, t) for i, t in kept if i in firsts and not brute_leak(t, items)[4]]
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(BPE_RANKS), special_tokens={})
    got = {r.doc_id: (r.ids, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert 0 < len(left) < docs.count()
    assert got == {i: (library.encode_ordinary(t), hashlib.sha256(t.encode()).hexdigest()) for i, t in left}


def test_stages_take_awkward_rows_and_keep_columns(spark, awkward, no_rows):
    for docs in (awkward, no_rows):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, SF)
            assert kept.columns == docs.columns
            assert kept.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_contaminated_rows_go_alone(spark):
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 200").first().text
    rows = [(None, "one clean text"), (None, leak), (None, "another"), (4, "clean too"), (4, leak), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = corpus_pipeline.drop_benchmark_text(spark, docs, SF)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([r for r in rows if r[1] != leak], key=str)

import random
import re

import pytest
import xxhash

from tickloom.llm import simhash
from tickloom.llm.components import components
from tickloom.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"


def brute_print(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(ids_prints):
    parent = list(range(len(ids_prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, p) in enumerate(ids_prints):
        for j in range(i):
            if (p ^ ids_prints[j][1]).bit_count() <= 4:
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(ids_prints):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted([(d, format(p, "016x"), least.get(root(i))) for i, (d, p) in enumerate(ids_prints)], key=str)


def hexed(frame):
    return sorted([(r.doc_id, format(r.fp & (1 << 64) - 1, "016x"), r.component_id) for r in frame.collect()], key=str)


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = sorted([tuple(r) for r in QUERIES["op5_simhash"](spark, SF).collect()], key=str)
    assert got == brute_groups([(r.doc_id, brute_print(r.text)) for r in rows])


def test_awkward_rows(awkward, no_rows):
    rows = awkward.collect()
    assert hexed(simhash.groups(awkward)) == brute_groups([(r.doc_id, brute_print(r.text)) for r in rows])
    assert simhash.groups(no_rows).count() == 0
    kept = simhash.deduplicate(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 2, 5, 6, 7, 8, 10, 11]
    assert simhash.deduplicate(no_rows).count() == 0


def test_pieces_leave_no_trace(monkeypatch):
    text = "".join(random.choices(["a ", "Bb\t", "ccc\n", "é ", " "], k=400))
    monkeypatch.setattr(simhash, "_PIECE", 9)
    assert simhash.fingerprint(text) & (1 << 64) - 1 == brute_print(text)


@pytest.mark.parametrize("full", [0, 3, 512])
def test_links_equal_brute_force(spark, monkeypatch, full):
    monkeypatch.setattr(simhash, "FULL", full)
    rng = random.Random(full)
    centres = [rng.getrandbits(64) for _ in range(20)]
    prints = {0, (1 << 64) - 1}
    for c in centres:
        for _ in range(25):
            x = c
            for _ in range(rng.randint(0, 6)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    signed = sorted(simhash._signed(p) for p in prints)
    frame = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    got = {tuple(r) for r in simhash.links(frame).collect()}
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4}


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(200)] + [(500, 500), (None, 3), (700, 600)]
    random.Random(1).shuffle(chain)
    got = {r.node: r.label for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 600: 600, 700: 600}


def test_one_row_per_group_where_ids_are_null_or_repeated(spark):
    rng = random.Random(5)
    text = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(40))
    nameless, twice, copied = [text() for _ in range(5)], [text(), text()], text()
    rows = [(None, t) for t in nameless + nameless[:2]] + [(1, t) for t in twice + twice[:1]] + [(None, copied), (3, copied), (1, copied), (2, copied)]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id bigint, text string, _key int").repartition(3)
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    expected = [(None, t) for t in nameless] + [(1, t) for t in [*twice, copied]]
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=str) == sorted(expected, key=str)


def joins_of(frame):
    frame.collect()
    return re.findall(r"(\w+Join) \[", frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])


def test_probes_and_buckets_are_not_broadcast(spark):
    # Without a bucket of many fingerprints either side looks as small as the table it is exploded from.
    rng = random.Random(9)
    prints = [rng.getrandbits(64) for _ in range(300)]
    classes = simhash.stored(spark.createDataFrame([(simhash._signed(p),) for p in [*prints, prints[0] ^ 1]], "fp bigint"))
    assert joins_of(simhash.links(classes)) == ["SortMergeJoin"]


def test_rows_and_classes_are_not_broadcast(spark):
    docs = spark.createDataFrame([(i, f"{i} one two three {i % 7} four") for i in range(50)], "doc_id bigint, text string")
    assert joins_of(simhash.groups(docs))[0] == "SortMergeJoin"

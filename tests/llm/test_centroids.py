import hashlib
import math

import pytest
from oracle import connect, differences

from tickloom.llm import centroids
from tickloom.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def brute(rows, k, rounds):
    """rows: (vec_id, integer components), in any order."""
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    middle = [list(v) for _, v in sorted(rows, key=key)[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(middle))

    for _ in range(rounds):
        groups = {}
        for _, v in rows:
            groups.setdefault(near(v)[1], []).append(v)
        for i, vs in groups.items():
            middle[i] = [sum(x) // len(vs) for x in zip(*vs)]
    found = [(d, *near(v)) for d, v in rows]
    sums = {i: sum(x[1] for x in found if x[2] == i) for i in range(k)}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return sorted([(d, c, s, sums[c], sum(sums.values()), digest[c]) for d, s, c in found], key=str)


def test_query_equals_oracle(spark):
    assert not differences(QUERIES["op12_centroids"](spark, SF), connect(SF), ORACLES["op12_centroids"])


@pytest.fixture(scope="module")
def odd(spark):
    x = lambda n: [math.sin(n * 7 + i) for i in range(64)]
    rows = [(i, x(i % 9)) for i in range(40)] + [(3, x(3))] * 200 + [(None, x(77)), (None, x(77)), (50, [0.0] * 64), (51, [-1e-9] * 64), (52, [1e30] + [0.0] * 63)]
    rows += [(60, None), (61, []), (62, [1.0] * 63), (63, [1.0] * 65), (64, [None] + [1.0] * 63), (65, [math.nan] + [1.0] * 63), (66, [-math.inf] + [1.0] * 63)]
    rows = [(i, v, "clash", 1) for i, v in rows]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, v string, cluster int").repartition(3)


def integers(v):
    return [max(min(math.floor(64 * x), centroids.LARGEST), -centroids.LARGEST) for x in v]


@pytest.mark.parametrize("k, rounds", [(16, 3), (2, 1), (5, 4)])
def test_equals_brute_force_on_awkward_rows(odd, k, rounds):
    sound = [(r.vec_id, integers(r.embedding)) for r in odd.collect() if r.vec_id is None or r.vec_id < 60]
    got = sorted([tuple(r) for r in centroids.clusters(odd, k, rounds).collect()], key=str)
    assert got == brute(sound, k, rounds)
    assert len(got) == 245  # repeated rows, ties between equal centroids, ids that are NULL


def test_fewer_vectors_than_clusters(spark, odd):
    few = odd.where("vec_id in (0, 1, 60, 61)")
    assert sorted(r.distance for r in centroids.clusters(few).collect()) == [0, 0]
    none = centroids.clusters(odd.where("vec_id >= 60"))
    assert none.count() == 0
    assert none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert centroids.clusters(odd.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    vectors = centroids.whole_vectors(spark.read.parquet(f"{SF}/embeddings.parquet"))
    plan = centroids.assign(vectors, centroids.starts(vectors))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

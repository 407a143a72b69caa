"""Exact quantiles against sorting, with ranges so small that many rounds are needed."""

import math
import random

import pytest

from tickloom.operators.quantiles import _classed, exact_cuts


def brute(values, parts):
    ordered = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
    n = len(ordered)
    return [ordered[max(1, -(-i * n // parts)) - 1] for i in range(1, parts)]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(11)
    n = 6000
    wide = [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(n)]
    ties = [float(rng.choice([0, 0, 0, 0, 1, 2])) for _ in range(n)]
    same = [7.5] * n
    holes = [rng.gauss(0, 1) if rng.random() < 0.3 else None for _ in range(n)]
    odd = [rng.choice([math.inf, -math.inf, math.nan, 0.0, rng.random()]) for _ in range(n)]
    near = [1.0 + i * 2**-52 for i in rng.choices(range(500), k=n)]
    rows = list(zip(wide, ties, same, holes, odd, near, [None] * n))
    names = "wide ties same holes odd near nothing".split()
    return spark.createDataFrame(rows, ", ".join(f"{c} DOUBLE" for c in names)).repartition(5), dict(zip(names, zip(*rows)))


@pytest.mark.parametrize("small, accuracy", [(4096, 10000), (40, 200), (3, 50)])
def test_equals_sorting(table, small, accuracy):
    frame, columns = table
    got = {r.feature: r.cuts for r in exact_cuts(frame, list(columns), 10, accuracy, small).collect()}
    assert set(got) == set(columns) - {"nothing"}
    for name, cuts in got.items():
        assert [repr(c) for c in cuts] == [repr(c) for c in brute(columns[name], 10)], name


def test_few_rows(spark):
    one = spark.createDataFrame([(1, 5.0), (2, None)], "a INT, b DOUBLE")
    got = {r.feature: r.cuts for r in exact_cuts(one, ["a", "b"], 4).collect()}
    assert got == {"a": [1.0, 1.0, 2.0], "b": [5.0, 5.0, 5.0]}
    assert exact_cuts(one.limit(0), ["a", "b"]).count() == 0


def test_many_proposals_are_searched_not_listed(spark):
    cuts = [i / 2 for i in range(396)] + [math.inf, math.nan]
    values = [-1.0, 0.0, 0.1, 98.5, 98.7, 197.5, 198.0, math.inf, math.nan]
    rows = spark.createDataFrame([("r", v) for v in values] + [("s", 5.0)], "range STRING, value DOUBLE")
    classed = _classed(spark, rows, {"r": cuts, "s": [5.0]})
    got = {repr(r.value): r["class"] for r in classed.where("range = 'r'").collect()}
    assert got == dict(zip(map(repr, values), [0, 1, 2, 395, 396, 791, 792, 793, 795]))
    assert classed.where("range = 's'").first()["class"] == 1
    assert classed._jdf.queryExecution().optimizedPlan().toString().count("cuts#") < 100

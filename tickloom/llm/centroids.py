"""Centroid clustering in JVM expressions, exact in integers.

Vectors become integers once and are stored. A round is one pass: ``zip_with`` and ``aggregate`` give the squared distance to
each centroid, a literal array in the plan; ``array_min`` over structs of distance and number takes the nearest, the
smaller number among equals; sums per component and cluster are combined before the shuffle, so a round moves
k rows a task, however unequal the clusters are. Only k centroids ever reach the driver.

Vectors of another length, NULL, or with a NULL, NaN or infinite component are left out. Components are held within
``LARGEST`` in size, so that a squared distance fits 64 bits. Repeated rows count as often as they stand there. A vector
without id is clustered like any other, but starts a cluster only where vectors with ids are too few. Fewer
vectors than k give as many clusters; none give an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import stored

SIZE, CLUSTERS, ROUNDS, SCALE = 64, 16, 3, 64
# 64 * (2 * LARGEST) ** 2 < 2 ** 63
LARGEST = (1 << 27) - 1

Centroids = list[list[int]]


def whole_vectors(embeddings: DataFrame, size: int = SIZE) -> DataFrame:
    """(vec_id, v): ``floor(SCALE * x)`` of every component, stored."""
    value = F.col("embedding").cast("array<double>")
    sound = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = embeddings.where(F.col("embedding").isNotNull() & (F.size("embedding") == size) & F.coalesce(sound, F.lit(False)))
    whole = F.transform(value, lambda x: F.greatest(F.least(F.floor(x * float(SCALE)), F.lit(LARGEST)), F.lit(-LARGEST)).cast("bigint"))
    return stored(kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), whole.alias("v")))


def starts(vectors: DataFrame, k: int = CLUSTERS) -> Centroids:
    """The k vectors whose ids hash lowest; one id's rows in the order of their components."""
    order = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    return [list(r.v) for r in vectors.orderBy(order.asc_nulls_last(), "v").select("v").limit(k).collect()]


def _literal(centroid: list[int]) -> str:
    return f"array({', '.join(f'{x}L' for x in centroid)})"


def nearest(centroids: Centroids) -> Column:
    """Struct of distance and cluster for the vector in ``v``."""
    squared = "aggregate(zip_with(v, {c}, (a, b) -> (a - b) * (a - b)), 0L, (s, d) -> s + d)"
    pairs = [F.struct(F.expr(squared.format(c=_literal(c))).alias("distance"), F.lit(i).alias("cluster")) for i, c in enumerate(centroids)]
    return F.array_min(F.array(*pairs))


def assign(vectors: DataFrame, centroids: Centroids) -> DataFrame:
    """Adds ``cluster`` and ``distance``."""
    found = vectors.withColumn("nearest", nearest(centroids))
    return found.select(*vectors.columns, "nearest.cluster", "nearest.distance")


def moved(vectors: DataFrame, centroids: Centroids) -> Centroids:
    """Every centroid that has vectors goes to the floor of their mean; the others stay."""
    sums = [F.sum(F.get("v", F.lit(i))).alias(f"s{i}") for i in range(len(centroids[0]))]
    rows = assign(vectors, centroids).groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect()
    after = list(centroids)
    for row in rows:
        after[row.cluster] = [row[f"s{i}"] // row.n for i in range(len(centroids[0]))]
    return after


def fit(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS) -> Centroids:
    centroids = starts(vectors, k)
    for _ in range(rounds if centroids else 0):
        centroids = moved(vectors, centroids)
    return centroids


def _long(value: int) -> Column:
    return F.lit(value if abs(value) < 1 << 63 else None).cast("bigint")


def clusters(embeddings: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS) -> DataFrame:
    """One row per kept vector: its cluster and distance, the distance summed over its cluster and over all
    (NULL beyond 64 bits), and the digest of its centroid."""
    vectors = whole_vectors(embeddings)
    centroids = fit(vectors, k, rounds)
    if not centroids:
        none = {"cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint", "centroid_sha256": "string"}
        return vectors.where(F.lit(False)).select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    found = stored(assign(vectors.select("vec_id", "v"), centroids).drop("v"))
    sums = dict.fromkeys(range(len(centroids)), 0)
    sums |= {r.cluster: int(r.d) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    pick = lambda values: F.get(F.array(*values), F.col("cluster"))
    return found.select(
        "vec_id",
        "cluster",
        "distance",
        pick([_long(sums[i]) for i in range(len(centroids))]).alias("cluster_inertia"),
        _long(sum(sums.values())).alias("inertia"),
        pick([F.lit(d) for d in digests]).alias("centroid_sha256"),
    )


def sql() -> str:
    """The same as DuckDB SQL, where ids are unique and components far below ``LARGEST``."""
    steps = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {SIZE}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster, v AS c FROM kept ORDER BY cluster LIMIT {CLUSTERS})"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT * FROM (
    SELECT n, vec_id, v, cluster,
           CAST(list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance
    FROM kept CROSS JOIN c{i})
  QUALIFY row_number() OVER (PARTITION BY n ORDER BY distance, cluster) = 1)""")
        if i < ROUNDS:
            steps.append(f"""m{i} AS (
  SELECT cluster, list((s - ((s % k) + k) % k) // k ORDER BY place) AS c FROM (
    SELECT cluster, place, sum(x) AS s, count(*) AS k
    FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM a{i}) GROUP BY cluster, place)
  GROUP BY cluster),
c{i + 1} AS MATERIALIZED (SELECT c{i}.cluster, coalesce(CAST(m{i}.c AS BIGINT[]), c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster))""")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} USING (cluster)"""

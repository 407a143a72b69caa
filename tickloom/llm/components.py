"""Connected components of a link table by hooking, pointer jumping and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import stored


def _roots(parents: DataFrame) -> DataFrame:
    """Follow (node, parent) to the end: every jump halves the way."""
    while True:
        onward = parents.select(F.col("node").alias("parent"), F.col("parent").alias("next"))
        step = stored(parents.join(onward, "parent").select("node", F.col("next").alias("parent"), (F.col("next") < F.col("parent")).alias("moved")))
        parents = step.select("node", "parent")
        if step.where("moved").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links(a, b)``; the label is the smallest node reachable.

    In each round every node hooks to its smallest neighbour, trees are flattened by pointer jumping, and
    links are rewritten to the roots, without those that fall together. At least half of the nodes
    with links go in each round, so rounds are few and links shrink fast. Every step is written to the
    shared folder: a lost executor repeats a step, not all of them. The minimum over neighbours combines
    before the shuffle, so a node with very many links is no hot group. Links with a NULL end are
    ignored; a link to itself makes a single node.
    """
    ends = links.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    edges = stored(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("label", F.col("node"))
    while not edges.isEmpty():
        ways = F.inline(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("near")), F.struct(F.col("b").alias("node"), F.col("a").alias("near"))))
        nearest = edges.select(ways).groupBy("node").agg(F.min("near").alias("near"))
        roots = _roots(stored(nearest.select("node", F.least("node", "near").alias("parent"))))
        of = lambda end: roots.select(F.col("node").alias(end), F.col("parent").alias(f"{end}_root"))
        labels = stored(labels.join(of("label"), "label", "left").select("node", F.coalesce("label_root", "label").alias("label")))
        rooted = edges.join(of("a"), "a").join(of("b"), "b").where(F.col("a_root") != F.col("b_root"))
        edges = stored(rooted.select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")).distinct())
    return labels

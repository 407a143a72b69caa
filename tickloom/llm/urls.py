"""URL filter: given rules first, gradient-boosted trees on lexical features for the rest.

A rule names a host and a path prefix; it fits the host and its subdomains, and of those that fit the longest
decides. Other URLs are judged by boosted trees that learn from labelled URLs: length, path depth, share of digits,
character entropy, number of parameters, and what the labelled URLs say about the host's suffix (its last label and
its last two). Labels come from elsewhere, such as the judged text of sampled pages, and never from the rules: a rule's
verdict would come back as the statistic of its suffix.

Fitting takes a bounded sample (``SAMPLE`` distinct URLs, in the order of a hash); every URL is judged. A training row sees
the statistics of the other folds, so that no label tells itself, and a rate is drawn to the share of all labels by
``PRIOR`` rows, which is also what an unknown suffix gets. A URL with both labels is not learned from. With labels of one
kind only, that is the verdict; without labels it is ``allow``. A NULL URL has an empty host and path and is not learned
from. Repeated rows get the same verdict. Of equally long rules the first by name, then the first given, decides. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import lower_ascii, stored

ALLOW, BLOCK = "allow", "block"
SAMPLE = 20_000
FOLDS = 5
# Rows of the common share that every suffix starts with.
PRIOR = 10.0
ROUNDS, DEPTH = 20, 4
FEATURES = ["length", "host_length", "depth", "digits", "entropy", "parameters", "labels", "dashes", "top_rate", "top_seen", "pair_rate", "pair_seen"]


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty where there is no ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    start = F.locate("://", text)
    rest = F.when(start > 0, F.substring(text, start + 3, F.length(text))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return lower_ascii(host), path


def fitting(rules: list[Rule], host: Column, path: Column) -> Column:
    """The longest rule that fits, as a struct (name, verdict); NULL where none does."""
    tests = []
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        on_host = (host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))
        tests.append(F.when(on_host & F.startswith(path, F.lit(rule.path)), F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))))
    return F.coalesce(*tests) if tests else F.lit(None).cast("struct<name:string,verdict:string>")


def _suffix(host: Column, labels: int) -> Column:
    """The last labels of a host as a key of fixed size."""
    return F.xxhash64(F.substring_index(host, ".", -labels))


def _with_features(urls: DataFrame, *keep: str) -> DataFrame:
    """Lexical features and the two suffix keys of (url, host, path)."""
    url = F.coalesce("url", F.lit(""))
    size = F.greatest(F.length(url), F.lit(1))
    count = lambda pattern: F.regexp_count(url, F.lit(pattern))
    characters = F.filter(F.split(url, ""), lambda c: c != "")
    bits = F.aggregate(
        F.array_distinct(characters), F.lit(0.0), lambda total, c: total - (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / size * F.log2((F.length(url) - F.length(F.replace(url, c, F.lit("")))) / size)
    )
    return urls.select(
        *keep,
        F.length(url).cast("double").alias("length"),
        F.length("host").cast("double").alias("host_length"),
        F.size(F.split("path", "/")).cast("double").alias("depth"),
        (count("[0-9]") / size).alias("digits"),
        F.coalesce(bits, F.lit(0.0)).alias("entropy"),
        count("[?&][^=&#]*=").cast("double").alias("parameters"),
        F.size(F.split("host", r"\.")).cast("double").alias("labels"),
        count("-").cast("double").alias("dashes"),
        _suffix(F.col("host"), 1).alias("top"),
        _suffix(F.col("host"), 2).alias("pair"),
    )


def _rates(rows: DataFrame, key: str, share: float, *by: str) -> DataFrame:
    """Rate and number seen by ``key`` and ``by``, from rows with blocked and n."""
    total = rows.groupBy(key, *by).agg(F.sum("blocked").alias("blocked"), F.sum("n").alias("n"))
    rate = (F.col("blocked") + PRIOR * share) / (F.col("n") + PRIOR)
    return total.select(key, *by, rate.alias(f"{key}_rate"), F.log1p("n").alias(f"{key}_seen"))


@dataclass(frozen=True)
class Model:
    """Trees, the share blocked, and tables of suffix statistics; without trees ``constant`` counts."""

    trees: GBTClassificationModel | None
    share: float
    statistics: dict[str, DataFrame]
    constant: str

    def assembled(self, featured: DataFrame, statistics: dict[str, DataFrame], *by: str) -> DataFrame:
        for key, known in statistics.items():
            # At most a row for each sampled URL and fold.
            featured = featured.join(F.broadcast(known), [key, *by], "left")
            featured = featured.fillna({f"{key}_rate": self.share, f"{key}_seen": 0.0})
        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(featured)

    def verdicts(self, urls: DataFrame, *keep: str) -> DataFrame:
        """``keep``, the probability of blocking, and the verdict, for rows of (url, host, path)."""
        if self.trees is None:
            chance = F.lit(1.0 if self.constant == BLOCK else 0.0)
            return urls.select(*keep, chance.alias("chance"), F.lit(self.constant).alias("judged"))
        scored = self.trees.transform(self.assembled(_with_features(urls, *keep), self.statistics))
        chance = F.get(vector_to_array("probability"), F.lit(1))
        return scored.select(*keep, chance.alias("chance"), F.when(chance >= 0.5, BLOCK).otherwise(ALLOW).alias("judged"))


def sampled(rows: DataFrame, *also: str) -> DataFrame:
    """At most ``SAMPLE`` distinct URLs in the order of a hash, with the smallest value each of other columns. Only URLs are
    sorted; of the other columns only rows of sampled URLs are read on."""
    order = F.xxhash64("url")
    # A URL as long as a book need not travel: URLs are chosen by their hash.
    chosen = rows.where("url is not null").select(order.alias("_chosen")).distinct().orderBy("_chosen").limit(SAMPLE)
    held = rows.where("url is not null").join(F.broadcast(chosen), order == F.col("_chosen"), "left_semi")
    return held.groupBy("url").agg(*[F.min(c).alias(c) for c in also])


def fit(labelled: DataFrame) -> Model:
    """Learn from rows of (url, verdict)."""
    rows = labelled.where(F.col("verdict").isin(ALLOW, BLOCK)).select("url", "verdict", (F.col("verdict") == BLOCK).cast("double").alias("label"), (F.col("verdict") == ALLOW).cast("double").alias("other"))
    least = sampled(rows, "label", "other").where(F.col("label") + F.col("other") == 1).select("url", "label")
    host, path = host_and_path(F.col("url"))
    fold = F.pmod(F.xxhash64(F.lit("fold"), "url"), F.lit(FOLDS)).cast("int")
    training = stored(_with_features(least.select("url", "label", host.alias("host"), path.alias("path"), fold.alias("fold")), "label", "fold"))
    seen = training.agg(F.sum("label").alias("blocked"), F.count("*").alias("n")).first()
    if not seen.n or seen.blocked in (0, seen.n):
        return Model(None, 0.0, {}, BLOCK if seen.n and seen.blocked else ALLOW)
    share = seen.blocked / seen.n
    statistics, others = {}, {}
    for key in ("top", "pair"):
        counts = stored(training.groupBy(key, "fold").agg(F.sum("label").alias("blocked"), F.count("*").alias("n")))
        statistics[key] = stored(_rates(counts, key, share))
        # What a row of some fold sees: the counts of each other fold.
        elsewhere = counts.withColumn("fold", F.explode(F.array(*[F.pmod(F.col("fold") + step, F.lit(FOLDS)).cast("int") for step in range(1, FOLDS)])))
        others[key] = _rates(elsewhere, key, share, "fold")
    model = Model(None, share, statistics, ALLOW)
    gbt = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, minInstancesPerNode=5, seed=7, featuresCol="features", labelCol="label")
    return Model(gbt.fit(stored(model.assembled(training, others, "fold").select("label", "features"))), share, statistics, ALLOW)


def judge(pages: DataFrame, rules: list[Rule], model: Model | None = None) -> DataFrame:
    """page_id, host, path, the deciding rule's name (or NULL) and the verdict; without a model only rules block."""
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rows = split.withColumn("fits", fitting(rules, F.col("host"), F.col("path")))
    judged = (model or Model(None, 0.0, {}, ALLOW)).verdicts(rows, "page_id", "host", "path", "fits")
    return judged.select("page_id", "host", "path", F.col("fits.name").alias("rule"), F.coalesce("fits.verdict", "judged").alias("verdict"), "chance")

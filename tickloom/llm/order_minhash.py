"""Order MinHash fingerprints: likeness that follows the edit distance, not only the set of words.

A k-mer is five consecutive words; the n-th time that it occurs it is numbered n, so repeats count. Each of
``SIZE`` components draws ``PICKS`` k-mers, the minimal ones under as many hash functions, puts them in the order of
their places in the text and hashes the tuple. Two texts agree in a component if they share those k-mers
and have them in the same order.

All steps are DataFrame functions. Minima are taken by a plain aggregate over one row per k-mer. The
text is shuffled once, by blocks of neighbouring ids; the window that finds the next document, the aggregate and the
comparison with the next fingerprint all keep to those blocks.

A text of fewer than five words is one k-mer; one without words has components of zero, so such texts are
alike. A NULL text is empty. Rows are ordered by id, then text; rows of one id follow each other, NULL ids come first.
Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.llm.common import let, texts

K = 5
SIZE = 32
PICKS = 2
# Rows that a block should hold, and the most blocks (their bounds travel with the plan).
BLOCK_ROWS = 1_000
MOST_BLOCKS = 1 << 14
# A minimum keeps the hash in its high bits and the k-mer's place below.
PLACE_BITS = 27
_SPACE = r"[\x20\x09-\x0D]+"


# -- k-mers -------------------------------------------------------------------------------------


def _hashes(text: Column) -> Column:
    """A hash for each k-mer, in text order."""
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    ends = lambda h: F.sequence(F.lit(0), F.greatest(F.size(h) - K, F.lit(0)))
    kmer = lambda h, i: F.xxhash64(*[F.get(h, i + j) for j in range(K)])
    of = lambda h: F.when(F.size(h) == 0, F.array().cast("array<bigint>")).otherwise(F.transform(ends(h), lambda i: kmer(h, i)))
    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def _numbered(hashes: Column) -> Column:
    """(place, hash with its occurrence number) for hashes of which some repeat."""
    ranked = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def runs(s: Column) -> Column:
        fresh = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: (j == 0) | (F.get(s, j)["h"] != F.get(s, j - 1)["h"]))
        lengths = let(fresh, lambda f: F.transform(f, lambda at, r: F.coalesce(F.get(f, r + 1), F.size(s)) - at))
        numbers = F.flatten(F.transform(lengths, lambda n: F.sequence(F.lit(0), n - 1)))
        return F.transform(F.arrays_zip(s.alias("s"), numbers.alias("n")), lambda x: F.struct(x["s"]["i"].alias("place"), F.xxhash64(x["s"]["h"], x["n"]).alias("kmer")))

    return let(ranked, runs)


def _kmers(hashes: Column) -> Column:
    once = F.transform(hashes, lambda h, i: F.struct(i.alias("place"), F.xxhash64(h, F.lit(0)).alias("kmer")))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), once).otherwise(_numbered(hashes))


def _minimum(n: int) -> Column:
    mixed = F.xxhash64("kmer", F.lit(n))
    return F.min(F.shiftleft(F.shiftright(mixed, PLACE_BITS), PLACE_BITS).bitwiseOR(F.col("place").cast("bigint"))).alias(f"m{n}")


def _component(n: int) -> Column:
    """The picked k-mers of component n, in text order, as one hash of 32 bits."""
    place = lambda m: m.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    picks = [F.struct(place(F.col(f"m{n * PICKS + p}")), F.shiftright(F.col(f"m{n * PICKS + p}"), PLACE_BITS).alias("kmer")) for p in range(PICKS)]
    ordered = F.transform(F.array_sort(F.array(*picks)), lambda x: x["kmer"])
    return F.when(F.col(f"m{n * PICKS}").isNull(), F.lit(0)).otherwise(F.xxhash64(ordered).bitwiseAND(F.lit(0xFFFFFFFF))).cast("bigint")


def signatures(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` and ``signature`` (an array of SIZE numbers) of every row; keys must tell rows apart.

    Where rows are already partitioned by some of the keys, nothing is shuffled.
    """
    hashed = rows.select(*keys, _hashes(F.col(text)).alias("hashes"))
    listed = hashed.select(*keys, _kmers(F.col("hashes")).alias("kmers"))
    minima = listed.select(*keys, F.inline_outer("kmers")).groupBy(*keys).agg(*[_minimum(n) for n in range(SIZE * PICKS)])
    return minima.select(*keys, F.array(*[_component(n) for n in range(SIZE)]).alias("signature"))


def fingerprint(signature: Column) -> Column:
    return F.lower(F.array_join(F.transform(signature, lambda x: F.lpad(F.hex(x), 8, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal components."""
    same = F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x: x["a"] == x["b"])
    return F.size(same) / F.lit(float(SIZE))


# -- next documents -----------------------------------------------------------------------------


def with_next(docs: DataFrame) -> DataFrame:
    """block, n (place in the block), guest, doc_id, text and the next document's text.

    Blocks are ranges of ids between quantiles, found in one pass over the ids; they decide where rows are
    compared, not the result. A bound is an id of the data, so the rows of the first id of a block also visit
    the block before as guests, where they follow its last row; the very first id visits the last block.
    """
    rows = texts(docs)
    seen = rows.agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.count("doc_id").alias("ids")).first()
    wanted = min(MOST_BLOCKS, max(1, seen.n // BLOCK_ROWS))
    bounds: list[int] = []
    if wanted > 1 and seen.first is not None:
        found = rows.agg(F.percentile_approx("doc_id", [i / wanted for i in range(1, wanted)], 10 * wanted)).first()[0]
        bounds = sorted({*found} - {seen.first})
    array = F.array(*[F.lit(b) for b in bounds]).cast("array<bigint>")
    # Binary search for the number of bounds at or below the id.
    steps = F.array(*[F.lit(1 << s) for s in reversed(range(len(bounds).bit_length()))]).cast("array<int>")
    block = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(array, at + step - 1) <= F.col("doc_id"), at + step).otherwise(at))
    first = F.col("doc_id").isNull() if seen.ids < seen.n else F.col("doc_id") == F.lit(seen.first)
    home = F.struct(F.col("at").alias("block"), F.lit(False).alias("guest"))
    before = F.when(F.get(array, F.col("at") - 1) == F.col("doc_id"), F.struct((F.col("at") - 1).alias("block"), F.lit(True).alias("guest")))
    around = F.when(first, F.struct(F.lit(len(bounds)).alias("block"), F.lit(True).alias("guest")))
    placed = rows.withColumn("at", block).select("doc_id", "text", F.inline(F.array_compact(F.array(home, before, around))))
    order = Window.partitionBy("block").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    return placed.select("block", F.row_number().over(order).alias("n"), "guest", "doc_id", "text", F.lead("text").over(order).alias("next_text"))


def edited(text: Column, following: Column) -> Column:
    """The last half of the code points replaced by the first as many (or all) of the next text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def compare(docs: DataFrame) -> DataFrame:
    """Per row: the signatures of its text, of its edited text and of the next document, and what else the query asks for."""
    rows = with_next(docs)
    other = F.when(~F.col("guest"), edited(F.col("text"), F.col("next_text")))
    both = F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")), F.when(~F.col("guest"), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text"))))
    listed = rows.withColumn("edited", other).select(
        "block", "n", "guest", "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), F.inline(F.array_compact(both))
    )
    signed = signatures(listed, ["block", "n", "kind", "guest", "doc_id", "n_chars", "edited_sha256"], "text")
    # In a block: text, edited text, next text.
    order = Window.partitionBy("block").orderBy("n", "kind")
    ahead = signed.select("*", F.lead("signature", 1).over(order).alias("edited"), F.lead("signature", 2).over(order).alias("following"))
    return ahead.where((F.col("kind") == 0) & ~F.col("guest")).select("doc_id", "n_chars", "edited_sha256", "signature", "edited", "following")


def digests(compared: DataFrame) -> DataFrame:
    return compared.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("signature")).alias("fingerprint"),
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("edited")).alias("near_edited"),
        likeness(F.col("signature"), F.col("following")).alias("near_next"),
    )

"""Benchmark passages in training text, by a positional inverted index.

1. The words that test items use are counted over the whole corpus.
2. Every window of an item (``WINDOW`` consecutive words, or a shorter item as a whole) is asked for by its two
   rarest words. The index stores their postings: word, document, position.
3. A posting less the word's place in the item is the place where the item would begin. Lists adjusted so are
   intersected: a document and a beginning stay where both words of some window agree on it.
4. What stays is compared word by word with the document, which gives the exact places of every window.

Everything is DataFrame functions. A row goes by a 64-bit hash of its id and text, so that neither a NULL nor a repeated id
gathers the candidates of many texts; words are keyed by a hash too. Step 4 compares the words themselves. Only texts that
may have candidates are shuffled for it: the others are told apart by a bit map of fixed size (``MASK_BITS``) over the candidates' hashes.

Words are runs of digits, a-z (A-Z is lower-cased) and anything outside ASCII. A NULL text has none.
Rows that repeat an id are judged one by one; NULL ids are ids of their own; an item without an id has
the empty string as id. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import lower_ascii, new_column, stored, texts

WINDOW = 10
# Distinct words of all items that may be sent to every task, 16 bytes each; beyond it their join shuffles.
BROADCAST_WORDS = 1_000_000
# Size of the bit map of rows with candidates, sent to every task: 2^25 bits are 4 MB. With more candidates than bits it
# rules out less, and more text is shuffled; the result is the same.
MASK_BITS = 25


def words(text: Column) -> Column:
    parts = F.split(lower_ascii(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.filter(parts, lambda w: w != "")


def _small(df: DataFrame) -> DataFrame:
    """Marked for broadcast where its counted rows allow it, else for a merge join: the other side may be an explode, which Spark
    takes to be no longer than its input."""
    return F.broadcast(df) if df.limit(BROADCAST_WORDS + 1).count() <= BROADCAST_WORDS else df.hint("merge")


@dataclass(frozen=True)
class Items:
    """Test items with words: ``rows`` (item, item_id, said) and ``terms`` (item, place, term), both stored."""

    rows: DataFrame
    terms: DataFrame

    @classmethod
    def of(cls, benchmark: DataFrame) -> Items:
        ids = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
        rows = benchmark.select(ids.alias("item_id"), words(F.coalesce(F.col("text"), F.lit(""))).alias("said")).where(F.size("said") > 0).distinct()
        rows = stored(rows.select(F.xxhash64("item_id", "said").alias("item"), "item_id", "said"))
        exploded = rows.select("item", F.posexplode("said").alias("place", "word"))
        return cls(rows, stored(exploded.select("item", "place", F.xxhash64("word").alias("term"))))


def _keyed(docs: DataFrame) -> DataFrame:
    return texts(docs).select("doc_id", F.xxhash64("doc_id", "text").alias("doc"), "text")


def _tokens(docs: DataFrame) -> DataFrame:
    exploded = _keyed(docs).select("doc_id", "doc", F.posexplode(words(F.col("text"))).alias("pos", "word"))
    return exploded.select("doc_id", "doc", "pos", F.xxhash64("word").alias("term"))


def rarity(docs: DataFrame, items: Items) -> DataFrame:
    """(term, n): how often each word of the items stands in the corpus, 0 included."""
    vocabulary = items.terms.select("term").distinct()
    counts = _tokens(docs).select("term").join(_small(vocabulary), "term").groupBy("term").agg(F.count("*").alias("n"))
    return stored(vocabulary.join(counts, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n")))


def anchors(items: Items, counts: DataFrame) -> DataFrame:
    """(item, pairs): for every window of an item the places of its two rarest words; one twice if it has one word."""
    placed = items.terms.join(counts, "term").groupBy("item").agg(F.array_sort(F.collect_list(F.struct("place", "n"))).alias("all"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - WINDOW + 1, F.lit(1)))
    by_n = lambda s: F.array_sort(F.transform(F.slice("all", s, WINDOW), lambda x: F.struct(x["n"], x["place"])))
    pair = lambda ranked: F.struct(ranked[0]["place"].alias("a"), F.coalesce(F.get(ranked, F.lit(1)), ranked[0])["place"].alias("b"))
    pairs = F.transform(F.transform(starts, by_n), pair)
    return stored(placed.select("item", F.array_distinct(pairs).alias("pairs")))


def asked_places(items: Items, rare: DataFrame) -> DataFrame:
    """(item, place, term): the places that some window is asked for by."""
    places = rare.select("item", F.explode("pairs").alias("pair")).select("item", F.explode(F.array("pair.a", "pair.b")).alias("place")).distinct()
    # Places are exploded, so Spark would take them for few and might broadcast them.
    return stored(places.join(items.terms.hint("merge"), ["item", "place"]))


def postings(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """The index: (term, doc_id, doc, pos) of every word that some window is asked for by."""
    return stored(_tokens(docs).join(_small(asked.select("term").distinct()), "term").select("term", "doc_id", "doc", "pos"))


def adjusted(index: DataFrame, asked: DataFrame) -> DataFrame:
    """(doc_id, doc, item, begin, place): where an item would begin for its word at ``place`` to stand where it does."""
    return index.join(_small(asked), "term").select("doc_id", "doc", "item", (F.col("pos") - F.col("place")).alias("begin"), "place")


def aligned(index: DataFrame, asked: DataFrame, rare: DataFrame) -> DataFrame:
    """(doc, item, begin) where both rarest words of some window agree."""
    agreed = adjusted(index, asked).groupBy("doc", "item", "begin").agg(F.collect_set("place").alias("places"))
    both = F.exists("pairs", lambda p: F.array_contains("places", p["a"]) & F.array_contains("places", p["b"]))
    return agreed.join(rare, "item").where(both).select("doc", "item", "begin")


def near(index: DataFrame, asked: DataFrame, items: Items, rare: DataFrame, slop: int) -> DataFrame:
    """Proximity matches: (doc_id, item_id, a_pos, b_pos) where the two rarest words of a window stand within ``slop`` words of
    their distance in the item. Beginnings are put in buckets of ``slop + 1``, so only neighbours meet."""
    pairs = rare.select("item", F.explode("pairs").alias("p")).select("item", "p.a", "p.b").where(F.col("a") != F.col("b"))
    found = adjusted(index, asked)
    bucket = F.floor(F.col("begin") / (slop + 1))
    left = found.withColumnRenamed("place", "a").join(pairs, ["item", "a"])
    left = left.select("doc_id", "doc", "item", "a", "b", F.col("begin").alias("a_begin"), F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("bucket"))
    right = found.select(F.col("doc").alias("b_doc"), "item", F.col("place").alias("b"), F.col("begin").alias("b_begin"), bucket.alias("bucket"))
    right = right.withColumnsRenamed({"item": "b_item", "b": "b_place", "bucket": "b_bucket"})
    same = (F.col("doc") == F.col("b_doc")) & (F.col("item") == F.col("b_item")) & (F.col("b") == F.col("b_place")) & (F.col("bucket") == F.col("b_bucket"))
    met = left.join(right, same)
    met = met.where(F.abs(F.col("a_begin") - F.col("b_begin")) <= slop)
    named = met.join(items.rows.select("item", "item_id"), "item")
    return named.select("doc_id", "item_id", (F.col("a_begin") + F.col("a")).alias("a_pos"), (F.col("b_begin") + F.col("b")).alias("b_pos")).distinct()


def _marked(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with ``maybe``: false only where no row of ``found`` has the same ``doc``."""
    slot = F.pmod(F.col("doc"), F.lit(1 << MASK_BITS))
    # A row of 4 KB for each 32,768 slots, so this side has a size that no corpus changes.
    masks = found.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("mask"))
    position = F.bitmap_bit_position(slot)
    octet = F.conv(F.hex(F.substring("mask", (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.expr("shiftright(octet, int(pmod(position, 8))) & 1")
    held = rows.withColumns({"bucket": F.bitmap_bucket_number(slot), "position": position}).join(F.broadcast(masks), "bucket", "left")
    return held.withColumn("octet", octet).withColumn("maybe", F.coalesce(bit == 1, F.lit(False))).select(*rows.columns, "maybe")


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, and matches, an array of (item_id, length of its windows, starts), NULL without candidates."""
    items = Items.of(benchmark)
    rare = anchors(items, rarity(docs, items))
    places = asked_places(items, rare)
    candidates = stored(aligned(postings(docs, places), places, rare))
    length = F.least(F.size("said"), F.lit(WINDOW))
    candidate = F.struct("item_id", "said", "begin", length.alias("length"), F.sequence(F.lit(0), F.size("said") - length).alias("offsets"), F.sequence(F.lit(0), length - 1).alias("steps"))
    asked = candidates.join(items.rows, "item").groupBy("doc").agg(F.collect_list(candidate).alias("asked"))
    marked = _marked(_keyed(docs), candidates)
    rows = marked.where("maybe").join(asked, "doc", "left").select("doc_id", words(F.col("text")).alias("spoken"), "asked")
    # One word at a time: slice() would copy the whole document for every window. The words are bound to w, so
    # that they are made once per row even where a filter on the result is pushed down to the text.
    held = F.expr("""
        element_at(transform(array(spoken), w -> filter(transform(asked, c -> named_struct(
            'item_id', c.item_id,
            'length', c.length,
            'starts', transform(filter(c.offsets, s -> forall(c.steps, k -> get(w, c.begin + s + k) = get(c.said, s + k))), s -> c.begin + s)
        )), m -> size(m.starts) > 0)), 1)""")
    compared = rows.select("doc_id", F.size("spoken").cast("bigint").alias("n_words"), held.alias("matches"))
    clean = marked.where("NOT maybe").select("doc_id", F.size(words(F.col("text"))).cast("bigint").alias("n_words"), F.lit(None).cast(compared.schema["matches"].dataType).alias("matches"))
    return compared.unionByName(clean)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row: its words, those inside any window, the items found, and the verdict."""
    # Sorted spans, each counted from where the ones before it end.
    hit = F.expr("""
        aggregate(array_sort(flatten(transform(matches, m -> transform(m.starts, s -> named_struct('s', s, 'e', s + m.length))))),
            named_struct('n', 0, 'e', 0),
            (t, x) -> named_struct('n', t.n + greatest(x.e - greatest(x.s, t.e), 0), 'e', greatest(x.e, t.e)),
            t -> t.n)""")
    items = F.expr("array_sort(array_distinct(transform(matches, m -> m.item_id)))")
    none = F.col("matches").isNull()
    rows = matches(docs, benchmark).select(
        "doc_id",
        "n_words",
        F.when(none, F.lit(0)).otherwise(hit).cast("bigint").alias("n_hit"),
        F.when(none, F.array().cast("array<string>")).otherwise(items).alias("items"),
    )
    return rows.withColumn("contaminated", F.col("n_hit") > 0)


def digests(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows whose id has no contaminated text."""
    # Stored, so that the filter reads the verdicts and is not pushed into their making.
    verdicts = stored(contamination(docs, benchmark).select("doc_id", "contaminated"))
    ids = verdicts.where("contaminated").select(F.col("doc_id").alias("_bad"))
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["_bad"]), "left_anti")


def remove_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows without contaminated text, whatever other rows of their id say."""
    key = new_column(docs, "_key")
    # Stored, so that a row keeps its number, which stands for its id here: ids may be NULL or repeated.
    rows = stored(docs.withColumn(key, F.monotonically_increasing_id()))
    found = contamination(rows.select(F.col(key).alias("doc_id"), "text"), benchmark)
    # Stored twice: the filter is not pushed into the making of the verdicts, and the join is planned by the true number of bad rows.
    verdicts = stored(found.select(F.col("doc_id").alias(key), "contaminated"))
    bad = stored(verdicts.where("contaminated").select(key))
    return rows.join(bad, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def sql(documents: str = "documents") -> str:
    """The same in DuckDB's SQL, comparing every window of every document."""
    cut = lambda t: f"regexp_extract_all(translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    leads = ", ".join(f"lead(word, {k}) OVER x" for k in range(1, WINDOW))
    return f"""
WITH d AS (SELECT doc_id, {cut('text')} AS w FROM {documents}),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {cut('text')} AS w FROM benchmark),
s AS (SELECT item_id, w, least(len(w), {WINDOW}) AS n, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS p FROM i WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS said FROM s),
l AS (SELECT DISTINCT n FROM q),
u AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS p FROM d),
v AS (SELECT doc_id, p, [word, {leads}] AS ahead FROM u WINDOW x AS (PARTITION BY doc_id ORDER BY p)),
h AS (SELECT doc_id, p, l.n AS n, item_id FROM v JOIN l ON ahead[l.n] IS NOT NULL JOIN q ON q.n = l.n AND q.said = array_to_string(ahead[1:l.n], ' ')),
c AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS place FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM h GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)"""

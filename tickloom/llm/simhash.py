"""SimHash near-duplicates by chained segments.

A fingerprint has 64 bits; two are linked at ``DISTANCE`` (4) or fewer differing bits. The bits are cut
into five segments on a ring. If two fingerprints differ in at most 4 bits, then some segment starts a chain whose
first n segments, for every n, differ in at most floor(n * 4 / 5) bits: 0, 1, 2, 3, 4. So candidates
agree in the first segment of a chain and differ in at most one bit of the second, which an equi-join finds when one side
also looks under the 13 keys with one bit flipped. Buckets that hold many fingerprints are keyed by three
segments instead, with up to two flipped bits. Candidates must then pass the whole chain before the
full Hamming distance is taken.

Only different fingerprints are compared: copies share one. A word is a run of anything but the six
ASCII white-space characters; a text without words, like a NULL text, has fingerprint zero. Rows of one id
count one by one; NULL ids belong to their group but never name it. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tickloom.llm.common import all_of, new_column, slices, stored, texts
from tickloom.llm.components import components

DISTANCE = 4
SHINGLE = 4
SEED = 42
WIDTHS = (13, 13, 13, 13, 12)
# Fingerprints in a bucket of two segments from which it is keyed by three.
FULL = 512
_PIECE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


# -- fingerprints -------------------------------------------------------------------------------


def _pieces(raw: bytes) -> Iterator[bytes]:
    """Whole words, about a megabyte at a time."""
    start = 0
    while start < len(raw):
        cut = _SPACE.search(raw, start + _PIECE)
        end = cut.start() if cut else len(raw)
        yield raw[start:end]
        start = end


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Majority of the shingles' hash bits, as a signed 64-bit integer."""
    set_in, hashes = np.zeros(64, np.int64), 0
    digest, words = xxhash.xxh64_intdigest, []
    for piece in _pieces(text.encode().lower()):
        words = words[-(shingle - 1) :] + piece.split() if hashes else words + piece.split()
        if len(words) < shingle:
            continue
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.append(0, ends[:-1] + 1)
        found = [digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends[shingle - 1 :].tolist())]
        bits = np.unpackbits(np.array(found, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_in += bits.sum(axis=0, dtype=np.int32)
        hashes += len(found)
    if not hashes:
        value = digest(b" ".join(words), SEED) if words else 0
        return value - (1 << 64) if value >> 63 else value
    return int(np.packbits(set_in * 2 > hashes, bitorder="little").view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            found = pa.array([fingerprint(t) for t in part.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), found], names=["doc_id", "fp"])


def _with_fingerprints(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            found = pa.array([fingerprint(t or "") for t in part.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*part.columns, found], names=[*part.schema.names, name])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint (a BIGINT holding the 64 bits) of every whole text."""
    return texts(docs).mapInArrow(_fingerprints, "doc_id bigint, fp bigint")


# -- links --------------------------------------------------------------------------------------


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _segments() -> list[int]:
    masks, at = [], 0
    for width in WIDTHS:
        masks.append(((1 << width) - 1) << at)
        at += width
    return masks


SEGMENTS = _segments()
RING = len(SEGMENTS)
BUDGETS = [n * DISTANCE // RING for n in range(1, RING + 1)]


def _chain(start: int, length: int) -> list[int]:
    return [SEGMENTS[(start + n) % RING] for n in range(length)]


def _flips(segment: int, most: int) -> list[int]:
    """Every mask with up to ``most`` bits inside a segment."""
    bits = [1 << b for b in range(64) if segment >> b & 1]
    return [sum(c) for n in range(most + 1) for c in combinations(bits, n)]


def _array(values: list[int]) -> Column:
    return F.array(*[F.lit(_signed(v)).cast("bigint") for v in values])


def _key(start: int, length: int, fp: Column) -> Column:
    return fp.bitwiseAND(F.lit(_signed(sum(_chain(start, length)))))


def _chain_holds(start: int, differing: Column) -> Column:
    """Prefix sums of a chain within their budgets; the last prefix is the full distance, taken later."""
    prefix, conditions = 0, []
    for segment, budget in zip(_chain(start, RING - 1), BUDGETS):
        prefix |= segment
        conditions.append(F.bit_count(differing.bitwiseAND(F.lit(_signed(prefix)))) <= budget)
    return all_of(conditions)


def links(distinct: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of different fingerprints within the distance. ``distinct`` has a stored column fp, each value once."""
    fp = F.col("fp")
    starts = range(RING)
    index = distinct.select("fp", F.inline(F.array(*[F.struct(F.lit(i).alias("ring"), _key(i, 2, fp).alias("pair")) for i in starts])))
    # At most (five times all fingerprints / FULL) keys, usually none; stored, so that their true size plans the joins below.
    full = stored(index.groupBy("ring", "pair").agg(F.count("*").alias("n")).where(F.col("n") > FULL).select("ring", "pair", F.lit(True).alias("full")))
    place = lambda rows: rows.join(full, ["ring", "pair"], "left")
    by_ring = lambda make: F.coalesce(*[F.when(F.col("ring") == i, make(i)) for i in starts])
    three = by_ring(lambda i: _key(i, 3, fp))
    held = place(index).select(F.col("fp").alias("b"), "ring", F.coalesce("full", F.lit(False)).alias("full"), F.when(F.col("full"), three).otherwise(F.col("pair")).alias("key"))

    variants = lambda i: F.transform(_array(_flips(_chain(i, 2)[1], BUDGETS[1])), lambda v: F.struct(F.lit(i).alias("ring"), v.alias("flip")))
    probes = distinct.select("fp", F.inline(F.flatten(F.array(*[variants(i) for i in starts]))))
    probes = probes.withColumn("pair", by_ring(lambda i: _key(i, 2, fp)).bitwiseXOR(F.col("flip")))
    third = lambda most: by_ring(lambda i: _array(_flips(_chain(i, 3)[2], most)))
    more = F.when(F.col("full"), F.when(F.col("flip") == 0, third(BUDGETS[2])).otherwise(third(BUDGETS[2] - 1))).otherwise(_array([0]))
    probes = place(probes).select("fp", "ring", "full", "flip", "pair", F.explode(more).alias("flip3"))
    key3 = three.bitwiseXOR(F.col("flip")).bitwiseXOR(F.col("flip3"))
    asked = probes.select(F.col("fp").alias("a"), "ring", F.coalesce("full", F.lit(False)).alias("full"), F.when(F.col("full"), key3).otherwise(F.col("pair")).alias("key"))

    # Both sides are explodes, which Spark takes to be no longer than their input: left to it, it may broadcast one.
    candidates = asked.join(held.hint("merge"), ["ring", "full", "key"]).where(F.col("a") < F.col("b"))
    differing = F.col("a").bitwiseXOR(F.col("b"))
    chained = candidates.where(by_ring(lambda i: _chain_holds(i, differing)))
    return chained.where(F.bit_count(differing) <= DISTANCE).select("a", "b").distinct()


# -- groups -------------------------------------------------------------------------------------


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id reachable over links, for every row."""
    rows = stored(fingerprints(docs))
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    linked = components(links(classes.select("fp")))
    named = linked.join(classes, linked["node"] == classes["fp"]).select("fp", "label", "first")
    smallest = named.groupBy("label").agg(F.min("first").alias("smallest"))
    joined = named.join(smallest, "label").select("fp", "smallest")
    final = classes.join(joined, "fp", "left").select("fp", F.coalesce("smallest", "first").alias("component_id"))
    # One side has a row of every document, the other of every fingerprint: neither is broadcast, however well its files are packed.
    return rows.join(final.hint("merge"), "fp").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame) -> DataFrame:
    """Exactly one row of each group stays: the one with the smallest id, and of those the one with the smallest
    hash of its text.

    Rows are told apart by a number of their own, so ids may be NULL or repeated: a NULL id comes after all others,
    and which of several rows alike in id and text stays is not specified.
    """
    fp, key, order = (new_column(docs, name) for name in ("_fp", "_key", "_order"))
    schema = StructType([*docs.schema.fields, StructField(fp, LongType())])
    rows = docs.mapInArrow(partial(_with_fingerprints, name=fp), schema)
    # Stored, so that a row keeps its number.
    rows = stored(rows.withColumns({key: F.monotonically_increasing_id(), order: F.xxhash64(F.coalesce("text", F.lit("")))}))
    doc_id = F.col("doc_id").cast("bigint")
    rank = F.struct(doc_id.isNull().alias("unnamed"), doc_id.alias("doc_id"), F.col(order).alias("hash"), F.col(key).alias("key"))
    classes = stored(rows.groupBy(F.col(fp).alias("fp")).agg(F.min(rank).alias("first")))
    linked = components(links(classes.select("fp")))
    labelled = classes.join(linked, classes["fp"] == linked["node"], "left")
    firsts = labelled.groupBy(F.coalesce("label", "fp").alias("group")).agg(F.min("first").alias("first"))
    kept = stored(firsts.select(F.col("first.key").alias(key)))
    # The kept rows are most rows: a broadcast of them would only hold while the corpus is small.
    return rows.join(kept.hint("merge"), key, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])

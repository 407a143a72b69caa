"""Token ids in a binary format of patched frame-of-reference blocks.

Documents are range-partitioned by id, so that the parts of the output are in ascending order of id.
A task encodes its rows in order and writes them as segments. Each row of the written table is one
segment: its part, its place in the part, and the bytes of ``pack``. Spark's own writer commits
them, so a lost or repeated task leaves no trace. Reading adds up the ids of earlier parts (one row per
part) for the place of every document in the whole stream.

A segment (little-endian):

    "PFR1", documents u32, ids u64, blocks u32
    per document: doc_id i64, 1 if it is NULL u8, ids u32
    per block:    minimum u32, width u8, start of its packed bytes u64, start of its exceptions u32
    exceptions:   place in the block u8, value above the minimum u32
    packed bytes: 128 values above the minimum, each in ``width`` bits

The width holds 90 % of a block's values; the rest are exceptions, whose low bits are packed all the same.

NULL texts are empty: they have the end id only. Rows with equal ids are all kept, in the order of
their texts; NULL ids come first. An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from tickloom.llm.common import slices, texts

BLOCK = 128
PERCENTILE = 0.9
_HEAD = struct.Struct("<4sIQI")
_DOC = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("n", "<u4")])
_INDEX = np.dtype([("low", "<u4"), ("width", "u1"), ("start", "<u8"), ("patch", "<u4")])
_PATCH = np.dtype([("at", "u1"), ("value", "<u4")])
_KNOWN = 500_000


# -- blocks -------------------------------------------------------------------------------------


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each unsigned value needs."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def pack(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    """One segment of whole documents."""
    blocks = -(-ids.size // BLOCK)
    values = np.resize(ids.astype(np.uint32), blocks * BLOCK) if blocks else np.empty(0, np.uint32)
    if blocks:
        values[ids.size :] = ids[-1]
    values = values.reshape(blocks, BLOCK)
    low = values.min(axis=1) if blocks else np.empty(0, np.uint32)
    above = values - low[:, None]
    rank = int(np.ceil(PERCENTILE * BLOCK)) - 1
    width = _bits(np.partition(above, rank, axis=1)[:, rank]) if blocks else np.empty(0, np.uint8)
    patched = _bits(above.ravel()).reshape(above.shape) > width[:, None]
    row, at = np.nonzero(patched)
    patches = np.empty(row.size, _PATCH)
    patches["at"], patches["value"] = at, above[row, at]
    index = np.empty(blocks, _INDEX)
    sizes = width.astype(np.int64) * (BLOCK // 8)
    index["low"], index["width"] = low, width
    index["start"] = np.cumsum(sizes) - sizes
    per_block = patched.sum(axis=1)
    index["patch"] = np.cumsum(per_block) - per_block
    body = np.empty(int(sizes.sum()), np.uint8)
    for w in np.unique(width[width > 0]).tolist():
        of = np.flatnonzero(width == w)
        octets = above[of].astype("<u4").view(np.uint8).reshape(of.size, BLOCK, 4)
        bits = np.unpackbits(octets, axis=2, count=w, bitorder="little")
        packed = np.packbits(bits.reshape(of.size, -1), axis=1, bitorder="little")
        body[index["start"][of].astype(np.int64)[:, None] + np.arange(packed.shape[1])] = packed
    docs = np.empty(len(doc_ids), _DOC)
    docs["doc_id"] = [0 if i is None else i for i in doc_ids]
    docs["null"] = [i is None for i in doc_ids]
    docs["n"] = counts
    head = _HEAD.pack(b"PFR1", len(doc_ids), ids.size, blocks)
    return b"".join([head, docs.tobytes(), index.tobytes(), struct.pack("<I", patches.size), patches.tobytes(), body.tobytes()])


def _parts(segment: bytes):
    magic, n_docs, n_ids, blocks = _HEAD.unpack_from(segment)
    if magic != b"PFR1":
        raise ValueError("not a segment of token blocks")
    at = _HEAD.size
    docs = np.frombuffer(segment, _DOC, n_docs, at)
    at += docs.nbytes
    index = np.frombuffer(segment, _INDEX, blocks, at)
    at += index.nbytes
    (n_patches,) = struct.unpack_from("<I", segment, at)
    patches = np.frombuffer(segment, _PATCH, n_patches, at + 4)
    return docs, n_ids, index, patches, np.frombuffer(segment, np.uint8, offset=at + 4 + patches.nbytes)


def _unpack_blocks(index: np.ndarray, patches: np.ndarray, patch_ends: np.ndarray, body: np.ndarray) -> np.ndarray:
    out = np.zeros((index.size, BLOCK), np.uint32)
    for w in np.unique(index["width"][index["width"] > 0]).tolist():
        of = np.flatnonzero(index["width"] == w)
        packed = body[index["start"][of].astype(np.int64)[:, None] + np.arange(w * BLOCK // 8)]
        bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(of.size, BLOCK, w)
        padded = np.zeros((of.size, BLOCK, 32), np.uint8)
        padded[:, :, :w] = bits
        out[of] = np.packbits(padded, axis=2, bitorder="little").view("<u4")[:, :, 0]
    counts = patch_ends - index["patch"]
    row = np.repeat(np.arange(index.size), counts)
    out[row, patches["at"]] = patches["value"]
    return out + index["low"][:, None]


def unpack(segment: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The document table and all ids of a segment."""
    docs, n_ids, index, patches, body = _parts(segment)
    ends = np.append(index["patch"][1:], patches.size) if index.size else np.empty(0, np.int64)
    return docs, _unpack_blocks(index, patches, ends, body).ravel()[:n_ids]


def seek(segment: bytes, first: int, count: int) -> np.ndarray:
    """Ids ``first`` to ``first + count`` of a segment: only the blocks that hold them are decoded."""
    _, n_ids, index, patches, body = _parts(segment)
    count = max(0, min(count, n_ids - first))
    a, b = first // BLOCK, -(-(first + count) // BLOCK)
    ends = np.append(index["patch"][1:], patches.size)[a:b]
    some = index[a:b]
    if not some.size:
        return np.empty(0, np.uint32)
    own = patches[some["patch"][0] : ends[-1]]
    shifted = some.copy()
    shifted["patch"] -= some["patch"][0]
    flat = _unpack_blocks(shifted, own, ends - some["patch"][0], body).ravel()
    return flat[first - a * BLOCK :][:count]


# -- encoding -----------------------------------------------------------------------------------

# Below U+0180 there is nothing to compose, and lower case is one character for one, but for U+0130.
# Python counts the separators U+001C to U+001F as white space, the vocabulary's pattern does not.
_RARE = re.compile("[^\x00-ſ]|[İ\x1c-\x1f]")
_LATIN = [chr(c) for c in range(0x180)]


def _rare(text: str) -> bool:
    """Does ``_RARE`` find anything? ASCII, as most texts are, is searched for the four separators only."""
    if text.isascii():
        return any(c in text for c in "\x1c\x1d\x1e\x1f")
    return _RARE.search(text) is not None


def _pattern() -> re.Pattern:
    """The vocabulary's word pattern over those characters."""
    letters, digits = ("".join(c for c in _LATIN if unicodedata.category(c)[0] == kind) for kind in "LN")
    return re.compile(rf"[{letters}]+|[{digits}]|'(?:[stmd]|re|ve|ll)|[^\s{letters}{digits}]+")


class _Codes(dict):
    def __missing__(self, key: str) -> int:
        self[key] = code = len(self)
        return code


class WordEncoder:
    """Ids of whole texts; new words go to the tokenizer together, known ones come from a bounded table."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            suffix = json.load(f)["model"]["end_of_word_suffix"]
        self.closes = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.closes[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        self.find = _pattern().findall
        self._forget()

    def _forget(self) -> None:
        self.codes = _Codes()
        self.flat, self.counts, self.starts = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _encode(self, some: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]

    def _learn(self) -> None:
        """Every word ends in exactly one token with the end-of-word mark, so many go in one text."""
        words = list(islice(self.codes, self.counts.size, None))
        lines = [" ".join(words[i : i + 1000]) for i in range(0, len(words), 1000)]
        ids = np.concatenate([np.array(x, np.uint32) for x in self._encode(lines)])
        ends = np.flatnonzero(self.closes[ids]) + 1
        counts = np.diff(ends, prepend=0)
        if counts.size != len(words):
            raise ValueError("the tokenizer split a word otherwise than its pattern says")
        self.flat = np.concatenate([self.flat, ids])
        self.counts = np.concatenate([self.counts, counts])
        self.starts = np.cumsum(self.counts) - self.counts

    def encode(self, some: Iterable[str]) -> list[np.ndarray]:
        if len(self.codes) > _KNOWN:
            self._forget()
        code = self.codes.__getitem__
        coded = [self._encode([t])[0] if _rare(t) else np.fromiter(map(code, self.find(t.lower())), np.int32) for t in some]
        if len(self.codes) > self.counts.size:
            self._learn()
        return [np.array(c, np.uint32) if isinstance(c, list) else self._ids(c) for c in coded]

    def _ids(self, codes: np.ndarray) -> np.ndarray:
        counts = self.counts[codes]
        ends = np.cumsum(counts)
        shift = np.repeat(self.starts[codes] - (ends - counts), counts)
        return self.flat[shift + np.arange(shift.size)]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return WordEncoder(path)


# -- Spark --------------------------------------------------------------------------------------

SEGMENTS = "seq int, first bigint, n_ids bigint, payload binary"
DOCUMENTS = "doc_id bigint, start bigint, n_tokens bigint, ids binary"


def _segments(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    coder = encoder(path)
    first = seq = 0
    for batch in batches:
        for part in slices(batch, "text", 1 << 23):
            found = coder.encode(part.column("text").to_pylist())
            counts = np.array([x.size + 1 for x in found], np.uint32)
            ids = np.full(int(counts.sum()), end_id, np.uint32)
            inside = np.ones(ids.size, bool)
            inside[np.cumsum(counts) - 1] = False
            ids[inside] = np.concatenate(found)
            payload = pack(part.column("doc_id").to_pylist(), counts, ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([seq], pa.int32()), pa.array([first], pa.int64()), pa.array([ids.size], pa.int64()), pa.array([payload], pa.binary())],
                names=["seq", "first", "n_ids", "payload"],
            )
            first, seq = first + ids.size, seq + 1


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, payload in zip(batch.column("start").to_pylist(), batch.column("payload")):
            docs, ids = unpack(payload.as_py())
            ends = np.append(0, np.cumsum(docs["n"], dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(docs["doc_id"], pa.int64(), mask=docs["null"] == 1),
                    pa.array(start + ends[:-1]),
                    pa.array(docs["n"].astype(np.int64)),
                    pa.array([ids[a:b].astype("<u4").tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
                ],
                names=["doc_id", "start", "n_tokens", "ids"],
            )


def write(docs: DataFrame, folder: str, path: str, end_id: int) -> None:
    """Encode and write in ascending order of doc_id. ``path``: the vocabulary, at the same place on every executor."""
    # The hash of the text splits the rows of one id, should they be many.
    keyed = texts(docs).withColumn("tie", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
    segments = ordered.mapInArrow(partial(_segments, path=path, end_id=end_id), SEGMENTS)
    segments.withColumn("part", F.spark_partition_id()).write.parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, ids before it in the whole stream, number of its ids, and the ids as little-endian u32."""
    segments = spark.read.parquet(folder)
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per written part
    bases = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    placed = segments.join(bases, "part").select((F.col("base") + F.col("first")).alias("start"), "payload")
    return placed.mapInArrow(_documents, DOCUMENTS)


def digests(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

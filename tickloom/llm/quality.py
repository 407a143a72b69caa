"""Quality score from compression with dictionaries of good and of bad text.

Two zstandard dictionaries are trained on labelled text, one per label. A text is cut into pieces of
a kilobyte, so that a long text keeps asking the dictionary and not only its own past, and every piece
is compressed with either. The normalised difference of the sizes, (bad - good) / max(bad, good), becomes a
probability by a logistic curve fitted on labelled documents that the dictionaries have not seen.

Fitting reads a bounded sample of labelled rows (``ROWS`` per label, in the order of a hash of their id,
and ``PIECES`` pieces per label, likewise); scoring reads every whole text. The curve weighs a sampled row by the number of
rows of its label that it stands for, so that the score is a probability under the labels' true shares at any size. An id with
both labels is not used, and of the rows of one id the one whose text sorts first counts, so repeated rows change nothing. A NULL text is empty, and an empty text gets the curve's value at no difference. With fewer than two labels to
learn from, the score is the share of good labels, or 0.5 without any. Only the text is an input of the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import slices, stored, texts

ROWS = 6_000
PIECES = 20_000
PIECE = 1_024
DICTIONARY = 112_640
LEVEL = 3
THRESHOLD = 0.3
_BAD, _GOOD = 0, 1


@dataclass(frozen=True)
class Model:
    """Dictionaries by label, and the curve; without dictionaries the intercept alone counts."""

    bad: bytes
    good: bytes
    slope: float
    intercept: float


def held_out(doc_id: Column) -> Column:
    """One fifth of all ids, which no model learns from."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


# -- in tasks -----------------------------------------------------------------------------------


def _cut(raw: bytes) -> list[bytes]:
    return [raw[i : i + PIECE] for i in range(0, len(raw), PIECE)]


@lru_cache(maxsize=4)
def _compressor(dictionary: bytes):
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    options = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, **options).compress


def difference(text: str, model: Model) -> float:
    """Above 0 where the good dictionary fits better."""
    if not model.bad or not model.good:
        return 0.0
    pieces = _cut(text.encode())
    bad, good = (sum(len(p) for p in map(_compressor(d), pieces)) for d in (model.bad, model.good))
    return (bad - good) / max(bad, good, 1)


def _score(texts_: list[str | None], model: Model) -> np.ndarray:
    found = np.array([difference(t or "", model) for t in texts_], float)
    return 1 / (1 + np.exp(-np.clip(model.slope * found + model.intercept, -500, 500)))


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_score(batch.column("text").to_pylist(), model))], names=["doc_id", "score"])


def _kept(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array(_score(batch.column("text").to_pylist(), model) >= THRESHOLD))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            rows = [(label, xxhash.xxh64_intdigest(p) >> 1, p) for label, t in zip(part.column("label").to_pylist(), part.column("text").to_pylist()) for p in _cut(t.encode())]
            label, order, piece = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(order, pa.int64()), pa.array(piece, pa.binary())], names=["label", "order", "piece"])


def _train(group: pa.Table) -> pa.Table:
    """The dictionary of one label's pieces; text as it is where there is too little to train on."""
    pieces = group.sort_by([("order", "ascending"), ("piece", "ascending")]).column("piece").to_pylist()
    try:
        dictionary = zstandard.train_dictionary(DICTIONARY, pieces).as_bytes()
    except zstandard.ZstdError:
        dictionary = b"".join(pieces)[:DICTIONARY]
    return pa.table({"label": pa.array([group.column("label")[0].as_py()], pa.int32()), "dictionary": pa.array([dictionary], pa.binary())})


# -- fitting and scoring ------------------------------------------------------------------------


def _curve(x: np.ndarray, y: np.ndarray, stands_for: np.ndarray) -> tuple[float, float]:
    """Logistic fit by Newton's steps of rows weighted by ``stands_for``, with targets pulled in from 0 and 1 so that it stays finite."""
    good = y.sum()
    target = np.where(y == 1, (good + 1) / (good + 2), 1 / (y.size - good + 2))
    scale = x.std() or 1.0
    design = np.stack([x / scale, np.ones_like(x)], axis=1)
    weights = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        hessian = (design * (stands_for * p * (1 - p))[:, None]).T @ design + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (stands_for * (target - p)) - 1e-6 * weights)
        weights += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(weights[0] / scale), float(weights[1])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from labelled documents that are not held out. ``labels`` has doc_id and quality (0 or 1)."""
    ids = labels.select(F.col("doc_id").cast("bigint").alias("id"), F.col("quality").cast("int").alias("quality"))
    ids = ids.where(F.col("id").isNotNull() & F.col("quality").isin(_BAD, _GOOD) & ~held_out(F.col("id")))
    ids = ids.groupBy("id").agg(F.min("quality").alias("label"), F.max("quality").alias("most")).where(F.col("label") == F.col("most"))
    order = F.xxhash64("id")
    sample = [ids.where(F.col("label") == q).select("id", "label", F.pmod(order, F.lit(3)).alias("fold")).orderBy(order, "id").limit(ROWS) for q in (_BAD, _GOOD)]
    # At most 2 * ROWS ids, so this side can be sent to every task.
    chosen = F.broadcast(sample[0].union(sample[1]))
    # One row of each id, so that the bound is one of rows; stored, as three passes follow.
    known = stored(texts(docs).join(chosen, F.col("doc_id") == F.col("id")).groupBy("id", "label", "fold").agg(F.min("text").alias("text")))
    rows = known.where(F.col("fold") > 0).select("label", "text").mapInArrow(_pieces, "label int, order bigint, piece binary")
    bounded = [rows.where(F.col("label") == q).orderBy("order", "piece").limit(PIECES) for q in (_BAD, _GOOD)]
    trained = bounded[0].union(bounded[1]).groupBy("label").applyInArrow(_train, "label int, dictionary binary")
    dictionaries = {r.label: bytes(r.dictionary) for r in trained.collect()}  # two rows at most
    model = Model(dictionaries.get(_BAD, b""), dictionaries.get(_GOOD, b""), 0.0, 0.0)
    if not (model.bad and model.good):
        share = ids.agg(F.avg("label")).first()[0]
        return Model(b"", b"", 0.0, 0.0 if share is None else float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    differ = partial(_differences, model=model)
    pairs = known.where(F.col("fold") == 0).select("label", "text").mapInArrow(differ, "label int, difference double").collect()  # at most 2 * ROWS rows
    if not pairs:
        return model
    counts = {r.label: r.n for r in ids.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows at most
    label = np.array([r.label for r in pairs])
    stands_for = np.array([max(counts[q] / ROWS, 1.0) for q in label.tolist()])
    return Model(model.bad, model.good, *_curve(np.array([r.difference for r in pairs]), label, stands_for))


def _differences(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [difference(t, model) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found, pa.float64())], names=["label", "difference"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""
    return texts(docs).mapInArrow(partial(_scored, model=model), "doc_id bigint, score double")


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows, with all their columns, that reach the threshold."""
    return docs.mapInArrow(partial(_kept, model=model), docs.schema)

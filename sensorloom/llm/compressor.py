"""Quality by compression: dictionaries of good and of bad text, and which of them packs a document better.

Two zstandard dictionaries are built from labelled documents. Each whole text is packed in blocks with either; the
difference of the packed sizes over their sum, put through a logistic curve that is fitted on other labelled documents,
is the score.

The fit reads a bounded sample, chosen by a hash of the key: `DICTIONARY_DOCS` documents of each label, at most
`DICTIONARY_BYTES` of their blocks, and `CURVE_DOCS` documents for the curve. Documents with contradicting or missing labels
teach nothing. Scoring covers every row and needs no shuffle. Null and empty texts have difference 0. Without labels of
both kinds every score is the smoothed share of good labels. Repeated rows get one score each; empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.llm.texts import in_tasks, map_texts, stored

BLOCK_BYTES = 512
DICTIONARY_SIZE = 32_000
DICTIONARY_DOCS = 1_000  # of each label
DICTIONARY_BYTES = 6_000_000  # of each label
CURVE_DOCS = 4_000
LEVEL = 3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    shift: float

    def score(self, difference: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * difference + self.shift, -500, 500)))


def blocks(text: str | None) -> list[bytes]:
    raw = (text or "").encode()
    return [raw[i : i + BLOCK_BYTES] for i in range(0, len(raw), BLOCK_BYTES)]


def build_dictionary(samples: list[bytes]) -> bytes:
    """Trained from the samples; if these are too few for that, they are the dictionary."""
    try:
        return zstandard.train_dictionary(DICTIONARY_SIZE, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_SIZE:] or b" " * 8


def packer(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False)


def difference(text: str | None, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> float:
    a = b = 0
    for block in blocks(text):
        a += len(good.compress(block))
        b += len(bad.compress(block))
    return (b - a) / (a + b) if a else 0.0


def _differences(column: pa.Array, good: bytes, bad: bytes) -> np.ndarray:
    g, b = packer(good), packer(bad)
    return np.array([difference(t, g, b) for t in column.to_pylist()], np.float64)


def curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic fit by Newton steps with a small ridge; a constant if there is one label only."""
    if len(y) == 0 or y.min() == y.max():
        return 0.0, float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    mean, spread = x.mean(), x.std() or 1.0
    design = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    w = np.array([0.0, np.log((y.sum() + 1) / (len(y) - y.sum() + 1))])
    ridge = np.diag([1e-2, 1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        w += np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + ridge, design.T @ (y - p) - ridge @ w)
    return float(w[0] / spread), float(w[1] - w[0] * mean / spread)


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """`learnable`: a condition on the key column of `labels`."""
    known = labels.filter(learnable).groupBy(key).agg(F.min(label).alias("y"), F.max(label).alias("y1")).filter("y = y1")
    known = known.select(F.col(key).alias("k"), "y", F.xxhash64(key).alias("h"))
    for_curve = F.pmod("h", F.lit(3)) == 0
    taken = known.filter(for_curve).orderBy("h", "k").limit(CURVE_DOCS).withColumn("use", F.lit("curve"))
    for y in (0, 1):
        part = known.filter(~for_curve & (F.col("y") == y)).orderBy("h", "k").limit(DICTIONARY_DOCS)
        taken = taken.union(part.withColumn("use", F.lit("words")))
    sample = stored(docs.select(key, text).join(F.broadcast(taken), F.col(key) == F.col("k")).select("k", "use", "y", F.col(text).alias("text")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for y, t in zip(batch.column(0), batch.column(1)):
                own = blocks(t.as_py())
                yield pa.RecordBatch.from_arrays([pa.array([y.as_py()] * len(own), pa.int32()), pa.array(own, pa.binary())], names=["y", "block"])

    cuts = in_tasks(sample.filter("use = 'words'").select(F.col("y").cast("int"), "text"), cut, "y int, block binary")
    made = {}
    for y in (0, 1):
        mine = cuts.filter(F.col("y") == y).orderBy(F.xxhash64("block"), "block").limit(DICTIONARY_BYTES // BLOCK_BYTES)
        made[y] = build_dictionary([bytes(r.block) for r in mine.collect()])  # DICTIONARY_BYTES at most

    def measure(piece: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([piece.column(0), pa.array(_differences(piece.column(1), made[1], made[0]))], names=["y", "x"])

    rows = map_texts(sample.filter("use = 'curve'").select(F.col("y").cast("int"), "text"), "text", "y int, x double", measure).collect()
    slope, shift = curve(np.array([r.x for r in rows]), np.array([r.y for r in rows], np.float64))
    return Model(made[1], made[0], slope, shift)


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, score and prediction of every row."""

    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        score = model.score(_differences(piece.column(1), model.good, model.bad))
        return pa.RecordBatch.from_arrays([piece.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=[key, "score", "predicted"])

    picked = docs.select(key, text)
    return map_texts(picked, text, f"`{key}` {picked.schema[key].dataType.simpleString()}, score double, predicted int", run)

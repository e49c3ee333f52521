"""Target-distribution importance resampling: documents drawn by how much their words look like a target's.

Features are runs of 1 to `grams` consecutive words, hashed into a fixed number of buckets. The bucket counts of all
documents and of all target texts give each bucket a gain, the log ratio of its smoothed shares; a document's weight is the
sum of its features' gains. A Gumbel draw from the key's digest is added, and the highest scores are taken, which is sampling
without replacement by weight.

Tasks join the texts of a batch with a separator byte, find all words in one regex pass, place them in documents by
`searchsorted` over the documents' offsets, mask the runs that cross from one document to the next, and count with `bincount`.
The text is read twice, once for the counts and once for the weights; only bucket counts (`BUCKETS` rows) pass the driver.
Ranks come from one range-partitioned sort and the row counts of its partitions.

Null text: no words. A document without words has weight 0. Null key: the digest is that of an empty key, and it comes
after other keys on a tie. Repeated rows are documents of their own, equal in weight and score, and get ranks of their own.
Empty target: all gains come from smoothing alone. Empty table: empty result. Further columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.llm.texts import give_back, in_tasks, map_texts, pieces, ranked, stored, text_bytes

BUCKETS = 10_000
SEPARATOR = b"\x00"  # no word holds it
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
KNOWN_WORDS, KNOWN_BYTES = 300_000, 64  # of the words whose bucket a task remembers


@dataclass(frozen=True)
class Plan:
    grams: int = 1
    buckets: int = BUCKETS
    percent: int = 10
    least_words: int = 20
    seed: int = 2024


class Buckets(dict):
    """Bucket of a word; the first ones met are remembered."""

    def __init__(self, n: int):
        self.n = n

    def __missing__(self, word: bytes) -> int:
        at = crc32(word) % self.n
        if len(self) < KNOWN_WORDS and len(word) <= KNOWN_BYTES:
            self[word] = at
        return at


def features(column: pa.Array, plan: Plan, known: Buckets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket) of every feature of a batch, and the words of each document."""
    raw, at = text_bytes(column)
    n = len(column)
    data = raw.tobytes()
    joined = SEPARATOR.join([data[a:b] for a, b in zip(at[:-1], at[1:])]).lower()  # of bytes: A-Z only
    offsets = at[:-1] + np.arange(n)
    starts, words = [], []
    for m in WORD.finditer(joined):
        starts.append(m.start())
        words.append(m.group())
    document = np.searchsorted(offsets, np.array(starts, np.int64), "right") - 1
    bucket = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    documents, buckets, sums = [document], [bucket], None
    for length in range(2, plan.grams + 1):
        if sums is None:
            sums = [crc32(w) for w in words]
        sums = [crc32(w, crc32(b" ", s)) for s, w in zip(sums[: len(words) - length + 1], words[length - 1 :])]
        whole = document[: len(sums)] == document[length - 1 :]
        documents.append(document[: len(sums)][whole])
        buckets.append(np.array(sums, np.int64)[whole] % plan.buckets)
    return np.concatenate(documents), np.concatenate(buckets), np.bincount(document, minlength=n)


def bucket_counts(texts: DataFrame, plan: Plan, text: str = "text") -> DataFrame:
    """(bucket, n): features of all texts, one row per task and bucket before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, known = np.zeros(plan.buckets, np.int64), Buckets(plan.buckets)
        for batch in batches:
            for piece in pieces(batch, text):
                total += np.bincount(features(piece.column(0), plan, known)[1], minlength=plan.buckets)
            give_back()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return in_tasks(texts.select(text), run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, plan: Plan, text: str = "text") -> np.ndarray:
    """Gain of each bucket, in thousandths."""
    sides = [bucket_counts(df, plan, text).withColumn("side", F.lit(i)) for i, df in enumerate((docs, target))]
    counts = np.zeros((2, plan.buckets), np.int64)
    for r in sides[0].union(sides[1]).collect():  # two rows per bucket at most
        counts[r.side, r.bucket] = r.n
    (s, t), (s_all, t_all) = counts, counts.sum(axis=1).tolist()
    return np.array([math.floor(1000 * math.log((b + 1) * (s_all + plan.buckets) / ((a + 1) * (t_all + plan.buckets))))
                     for a, b in zip(s.tolist(), t.tolist())], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, plan: Plan, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, words, features and weight of every row."""
    known = Buckets(plan.buckets)  # each task fills a copy of its own

    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        document, bucket, n_words = features(piece.column(1), plan, known)
        n = len(piece)
        weight = np.zeros(n, np.int64)
        np.add.at(weight, document, gain[bucket])
        made = [pa.array(x, pa.int64()) for x in (n_words, np.bincount(document, minlength=n), weight)]
        return pa.RecordBatch.from_arrays([piece.column(0), *made], names=[key, "n_words", "n_features", "weight"])

    picked = docs.select(key, text)
    schema = f"`{key}` {picked.schema[key].dataType.simpleString()}, n_words long, n_features long, weight long"
    return map_texts(picked, text, schema, run)


def gumbel(key: Column, seed: int) -> Column:
    """A Gumbel draw in thousandths, from the first 32 bits of the digest of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("long")


def resampled(
    docs: DataFrame, target: DataFrame, plan: Plan = Plan(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Key, n_features, weight, score and rank of every row; rank is null where the row is not drawn."""
    rows = weighted(docs, gains(docs, target, plan, text), plan, key, text)
    rows = stored(rows.withColumn("score", F.col("weight") + gumbel(F.col(key), plan.seed)))
    long_enough = F.col("n_words") >= plan.least_words
    drawn = rows.filter(long_enough).count() * plan.percent // 100
    order = ranked(rows.filter(long_enough), F.desc("score"), F.asc_nulls_last(key))
    order = order.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = rows.filter(~long_enough).withColumn("rank", F.lit(None).cast("long"))
    return order.union(rest).select(key, "n_features", "weight", "score", "rank")

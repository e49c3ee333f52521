"""Token counts through a digest cache.

Each text has a content digest; a cache table maps (content digest, tokenizer digest) to a token count. Texts whose digest
is stored are not encoded again. Of the others each distinct one is encoded once, and its count is appended to the cache.
Each scan task first drops its own repeated misses, so that a group of copies sends one text per task at most.

Normalisation: null becomes the empty text; nothing else may change, or counts would. A new tokenizer file has another
digest and so other entries. Repeated rows and ties share one entry. Empty table: nothing is appended. The cache folder
must be one that all executors share.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from sensorloom.llm.pair_bpe import BATCH_BYTES, MOST_WORDS, Words, encoder
from sensorloom.llm.texts import PIECE_BYTES, in_tasks, stored

ENTRY = "content binary, tokenizer string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return sha256(f.read()).hexdigest()


def content_digest(text: str):
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def _local_distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first of equal texts within a task, packed for the shuffle."""
    seen: set[bytes] = set()
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        new, packed = [], []
        for digest, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if digest not in seen:
                seen.add(digest)
                new.append(digest)
                packed.append(pack.compress((text.as_py() or "").encode()))
        yield pa.RecordBatch.from_arrays([pa.array(new, pa.binary()), pa.array(packed, pa.binary())], names=["content", "packed"])


def _counter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        words = Words(encoder(path))
        unpack = zstandard.ZstdDecompressor()
        digests, rows, texts, held, total = [], [], [], 0, 0

        def cut() -> None:
            slots, at = words.slots(texts)
            rows.extend(slots[a:b] for a, b in zip(at[:-1], at[1:]))
            texts.clear()

        def flush() -> pa.RecordBatch:
            cut()
            words.learn(False)
            counts = [int(words.counts[r].sum()) for r in rows]
            out = pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(counts, pa.int64())], names=["content", "n_tokens"])
            digests.clear(), rows.clear()
            return out

        for batch in batches:
            for digest, packed in zip(batch.column(0), batch.column(1)):
                digest = digest.as_py()
                if digest in seen:
                    continue
                seen.add(digest)
                raw = unpack.decompress(packed.as_py())
                digests.append(digest)
                texts.append(raw.decode())
                held, total = held + len(raw), total + len(raw)
                if held > PIECE_BYTES:
                    cut()
                    held = 0
                if total > BATCH_BYTES:
                    yield flush()
                    held = total = 0
                    if len(words.number) > MOST_WORDS:
                        words = Words(encoder(path))
        yield flush()

    return run


def read_cache(docs: DataFrame, folder: str) -> DataFrame:
    spark = docs.sparkSession
    try:
        return spark.read.schema(ENTRY).parquet(folder)
    except AnalysisException as e:  # nothing stored yet
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ENTRY)


def cached_counts(docs: DataFrame, path: str, folder: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, UTF-8 bytes, tokens and whether these are more than `limit`; new counts are appended to `folder`."""
    version = tokenizer_digest(path)
    digested = docs.select(
        F.col(key), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), content_digest(text).alias("content"), F.col(text).alias("raw"),
    )
    have = read_cache(docs, folder).filter(F.col("tokenizer") == version).select("content").hint("shuffle_hash")
    misses = in_tasks(digested.select("content", "raw"), _local_distinct, "content binary, packed binary")
    counted = in_tasks(misses.repartition("content").join(have, "content", "left_anti"), _counter(path), "content binary, n_tokens long")
    counted.select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(folder)
    known = read_cache(docs, folder).filter(F.col("tokenizer") == version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    known = stored(known)  # a table of its own, so that the join's hot digests may be split
    return digested.join(known, "content").select(
        key, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )

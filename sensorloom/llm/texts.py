"""Shared helpers: readers, folders, texts as byte arrays in Arrow tasks, words as 64-bit hashes."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ARROW_BYTES = 4_000_000  # sent to a task's worker at once; a longer row is sent alone
PIECE_BYTES = 2_000_000  # text handled at once in a task; a longer document is a piece of its own
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder name below the folder that driver and executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage and survives lost executors."""
    path = shared_dir(df.sparkSession)
    df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the session's shared folder, which Spark removes when the frame is no longer used."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """`rows` with `rank` 1, 2, 3, ... in `order`, without a sort in one task: partitions of a range-partitioned sort hold
    consecutive rows, and each begins after the rows of those before it."""
    names = rows.columns
    cut = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    cut = stored(cut.select("*", F.monotonically_increasing_id().alias("_at")))
    part, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = cut.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).orderBy("_part").collect()  # the partitions
    before, begins = 0, []
    for r in counts:
        begins.append((r["_part"], before))
        before += r.n
    begins = rows.sparkSession.createDataFrame(begins, "_part long, _before long")
    numbered = cut.withColumn("_part", part).join(F.broadcast(begins), "_part")  # bounded by the number of partitions
    return numbered.select(*names, (F.col("_before") + inside + 1).alias("rank"))


def pieces(batch: pa.RecordBatch, text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about `limit` bytes of text, or one document."""
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(size)])
    a, n = 0, len(size)
    while a < n:
        b = max(a + 1, int(np.searchsorted(total, total[a] + limit, "right")) - 1)
        yield batch.slice(a, b - a)
        a = b


def give_back() -> None:
    """Freed memory back to the system: a worker lives on through later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def in_tasks(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """`mapInArrow` with the session's Arrow batches bounded in bytes: ten thousand rows of text may be far more than a
    worker needs at once."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return df.mapInArrow(fn, schema)


def map_texts(
    df: DataFrame, text: str, schema: str, fn: Callable[[pa.RecordBatch], pa.RecordBatch], limit: int = PIECE_BYTES
) -> DataFrame:
    """`fn` over pieces of bounded size; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text, limit):
                yield fn(piece)
            give_back()

    return in_tasks(df, run, schema)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after the other, and where each begins (one more for the end). Null: empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(seed: int, n: int) -> np.ndarray:
    """`n` fixed 64-bit numbers."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


BASE = int(constants(1, 1)[0]) | 1


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    def made(x: int) -> np.ndarray:
        steps = np.full(PIECE_BYTES + 1, x, np.uint64)
        steps[0] = 1
        return np.cumprod(steps)

    return made(BASE), made(pow(BASE, -1, 1 << 64))


class Splitter:
    """Cuts texts into words at separator bytes, and hashes the words (64 bits, the same everywhere)."""

    def __init__(self, separators: bytes, fold: bool):
        self.is_word = np.ones(256, bool)
        self.is_word[list(separators)] = False
        self.value = constants(2, 256)
        if fold:
            self.value[[ord(c) for c in UPPER]] = self.value[[ord(c) for c in LOWER]]

    def cut(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and end of each word, and each text's first word (one more for the end)."""
        inside = self.is_word[data]
        joined = inside[:-1] & inside[1:]  # byte i goes on in byte i + 1
        edge = at[(at > 0) & (at < len(data))] - 1
        joined[edge] = False
        begins, ends = inside.copy(), inside
        begins[1:] &= ~joined
        ends[:-1] &= ~joined
        start = np.flatnonzero(begins)
        return start, np.flatnonzero(ends) + 1, np.searchsorted(start, at)

    def hashes(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.empty(len(start), np.uint64)
        power, inverse = _powers()
        i = 0
        while i < len(start):
            j = max(i + 1, int(np.searchsorted(end, start[i] + PIECE_BYTES, "right")))
            a, b = int(start[i]), int(end[j - 1])
            if b - a > PIECE_BYTES:  # one very long word
                h = np.uint64(0)
                for k in range(a, b, PIECE_BYTES):
                    part = self.value[data[k : min(b, k + PIECE_BYTES)]]
                    h = mix64(np.array([(part * power[: len(part)]).sum(dtype=np.uint64) + h]))[0]
                out[i] = h
            else:
                sums = np.zeros(b - a + 1, np.uint64)
                np.cumsum(self.value[data[a:b]] * power[: b - a], out=sums[1:])
                s, e = start[i:j] - a, end[i:j] - a
                out[i:j] = (sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64)
            i = j
        return mix64(out)


def blank_words(fold: bool) -> Splitter:
    """Words `[^\\x20\\x09-\\x0D]+`."""
    return Splitter(SPACES.encode(), fold)


def hex_sha256(values: list[bytes]) -> pa.Array:
    from hashlib import sha256

    return pa.array([sha256(v).hexdigest() for v in values], pa.string())

"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Shards stand on a ring at many virtual nodes. A key belongs to the first node clockwise of its own place. Each shard has a
capacity in rows; keys that meet a full shard go on clockwise to the next shard with room. Without slack the capacities
add up to the number of rows, so that counts differ by one at most.

The ring is cut into `cells`, a fixed number. Spark counts rows per (cell, salt); only these counts, bounded by cells *
salts, pass the driver, which walks the ring once. A cell that doesn't fit is split at a row number, so the walk is exact.
Place and salt come from the rows' content alone, so no result depends on files or partitions. Rows that are equal in key,
size and checksum are one counted row until the end: they take the next numbers of their (cell, salt), whatever task had
them, and are dealt out in chunks, so a key with a third of all rows is neither numbered nor written by one task.

Null key: a key of its own. Null text: no bytes. Repeated rows are rows of their own. Empty table: empty result.
Further columns are not carried.
"""

from __future__ import annotations

import bisect
from hashlib import blake2b

from pyspark.sql import DataFrame, Window, functions as F

from sensorloom.llm.texts import stored

CELLS = 1 << 12
SALTS = 16
NODES = 64  # virtual nodes of a shard
CHUNK = 100_000  # equal rows written by one task at once


def place(name: str) -> int:
    return int.from_bytes(blake2b(name.encode(), digest_size=8).digest(), "big") % CELLS


def clockwise(shards: int) -> tuple[list[int], list[int]]:
    """Places of all virtual nodes, ascending, and their shards."""
    nodes = sorted((place(f"shard {s} node {v}"), blake2b(f"{s}/{v}".encode(), digest_size=8).digest(), s)
                   for s in range(shards) for v in range(NODES))
    return [p for p, _, _ in nodes], [s for _, _, s in nodes]


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Rows that each shard may hold. No slack: they add up to `rows`."""
    least, more = divmod(rows, shards)
    even = [least + (s < more) for s in range(shards)]
    return [int(c * (1 + slack)) for c in even] if slack else even


def walk(counts: list[tuple[int, int, int]], shards: int, slack: float) -> list[tuple[int, int, int, int, int, int]]:
    """(cell, salt, from row, to row, shard, first slot) for counts (cell, salt, rows).

    Cells come in an order of their own hash, as keys would come in any order; each goes clockwise from its place.
    """
    places, owner = clockwise(shards)
    room = capacities(sum(n for _, _, n in counts), shards, slack)
    used = [0] * shards
    out = []
    for cell, salt, n in sorted(counts, key=lambda c: blake2b(f"cell {c[0]}.{c[1]}".encode(), digest_size=8).digest()):
        at, begin, tried = bisect.bisect_left(places, cell), 0, 0
        while begin < n:
            shard = owner[(at + tried) % len(owner)]
            take = min(n - begin, room[shard])
            if take > 0:
                out.append((cell, salt, begin, begin + take, shard, used[shard]))
                room[shard] -= take
                used[shard] += take
                begin += take
            tried += 1
    return out


def ring_shards(
    docs: DataFrame, shards: int, slack: float = 0.0, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Key, size, checksum, law, shard and slot of every row."""
    spark = docs.sparkSession
    raw = F.coalesce(F.col(text), F.lit(""))
    alike = docs.select(
        F.col(key).alias("_key"), (F.octet_length(raw) + F.lit(8)).cast("long").alias("size"),
        F.crc32(raw.cast("binary")).alias("text_crc32"),
    ).groupBy("_key", "size", "text_crc32").agg(F.count("*").alias("n"))
    own = F.coalesce(F.col("_key").cast("string"), F.lit("null"))
    placed = stored(
        alike.withColumn("cell", F.pmod(F.xxhash64(own), F.lit(CELLS)).cast("int"))
        .withColumn("mixed", F.xxhash64(F.lit(1), own, "size", "text_crc32"))
        .withColumn("salt", F.pmod("mixed", F.lit(SALTS)).cast("int"))
    )
    counts = [tuple(r) for r in placed.groupBy("cell", "salt").agg(F.sum("n")).collect()]  # CELLS * SALTS at most
    made = spark.createDataFrame(
        walk(counts, shards, slack), "cell int, salt int, from_row long, to_row long, shard int, first_slot long"
    )
    order = Window.partitionBy("cell", "salt").orderBy("mixed", "_key", "size", "text_crc32")
    begun = placed.withColumn("begin", F.sum("n").over(order) - F.col("n"))
    chunks = begun.select(
        "_key", "size", "text_crc32", "cell", "salt", (F.col("begin") + F.col("n")).alias("end"),
        F.explode(F.sequence(F.col("begin"), F.col("begin") + F.col("n") - 1, F.lit(CHUNK).cast("long"))).alias("at"),
    ).repartition("cell", "salt", "at")
    upto = F.least("end", F.col("at") + CHUNK, "to_row")
    since = F.greatest("at", "from_row")
    parts = chunks.join(F.broadcast(made), ["cell", "salt"]).filter(since < upto)  # bounded as the counts are
    rows = parts.select("*", F.explode(F.sequence(since, upto - 1)).alias("row"))
    return rows.select(
        F.col("_key").alias(key), "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("first_slot") + F.col("row") - F.col("from_row")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )

"""Benchmark decontamination with suffix arrays over the training documents.

Each task orders the suffixes of its shard of the corpus by their following words and looks every suffix of the benchmark
up by binary search. A document's words inside a found window are hit; a match is then followed to its whole length.
Only words of the benchmark can match: the others are one sign that ends a run, and a suffix whose run is shorter than the
shortest window is left out of the array, which changes no result.

The benchmark is read in blocks of `BLOCK_CHARS`; each block goes to the tasks with the function, and documents pass all
blocks in one stage. Null or empty text: no words, no hits; null or empty item: no windows. Items of fewer words than a
window are one window. Repeated items count once by id; items without an id count as one, which has no name in the list.
Documents repeated are judged each by itself. Columns of the documents may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sensorloom.llm.texts import PIECE_BYTES, Splitter, in_tasks, pieces, text_bytes

WINDOW = 13
BLOCK_CHARS = 4_000_000
WORDS = Splitter(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]), True)


class Block:
    """Part of the benchmark: its words as small numbers, and all its windows."""

    def __init__(self, items: list[tuple[object, str | None]], window: int):
        self.ids = [None if i is None else str(i) for i, _ in items]
        data, at = text_bytes(pa.array([t for _, t in items], pa.string()))
        start, end, first = WORDS.cut(data, at)
        hashes = WORDS.hashes(data, start, end)
        self.vocabulary, codes = np.unique(hashes, return_inverse=True)
        self.codes = (codes + 1).astype(">u4")
        self.first, self.window = first, window
        begins, sizes, owners = [], [], []
        for i, (a, b) in enumerate(zip(first[:-1], first[1:])):
            n = min(window, b - a)
            if n:
                begins += range(a, b - n + 1)
                sizes += [n] * (b - n + 1 - a)
                owners += [i] * (b - n + 1 - a)
        self.begin, self.size, self.owner = (np.array(x, np.int64) for x in (begins, sizes, owners))
        self.least = int(self.size.min(initial=window))

    def encode(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word, 0 for a word that the benchmark doesn't have."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.uint32)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0).astype(np.uint32)


def _keys(codes: np.ndarray, begin: np.ndarray, room: np.ndarray, window: int, fill: int) -> np.ndarray:
    """The words after each position as bytes that sort as they do; `fill` beyond the text's end."""
    grid = begin[:, None] + np.arange(window)
    inside = np.arange(window) < room[:, None]
    words = np.where(inside, codes[np.minimum(grid, len(codes) - 1)], fill).astype(">u4")
    return np.ascontiguousarray(words).view(f"S{4 * window}")[:, 0]


def matches(block: Block, codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, window's number, longest match from there in words) of all occurrences of the block's windows."""
    none = np.zeros(0, np.int64)
    n = len(codes)
    if n == 0 or not len(block.begin):
        return none, none, none
    # words left in the run of benchmark words, within the text
    stop = np.zeros(n + 1, bool)
    stop[:n] = codes == 0
    stop[first] = True
    stops = np.flatnonzero(stop)
    room = stops[np.searchsorted(stops, np.arange(n), "right")] - np.arange(n)
    room[codes == 0] = 0
    suffixes = np.flatnonzero(room >= block.least)
    if not len(suffixes):
        return none, none, none
    keys = _keys(codes, suffixes, room[suffixes], block.window, 0)
    order = np.argsort(keys, kind="stable")
    suffixes, keys = suffixes[order], keys[order]
    low = np.searchsorted(keys, _keys(block.codes, block.begin, block.size, block.window, 0), "left")
    high = np.searchsorted(keys, _keys(block.codes, block.begin, block.size, block.window, 0xFFFFFFFF), "right")
    full = block.size == block.window  # a full window has equal bounds
    if full.any():
        high[full] = np.searchsorted(keys, _keys(block.codes, block.begin[full], block.size[full], block.window, 0), "right")
    number = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(low)), number)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(number) - number, number)
    position = suffixes[low[which] + offset]
    # follow each match to its end
    length = block.size[which].copy()
    most = np.minimum(room[position], block.first[block.owner[which] + 1] - block.begin[which])
    going = np.flatnonzero(length < most)
    while len(going):
        same = codes[position[going] + length[going]] == block.codes[block.begin[which[going]] + length[going]]
        going = going[same]
        length[going] += 1
        going = going[length[going] < most[going]]
    return position, which, length


FOUND = "_hits array<int>, _items array<string>, _longest int, _n_words long"


def _step(block: Block, again: bool):
    """One block over all documents; `again`: earlier blocks have left their finds in the last columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for piece in pieces(whole, "_text", PIECE_BYTES):
                column = piece.column(piece.schema.get_field_index("_text"))
                data, at = text_bytes(column)
                start, end, first = WORDS.cut(data, at)
                codes = block.encode(WORDS.hashes(data, start, end))
                position, which, length = matches(block, codes, first)
                size = block.size[which]
                change = np.bincount(position, minlength=len(codes) + 1) - np.bincount(position + size, minlength=len(codes) + 1)
                hit = np.cumsum(change)[: len(codes)] > 0
                text = np.searchsorted(first, position, "right") - 1
                items: list[set[str | None]] = [set() for _ in range(piece.num_rows)]
                longest = np.zeros(piece.num_rows, np.int32)
                np.maximum.at(longest, text, length.astype(np.int32))
                for pair in np.unique(text * len(block.ids) + block.owner[which]) if len(which) else []:
                    items[pair // len(block.ids)].add(block.ids[pair % len(block.ids)])
                hits = [np.flatnonzero(hit[a:b]).astype(np.int32) for a, b in zip(first[:-1], first[1:])]
                if again:
                    old = piece.columns[-4:]
                    hits = [np.union1d(h, o).astype(np.int32) for h, o in zip(hits, old[0].to_pylist())]
                    items = [i | set(o) for i, o in zip(items, old[1].to_pylist())]
                    longest = np.maximum(longest, old[2].to_numpy())
                made = [
                    pa.array(hits, pa.list_(pa.int32())), pa.array([sorted(i, key=lambda x: (x is None, x or "")) for i in items], pa.list_(pa.string())),
                    pa.array(longest, pa.int32()), pa.array(np.diff(first).astype(np.int64)),
                ]
                kept = piece.columns[:-4] if again else piece.columns
                names = piece.schema.names[:-4] if again else piece.schema.names
                yield pa.RecordBatch.from_arrays([*kept, *made], names=[*names, "_hits", "_items", "_longest", "_n_words"])

    return run


def searched(docs: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str, window: int, block_chars: int) -> DataFrame:
    """`docs` with hit words, items, longest match and number of words. The columns of `docs` are named by their places."""
    items = benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // block_chars) or 1
    numbered = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n)))
    out = docs.toDF(*_places(docs)).withColumn("_text", F.col(_places(docs)[docs.columns.index(text)]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
    for b in range(n):
        part = [(r.item, r.text) for r in numbered.filter(F.col("block") == b).toLocalIterator()]  # about block_chars
        out = in_tasks(out, _step(Block(part, window), b > 0), f"{schema}, {FOUND}")
    return out


def _places(docs: DataFrame) -> list[str]:
    return [f"c{i}" for i in range(len(docs.columns))]


def _verdict(share: int):
    n = F.size("_hits").cast("long")
    return n, (n > 0) & (F.lit(share) * n >= F.col("_n_words"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", window: int = WINDOW, share: int = 20, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Per document: words, hit words and their places, items found, longest verbatim match, verdict (1 / `share` of its words)."""
    found = searched(docs.select(key, text), benchmark, text, item, item_text, window, block_chars)
    n, bad = _verdict(share)
    return found.select(
        F.col("c0").alias(key), F.col("_n_words").alias("n_words"), n.alias("n_hit"), F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"), bad.alias("contaminated"),
        F.col("_hits").alias("hit_words"), F.col("_items").alias("items"), F.col("_longest").alias("longest_match"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
                   window: int = WINDOW, share: int = 20, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    found = searched(docs, benchmark, text, item, item_text, window, block_chars)
    kept = found.filter(~_verdict(share)[1])
    return kept.select(*[F.col(p).alias(c) for p, c in zip(_places(docs), docs.columns)])



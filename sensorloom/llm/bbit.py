"""Near-duplicate documents by b-bit MinHash.

1. Each document's distinct shingles are hashed; bands of minima, as many as the wanted similarity needs (28 of 6 at 0.85,
   34 of 5 at 0.80), give its buckets, and the low 4 bits of all minima, packed, its signature. Documents with equal sets have equal digests and become one representative.
2. Representatives in one bucket are compared by their packed bits (bit counts, corrected for chance collisions). Of the
   pairs above a low bar only a spanning forest leaves the task. A bucket of many members is compared in pairs of blocks,
   so that no task holds it whole.
3. The forest's edges are confirmed on the full sets, and components are built.
4. Where a bucket had more pairs above the bar than the forest shows and still holds several components, its remaining
   pairs between components are confirmed within the tasks, again with only a forest leaving them.
So no link is lost but by the signature: a pair at the limit shares no band with probability 2e-6 and falls below the bar
(five standard errors) with 3e-7; pairs above it less often.

No words or null text: no shingles, linked with nothing. Fewer words than a shingle: one shingle. Repeated rows have one
set and one component; rows of one key are one node. A null key never is a component's name; its row is kept if nothing
else holds its set or one near it. Empty table: empty result. Further columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from math import ceil, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sensorloom.llm.components import components
from sensorloom.llm.texts import blank_words, constants, in_tasks, map_texts, mix64, stored, text_bytes

SHINGLE = 5
BITS = 4
LOSS = 2e-6  # chance that a pair at the wanted similarity shares no band
BLOCK = 512  # members of a bucket compared at once
BAR = 5  # standard errors below the wanted similarity

PLACES = constants(5, SHINGLE + 1) | np.uint64(1)


class Scheme:
    """Bands and rows of a wanted similarity, and the fixed numbers of their minima."""

    def __init__(self, percent: int):
        self.rows = 6 if percent >= 85 else 5
        shared = (percent / 100) ** self.rows
        self.bands = 1 if shared == 1 else ceil(log(LOSS) / log1p(-shared))
        self.minima = self.bands * self.rows
        self.longs = -(-self.minima * BITS // 64)
        self.factors = (constants(3, self.minima) | np.uint64(1)).astype(np.uint32)[:, None]
        self.shifts = constants(4, self.minima).astype(np.uint32)[:, None]
        self.band_names = constants(6, self.bands)
        self.band_places = constants(7, self.rows) | np.uint64(1)


@lru_cache(maxsize=8)
def scheme(percent: int) -> Scheme:
    return Scheme(percent)


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingles of each text, as 64-bit hashes."""
    data, at = text_bytes(column)
    split = blank_words(True)
    start, end, first = split.cut(data, at)
    words = split.hashes(data, start, end)
    n = len(words)
    five = np.zeros(n, np.uint64)
    if n >= SHINGLE:
        five[: n - SHINGLE + 1] = mix64(sum(words[j : n - SHINGLE + 1 + j] * PLACES[j] for j in range(SHINGLE)))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= SHINGLE:
            out.append(np.unique(five[a : b - SHINGLE + 1]))
        elif b > a:
            k = b - a
            out.append(mix64((words[a:b] * PLACES[:k]).sum(dtype=np.uint64, keepdims=True) + PLACES[SHINGLE:] * np.uint64(k)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minima(shingles: np.ndarray, of: Scheme) -> np.ndarray:
    x = (shingles >> np.uint64(16)).astype(np.uint32)
    least = np.full(of.minima, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(x), 512):
        np.minimum(least, (x[a : a + 512] * of.factors + of.shifts).min(axis=1), out=least)
    return least


def bands(least: np.ndarray, of: Scheme) -> np.ndarray:
    rows = least.astype(np.uint64).reshape(of.bands, of.rows)
    return mix64((rows * of.band_places).sum(axis=1, dtype=np.uint64) + of.band_names).astype(np.int64)


def packed(least: np.ndarray, of: Scheme) -> np.ndarray:
    """Low bits of the minima, in 64-bit words."""
    low = (mix64(least.astype(np.uint64)) & np.uint64((1 << BITS) - 1)).astype(np.uint64)
    low = np.concatenate([low, np.zeros(of.longs * 64 // BITS - of.minima, np.uint64)]).reshape(of.longs, -1)
    return (low << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64)


def similarity(a: np.ndarray, b: np.ndarray, of: Scheme) -> np.ndarray:
    """Estimate from packed signatures, row by row, corrected for low bits that agree by chance."""
    x = a ^ b
    x |= x >> np.uint64(2)
    x |= x >> np.uint64(1)
    differ = np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=1, dtype=np.int64)
    chance = 1 / (1 << BITS)
    return ((of.minima - differ) / of.minima - chance) / (1 - chance)


def bar(percent: int) -> float:
    chance, s = 1 / (1 << BITS), percent / 100
    p = chance + (1 - chance) * s
    return s - BAR * (p * (1 - p) / scheme(percent).minima) ** 0.5 / (1 - chance)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _signed(percent: int):
    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        of = scheme(percent)
        n, digests, all_bands, all_bits = [], [], [], []
        for s in shingle_sets(piece.column("text")):
            n.append(len(s))
            least = minima(s, of) if len(s) else None
            digests.append(blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            all_bands.append(bands(least, of) if len(s) else None)
            all_bits.append(packed(least, of).tobytes() if len(s) else None)
        return pa.RecordBatch.from_arrays(
            [piece.column("id"), piece.column("place"), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
             pa.array(all_bands, pa.list_(pa.int64())), pa.array(all_bits, pa.binary())],
            names=["id", "place", "n", "digest", "bands", "bits"],
        )

    return run


def _sets(piece: pa.RecordBatch) -> pa.RecordBatch:
    sets = [s.tobytes() for s in shingle_sets(piece.column("text"))]
    return pa.RecordBatch.from_arrays([piece.column("rid"), pa.array(sets, pa.binary())], names=["rid", "shingles"])


class Forest:
    """Union-find over row numbers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by (bucket, i, j), in parts that cut no group."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "i", "j")]
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            change[1:] |= k[1:] != k[:-1]
        cut = np.flatnonzero(change)
        if held:
            last = held[-1]
            if any(last.column(c)[-1].as_py() != k[0] for c, k in zip(("bucket", "i", "j"), keys)):
                yield pa.Table.from_batches(held)
                held = []
        if len(cut):
            yield pa.Table.from_batches([*held, batch.slice(0, int(cut[-1]))])
            held = [batch.slice(int(cut[-1]))]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _candidates(table: pa.Table, percent: int, also=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (x, y) of one group whose estimate reaches the bar, best first."""
    of, least = scheme(percent), bar(percent)
    bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(-1, of.longs)
    bucket, i, j, own = (table.column(c).to_numpy() for c in ("bucket", "i", "j", "own"))
    xs, ys, es = [], [], []
    for d in range(1, table.num_rows):
        x = np.flatnonzero((bucket[:-d] == bucket[d:]) & (i[:-d] == i[d:]) & (j[:-d] == j[d:]))
        if not len(x):
            break
        x = x[(i[x] == j[x]) | (own[x] != own[x + d])]
        if also is not None:
            x = x[also(x, x + d)]
        e = similarity(bits[x], bits[x + d], of)
        good = e >= least
        xs.append(x[good]), ys.append(x[good] + d), es.append(e[good])
    if not xs:
        none = np.zeros(0, np.int64)
        return none, none, none
    x, y, e = np.concatenate(xs), np.concatenate(ys), np.concatenate(es)
    order = np.argsort(-e, kind="stable")
    return x[order], y[order], e[order]


def _forests(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            x, y, _ = _candidates(table, percent)
            forest = Forest(table.num_rows)
            edges, spare = [], []
            for a, b in zip(x.tolist(), y.tolist()):
                (edges if forest.join(a, b) else spare).append((a, b))
            more = {forest.root(a) for a, _ in spare}
            rows = np.array([a for a, _ in edges], np.int64)
            rid = table.column("rid").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(table.column(c).to_numpy()[rows]) for c in ("bucket", "i", "j")), pa.array(rid[rows]),
                 pa.array(rid[np.array([b for _, b in edges], np.int64)]),
                 pa.array([forest.root(a) in more for a, _ in edges], pa.bool_())],
                names=["bucket", "i", "j", "a", "b", "more"],
            )

    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = ([np.frombuffer(s.as_py(), np.uint64) for s in batch.column(c)] for c in ("sa", "sb"))
            yield batch.select(["a", "b"]).filter(pa.array([linked(a, b, percent) for a, b in zip(*sets)], pa.bool_()))

    return run


def _rest(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            part = table.column("part").to_numpy()
            own_bands = np.array(table.column("bands").to_pylist(), np.int64)
            bucket = table.column("bucket").to_numpy()

            def also(x: np.ndarray, y: np.ndarray) -> np.ndarray:
                """Of different components, and in the first bucket that the two share."""
                same = own_bands[x] == own_bands[y]
                return (part[x] != part[y]) & (own_bands[x, same.argmax(axis=1)] == bucket[x])

            x, y, _ = _candidates(table, percent, also)
            sets = [np.frombuffer(s.as_py(), np.uint64) for s in table.column("shingles")]
            number = {p: k for k, p in enumerate(np.unique(part).tolist())}
            forest = Forest(len(number))
            rid = table.column("rid").to_numpy()
            edges = []
            for a, b in zip(x.tolist(), y.tolist()):
                p, q = number[part[a]], number[part[b]]
                if forest.root(p) != forest.root(q) and linked(sets[a], sets[b], percent):
                    forest.join(p, q)
                    edges.append((rid[a], rid[b]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in edges], pa.int64()), pa.array([b for _, b in edges], pa.int64())], names=["a", "b"]
            )

    return run


GROUP = ("bucket", "i", "j")


def near_duplicates(docs: DataFrame, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key (a long), number of shingles, component (its smallest key) and whether the row's key is the component's."""
    raw = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("place"), F.col(text).alias("text"))
    signed = stored(map_texts(raw, "text", "id long, place long, n long, digest binary, bands array<long>, bits binary", _signed(percent)))
    # one representative of each set; a set held by rows without a key only gets a negative name
    reps = stored(
        signed.filter("digest is not null").groupBy("digest")
        .agg(F.min("id").alias("least"), F.min(F.struct("id", "place")).alias("at"), F.first("bands").alias("bands"), F.first("bits").alias("bits"))
        .withColumn("rid", F.coalesce("least", -F.abs(F.xxhash64("digest")) - 1))
    )
    banded = reps.select(F.explode("bands").alias("bucket"), "rid")
    shared = banded.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = banded.join(shared, "bucket").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    members = members.withColumn("own", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rid")
    in_groups = members.join(reps.select("rid", "bits"), "rid").repartition(*GROUP).sortWithinPartitions(*GROUP)
    found = stored(in_tasks(in_groups, _forests(percent), "bucket long, i int, j int, a long, b long, more boolean"))

    pairs = found.select("a", "b").distinct()
    ends = found.select(F.explode(F.array("a", "b")).alias("rid")).distinct()
    where = reps.join(ends, "rid").select("rid", F.coalesce(F.col("at.id"), F.lit(0)).alias("known"), F.col("at.place").alias("place"))
    known = raw.withColumn("known", F.coalesce("id", F.lit(0)))
    texts = known.join(where.hint("shuffle_hash"), ["known", "place"]).select("rid", "text")
    sets = stored(map_texts(texts, "text", "rid long, shingles binary", _sets))
    one = sets.dropDuplicates(["rid"])

    def side(name: str, column: str) -> DataFrame:
        return one.select(F.col("rid").alias(name), F.col("shingles").alias(column))

    links = stored(in_tasks(pairs.join(side("a", "sa"), "a").join(side("b", "sb"), "b").select("a", "b", "sa", "sb"), _confirmed(percent), "a long, b long"))
    parts = stored(components(links))

    open_ = found.filter("more").select(*GROUP, F.explode(F.array("a", "b")).alias("rid")).distinct()
    open_ = open_.join(parts.withColumnRenamed("node", "rid"), "rid", "left").withColumn("part", F.coalesce("component", "rid")).drop("component")
    several = open_.groupBy(*GROUP).agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q").select(*GROUP)
    rest = open_.join(several, [*GROUP]).join(members.select(*GROUP, "rid", "own"), [*GROUP, "rid"])
    rest = rest.join(reps.select("rid", "bits", "bands"), "rid").join(one, "rid")
    rest = rest.select(*GROUP, "own", "rid", "part", "bits", "bands", "shingles").repartition(*GROUP).sortWithinPartitions(*GROUP)
    late = stored(in_tasks(rest, _rest(percent), "a long, b long"))

    parts = stored(components(links.union(late)))
    named = reps.select("digest", "rid", "least").join(parts.withColumnRenamed("node", "rid"), "rid", "left")
    smallest = named.filter("component is not null").groupBy("component").agg(F.min("least").alias("smallest"))
    named = named.join(smallest, "component", "left").select("digest", F.coalesce("smallest", "least").alias("component"))
    done = signed.join(named, "digest", "left").withColumn("component_id", F.coalesce("component", "id"))
    return done.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def without_near_duplicates(docs: DataFrame, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, with all columns."""
    keep = near_duplicates(docs, percent, key, text).filter("kept").select(F.col(key).alias("_kept")).distinct()
    return docs.join(keep.hint("shuffle_hash"), docs[key].eqNullSafe(F.col("_kept")), "left_semi")

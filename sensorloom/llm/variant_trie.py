"""Spelling variants: words one letter apart, found in a trie over letter counts, and each word's more frequent form.

A word is a vector of counts over letter groups. A trie arranges the words by these counts, one group a level. The search for
a word's neighbours goes down with a budget of one surplus and one deficit: an inserted letter is a surplus of one, a deleted
letter a deficit of one, a replaced one both or (inside a group) neither. The words of a leaf that is reached are compared
letter by letter. Each pair is found once: the longer word looks for the shorter one, and of two words of one length, the one
that has the surplus in the earlier group does.

Spark counts the words (merged map-side), and cuts the trie into parts by length and the counts of a few coarse groups, each
of which is a run of the fine ones. A word is a member of one part and, with four groups, asks in at most eleven, again by
the budget. The number of groups grows with the vocabulary, so that parts stay small. A part's members come before its questions, so a task holds one part of the trie and one batch of questions at a time; what
leaves it is at most one row per word: neighbours counted, and the best of them. A very frequent word is one row after
counting.

Words are runs of Latin-1 letters, so a byte each. Null or empty text: no words. Null key: noise digests are of an empty key.
Repeated rows count again. A word without a near one has n_near 0 and no form; empty table: empty result.
Further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.llm.texts import LOWER, UPPER, give_back, in_tasks, stored

LEAST_LETTERS = 7
LEAST_COUNT = 2
FACTOR = 10  # how much more frequent a form is
NOISE = 31
FINE = 32  # a fine group is a code point modulo 32, a coarse one modulo a smaller power of two
LETTERS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
FRONTIER = 400_000  # places of the search held at once
PAIRS_BYTES = 8_000_000  # letters compared at once


def occurrences(docs: DataFrame, key: str, text: str, noise: int) -> DataFrame:
    """(word): each run of `LEAST_LETTERS` letters or more; one letter less where the digest of key and run says so."""
    runs = F.regexp_extract_all(F.col(text), F.lit(f"[A-Za-zÀ-ÿ]{{{LEAST_LETTERS},}}"), F.lit(0))
    made = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key"), F.explode(runs).alias("run"))
    made = made.withColumn("run", F.translate("run", UPPER, LOWER))
    h = F.crc32(F.concat(F.col("_key"), F.lit(":"), F.col("run")).cast("binary"))
    made = made.withColumn("h", h)
    at = F.pmod(F.col("h"), F.length("run").cast("long")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return made.select(F.when(F.col("h") % noise == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", noise: int = NOISE) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    counts = occurrences(docs, key, text, noise).groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter((F.length("word") >= LEAST_LETTERS) & (F.col("n") >= LEAST_COUNT))


def coarse_groups(words: int) -> int:
    """Four, and twice as many for every 32-fold vocabulary above 2^24 words."""
    return min(16, 4 << max(0, math.ceil(math.log(max(words, 1) / (1 << 24), 32))))


def levels(groups: int) -> np.ndarray:
    """Level of each code point in the trie: fine groups, coarse group by coarse group."""
    return np.array([(c % FINE) % groups * (FINE // groups) + (c % FINE) // groups for c in range(256)])


def _coarse(word: Column, groups: int) -> list[Column]:
    members = ["".join(chr(c) for c in LETTERS if c % groups == g) for g in range(groups)]
    return [(F.length(word) - F.length(F.translate(word, m, ""))).cast("long") for m in members]


def _part(length: Column, counts: list[Column]) -> Column:
    return F.xxhash64(length.cast("long"), *counts)


def steps(groups: int) -> list[tuple[int, int, int]]:
    """(change of length, group with a surplus or -1, group with a deficit or -1) that a question may take between parts."""
    same = [(0, i, j) for i in range(groups) for j in range(i + 1, groups)]
    return [(0, -1, -1), *same, *[(-1, -1, j) for j in range(groups)]]


def parts(words: DataFrame, groups: int) -> DataFrame:
    """Members (asks false) and questions of each part of the trie."""
    counted = words.select(
        F.encode("word", "ISO-8859-1").alias("word"), "n", F.length("word").alias("length"),
        *[c.alias(f"c{g}") for g, c in enumerate(_coarse(F.col("word"), groups))],
    )
    own = [F.col(f"c{g}") for g in range(groups)]
    asked = []
    for longer, up, down in steps(groups):
        there = [c + F.lit((g == up) - (g == down)).cast("long") for g, c in enumerate(own)]
        possible = F.lit(True) if down < 0 else own[down] > 0
        asked.append(F.when(possible, F.struct(F.lit(True).alias("asks"), F.lit(longer < 0).alias("shorter"),
                                               _part(F.col("length") + longer, there).alias("part"))))
    home = F.struct(F.lit(False).alias("asks"), F.lit(False).alias("shorter"), _part(F.col("length"), own).alias("part"))
    made = counted.select("word", "n", F.explode(F.array(home, *asked)).alias("p")).filter("p is not null")
    return made.select("p.part", "p.asks", "p.shorter", "word", "n")


def matrix(words: pa.Array) -> np.ndarray:
    """Words of one length, at least one, as rows of bytes."""
    return np.frombuffer(b"".join(words.to_pylist()), np.uint8).reshape(len(words), -1)


def vectors(letters: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Counts of each word's letters by fine group."""
    n, width = letters.shape
    out = np.empty((n, FINE), np.int32)
    step = max(1, PAIRS_BYTES // 8 // width)
    for a in range(0, n, step):
        some = level[letters[a : a + step]]
        at = np.arange(len(some))[:, None] * FINE + some
        out[a : a + step] = np.bincount(at.ravel(), minlength=len(some) * FINE).reshape(-1, FINE)
    return out


class Trie:
    """Words of one length and their counts, sorted by vector. Level by level: (node above, count) of each node, ascending."""

    def __init__(self, letters: np.ndarray, n: np.ndarray, level_of: np.ndarray):
        self.level_of = level_of
        own = vectors(letters, level_of)
        order = np.lexsort(own.T[::-1])
        self.letters, self.n, own = letters[order], n[order], own[order]
        self.base = int(own.max(initial=0)) + 3
        self.keys = []
        fresh, above = np.zeros(len(own), bool), np.zeros(len(own), np.int64)
        fresh[:1] = True
        for level in range(FINE):
            fresh[1:] |= own[1:, level] != own[:-1, level]
            at = np.flatnonzero(fresh)
            self.keys.append(above[at] * self.base + own[at, level])
            above = np.cumsum(fresh) - 1
        self.leaf = np.append(np.flatnonzero(fresh), len(own))  # first word of each leaf
        self.found = Found(len(own))

    def search(self, own: np.ndarray, shorter: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Blocks of (question, leaf, whether the budget was touched) for questions' vectors. Depth first, by blocks."""
        n = len(own)
        stack = [(0, np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int8))]
        while stack:
            level, q, node, spent = stack.pop()
            if len(q) > FRONTIER:
                half = len(q) // 2
                stack += [(level, q[half:], node[half:], spent[half:]), (level, q[:half], node[:half], spent[:half])]
                continue
            if not len(q):
                continue
            if level == FINE:
                yield q, node, spent
                continue
            have = own[q, level]
            ways = [(q, node, have, spent)]
            # spent: 0 nothing, 1 the surplus, 2 all. A shorter word is one deficit away; else the surplus comes first
            rich = spent == 0
            if not shorter:
                ways.append((q[rich], node[rich], have[rich] + 1, np.ones(int(rich.sum()), np.int8)))
            lend = (rich if shorter else spent == 1) & (have > 0)
            ways.append((q[lend], node[lend], have[lend] - 1, np.full(int(lend.sum()), 2, np.int8)))
            q, node, value, spent = (np.concatenate(x) for x in zip(*ways))
            key = node * self.base + value
            keys = self.keys[level]
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = (keys[at] == key) & (value < self.base)
            stack.append((level + 1, q[hit], at[hit], spent[hit]))

    def near(self, letters: np.ndarray, shorter: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (question, member) that differ by one letter."""
        width = letters.shape[1]
        limit = max(1, PAIRS_BYTES // max(width, 1))
        for q, leaf, spent in self.search(vectors(letters, self.level_of), shorter):
            done = spent == 2 if shorter else spent != 1
            q, leaf, spent = q[done], leaf[done], spent[done]
            first, size = self.leaf[leaf], self.leaf[leaf + 1] - self.leaf[leaf]
            upto = np.cumsum(size)
            for a in range(0, int(upto[-1]) if len(upto) else 0, limit):
                i = np.arange(a, min(a + limit, int(upto[-1])))
                of = np.searchsorted(upto, i, "right")
                member = first[of] + i - (upto[of] - size[of])
                mine, theirs = letters[q[of]], self.letters[member]
                ok = one_deleted(mine, theirs) if shorter else one_replaced(mine, theirs, spent[of] == 0)
                yield q[of[ok]], member[ok]


def one_replaced(a: np.ndarray, b: np.ndarray, alike: np.ndarray) -> np.ndarray:
    """Rows that differ at one place. Where the vectors are `alike`, both words ask: the smaller at that place is taken."""
    other = a != b
    at = other.argmax(axis=1)
    rows = np.arange(len(a))
    return (other.sum(axis=1) == 1) & (~alike | (a[rows, at] < b[rows, at]))


def one_deleted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows where b is a without one letter: what agrees from the left and from the right covers b."""
    left = np.logical_and.accumulate(a[:, :-1] == b, axis=1).sum(axis=1)
    right = np.logical_and.accumulate((a[:, 1:] == b)[:, ::-1], axis=1).sum(axis=1)
    return left + right >= b.shape[1]


class Found:
    """Near words of a list of words: how many, the largest count among them and the first word that has it."""

    def __init__(self, n: int):
        self.near = np.zeros(n, np.int64)
        self.n = np.zeros(n, np.int64)
        self.form = np.full(n, None, object)

    def add(self, at: np.ndarray, count: np.ndarray, words: np.ndarray) -> None:
        if not len(at):
            return
        self.near += np.bincount(at, minlength=len(self.near))
        order = np.lexsort((-count, at))
        at, count = at[order], count[order]
        group = np.flatnonzero(np.diff(at, prepend=-1))
        top = count[group]
        tied = count == np.repeat(top, np.diff(np.append(group, len(at))))
        for i, c, w in zip(at[tied].tolist(), count[tied].tolist(), words[order][tied].tolist()):
            w = bytes(w)
            if c > self.n[i] or c == self.n[i] and w < self.form[i]:
                self.n[i], self.form[i] = c, w

    def rows(self, words: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(self.near)
        made = [pa.array([bytes(w) for w in words[at].tolist()], pa.binary()), pa.array(self.near[at]), pa.array(self.n[at]),
                pa.array(self.form[at].tolist(), pa.binary())]
        return pa.RecordBatch.from_arrays(made, names=["word", "near", "form_n", "form"])


FOUND = "word binary, near long, form_n long, form binary"


def _searched(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part, members first."""
    level_of = levels(groups)
    current, members, trie = None, [], None
    for batch in batches:
        part, asks, shorter = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        kind = np.stack([part, asks.astype(np.int64), shorter.astype(np.int64)])
        cuts = [0, *(np.flatnonzero((kind[:, 1:] != kind[:, :-1]).any(axis=0)) + 1).tolist(), len(part)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            if part[a] != current:
                if trie is not None:
                    yield trie.found.rows(trie.letters)
                current, members, trie = part[a], [], None
            words, n = matrix(batch.column(3).slice(a, b - a)), batch.column(4).slice(a, b - a).to_numpy()
            if not asks[a]:
                members.append((words, n))
                continue
            if trie is None:
                if not members:
                    continue  # nobody lives in this part
                trie = Trie(np.concatenate([w for w, _ in members]), np.concatenate([n for _, n in members]), level_of)
                members = []
            found = Found(len(words))
            for q, m in trie.near(words, bool(shorter[a])):
                found.add(q, trie.n[m], trie.letters[m])
                trie.found.add(m, n[q], words[q])
            yield found.rows(words)
        give_back()
    if trie is not None:
        yield trie.found.rows(trie.letters)


def neighbours(words: DataFrame, groups: int) -> DataFrame:
    """(word, n_near, best): of each word that has near words; best holds the largest n, negated, and the first such word."""
    dealt = parts(words, groups).repartition("part").sortWithinPartitions("part", "asks", "shorter")
    found = in_tasks(dealt, lambda batches: _searched(batches, groups), FOUND)
    text = [F.decode(F.col(c), "ISO-8859-1").alias(c) for c in ("word", "form")]
    found = found.select(text[0], "near", "form_n", text[1])
    least = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), least.alias("best"))


def variants(words: DataFrame, factor: int = FACTOR, groups: int | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word in a table (word, n) without repeats."""
    words = stored(words.select("word", "n"))
    near = neighbours(words, groups or coarse_groups(words.count())).withColumnRenamed("word", "_word")
    made = words.join(near, F.col("word") == F.col("_word"), "left")
    enough = -F.col("best.less") >= factor * F.col("n")
    made = stored(made.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
    ))
    links = made.filter("form is not null").select(F.col("word").alias("_from"), F.col("form").alias("_to"))
    most = made.agg(F.max("n")).first()[0] or 1
    # n grows by the factor at each step, so a chain has at most `length` steps; each round doubles those taken
    length = int(math.log(max(most / LEAST_COUNT, 1), factor) + 1e-9)
    for _ in range(max(0, math.ceil(math.log2(length))) if length else 0):
        on = links.select(F.col("_from").alias("_next"), F.col("_to").alias("_far"))
        links = links.join(on, F.col("_to") == F.col("_next"), "left").select("_from", F.coalesce("_far", "_to").alias("_to"))
        links = stored(links)
    return made.join(links, F.col("word") == F.col("_from"), "left").select(
        "word", "form", F.coalesce("_to", "word").alias("root"), "n", "n_near", "form_n"
    )

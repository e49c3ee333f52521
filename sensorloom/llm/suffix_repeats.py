"""Quality rules from repeated passages within a document, found by a suffix array over its words.

All words of a piece of the corpus are ordered by their following words (prefix doubling in numpy; a word of one
document never equals that of another). The longest common prefix of neighbours gives, for each word, the longest passage
that begins there and occurs once more in the document. The union of these spans is the repeated part.

Null or empty text: no words, fails the base rule. Repeated rows are judged each by itself. Other columns are carried
along by `keep_good` only. Memory is bounded by the piece of text handled at once, or the longest document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sensorloom.llm.texts import SPACES, blank_words, map_texts, mix64, text_bytes

SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """Rules of a good document. Shares in hundredths."""

    least_words: int = 10
    repeat_words: int = 5  # words of the shortest passage that counts
    most_repeated: int = 20  # of the words
    most_covered: int = 20  # of the characters of all words, in repeated passages
    longest_repeat: int = 50  # words


def longest_repeats(words: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each word that begins a passage of `least` words or more found twice in its text: (position, words)."""
    n, sizes = len(words), np.diff(first)
    none = np.zeros(0, np.int64)
    if n == 0:
        return none, none
    text = np.repeat(np.arange(len(sizes)), sizes)
    end = np.repeat(first[1:], sizes)
    # names of single words, by text; equal names are neighbours
    named = mix64(words ^ mix64(text.astype(np.uint64)))
    order = np.argsort(named)
    new = np.ones(n, bool)
    new[1:] = named[order[1:]] != named[order[:-1]]
    starts = np.flatnonzero(new)
    rank = np.empty(n, np.int32)
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    group = np.repeat(np.diff(np.append(starts, n)), np.diff(np.append(starts, n)))
    active = order[group > 1]
    levels, k, enough = [rank], 1, active if least == 1 else None
    while len(active):
        after = active + k
        inside = after < end[active]
        second = np.zeros(len(active), np.int64)
        second[inside] = rank[after[inside]].astype(np.int64) + 1
        one = rank[active].astype(np.int64)
        key = one * (n + 1) + second
        order = np.argsort(key)
        key, pos, one = key[order], active[order], one[order]
        new = np.ones(len(pos), bool)
        new[1:] = key[1:] != key[:-1]
        starts = np.flatnonzero(new)
        sizes_ = np.diff(np.append(starts, len(pos)))
        base = np.ones(len(pos), bool)
        base[1:] = one[1:] != one[:-1]
        bases = np.flatnonzero(base)
        shift = np.repeat(bases, np.diff(np.append(bases, len(pos))))
        rank = rank.copy()
        rank[pos] = one + np.repeat(starts, sizes_) - shift
        k *= 2
        active = pos[np.repeat(sizes_, sizes_) > 1]
        if 2 * k > least and enough is None:
            enough = active  # they share k words, k <= least
        levels.append(rank)
    if enough is None or not len(enough):
        return none, none
    suffixes = enough[np.argsort(rank[enough])]
    a, b = suffixes[:-1], suffixes[1:]
    common = np.zeros(len(a), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        names, x, y = levels[level], a + common, b + common
        ok = (x < end[a]) & (y < end[b])
        ok[ok] = names[x[ok]] == names[y[ok]]
        common[ok] += 1 << level
    common[text[a] != text[b]] = 0
    best = np.zeros(len(suffixes), np.int64)
    best[1:] = common
    best[:-1] = np.maximum(best[:-1], common)
    keep = best >= least
    return suffixes[keep], best[keep]


def measures(column: pa.Array, limits: Limits) -> dict[str, np.ndarray]:
    """Counts of each text and the verdict on it."""
    data, at = text_bytes(column)
    start, end, first = blank_words(False).cut(data, at)
    words = blank_words(False).hashes(data, start, end)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
    chars = points[end] - points[start]
    position, length = longest_repeats(words, first, limits.repeat_words)
    change = np.bincount(position, minlength=len(words) + 1) - np.bincount(position + length, minlength=len(words) + 1)
    covered = np.cumsum(change)[: len(words)] > 0

    def by_text(values: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[first])

    longest = np.zeros(len(column), np.int64)
    np.maximum.at(longest, np.searchsorted(first, position, "right") - 1, length)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    symbols = np.concatenate([[0], np.cumsum(symbol[data], dtype=np.int64)])
    n_words, n_repeat = np.diff(first), by_text(covered)
    word_chars, covered_chars = by_text(chars), by_text(chars * covered)
    base_failed = (n_words < limits.least_words) | (100 * n_repeat > limits.most_repeated * n_words)
    kept = ~base_failed & (100 * covered_chars <= limits.most_covered * word_chars) & (longest <= limits.longest_repeat)
    twice = np.zeros(len(column), np.int64)
    for i, text in enumerate(column.to_pylist()):
        if text and "\n" in text:
            lines = [line for line in text.split("\n") if line.strip(SPACES)]
            twice[i] = len(lines) - len(set(lines))
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": np.diff(symbols[at]), "n_dup_lines": twice,
        "n_repeat_words": n_repeat, "base_failed": base_failed, "kept": kept, "covered_chars": covered_chars,
        "longest_repeat": longest,
    }


KINDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean,"
    " kept boolean, covered_chars long, longest_repeat long"
)


def repeat_rules(docs: DataFrame, limits: Limits = Limits(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, counts, repeated part and verdict."""

    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        found = measures(piece.column(1), limits)
        return pa.RecordBatch.from_arrays(
            [piece.column(0), *(pa.array(v) for v in found.values())], names=[key, *found]
        )

    picked = docs.select(key, text)
    return map_texts(picked, text, f"`{key}` {picked.schema[key].dataType.simpleString()}, {KINDS}", run)


def keep_good(docs: DataFrame, limits: Limits = Limits(), text: str = "text") -> DataFrame:
    """The documents that pass, with all their columns."""

    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        return piece.filter(pa.array(measures(piece.column(text), limits)["kept"]))

    return map_texts(docs, text, docs.schema, run)

"""Secrets: fixed patterns, and values in a credential context that are hard to guess.

A value that stands after a word such as `pwd` or `client_secret` is cut into segments by dynamic programming over its
positions, at the least sum of log10 guesses. A segment is a word by its rank, a date, a repeat of a unit, a walk on a keyboard,
or brute force character by character. A value at `LEAST_COST` or above is a secret; `changeme` or `2024-01-01` is not one.

Ranks of words come from the corpus itself: Spark counts the ASCII words of all texts, and the `DICTIONARY` most frequent
ones (a bounded table, an assumption of the cost model and not a cut of the rows) go to the tasks behind the fixed placeholders.
Texts are scanned whole, in one pass without a shuffle. A very frequent word is merged map-side before the count's shuffle.

Repeats and walks are maximal ones, so the work per value is linear in its length. Null or empty text: no spans. Repeated rows
get the same spans each. Keys, null ones too, are carried only. Empty table: empty result. Further columns are not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sensorloom.llm.texts import hex_sha256, map_texts, ranked

# The base patterns, with the least length of a match (of group 2 where it has one).
BASE = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),  # a shorter run holds no longer one
]
ASSIGNED = ["password", "passwd", "secret", "token", "apikey", "api_key"]
KINDS = ["assign", "access", "hex", "guess"]
# Words that announce a credential.
CREDENTIALS = (
    "password passwd passphrase passcode pwd pass secret token api_key api-key apikey access_key access-key auth_key"
    " authorization auth bearer credential credentials client_secret private_key signing_key encryption_key login_key"
).split()
# What stands in examples and bad passwords, most guessed first.
PLACEHOLDERS = (
    "password admin changeme change welcome letmein secret default example test user root guest login master dragon monkey"
    " sunshine princess football baseball shadow superman iloveyou qwerty abc your my value here token key placeholder none"
    " null undefined true false redacted hidden dummy sample insert replace string http https www com org net"
).split()
DICTIONARY = 20_000  # corpus words with a rank
LONGEST_WORD = 24
LEAST_COST = 8.0  # log10 guesses
LONGEST_UNIT = 12  # of a repeat
LEAST_WALK = 4
# Rows of a keyboard, plain and shifted; each row begins half a key to the right of the one above.
ROWS = [("1234567890-=", "!@#$%^&*()_+"), ("qwertyuiop[]", "QWERTYUIOP{}"), ("asdfghjkl;'", 'ASDFGHJKL:"'), ("zxcvbnm,./", "ZXCVBNM<>?")]
YEARS = 200

CONTEXT = re.compile(
    r"(?<![A-Za-z0-9])(?:%s)(?![A-Za-z0-9])[\"']?\x20*(?:=>|:=|[:=]|\x20is\x20)\x20*[\"'`]?([^\s\"'`<>,;]+)"
    % "|".join(re.escape(c) for c in sorted(CREDENTIALS, key=len, reverse=True)),
    re.I | re.A,
)
LEAST_VALUE = 6
DATE = re.compile(
    r"(?:1[89]|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0?[1-9]|[12]\d|3[01])[-/._](?:0?[1-9]|1[0-2])[-/._](?:1[89]|20)?\d\d"
    r"|(?:0[1-9]|[12]\d|3[01])(?:0[1-9]|1[0-2])(?:1[89]|20)\d\d",
    re.A,
)
YEAR = re.compile(r"(?:1[89]|20)\d\d", re.A)
LEET = str.maketrans("4310578$@!", "aeioastsai")


@lru_cache(maxsize=1)
def _keys() -> dict[str, tuple[float, int]]:
    return {c: (x + y / 2, y) for y, rows in enumerate(ROWS) for row in rows for x, c in enumerate(row)}


def _step(a: str, b: str) -> tuple[float, int] | None:
    """Direction from one key to a key beside it."""
    keys = _keys()
    if a not in keys or b not in keys:
        return None
    (x0, y0), (x1, y1) = keys[a], keys[b]
    way = (x1 - x0, y1 - y0)
    return way if abs(way[1]) <= 1 and 0 < abs(way[0]) <= 1 else None


def brute_cost(char: str) -> float:
    if char.isascii():
        return math.log10(10 if char.isdigit() else 26 if char.isalpha() else 33)
    return 2.0


def case_cost(word: str) -> float:
    """How many ways of writing the word's letters large: one for the plain ones, else what it takes to place them."""
    upper = sum(c.isupper() for c in word)
    if upper == 0:
        return 0.0
    if word.isupper() or (upper == 1 and word[0].isupper()):
        return math.log10(2)
    letters = sum(c.isalpha() for c in word)
    return math.log10(sum(math.comb(letters, k) for k in range(1, min(upper, letters - upper) + 1)) or 2)


class Guesses:
    """Cost model over a list of words, most frequent first."""

    def __init__(self, words: list[str]):
        self.words, self.rank, self.begins = words, {}, set()
        for word in dict.fromkeys([*PLACEHOLDERS, *words]):
            if 3 <= len(word) <= LONGEST_WORD or word in PLACEHOLDERS:
                self.rank[word] = math.log10(len(self.rank) + 2)
                self.begins.update(word[:i] for i in range(1, len(word) + 1))
        self.known: dict[str, float] = {}

    def __reduce__(self):  # tasks get the words alone
        return Guesses, (self.words,)

    def words_at(self, value: str, plain: str, at: int) -> Iterator[tuple[int, float]]:
        for end in range(at + 1, min(len(value), at + LONGEST_WORD) + 1):
            if plain[at:end] not in self.begins:
                return
            rank = self.rank.get(plain[at:end])
            if rank is not None:
                written = value[at:end]
                swapped = math.log10(2) if written.lower() != plain[at:end] else 0.0
                yield end, rank + swapped + case_cost(written)

    def dates_at(self, value: str, at: int) -> Iterator[tuple[int, float]]:
        m = DATE.match(value, at)
        if m:
            yield m.end(), math.log10(366 * YEARS) + (0.0 if m.group().isdigit() else math.log10(4))
        m = YEAR.match(value, at)
        if m:
            yield m.end(), math.log10(YEARS)

    def walks(self, value: str) -> Iterator[tuple[int, int, float]]:
        """Maximal walks of at least `LEAST_WALK` keys."""
        at = 0
        while at < len(value):
            end, turns, last = at + 1, 0, None
            while end < len(value) and (way := _step(value[end - 1], value[end])):
                turns += way != last
                last, end = way, end + 1
            if end - at >= LEAST_WALK:
                yield at, end, math.log10(len(_keys()) * (end - at)) + turns * math.log10(6)
            at = end

    def repeats(self, value: str) -> Iterator[tuple[int, int, float]]:
        """Maximal runs of a unit that stands at least twice."""
        n = len(value)
        for unit in range(1, min(LONGEST_UNIT, n // 2) + 1):
            at = 0
            while at + unit < n:
                end = at
                while end + unit < n and value[end] == value[end + unit]:
                    end += 1
                times = (end - at) // unit + 1
                if times >= 2:
                    yield at, at + times * unit, self.cost(value[at : at + unit]) + math.log10(times)
                at = end + 1

    def segments(self, value: str) -> list[list[tuple[int, float]]]:
        """By its begin: end and cost of each segment."""
        plain = value.lower()
        swapped = plain.translate(LEET)
        out: list[list[tuple[int, float]]] = [[] for _ in value]
        for at, char in enumerate(value):
            out[at].append((at + 1, brute_cost(char)))
            out[at] += self.words_at(value, plain, at)
            if swapped != plain:
                out[at] += self.words_at(value, swapped, at)
            if "0" <= char <= "9":
                out[at] += self.dates_at(value, at)
        for at, end, cost in (*self.walks(value), *self.repeats(value)):
            out[at].append((end, cost))
        return out

    def cost(self, value: str) -> float:
        """The least sum of log10 guesses over all ways to cut `value`."""
        if value in self.known:
            return self.known[value]
        best = [0.0] + [math.inf] * len(value)
        for at, ways in enumerate(self.segments(value)):
            for end, cost in ways:
                if best[at] + cost < best[end]:
                    best[end] = best[at] + cost
        if len(self.known) < 100_000 and len(value) <= 256:
            self.known[value] = best[-1]
        return best[-1]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(begin, kind, end) of the fixed patterns."""
    out, plain = [], text.lower()
    for kind, (name, pattern, group, least) in enumerate(BASE):
        if name == "assign" and not any(w in plain for w in ASSIGNED):
            continue
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), kind, m.end()))
    return out


def credential_values(text: str) -> Iterator[tuple[int, int]]:
    plain = text.lower()
    for m in CONTEXT.finditer(text) if any(w in plain for w in CREDENTIALS) else ():
        if m.end(1) - m.start(1) >= LEAST_VALUE:
            yield m.span(1)


def spans(text: str, guesses: Guesses) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], float | None]:
    """Base spans, spans added by cost that no base span covers, and the greatest cost of a credential's value."""
    base = sorted(base_spans(text))
    begins, upto = [x for x, _, _ in base], list(accumulate((y for _, _, y in base), max))
    added, hardest = [], None
    for a, b in credential_values(text):
        cost = guesses.cost(text[a:b])
        hardest = cost if hardest is None else max(hardest, cost)
        at = bisect_right(begins, a)
        if cost >= LEAST_COST and not (at and upto[at - 1] >= b):
            added.append((a, KINDS.index("guess"), b))
    return base, added, hardest


def listed(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in sorted(found))


def dictionary(docs: DataFrame, text: str = "text", size: int = DICTIONARY) -> list[str]:
    """The most frequent ASCII words of all texts; `size` rows at most pass the driver."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit(f"[a-z]{{3,{LONGEST_WORD}}}"), F.lit(0))).alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    top = ranked(counts, F.desc("n"), F.asc("word")).filter(F.col("rank") <= size)
    return [r.word for r in sorted(top.collect(), key=lambda r: r["rank"])]


def secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", words: list[str] | None = None) -> DataFrame:
    """Key, counts by kind, digest of the base spans, all spans, and the greatest cost of a credential's value."""
    model = Guesses(dictionary(docs, text) if words is None else words)

    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        rows = [spans(t or "", model) for t in piece.column(1).to_pylist()]
        counts = [pa.array([sum(k == kind for _, k, _ in b + a) for b, a, _ in rows], pa.int64()) for kind in range(len(KINDS))]
        made = [
            *counts[:3], hex_sha256([listed(b).encode() for b, _, _ in rows]),
            pa.array([listed(b + a) for b, a, _ in rows], pa.string()), counts[3], pa.array([h for _, _, h in rows], pa.float64()),
        ]
        return pa.RecordBatch.from_arrays([piece.column(0), *made], names=[key, *OUT])

    picked = docs.select(key, text)
    schema = ", ".join([f"`{key}` {picked.schema[key].dataType.simpleString()}", *[f"{c} {t}" for c, t in OUT.items()]])
    return map_texts(picked, text, schema, run)


OUT = {"n_assign": "long", "n_access": "long", "n_hex": "long", "base_sha256": "string", "spans": "string",
       "n_guess": "long", "hardest": "double"}

"""Byte-level BPE by a pair occurrence index: encoding, decoding, counting.

Texts are cut into pre-tokens by array operations. The distinct pre-tokens of a partition's batch stand one after the
other in one array of symbols. An index maps each mergeable pair to all its positions; ranks are taken in ascending
order, all positions of a pair are merged at once, and the lists of the pairs that change are updated. As a pair made of
a new symbol ranks after the merge that made the symbol, this is the order in which each word alone would be merged.

The result is that of the tokenizer's own library with default handling of special strings, without truncation or
padding. Null and empty texts have no tokens. Memory: one batch of text (or the longest document) and its pre-tokens.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from sensorloom.llm.texts import give_back, in_tasks, pieces

BATCH_BYTES = 4_000_000
MOST_WORDS = 120_000  # pre-tokens remembered between batches
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")  # fixed values of the pre-tokenizer
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """Letter, number, white space or other, for every code point."""
    out = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\p{White_Space}")):
        out[[ord(c) for c in regex.findall(pattern, every)]] = kind
    return out


def pre_tokens(text: str, edges: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin. `edges`: where segments begin (0 included); no token crosses one.

    A run of letters, of numbers or of other signs is a token, with one blank before it. A run of white space is a
    token but for its last character if something follows. Contractions stand apart.
    """
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(code)
    if n == 0:
        return np.zeros(0, np.int64)
    kind = kinds()[code]
    edge = np.zeros(n + 1, bool)
    edge[edges] = True
    edge[n] = True
    begin = np.ones(n, bool)
    begin[1:] = (kind[1:] != kind[:-1]) | edge[1:n]
    run = begin.copy()  # runs of one kind
    space = kind == SPACE
    # the last white space of a run before something else in its segment begins a token, which a blank shares with what follows
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~edge[1:n])
    begin[last] = True
    blank = last[code[last] == 32]
    begin[blank + 1] = False
    # contractions, where a sign is not shared with a blank or another sign
    quote = np.flatnonzero((code == 39) & run & begin)
    for short in CONTRACTIONS:
        tail = np.array([ord(c) for c in short[1:]])
        at = quote[quote + len(tail) < n]
        for i, c in enumerate(tail, 1):
            at = at[(code[at + i] == c) & ~edge[at + i]]
        begin[at + 1] = False
        after = at + len(short)
        begin[after[after < n]] |= ~space[after[after < n]] | run[after[after < n]]
    return np.flatnonzero(begin)


class Encoder:
    """A tokenizer file of the byte-level kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        # printable bytes stand for themselves, the others for signs from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        sign = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
        byte = {c: b for b, c in sign.items()}
        self.symbol = np.array([vocab[sign[b]] for b in range(256)], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        self.left, self.right = key >> 32, key & 0xFFFFFFFF
        self.by_key = np.argsort(key)
        self.keys = key[self.by_key]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of = {i: bytes(byte[c] for c in token) for token, i in vocab.items() if all(c in byte for c in token)}
        self.bytes_of |= {i: token.encode() for token, i in self.special.items()}
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 if it is never merged."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.by_key[at], -1)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and where each word begins (one more for the end)."""
        size = np.array([len(w) for w in words], np.int64)
        edge = np.concatenate([[0], np.cumsum(size)])
        ids = self.symbol[np.frombuffer(b"".join(words), np.uint8)]
        n = len(ids)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[edge[1:] - 1] = -1
        before[edge[:-1]] = -1
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(at: np.ndarray) -> None:
            rank = self.ranks(ids[at], ids[after[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cut = [0, *(np.flatnonzero(rank[1:] != rank[:-1]) + 1).tolist(), len(rank)]
            for a, b, r in zip(cut[:-1], cut[1:], rank[cut[:-1]].tolist()):
                if r not in index:
                    index[r] = []
                    heapq.heappush(active, r)
                index[r].append(at[a:b])

        add(np.flatnonzero(after >= 0))
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            a, b, new = self.left[r], self.right[r], self.made[r]
            at = at[(ids[at] == a) & (after[at] >= 0)]
            at = at[ids[after[at]] == b]
            if a == b and len(at) > 1:  # from the left, without overlap
                taken, alone = -1, []
                for p in np.sort(at).tolist():
                    if p != taken:
                        alone.append(p)
                        taken = after[p]
                at = np.array(alone, np.int64)
            if not len(at):
                continue
            gone = after[at]
            ids[at] = new
            ids[gone] = -1
            following = after[gone]
            after[at] = following
            inner = following >= 0
            before[following[inner]] = at[inner]
            previous = before[at]
            changed = np.concatenate([at[inner], previous[previous >= 0]])
            add(np.unique(changed) if len(changed) > 1 else changed)
        alive = ids >= 0
        return ids[alive], np.concatenate([[0], np.cumsum(alive)])[edge]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Words:
    """Pre-tokens met so far in a task, by number, with what is known of each."""

    def __init__(self, coder: Encoder):
        self.coder = coder
        self.number: dict[str, int] = {}
        self.counts = np.zeros(0, np.int64)
        self.ids: list[str] = []
        self.decoded: list[bytes] = []

    def slots(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all pre-tokens of the texts, and where each text begins."""
        special = self.coder.split
        parts: list[str] = []
        first: list[int] = []  # of each text, in characters
        edges: list[int] = [0]
        whole: list[int] = []
        size = 0
        for text in texts:
            first.append(size)
            text = text or ""
            cut = special.split(text) if special is not None and any(s in text for s in self.coder.special) else [text]
            for i, part in enumerate(cut):
                if part:
                    edges.append(size)
                    if i % 2:
                        whole.append(size)
                    parts.append(part)
                    size += len(part)
        joined = "".join(parts)
        begin = pre_tokens(joined, np.array([e for e in edges if e < size], np.int64))
        if whole:  # a special string is one token
            edge = np.unique(np.array([*edges, size]))
            segment = np.searchsorted(edge, begin, "right") - 1
            begin = begin[~np.isin(edge[segment], whole) | np.isin(begin, whole)]
        stops = [*begin[1:].tolist(), size]
        number = self.number
        found = [number.setdefault(joined[a:b], len(number)) for a, b in zip(begin.tolist(), stops)] if size else []
        return np.array(found, np.int32), np.searchsorted(begin, np.array([*first, size]))

    def learn(self, strings: bool) -> None:
        """Encode the pre-tokens that came since the last time."""
        new = list(self.number)[len(self.counts) :]
        if not new:
            return
        coder = self.coder
        plain = [w for w in new if w not in coder.special]
        ids, at = coder.encode([w.encode() for w in plain])
        known = dict(zip(plain, zip(at[:-1].tolist(), at[1:].tolist())))
        ids = ids.tolist()
        lists = [ids[slice(*known[w])] if w in known else [coder.special[w]] for w in new]
        self.counts = np.concatenate([self.counts, np.array([len(x) for x in lists], np.int64)])
        if strings:
            self.ids += [",".join(map(str, x)) for x in lists]
            self.decoded += [b"".join(map(coder.bytes_of.__getitem__, x)) for x in lists]


def _batches(batches: Iterator[pa.RecordBatch], path: str, strings: bool) -> Iterator[tuple]:
    """(batch, words, [(row, numbers of its pre-tokens)]) with all of the batch's pre-tokens encoded."""
    words = Words(encoder(path))
    for whole in batches:
        for batch in pieces(whole, whole.schema.names[-1], BATCH_BYTES):
            if len(words.number) > MOST_WORDS:
                words = Words(encoder(path))
            rows = []
            for piece in pieces(batch, batch.schema.names[-1]):
                slots, at = words.slots(piece.column(piece.num_columns - 1).to_pylist())
                rows += [slots[a:b] for a, b in zip(at[:-1], at[1:])]
            words.learn(strings)
            yield batch, words, rows
            give_back()


def encode_decode(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", with_ids: bool = False, with_text: bool = False
) -> DataFrame:
    """Token count, digests of the ids and of the decoded text; the ids and the decoded text themselves if wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words, rows in _batches(batches, path, True):
            n, id_digest, text_digest, all_ids, all_texts = [], [], [], [], []
            for slots in rows:
                own = slots.tolist()
                ids = ",".join(map(words.ids.__getitem__, own))
                back = b"".join(map(words.decoded.__getitem__, own)).decode("utf-8", "replace")
                n.append(int(words.counts[slots].sum()))
                id_digest.append(sha256(ids.encode()).hexdigest())
                text_digest.append(sha256(back.encode()).hexdigest())
                if with_ids:
                    all_ids.append(np.array(ids.split(",") if ids else [], np.int32))
                if with_text:
                    all_texts.append(back)
            made = {"n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(id_digest, pa.string()),
                    "decoded_sha256": pa.array(text_digest, pa.string())}
            if with_ids:
                made["ids"] = pa.array(all_ids, pa.list_(pa.int32()))
            if with_text:
                made["decoded"] = pa.array(all_texts, pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *made.values()], names=[key, *made])

    picked = docs.select(key, text)
    schema = f"`{key}` {picked.schema[key].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" * with_ids + ", decoded string" * with_text
    return in_tasks(picked, run, schema)

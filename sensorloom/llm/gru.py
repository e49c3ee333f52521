"""A gated recurrent language model in numpy, trained and applied by Spark tasks.

One pass over the corpus cuts the documents into words once and packs them into blocks, one or more per task: documents as
numbers of the block's words, and each word with its count in the block. Spark sums the counts over the blocks, numbers the
words of like counts, and hands each block the counts and numbers of its own words, so that no task and no driver holds the
whole vocabulary.

The model: a small GRU; its output is factored by classes. The most frequent words share classes by frequency, with rows of
their own. All other training words are put into steps by their counts (two steps for each power of two), each step a class;
a word in a step is found by the digits of its number there, a softmax over `BASE` values for each digit, whose rows depend
on the digit's place. Where the last node of a place has fewer words behind a digit, its share is smaller by as much, so
that the probabilities add up to 1. The unknown word is half of the class of words seen once: what was seen once is the
measure of what was never seen. As input, a word outside the shortlist is the row of its step and two learned rows by hash.

Training covers all training documents once, in rounds whose number grows with the blocks: in each, every task goes on from
the common parameters over its own documents by truncated backpropagation, and the parameters are averaged by tokens. For
scoring, the state is carried through the whole document, window after window.

Null or empty text: the end token alone. Repeated rows are learned and scored as often as they come. Without training
documents all words are the unknown one. Empty table: empty result. Further columns are not carried.
Memory: one block (`BLOCK_BYTES` of text, or the longest document) and its words.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorloom.llm.texts import blank_words, constants, give_back, in_tasks, mix64, pieces, stored, text_bytes

HIDDEN, SHORTLIST, CLASS_SIZE = 16, 512, 24
LEAST_ROUNDS = 2
LANES, WINDOW = 256, 20  # documents side by side and steps of a training window
SCORE_LANES, SCORE_WINDOW = 1024, 16  # a window of fewer lanes has as many steps more
RATE = 0.01
BLOCK_BYTES = 24_000_000
AT_ONCE = 4_000_000  # tokens learned together in a block
END = int(constants(8, 1)[0].astype(np.int64))  # the end token's key among the words'
CLASSES = -(-SHORTLIST // CLASS_SIZE)  # of the shortlist
CONTEXTS = 1024  # hashed input rows, of each of two kinds
BASE = 32  # of the digits of a word's number in its step
STEPS = 2  # for each power of two of the counts
STEP_BIT = 48  # a word's code: its step above, its number in the step below; -1 if it is unknown
CHUNK = 4096  # parameters in a row of the average
Params = dict[str, np.ndarray]


@dataclass(frozen=True)
class Counts:
    """What all training tokens add up to. `short`: codes of the shortlist, most frequent first; unused places stay free.
    `steps`: (step, words outside the shortlist, their tokens), ascending; step 0 is always there."""

    tokens: int
    kinds: int
    short: tuple[int, ...]
    short_counts: tuple[int, ...]
    steps: tuple[tuple[int, int, int], ...] = ((0, 0, 0),)

    @cached_property
    def sizes(self) -> np.ndarray:
        return np.array([s[1] for s in self.steps], np.int64)

    @cached_property
    def levels(self) -> int:
        """Digits of the largest step's numbers."""
        most, n = int(self.sizes.max()), 0
        while BASE**n < most:
            n += 1
        return n

    @cached_property
    def by_digits(self) -> tuple[np.ndarray, np.ndarray]:
        """Steps in the order of how many digits their words have, and where those with one, two, ... digits begin."""
        n = np.searchsorted(BASE ** np.arange(self.levels, dtype=np.int64), self.sizes)
        order = np.argsort(n, kind="stable")
        return order, np.searchsorted(n[order], np.arange(1, self.levels + 2))

    @cached_property
    def tails(self) -> np.ndarray:
        """(step, place of the digit, digit): log of the share of a full branch, in the last node of that place."""
        place = BASE ** np.arange(self.levels, dtype=np.int64)[None, :, None]
        n = self.sizes[:, None, None]
        begin = np.maximum(n - 1, 0) // (place * BASE) * (place * BASE)
        size = np.clip(n - begin - np.arange(BASE) * place, 0, place)
        return np.where(size > 0, np.log(np.maximum(size, 1) / place), -1e4).astype(np.float32)

    @cached_property
    def shapes(self) -> dict[str, tuple[int, ...]]:
        n = len(self.steps)
        return {
            "inputs": (SHORTLIST + n, 3 * HIDDEN), "carry": (HIDDEN, 3 * HIDDEN), "classes": (HIDDEN, CLASSES + n), "class_bias": (CLASSES + n,),
            "words": (SHORTLIST, HIDDEN), "word_bias": (SHORTLIST,), "contexts": (2 * CONTEXTS, 3 * HIDDEN), "digits": (self.levels * BASE, HIDDEN),
        }


class Words:
    """The words of a block as the model sees them."""

    def __init__(self, code: np.ndarray, totals: Counts):
        short = np.array(totals.short, np.int64)
        order = np.argsort(short)
        short = short[order]
        at = np.searchsorted(short, code)
        hit = np.zeros(len(code), bool)
        inside = at < len(short)
        hit[inside] = short[at[inside]] == code[inside]
        step = np.where(code < 0, 0, code >> STEP_BIT)
        index = np.searchsorted(np.array([s[0] for s in totals.steps]), step)
        index[hit] = 0
        # the shortlist's words leave no gaps in the numbers of their steps
        number = (code & ((1 << STEP_BIT) - 1)) - (at - np.searchsorted(short, step << STEP_BIT))
        number[code < 0] = 0
        place = np.where(hit, 0, SHORTLIST + index)
        place[hit] = order[at[hit]]
        self.totals = totals
        self.place = place.astype(np.int32)  # row among the inputs
        self.kind = np.where(hit, self.place // CLASS_SIZE, CLASSES + index).astype(np.int32)
        n = np.where(hit | (code < 0), 0, totals.sizes[index])
        power = BASE ** np.arange(totals.levels, dtype=np.int64)
        self.digit, self.last = np.zeros((len(code), totals.levels), np.int8), np.zeros((len(code), totals.levels), bool)
        for level, w in enumerate(power.tolist()):
            self.digit[:, level] = number // w % BASE
            self.last[:, level] = (n > w) & (number // (w * BASE) == (n - 1) // (w * BASE))
        rank = np.empty(len(totals.steps), np.int64)
        rank[totals.by_digits[0]] = np.arange(len(rank))
        group = np.where(code < 0, CLASSES, CLASSES + 1 + rank[index])
        self.group = np.where(hit, self.kind, group).astype(np.int16)  # class; the unknown word; step
        mixed = mix64(code.astype(np.uint64) + np.uint64(1))
        self.context = np.stack([mixed % np.uint64(CONTEXTS), CONTEXTS + (mixed >> np.uint64(32)) % np.uint64(CONTEXTS)], axis=1).astype(np.int32)

    def entering(self, p: Params, x: np.ndarray) -> np.ndarray:
        """Input rows of words."""
        place = self.place[x]
        e = np.take(p["inputs"], place, axis=0)
        rows = np.flatnonzero(place >= SHORTLIST)
        c = np.take(self.context, x.ravel()[rows], axis=0)
        own = np.take(p["contexts"], c[:, 0], axis=0)
        own += np.take(p["contexts"], c[:, 1], axis=0)
        flat_e = e.reshape(-1, e.shape[-1])
        own += np.take(flat_e, rows, axis=0)
        flat_e[rows] = own
        return e


class Targets:
    """Words to be found, in the order of their classes, steps with few digits before those with more: what is worked out
    together lies together. `rows`: which row of the states each has."""

    def __init__(self, words: Words, target: np.ndarray):
        group = words.group[target]
        self.rows = np.argsort(group, kind="stable")
        self.target, self.words = target[self.rows], words
        self.cut = np.searchsorted(group[self.rows], np.arange(CLASSES + len(words.totals.steps) + 2)).tolist()

    @cached_property
    def kind(self) -> np.ndarray:
        return self.words.kind[self.target]

    @property
    def short(self) -> int:
        """Those in the shortlist come first."""
        return self.cut[CLASSES]

    @cached_property
    def in_class(self) -> np.ndarray:
        return self.words.place[self.target[: self.short]] % CLASS_SIZE

    def classes(self) -> Iterator[tuple[slice, slice]]:
        """(the class's words, their targets)."""
        for c in range(CLASSES):
            a, b = self.cut[c : c + 2]
            if a < b:
                yield slice(c * CLASS_SIZE, min(SHORTLIST, (c + 1) * CLASS_SIZE)), slice(a, b)

    def of_class(self, rows: np.ndarray, state: np.ndarray) -> np.ndarray:
        """Logits of the shortlist's targets in columns, by place in the class. `rows`, `state`: as `joined` makes them."""
        made = np.full((CLASS_SIZE, self.short), -1e4, state.dtype)
        for of, at in self.classes():
            np.matmul(rows[of], state[at].T, out=made[: of.stop - of.start, at])
        return made

    def by_digit(self, p: Params, state: np.ndarray) -> Iterator[tuple[slice, slice, np.ndarray, np.ndarray]]:
        """Of the targets with one, two, ... digits: (targets, the digits' parameters, digits, logits: place, digit, target)."""
        words, totals = self.words, self.words.totals
        order, begin = totals.by_digits
        for n in range(1, totals.levels + 1):
            cut = self.cut[CLASSES + 1 + begin[n - 1] : CLASSES + 2 + begin[n]]
            at, of = slice(cut[0], cut[-1]), slice(0, n * BASE)
            if at.start == at.stop:
                continue
            logits = (p["digits"][of] @ state[at].T).reshape(n, BASE, -1)
            # at their first digit all are in the last node, at the others a few
            for step, a, b in zip(order[begin[n - 1] : begin[n]].tolist(), cut[:-1], cut[1:]):
                logits[n - 1, :, a - at.start : b - at.start] += totals.tails[step, n - 1][:, None]
            w, kind = self.target[at], self.kind[at] - CLASSES
            last = np.take(words.last, w, axis=0)
            for level in range(n - 1):
                own = np.flatnonzero(last[:, level])
                logits[level][:, own] += totals.tails[kind[own], level].T
            yield at, of, np.take(words.digit, w, axis=0)[:, :n].T.astype(np.intp), logits


def first_params(counts: Counts) -> Params:
    """Small fixed numbers, and biases that make the frequencies of single words."""
    made = {}
    for i, (name, shape) in enumerate(counts.shapes.items()):
        n = int(np.prod(shape))
        even = constants(20 + i, n).astype(np.float64) / 2.0**64 - 0.5
        made[name] = (even * (0.5 if name in ("inputs", "carry") else 0.1)).reshape(shape).astype(np.float32)
    made["digits"][:] = 0  # all words of a step alike
    own = np.full(SHORTLIST, 1e-9)
    own[: len(counts.short)] = np.array(counts.short_counts) + 1
    made["word_bias"] = np.log(own).astype(np.float32)
    of_class = np.add.reduceat(own, np.arange(0, SHORTLIST, CLASS_SIZE))
    made["class_bias"] = np.log([*of_class, *[mass + 1 for _, _, mass in counts.steps]]).astype(np.float32)
    return made


def flat(params: Params, counts: Counts) -> np.ndarray:
    return np.concatenate([params[n].ravel() for n in counts.shapes])


def unflat(values: np.ndarray, counts: Counts) -> Params:
    out, at = {}, 0
    for name, shape in counts.shapes.items():
        n = int(np.prod(shape))
        out[name] = np.asarray(values[at : at + n], np.float32).reshape(shape)
        at += n
    return out


def joined(rows: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Rows with one more column: a bias of weights, or 1 of states."""
    return np.concatenate([rows, np.broadcast_to(last, len(rows))[:, None].astype(rows.dtype)], axis=1)


def _softmax(x: np.ndarray) -> np.ndarray:
    """Of each column, in place."""
    x -= x.max(axis=-2, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=-2, keepdims=True)
    return x


def _own(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the row `at` of each column is among all numbers."""
    flat = at * x.shape[-1] + np.arange(x.shape[-1])
    if x.ndim == 3:
        flat += np.arange(len(x))[:, None] * x[0].size
    return flat


def _loss(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Derivatives of the loss by each column's logits, in their place."""
    _softmax(x)
    x.reshape(-1)[_own(x, at)] -= 1
    return x


def _log_softmax_at(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of each column, in the row that is asked for."""
    x -= x.max(axis=-2, keepdims=True)
    own = np.take(x, _own(x, at))
    np.exp(x, out=x)
    return own - np.log(x.sum(axis=-2))


def output_log(p: Params, state: np.ndarray, target: np.ndarray, words: Words) -> np.ndarray:
    """Natural log of each word's probability: of its class, and of the word in it. States may have their 1 already."""
    to, out = Targets(words, target), np.empty(len(target))
    own = np.take(state if state.shape[1] > HIDDEN else joined(state, 1), to.rows, axis=0)
    logs = _log_softmax_at(joined(p["classes"].T, p["class_bias"]) @ own.T, to.kind)
    if words.totals.sizes[0]:
        logs[to.kind == CLASSES] += np.log(0.5)  # words seen once, and the unknown one
    logs[: to.short] += _log_softmax_at(to.of_class(joined(p["words"], p["word_bias"]), own), to.in_class)
    for at, _, digit, logits in to.by_digit(p, own[:, :HIDDEN]):
        logs[at] += _log_softmax_at(logits, digit).sum(axis=0)
    out[to.rows] = logs
    return out


class Cell:
    """The recurrence, lanes in columns. What the gates add up has its sign turned beforehand."""

    def __init__(self, p: Params):
        self.carry = p["carry"].T.copy()
        self.carry[: 2 * HIDDEN] *= -1

    @staticmethod
    def entering(p: Params, x: np.ndarray, words: Words) -> np.ndarray:
        """(step, input, lane)."""
        e = words.entering(p, x).transpose(0, 2, 1).copy()
        np.negative(e[:, : 2 * HIDDEN], out=e[:, : 2 * HIDDEN])
        return e

    def step(self, h: np.ndarray, e: np.ndarray, g: np.ndarray, n: np.ndarray, new: np.ndarray) -> None:
        """Fills in both gates and what of the old state enters the candidate (`g`), the candidate and the new state."""
        np.matmul(self.carry, h, out=g)
        gates, own = g[: 2 * HIDDEN], g[2 * HIDDEN :]
        gates += e[: 2 * HIDDEN]
        np.exp(gates, out=gates)  # infinite where the gate is shut
        gates += 1
        np.reciprocal(gates, out=gates)
        np.multiply(gates[HIDDEN:], own, out=n)
        n += e[2 * HIDDEN :]
        np.tanh(n, out=n)
        np.subtract(h, n, out=new)
        new *= gates[:HIDDEN]
        new += n


@dataclass
class Lanes:
    """Documents one after the other in lanes, the longest lanes first. Time is the first axis."""

    target: np.ndarray
    document: np.ndarray  # -1 beyond a lane's end
    first: np.ndarray  # a document's first token
    live: np.ndarray  # lanes that go on, at each step

    @classmethod
    def of(cls, tokens: np.ndarray, begin: np.ndarray, lanes: int, documents: np.ndarray | None = None) -> Lanes:
        documents = np.arange(len(begin) - 1) if documents is None else documents
        sizes = np.diff(begin)[documents]
        # no more lanes than the longest document leaves work for
        lanes = min(lanes, len(sizes), -(-int(sizes.sum()) // int(sizes.max())))
        heap = [(0, b) for b in range(lanes)]
        held: list[list[int]] = [[] for _ in range(lanes)]
        for d in np.argsort(-sizes, kind="stable").tolist():
            n, b = heapq.heappop(heap)
            held[b].append(d)
            heapq.heappush(heap, (n + int(sizes[d]), b))
        length = np.array([sum(int(sizes[d]) for d in ds) for ds in held])
        steps = int(length.max(initial=0))
        target, document, first = np.zeros((steps, lanes), np.int32), np.full((steps, lanes), -1, np.int32), np.zeros((steps, lanes), bool)
        for lane, b in enumerate(np.argsort(-length, kind="stable").tolist()):
            at = 0
            for d in held[b]:
                n = int(sizes[d])
                own = int(documents[d])
                target[at : at + n, lane] = tokens[begin[own] : begin[own + 1]]
                document[at : at + n, lane] = own
                first[at, lane] = True
                at += n
        return cls(target, document, first, (document >= 0).sum(axis=1))

    def inputs(self, end: int) -> np.ndarray:
        """The token before each; before a document's first token, the end token."""
        x = np.empty_like(self.target)
        x[1:], x[:1] = self.target[:-1], end
        x[self.first] = end
        return x


@np.errstate(over="ignore")
def log10_by_document(p: Params, tokens: np.ndarray, begin: np.ndarray, end: int, words: Words) -> np.ndarray:
    """Sum over each document's tokens of the log10 probabilities that the network gives."""
    out, cell, sizes = np.zeros(len(begin) - 1), Cell(p), np.diff(begin)
    # a document longer than a lane would keep the others narrow
    long = sizes * SCORE_LANES > sizes.sum()
    for own in (np.flatnonzero(long), np.flatnonzero(~long)):
        if not len(own):
            continue
        lanes = Lanes.of(tokens, begin, SCORE_LANES, own)
        x, goes_on, a = lanes.inputs(end), ~lanes.first, 0
        h = np.zeros((HIDDEN, x.shape[1]), np.float32)
        while a < len(x):
            n = int(lanes.live[a])
            w = slice(a, a + SCORE_LANES * SCORE_WINDOW // n)
            e = cell.entering(p, x[w, :n], words)
            state, g, candidate = np.ones((len(e), HIDDEN + 1, n), e.dtype), np.empty(e.shape[1:], e.dtype), np.empty((HIDDEN, n), e.dtype)
            for t in range(len(e)):
                cell.step(h[:, :n] * goes_on[a + t, :n], e[t], g, candidate, state[t, :HIDDEN])
                h = state[t, :HIDDEN]
            rows = np.flatnonzero(lanes.document[w, :n].ravel() >= 0)
            states = np.take(state.transpose(0, 2, 1).reshape(-1, HIDDEN + 1), rows, axis=0)
            logs = output_log(p, states, lanes.target[w, :n].ravel()[rows], words)
            out += np.bincount(lanes.document[w, :n].ravel()[rows], logs, minlength=len(out))
            a += len(e)
    return out / np.log(10)


@np.errstate(over="ignore")
def gradients(
    p: Params, h: np.ndarray, x: np.ndarray, y: np.ndarray, first: np.ndarray, used: np.ndarray, words: Words
) -> tuple[Params, np.ndarray]:
    """Of the summed loss of one window, backwards through it; and the state after it."""
    steps, lanes = x.shape
    cell, e, goes_on = Cell(p), Cell.entering(p, x, words), ~first
    before, n, dn = (np.empty((steps, HIDDEN, lanes), e.dtype) for _ in range(3))
    state = np.ones((steps, HIDDEN + 1, lanes), e.dtype)
    g, now = np.empty(e.shape, e.dtype), h.T
    for t in range(steps):
        np.multiply(now, goes_on[t], out=before[t])
        now = state[t, :HIDDEN]
        cell.step(before[t], e[t], g[t], n[t], now)
    z, r, own = g[:, :HIDDEN], g[:, HIDDEN : 2 * HIDDEN], g[:, 2 * HIDDEN :]
    rows = np.flatnonzero(used.ravel())
    to = Targets(words, y.ravel()[rows])
    rows = rows[to.rows]
    s = np.take(state.transpose(0, 2, 1).reshape(-1, HIDDEN + 1), rows, axis=0)
    made = {name: np.zeros_like(v) for name, v in p.items()}
    d = _loss(joined(p["classes"].T, p["class_bias"]) @ s.T, to.kind)
    of_rows = d @ s
    made["classes"][:], made["class_bias"][:] = of_rows[:, :HIDDEN].T, of_rows[:, HIDDEN]
    back = p["classes"] @ d
    d = _loss(to.of_class(joined(p["words"], p["word_bias"]), s), to.in_class)
    of_rows = np.zeros((SHORTLIST, HIDDEN + 1), s.dtype)
    for of, at in to.classes():
        own_d = d[: of.stop - of.start, at]
        np.matmul(own_d, s[at], out=of_rows[of])
        back[:, at] += p["words"][of].T @ own_d
    made["words"][:], made["word_bias"][:] = of_rows[:, :HIDDEN], of_rows[:, HIDDEN]
    s = s[:, :HIDDEN]
    for at, of, digit, logits in to.by_digit(p, s):
        d = _loss(logits, digit).reshape(of.stop, -1)
        made["digits"][of] += d @ s[at]
        back[:, at] += p["digits"][of].T @ d
    from_output = np.zeros((x.size, HIDDEN), back.dtype)
    from_output[rows] = back.T
    from_output = from_output.reshape(steps, lanes, HIDDEN).transpose(0, 2, 1).copy()
    of_n, of_z, of_r = (1 - z) * (1 - n * n), (before - n) * z * (1 - z), own * r * (1 - r)
    dg, later, begins = np.empty_like(e), np.zeros_like(now), first.any(axis=1).tolist()
    for t in range(steps - 1, -1, -1):
        dh, d = from_output[t], dg[t]
        dh += later
        np.multiply(dh, of_n[t], out=dn[t])
        np.multiply(dh, of_z[t], out=d[:HIDDEN])
        np.multiply(dn[t], of_r[t], out=d[HIDDEN : 2 * HIDDEN])
        np.multiply(dn[t], r[t], out=d[2 * HIDDEN :])
        np.matmul(p["carry"], d, out=later)
        dh *= z[t]
        later += dh
        if begins[t]:
            later *= goes_on[t]
    made["carry"][:] = np.matmul(before, dg.transpose(0, 2, 1)).sum(axis=0)
    dg[:, 2 * HIDDEN :] = dn
    flat_x, rows = x.ravel(), np.ascontiguousarray(dg.transpose(0, 2, 1)).reshape(-1, 3 * HIDDEN)
    place = words.place[flat_x]
    _add_rows(made["inputs"], place, rows)
    others = np.flatnonzero(place >= SHORTLIST)
    c, rows = np.take(words.context, flat_x[others], axis=0), np.take(rows, others, axis=0)
    for i in (0, 1):
        _add_rows(made["contexts"], c[:, i], rows)
    return made, now.T


def _add_rows(to: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Sums of rows by place. Two numbers at once, as one complex number, and in one dimension, where `add.at` is fast."""
    pair = np.result_type(to, 1j)
    width = rows.shape[1] // 2
    np.add.at(to.view(pair).reshape(-1), (at.astype(np.intp)[:, None] * width + np.arange(width)).ravel(), rows.view(pair).ravel())


class Adam:
    """Sums are kept without the factors that all of them share."""

    def __init__(self, p: Params):
        self.m = {n: np.zeros_like(v) for n, v in p.items()}
        self.v = {n: np.zeros_like(v) for n, v in p.items()}
        self.t = 0

    def update(self, p: Params, g: Params, size: int) -> None:
        self.t += 1
        of_v = (1 - 0.99**self.t) ** 0.5
        rate, least = np.float32(RATE * of_v / (1 - 0.9**self.t)), np.float32(1e-8 * 10 * size * of_v)
        for name in p:
            d, m, v = g[name], self.m[name], self.v[name]
            m *= np.float32(0.9)
            m += d
            d *= d
            v *= np.float32(0.99)
            v += d
            np.sqrt(v, out=d)
            d += least
            np.divide(m, d, out=d)
            d *= rate
            p[name] -= d


def trained(p: Params, tokens: np.ndarray, begin: np.ndarray, end: int, adam: Adam, words: Words) -> None:
    """One pass over the documents, window after window, the state carried from each to the next."""
    lanes = Lanes.of(tokens, begin, LANES)
    x, used = lanes.inputs(end), lanes.document >= 0
    h = np.zeros((x.shape[1], HIDDEN), np.float32)
    for a in range(0, len(x), WINDOW):
        n = int(lanes.live[a])
        w = slice(a, a + WINDOW)
        g, h = gradients(p, h[:n], x[w, :n], lanes.target[w, :n], lanes.first[w, :n], used[w, :n], words)
        adam.update(p, g, LANES * WINDOW)


# ---- tables


class Numbering:
    """A block's words, numbered as they come, with their counts in training documents."""

    def __init__(self):
        self.keys, self.number, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)

    def add(self, tokens: np.ndarray, learned: np.ndarray) -> np.ndarray:
        """The tokens' numbers."""
        met = pa.array(tokens).dictionary_encode()
        kinds = met.dictionary.to_numpy()
        order = np.argsort(kinds)
        kinds, rank = kinds[order], np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        place = rank[met.indices.to_numpy()]
        at = np.searchsorted(self.keys, kinds)
        old = np.zeros(len(kinds), bool)
        inside = at < len(self.keys)
        old[inside] = self.keys[at[inside]] == kinds[inside]
        number = np.empty(len(kinds), np.int32)
        number[old] = self.number[at[old]]
        number[~old] = len(self.counts) + np.arange((~old).sum())
        self.keys = np.insert(self.keys, at[~old], kinds[~old])
        self.number = np.insert(self.number, at[~old], number[~old])
        self.counts = np.concatenate([self.counts, np.zeros((~old).sum(), np.int64)])
        self.counts[number] += np.bincount(place, learned, minlength=len(kinds)).astype(np.int64)
        return number[place]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, held_out, text) into rows of documents as numbers of their block's words, and rows of these words."""
    split, pack = blank_words(True), zstandard.ZstdCompressor(level=1)
    task, block, size, held = TaskContext.get().partitionId(), 0, 0, Numbering()

    def rows(kind: str, many: int, **columns: pa.Array) -> pa.RecordBatch:
        made = {"block": pa.array(np.full(many, task << 32 | block, np.int64)), "kind": pa.array([kind] * many, pa.string())}
        sorts = {"id": pa.int64(), "held_out": pa.bool_(), "packed": pa.binary(), "at": pa.int32(), "word": pa.int64(), "n": pa.int64()}
        for name, sort in sorts.items():
            made[name] = columns.get(name, pa.nulls(many, sort))
        return pa.RecordBatch.from_arrays(list(made.values()), names=list(made))

    def words() -> pa.RecordBatch:
        return rows("word", len(held.keys), at=pa.array(held.number), word=pa.array(held.keys), n=pa.array(held.counts[held.number]))

    for batch in batches:
        for piece in pieces(batch, "text"):
            if size > BLOCK_BYTES:
                yield words()
                block, size, held = block + 1, 0, Numbering()
            data, at = text_bytes(piece.column(2))
            start, end, first = split.cut(data, at)
            begin = first + np.arange(len(first))
            tokens = np.full(begin[-1], END, np.int64)
            tokens[np.arange(len(start)) + np.repeat(np.arange(piece.num_rows), np.diff(first))] = split.hashes(data, start, end).astype(np.int64)
            learn = ~piece.column(1).to_numpy(zero_copy_only=False)
            numbers = held.add(tokens, np.repeat(learn, np.diff(begin)).astype(np.float64))
            size += len(data)
            texts = [pack.compress(numbers[a:b].tobytes()) for a, b in zip(begin[:-1].tolist(), begin[1:].tolist())]
            yield rows("doc", piece.num_rows, id=piece.column(0), held_out=piece.column(1), packed=pa.array(texts, pa.binary()))
    if len(held.keys):
        yield words()


PACKED = "block long, kind string, id long, held_out boolean, packed binary, at int, word long, n long"


def _stepped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by word: each word's count over all blocks, its step by that count, and its number among the words of that
    step in this partition."""
    part, met = TaskContext.get().partitionId(), np.zeros(64 * STEPS, np.int64)
    held = {n: np.zeros(0, np.int64) for n in ("block", "at", "word", "n")}
    for batch in chain(batches, (None,)):
        if batch is not None:
            held = {n: np.concatenate([v, batch.column(batch.schema.get_field_index(n)).to_numpy()]) for n, v in held.items()}
        word = held["word"]
        # the last word may go on in the next batch; it has a row for each block at most
        whole = len(word) if batch is None or not len(word) else int(np.searchsorted(word, word[-1]))
        if not whole:
            continue
        rows, held = {n: v[:whole] for n, v in held.items()}, {n: v[whole:] for n, v in held.items()}
        word = rows["word"]
        new = np.concatenate([[True], word[1:] != word[:-1]])
        begins = np.flatnonzero(new)
        size, count = np.diff(np.append(begins, whole)), np.add.reduceat(rows["n"], begins)
        step_ = np.where(count > 0, np.floor(STEPS * np.log2(np.maximum(count, 1))), -1).astype(np.int64)
        learned = np.flatnonzero(count > 0)
        order = learned[np.argsort(step_[learned], kind="stable")]
        edge = np.searchsorted(step_[order], np.arange(64 * STEPS + 1))
        number = np.zeros(len(begins), np.int64)
        number[order] = np.arange(len(order)) - edge[step_[order]] + met[step_[order]]
        met += np.diff(edge)
        yield pa.RecordBatch.from_pydict({
            "block": pa.array(rows["block"]), "at": pa.array(rows["at"].astype(np.int32)), "count": pa.array(np.repeat(count, size)),
            "step": pa.array(np.repeat(step_.astype(np.int32), size)), "part": pa.array(np.full(whole, part, np.int32)),
            "number": pa.array(np.repeat(number, size)), "new": pa.array(new), "is_end": pa.array(word == END),
        })


STEPPED = "block long, at int, count long, step int, part int, number long, new boolean, is_end boolean"


class Block:
    """One block of documents and its words."""

    def __init__(self, row: dict, counts: Counts):
        self.row = row
        self.count = row["counts"]
        self.words = Words(row["codes"], counts)
        self.end = int(row["end"][0])

    def tokens(self, of: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Word numbers of documents, about `most` at once, and where each document begins."""
        unpack, held, size = zstandard.ZstdDecompressor(), [], 0
        for i, packed in enumerate(self.row["packed"].take(pa.array(of))):
            held.append(np.frombuffer(unpack.decompress(packed.as_buffer()), np.int32))
            size += len(held[-1])
            if size > most or i == len(of) - 1:
                yield np.concatenate(held), np.concatenate([[0], np.cumsum([len(t) for t in held])])
                held, size = [], 0


def _blocks(batches: Iterator[pa.RecordBatch], counts: Counts) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i].values for n in batch.schema.names}
            row = {n: v if n == "packed" else v.to_numpy(zero_copy_only=False) for n, v in row.items()}
            if len(row["packed"]):
                yield Block(row, counts)
            give_back()


def _learner(params: np.ndarray, counts: Counts, part: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, n = {k: v.copy() for k, v in unflat(params.copy(), counts).items()}, 0
        adam = Adam(p)
        for block in _blocks(batches, counts):
            learn = np.flatnonzero((block.row["held_out"] == 0) & (block.row["draws"] % rounds == part))
            for tokens, begin in block.tokens(learn, AT_ONCE):
                trained(p, tokens, begin, block.end, adam, block.words)
                n += len(tokens)
        if n:
            values = flat(p, counts).astype(np.float32)
            chunks = [values[a : a + CHUNK].tobytes() for a in range(0, len(values), CHUNK)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(chunks)), pa.int64()), pa.array(np.full(len(chunks), n), pa.int64()), pa.array(chunks, pa.binary())],
                names=["place", "tokens", "params"],
            )

    return run


def _mean(rows: pa.Table) -> pa.Table:
    tokens = rows.column("tokens").to_numpy()
    total = sum(np.frombuffer(v.as_py(), np.float32).astype(np.float64) * t for v, t in zip(rows.column("params"), tokens.tolist()))
    mean = (total / tokens.sum()).astype(np.float32).tobytes()
    return pa.table({"place": rows.column("place").slice(0, 1), "params": pa.array([mean], pa.binary())})


def train(blocks: DataFrame, counts: Counts) -> np.ndarray:
    """blocks: as `ready` makes them; a document's draw is the round in which it is learned."""
    params = flat(first_params(counts), counts)
    rounds = max(LEAST_ROUNDS, -(-blocks.count().bit_length() // 2))
    for part in range(rounds):
        made = in_tasks(blocks, _learner(params, counts, part, rounds), "place long, tokens long, params binary")
        mean = made.groupBy("place").applyInArrow(_mean, "place long, params binary").collect()
        if mean:  # as many numbers as the model has parameters
            params = np.concatenate([np.frombuffer(r["params"], np.float32) for r in sorted(mean, key=lambda r: r["place"])])
    return params


def _scorer(params: np.ndarray, counts: Counts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = unflat(params, counts)
        for block in _blocks(batches, counts):
            base = np.log10((block.count + 1) / (counts.tokens + counts.kinds + 1))
            row, at = block.row, 0
            for tokens, begin in block.tokens(np.arange(len(row["packed"])), AT_ONCE):
                n = len(begin) - 1
                of_base, known = (np.add.reduceat(v[tokens], begin[:-1]) for v in (base, (block.count > 0).astype(np.int64)))
                score = log10_by_document(p, tokens, begin, block.end, block.words)
                own = slice(at, at + n)
                yield pa.RecordBatch.from_pydict({
                    "id": pa.array(row["ids"][own], pa.int64(), mask=row["no_id"][own].astype(bool)), "held_out": pa.array(row["held_out"][own].astype(bool)),
                    "n_tokens": pa.array(np.diff(begin).astype(np.int64)), "n_known": pa.array(known),
                    "train_tokens": pa.array(np.full(n, counts.tokens, np.int64)), "base_score": pa.array(of_base), "score": pa.array(score),
                })
                at += n

    return run


READY = {
    "packed": ("array<binary>", pa.binary()), "ids": ("array<long>", pa.int64()), "no_id": ("array<int>", pa.int32()),
    "held_out": ("array<int>", pa.int32()), "draws": ("array<long>", pa.int64()),
    "codes": ("array<long>", pa.int64()), "counts": ("array<long>", pa.int64()), "end": ("array<int>", pa.int32()),
}


def _ready(documents: pa.Table, words: pa.Table) -> pa.Table:
    """A block in one row, its words in the order of their numbers."""
    words = words.sort_by("words")
    out, end = {}, words.filter(words.column("is_end")).select(["words"]).rename_columns(["end"])
    for table, names in ((documents, ("packed", "ids", "no_id", "held_out", "draws")), (words, ("codes", "counts")), (end, ("end",))):
        for name in names:
            values = table.column(name).combine_chunks()
            values = pa.concat_arrays(values.chunks) if isinstance(values, pa.ChunkedArray) else values
            values = values.cast(READY[name][1])
            out[name] = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    return pa.table(out)


def numbered(words: DataFrame) -> DataFrame:
    """Block, word's number in the block, count over all blocks, code, and whether the row is the word's first."""
    by_word = words.select("block", "at", "word", "n").repartition("word").sortWithinPartitions("word")
    stepped = stored(in_tasks(by_word, _stepped, STEPPED))
    # as many rows as steps times partitions
    sizes = stepped.filter("new and step >= 0").groupBy("step", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("step").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    begins = stored(sizes.select("step", "part", F.coalesce(before, F.lit(0)).alias("begin")))
    code = F.shiftleft(F.col("step").cast("long"), STEP_BIT) + F.col("begin") + F.col("number")
    return stepped.join(begins, ["step", "part"], "left").select("block", "at", "count", "step", "new", "is_end", F.coalesce(code, F.lit(-1)).alias("code"))


def totals_of(words: DataFrame) -> Counts:
    seen = words.filter("new and count > 0")
    steps = {r["step"]: [r["n"], r["mass"]] for r in seen.groupBy("step").agg(F.count("*").alias("n"), F.sum("count").alias("mass")).collect()}
    tokens, kinds = (sum(v[i] for v in steps.values()) for i in (1, 0))
    short = seen.orderBy(F.col("is_end").desc(), F.desc("count"), "code").limit(SHORTLIST).collect()
    for r in short:
        steps[r["step"]][0] -= 1
        steps[r["step"]][1] -= r["count"]
    left = {0: [0, 0], **{s: v for s, v in steps.items() if v[0]}}
    return Counts(tokens, kinds, tuple(r["code"] for r in short), tuple(r["count"] for r in short), tuple((s, *left[s]) for s in sorted(left)))


def scores(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key (a long), held_out, token counts, the score of single words and the score of the network, in log10."""
    plain = docs.select(F.col(key).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text).alias("text"))
    blocks = stored(in_tasks(plain, _packed, PACKED))
    words = numbered(blocks.filter("kind = 'word'").select("block", "at", "word", "n"))
    documents = blocks.filter("kind = 'doc'").select("block", "id", "held_out", "packed")
    counts = totals_of(words)
    looked_up = words.select(F.col("block").alias("of_block"), F.col("at").alias("words"), F.col("code").alias("codes"), F.col("count").alias("counts"), "is_end")
    own = documents.select(
        "block", "packed", F.coalesce("id", F.lit(0)).alias("ids"), F.col("id").isNull().cast("int").alias("no_id"),
        F.col("held_out").cast("int").alias("held_out"), F.shiftrightunsigned(F.xxhash64("packed"), 32).alias("draws"),
    )
    schema = ", ".join(f"{n} {sort}" for n, (sort, _) in READY.items())
    ready = stored(own.groupBy("block").cogroup(looked_up.groupBy("of_block")).applyInArrow(_ready, schema))
    params = train(ready, counts)
    schema = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return in_tasks(ready, _scorer(params, counts), schema).withColumnRenamed("id", key)

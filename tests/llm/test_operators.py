"""Each operator against a plain version, on rows with nulls, copies, long texts and clashing column names."""

import re
import zlib
from collections import Counter, defaultdict
from datetime import date
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sensorloom.llm import bbit, benchmark_suffixes, compressor, gru, line_dedup, pair_bpe, ring, suffix_repeats, token_cache, url_lists
from sensorloom.llm.components import components
from sensorloom.llm.texts import shared_dir
from tests.llm.conftest import ROWS, words

BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def digest(text):
    return sha256(text.encode()).hexdigest()


def rows_of(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def test_repeats(docs):
    want = Counter()
    for key, text in ROWS:
        w = WORD.findall(text or "")
        grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        hit = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
        want[key, len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(hit), failed] += 1
    found = suffix_repeats.repeat_rules(docs)
    assert rows_of(found, "doc_id", "n_words", "word_chars", "n_dup_lines", "n_repeat_words", "base_failed") == want
    by_key = {r.doc_id: r for r in found.collect()}
    assert by_key[4].longest_repeat == 30 and not by_key[4].kept and by_key[1].kept


def test_longest_repeat_alone_rejects(spark):
    text = words(1, 60) + " " + words(2, 600) + " " + words(1, 60)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = suffix_repeats.repeat_rules(df).first()
    assert not r.base_failed and r.longest_repeat >= 60 and not r.kept


def test_encode_decode(docs):
    library = Tokenizer.from_file(BPE)
    want = Counter()
    for key, text in ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want[key, len(ids), digest(",".join(map(str, ids))), digest(back)] += 1
    found = pair_bpe.encode_decode(docs, BPE, with_ids=True, with_text=True)
    assert rows_of(found, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    assert all(len(r.ids) == r.n_tokens and digest(r.decoded) == r.decoded_sha256 for r in found.collect())


def test_pre_tokens_on_random_signs():
    rng = np.random.default_rng(0)
    signs = [*"aab '  st're\n\t!1", "'s", "'ll", "é", "　", "²", "\x1c", "😀", "<|endoftext|>"]
    texts = ["".join(rng.choice(signs, rng.integers(0, 30))) for _ in range(2000)]
    library, own = Tokenizer.from_file(BPE), pair_bpe.Words(pair_bpe.encoder(BPE))
    slots, at = own.slots(texts)
    own.learn(True)
    for text, a, b in zip(texts, at[:-1], at[1:]):
        assert ",".join(own.ids[i] for i in slots[a:b]) == ",".join(map(str, library.encode(text, add_special_tokens=False).ids))


def test_ring_is_even_and_moves_little(spark, docs):
    keys = spark.range(3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("é").alias("text"))
    found = ring.ring_shards(keys, 24).collect()  # a third of the rows has one key
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
        assert r["size"] == 10 and r.text_crc32 == zlib.crc32("é".encode())
    assert {len(v) for v in slots.values()} == {125} and all(sorted(v) == list(range(125)) for v in slots.values())
    few = ring.ring_shards(docs, 24)
    assert few.count() == len(ROWS) and few.agg(F.max("slot")).first()[0] == 0
    one = {r.doc_id: r.shard for r in ring.ring_shards(spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("").alias("text")), 24).collect()}
    more = {r.doc_id: r.shard for r in ring.ring_shards(spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("").alias("text")), 25).collect()}
    assert sum(one[k] != more[k] for k in one) < 0.3 * len(one)


def plain_ring(rows, shards):
    """Rows walked one by one: each goes clockwise from its cell to the first shard with room."""
    places, owner = ring.clockwise(shards)
    room, used, out = ring.capacities(len(rows), shards, 0.0), [0] * shards, Counter()
    for cell, salt, _, key, size, crc in sorted(
        rows, key=lambda r: (ring.blake2b(f"cell {r[0]}.{r[1]}".encode(), digest_size=8).digest(), r[2], r[3] is not None, r[3] or 0, r[4], r[5])
    ):
        at = ring.bisect.bisect_left(places, cell)
        while not room[owner[at % len(owner)]]:
            at += 1
        shard = owner[at % len(owner)]
        out[key, size, crc, shard, used[shard]] += 1
        room[shard] -= 1
        used[shard] += 1
    return out


def test_ring_equals_a_walk_and_not_the_layout(spark, monkeypatch):
    monkeypatch.setattr(ring, "CHUNK", 7)
    rows = [*ROWS, *[(100 + i % 60, f"text {i % 90}") for i in range(150)], *[(5000, "same")] * 80, *[(None, None)] * 3]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, n int, size int")
    own = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    raw = F.coalesce("text", F.lit(""))
    size, crc = (F.octet_length(raw) + 8).cast("long"), F.crc32(raw.cast("binary"))
    mixed = F.xxhash64(F.lit(1), own, size, crc)
    known = df.select(F.pmod(F.xxhash64(own), F.lit(ring.CELLS)), F.pmod(mixed, F.lit(ring.SALTS)), mixed, "doc_id", size, crc)
    want = plain_ring([tuple(r) for r in known.collect()], 24)
    for parts in (3, 7):
        found = ring.ring_shards(df.repartition(parts), 24)
        assert rows_of(found, "doc_id", "size", "text_crc32", "shard", "slot") == want


def shingles(text):
    w = WORD.findall(lower(text))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows):
    sets = [(k, shingles(t)) for k, t in rows]
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                up[root(i)] = root(j)
    least = defaultdict(list)
    for i, (k, _) in enumerate(sets):
        if k is not None:
            least[root(i)].append(k)
    return Counter((k, len(s), min(least[root(i)], default=None)) for i, (k, s) in enumerate(sets))


def test_near_duplicates(docs):
    found = bbit.near_duplicates(docs)
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == brute_components(ROWS)
    kept = bbit.without_near_duplicates(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, None}


def test_near_duplicates_in_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(bbit, "BLOCK", 16)
    rng = np.random.default_rng(3)
    base = words(1, 120).split()
    rows = []
    for i in range(150):  # each with a few words changed, so that many pairs lie near the limit
        own = list(base)
        for at in rng.choice(120, rng.integers(0, 5), replace=False):
            own[at] = f"new{rng.integers(1e9)}"
        rows.append((i, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(bbit.near_duplicates(df), "doc_id", "n_shingles", "component_id") == brute_components(rows)


def test_bands_follow_the_limit():
    assert (bbit.scheme(85).bands, bbit.scheme(85).rows) == (28, 6)
    for percent in (70, 80, 85, 95):
        of = bbit.scheme(percent)
        assert (1 - (percent / 100) ** of.rows) ** of.bands <= 2.1e-6


def test_pipeline_drops_near_copies_from_80_percent(spark):
    import corpus_pipeline

    base = words(1, 120).split()
    rows = []
    for i, at in enumerate(([], [40, 80], [20, 60, 100])):  # 106 of 126 shingles are shared with the first: 0.84; 101 of 131: 0.77
        rows.append((i, " ".join(f"new{i}" if k in at else w for k, w in enumerate(base))))
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n_chars long")
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()} == {0, 2}


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(5, 5)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}}


def test_token_cache(docs):
    library, folder = Tokenizer.from_file(BPE), shared_dir(docs.sparkSession)
    want = Counter()
    for key, text in ROWS:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want[key, len((text or "").encode()), n, n > 512] += 1
    for _ in range(2):  # the second time nothing is missing
        found = token_cache.cached_counts(docs, BPE, folder, 512)
        assert rows_of(found, "doc_id", "n_bytes", "n_tokens", "over_limit") == want
        assert docs.sparkSession.read.parquet(folder).count() == len({t or "" for _, t in ROWS})


@pytest.mark.parametrize("least", [2, 3])
def test_lines(docs, least):
    def key(line):
        return lower(line.strip(" \t\n\r\x0b\x0c"))

    held = defaultdict(set)
    for k, text in ROWS:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10 and k is not None:
                held[key(line)].add(k)
    want = Counter()
    for k, text in ROWS:
        lines = (text or "").split("\n")
        stay = [x for x in lines if k is None or len(held[key(x)]) < least or min(held[key(x)]) == k]
        want[k, len(lines), len(lines) - len(stay), "\n".join(stay)] += 1
    assert rows_of(line_dedup.line_dedup(docs, least=least), "doc_id", "n_lines", "n_dropped", "kept_text") == want
    whole = line_dedup.deduplicated(docs)
    assert whole.columns == docs.columns and whole.filter("text is null").count() == 1


def test_benchmark(spark, docs):
    items = [(1, words(6, 40)), (2, "ONE two"), (2, "ONE two"), (3, None), (4, "!!"), (5, words(1, 14)), (None, words(2, 20)), (None, words(3, 20))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = defaultdict(set)
    for i, text in items:
        w = PLAIN.findall(lower(text))
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add(i)
    want = Counter()
    for key, text in ROWS:
        w, hit, found = PLAIN.findall(lower(text)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if own := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= own
        names = sorted(str(i) for i in found if i is not None)  # items without an id count once, and have no name
        want[key, len(w), len(hit), len(found), digest(",".join(names)), bool(hit) and 20 * len(hit) >= len(w)] += 1
    for size in (4_000_000, 100):  # one block, several blocks
        got = benchmark_suffixes.contamination(docs, bench, block_chars=size)
        assert rows_of(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want
    named = docs.withColumnsRenamed({"kept": "_text", "n_words": "_hits", "digest": "c0"})
    for df in (docs, named):
        clean = benchmark_suffixes.decontaminated(df, bench)
        assert clean.columns == df.columns and clean.count() == sum(not r.contaminated for r in got.collect())
    assert {r.doc_id: r.longest_match for r in got.collect()}[13] == 40


def test_classifier(spark, docs, nothing):
    rows = [(i, words(i, 60) if i % 2 else ("| " + words(i, 30).replace(" ", " | ") + "!!") * 2) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = df.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    model = compressor.fit(df, labels, F.col("doc_id") < 300)
    right = [(r.predicted == r.doc_id % 2) for r in compressor.scored(df, model).collect() if r.doc_id >= 300]
    assert sum(right) > 0.95 * len(right)
    got = compressor.scored(docs, model).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    blank = compressor.fit(docs, labels.limit(0), F.lit(True))  # nothing to learn from
    assert {r.score for r in compressor.scored(docs, blank).collect()} == {0.5}


def test_language_model_base(docs):
    held = F.col("doc_id") % 3 == 2
    learned = [t for k, t in ROWS if k is None or k % 3 != 2]
    counts = Counter(w for t in learned for w in [*WORD.findall(lower(t)), " "])
    n, v = sum(counts.values()), len(counts)
    want = []
    for k, t in ROWS:
        w = [*WORD.findall(lower(t)), " "]
        want.append((k or 0, len(w), sum(counts[x] > 0 for x in w), n, sum(np.log10((counts[x] + 1) / (n + v + 1)) for x in w)))
    got = [(r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in gru.scores(docs, held).collect()]
    for a, b in zip(sorted(got), sorted(want), strict=True):
        assert a[:4] == b[:4] and abs(a[4] - b[4]) < 1e-6 * abs(b[4])


def a_vocabulary():
    """Words as a block sees them: a shortlist of 512 words, three of them from step 3, steps of 1,500, 32, 40 and one word
    besides, and the unknown word last."""
    code = [s << gru.STEP_BIT | i for s, n in ((0, 1500), (2, 32), (3, 43), (4, 1), (40, 509)) for i in range(n)]
    short = [c for c in code if c >> gru.STEP_BIT == 40] + [3 << gru.STEP_BIT | i for i in (0, 7, 42)]
    totals = gru.Counts(6000, len(code), tuple(short), (9,) * 509 + (3,) * 3, ((0, 1500, 1500), (2, 32, 64), (3, 40, 120), (4, 1, 4)))
    return gru.Words(np.array([*code, -1]), totals), totals, np.array([*code, -1])


def a_model(totals):
    rng = np.random.default_rng(2)
    p = {k: v.astype(np.float64) for k, v in gru.first_params(totals).items()}
    p["digits"] = rng.normal(size=p["digits"].shape)
    return p, rng


def softmax(x):
    e = [np.exp(v - max(x)) for v in x]
    return [v / sum(e) for v in e]


def plain_probability(p, state, code, totals):
    """Of one word, from the definition: the class, then the place in it or digit after digit."""
    short = list(totals.short)
    steps = [s for s, _, _ in totals.steps]
    step, number = max(code, 0) >> gru.STEP_BIT, max(code, 0) & ((1 << gru.STEP_BIT) - 1)
    classes = softmax([state @ p["classes"][:, c] + p["class_bias"][c] for c in range(p["classes"].shape[1])])
    if code in short:
        at = short.index(code)
        own = range(at // 24 * 24, min(512, at // 24 * 24 + 24))
        return classes[at // 24] * softmax([state @ p["words"][w] + p["word_bias"][w] for w in own])[at - own[0]]
    i = steps.index(step)
    out = classes[gru.CLASSES + i] * (0.5 if i == 0 else 1)
    if code < 0:
        return out
    members = totals.steps[i][1]
    number -= sum(c >> gru.STEP_BIT == step and c < code for c in short)
    for level in reversed(range(totals.levels)):
        power = 32**level
        if members <= power:
            continue
        begin = number // (32 * power) * 32 * power
        below = [len(range(begin + d * power, min(members, begin + (d + 1) * power))) for d in range(32)]
        weight = [n * np.exp(state @ p["digits"][level * 32 + d]) for d, n in enumerate(below)]
        out *= weight[number // power % 32] / sum(weight)
    return out


def test_probabilities():
    """Every word's own, against the definition; all add up to 1; before training as the counts of the steps say."""
    words, totals, code = a_vocabulary()
    p, rng = a_model(totals)
    every, state = np.arange(len(code)), rng.normal(size=gru.HIDDEN)
    logs = gru.output_log(p, np.repeat(state[None], len(every), 0), every, words)
    assert abs(np.exp(logs).sum() - 1) < 1e-6
    for i in (0, 31, 32, 1023, 1024, 1488, 1499, 1500, 1531, 1532, 1533, 1539, 1540, 1573, 1574, 1575, 1576, 2000, len(code) - 1):
        assert abs(np.exp(logs[i]) / plain_probability(p, state, int(code[i]), totals) - 1) < 1e-5, i
    first = {k: v.astype(np.float64) for k, v in gru.first_params(totals).items()}
    at_rest = np.exp(gru.output_log(first, np.zeros((len(every), gru.HIDDEN)), every, words))
    assert len(np.unique(np.round(np.log(at_rest[:1500]), 6))) == 1 and at_rest[1600] > at_rest[1502] > at_rest[0]
    seen = words.entering(p, every)
    assert len(np.unique(np.round(seen, 9), axis=0)) > 0.99 * len(every)  # rows by two hashes


def test_scores_by_brute_force():
    """The recurrence and the sum of a document, step by step; lanes and windows change nothing."""
    words, totals, code = a_vocabulary()
    p, rng = a_model(totals)
    tokens, begin = rng.integers(0, len(code), 60), np.array([0, 25, 26, 60])
    got = gru.log10_by_document(p, tokens, begin, 5, words)

    def gate(x):
        return 1 / (1 + np.exp(-x))

    for d in range(3):
        h, last, total, n = np.zeros(gru.HIDDEN), 5, 0.0, gru.HIDDEN
        for t in tokens[begin[d] : begin[d + 1]].tolist():
            e = p["inputs"][words.place[last]].copy()
            if words.place[last] >= gru.SHORTLIST:
                e += sum(p["contexts"][c] for c in words.context[last])
            g = h @ p["carry"]
            z, r = gate(e[:n] + g[:n]), gate(e[n : 2 * n] + g[n : 2 * n])
            h = (1 - z) * np.tanh(e[2 * n :] + r * g[2 * n :]) + z * h
            total += np.log10(plain_probability(p, h, int(code[t]), totals))
            last = t
        assert abs(got[d] - total) < 1e-5 * abs(total)


def test_long_document_among_short_ones(monkeypatch):
    """It does not make the windows of all others narrow: few of them, and each document as if it were alone."""
    words, totals, code = a_vocabulary()
    p, rng = a_model(totals)
    begin = np.concatenate([[0], np.cumsum([3000] + [10] * 2000)])
    tokens, plain, calls = rng.integers(0, len(code), begin[-1]), gru.output_log, []
    monkeypatch.setattr(gru, "output_log", lambda *a: calls.append(len(a[2])) or plain(*a))
    got = gru.log10_by_document(p, tokens, begin, 5, words)
    assert sum(calls) == len(tokens) and len(calls) < 20
    for d in (0, 1, 777, 2000):
        alone = gru.log10_by_document(p, tokens[begin[d] : begin[d + 1]], np.array([0, begin[d + 1] - begin[d]]), 5, words)
        assert abs(got[d] / alone[0] - 1) < 1e-6


def test_gradients_of_narrow_windows():
    """One lane or one step: the same sums as those of the lanes side by side."""
    words, totals, code = a_vocabulary()
    p, rng = a_model(totals)
    x, y, first = rng.integers(0, len(code), (1, 2)), rng.integers(0, len(code), (1, 2)), np.zeros((1, 2), bool)
    h, used = rng.normal(size=(2, gru.HIDDEN)), np.ones((1, 2), bool)
    both, _ = gru.gradients(p, h, x, y, first, used, words)
    each = [gru.gradients(p, h[i : i + 1], *(v[:, i : i + 1] for v in (x, y, first, used)), words)[0] for i in (0, 1)]
    for name in p:
        assert np.allclose(both[name], each[0][name] + each[1][name], atol=1e-9), name


def test_gradients():
    words, totals, code = a_vocabulary()
    p, rng = a_model(totals)
    tokens, begin = rng.integers(0, len(code), 60), np.array([0, 25, 26, 60])
    tokens[:20] = rng.integers(1575, 2080, 20)
    lanes = gru.Lanes.of(tokens, begin, 2)
    x, used = lanes.inputs(0), lanes.document >= 0
    g, _ = gru.gradients(p, np.zeros((2, gru.HIDDEN)), x, lanes.target, lanes.first, used, words)

    def loss():
        return -gru.log10_by_document(p, tokens, begin, 0, words).sum() * np.log(10)

    row, short = words.context[tokens[tokens < 1500][0]], int(words.place[tokens[3]])
    places = [("digits", (1, 3)), ("digits", (35, 0)), ("digits", (64, 2)), ("contexts", (int(row[0]), 9)), ("contexts", (int(row[1]), 20)), ("carry", (3, 7)),
              ("carry", (5, 40)), ("inputs", (short, 9)), ("inputs", (gru.SHORTLIST, 3)), ("classes", (2, 1)), ("classes", (2, 23)), ("word_bias", (short,))]
    for name, at in places:
        old, eps = p[name][at], 1e-3
        p[name][at] = old + eps
        up = loss()
        p[name][at] = old - eps
        down = loss()
        p[name][at] = old
        assert abs((up - down) / (2 * eps) - g[name][at]) < 1e-2 * max(1, abs(g[name][at])), (name, at)


def test_words_are_numbered_once(spark):
    """Each word has one code in all blocks; the numbers of a step have no gap, over partitions and batches."""
    rng = np.random.default_rng(3)
    rows = [(int(b), i, int(w), int(n)) for b in range(7) for i, (w, n) in enumerate(zip(rng.choice(4000, 900, replace=False), rng.integers(0, 4, 900)))]
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    words = spark.createDataFrame(rows, "block long, at int, word long, n long")
    got = {(r.block, r["at"]): r for r in gru.numbered(words).collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    count, codes = Counter(), {}
    for _, _, w, n in rows:
        count[w] += n
    for b, i, w, _ in rows:
        r = got[b, i]
        assert r["count"] == count[w] and codes.setdefault(w, r.code) == r.code
    assert sum(r.new for r in got.values()) == len(count) and len(got) == len(rows)
    by_step = {}
    for w, c in codes.items():
        if count[w]:
            by_step.setdefault(int(np.floor(2 * np.log2(count[w]))), []).append(c)
        else:
            assert c == -1
    for s, own in by_step.items():
        assert sorted(own) == [s << gru.STEP_BIT | i for i in range(len(own))]


def test_language_model_learns(spark, docs, nothing):
    """Held-out text of the learned kind scores above single words; without training documents there is one word, the unknown."""
    rows = [(i, " ".join(f"{'ab'[i % 2]}{(i * 31 + j * j) % 50}" for j in range(40))) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = gru.scores(df, F.col("doc_id") % 5 == 1).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]
    none = gru.scores(docs, F.lit(True)).collect()
    assert len(none) == len(ROWS) and all(r.n_known == r.train_tokens == r.base_score == 0 and abs(r.score) < 1e-3 for r in none if r.n_tokens < 100)


def test_url_lists(spark):
    entries = [("bad.org", date(2024, 1, 1), "add"), ("bad.org", date(2024, 2, 1), "remove"), ("bad.org", date(2024, 3, 1), "add"),
               ("ok.com/ads", date(2024, 1, 5), "add"), ("ok.com/ads", date(2024, 1, 5), "remove"), ("ok.com/x/y", date(2024, 1, 5), "add"),
               (None, date(2024, 1, 1), "add"), ("a.com", None, "add"), ("a.com", date(2024, 1, 1), "what")]
    captures = [(1, "http://bad.org/", date(2024, 1, 1)), (2, "https://me@WWW.Bad.org.:80/q?x#y", date(2024, 1, 31)),
                (3, "http://bad.org", date(2024, 2, 1)), (4, "http://bad.org", date(2025, 1, 1)), (5, "http://notbad.org", date(2024, 1, 2)),
                (6, "http://ok.com/ads/1", date(2024, 2, 1)), (7, "http://ok.com//x/y/z", date(2024, 2, 1)), (8, "http://ok.com/x", date(2024, 2, 1)),
                (9, None, date(2024, 1, 2)), (10, "http://bad.org", None), (11, "", date(2024, 1, 2)), (1, "http://bad.org/", date(2024, 1, 1)),
                (12, "http://a.com", date(2024, 2, 1))]
    listed = url_lists.listed(
        spark.createDataFrame([(*c, "x") for c in captures], "page_id long, url string, fetched date, pattern string"),
        spark.createDataFrame(entries, "pattern string, dated date, action string"),
    )
    got = Counter((r.page_id, r.active_entries, r.blocked) for r in listed.collect())
    hit = {1: "bad.org", 2: "bad.org", 4: "bad.org", 7: "ok.com/x/y"}
    assert got == Counter((c[0], hit.get(c[0], ""), c[0] in hit) for c in captures)


def test_empty_tables(spark, nothing):
    bench = spark.createDataFrame([], "item_id long, text string")
    made = [
        suffix_repeats.repeat_rules(nothing), pair_bpe.encode_decode(nothing, BPE), ring.ring_shards(nothing, 24), bbit.near_duplicates(nothing),
        token_cache.cached_counts(nothing, BPE, shared_dir(spark), 512), line_dedup.line_dedup(nothing), gru.scores(nothing, F.lit(False)),
        benchmark_suffixes.contamination(nothing, bench),
    ]
    assert [df.count() for df in made] == [0] * len(made)


def test_empty_classifier_and_lists(spark, docs, nothing):
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    model = compressor.fit(nothing, labels.limit(0), F.lit(True))
    assert compressor.scored(nothing, model).count() == 0
    assert compressor.scored(nothing, compressor.fit(docs, labels, F.lit(True))).count() == 0
    captures = spark.createDataFrame([(1, "http://a.org/" + "x/" * 2_000, date(2024, 1, 2)), (2, None, None)], "page_id long, url string, fetched date")
    entries = spark.createDataFrame([("a.org/x", date(2024, 1, 1), "add")], "pattern string, dated date, action string")
    assert url_lists.listed(captures.limit(0), entries).count() == 0
    assert {r.page_id: r.blocked for r in url_lists.listed(captures, entries.limit(0)).collect()} == {1: False, 2: False}
    assert {r.page_id: r.blocked for r in url_lists.listed(captures, entries).collect()} == {1: True, 2: False}


def test_pipeline_on_empty_tables(spark, nothing, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    data = nothing.drop("n_words").withColumn("n_chars", F.length("text").cast("long"))
    data.write.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, data, str(tmp_path))
        assert out.columns == data.columns and out.count() == 0, name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_no_benchmark(spark, docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert benchmark_suffixes.contamination(docs, bench).filter("n_hit > 0").count() == 0


def test_pipeline_stages(spark, docs, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, words(6, 40))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    data = docs.drop("n_words").withColumn("n_chars", F.length("text").cast("long"))
    out = data
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, str(tmp_path))
        assert out.columns == data.columns, name
    # 9 repeats itself; the only line of 2 is in 1 already, so that it stays without text; 12 and 13 hold the benchmark's item
    assert {r.doc_id for r in out.collect()} == {1, 2, None}
    last = corpus_pipeline.STAGES[-1][1](spark, out, str(tmp_path))
    assert last.count() == out.count()

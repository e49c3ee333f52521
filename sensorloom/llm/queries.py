"""The registered query of each operator, and its SQL twin where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sensorloom.llm import url_lists
from sensorloom.llm.bbit import near_duplicates
from sensorloom.llm.benchmark_suffixes import contamination
from sensorloom.llm.compressor import fit, scored
from sensorloom.llm.gru import scores
from sensorloom.llm.guess_cost import secrets
from sensorloom.llm.line_dedup import line_dedup
from sensorloom.llm.pair_bpe import encode_decode
from sensorloom.llm.ring import ring_shards
from sensorloom.llm.suffix_repeats import repeat_rules
from sensorloom.llm.target_resampling import resampled
from sensorloom.llm.texts import LOWER, UPPER, shared_dir, table
from sensorloom.llm.token_cache import cached_counts
from sensorloom.llm.variant_trie import variants, vocabulary
from sensorloom.session import prepare

BYTE_BPE = "byte_bpe_50k.json"
QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def crc_table() -> list[int]:
    """What crc32 makes of each byte."""
    out = list(range(256))
    for _ in range(8):
        out = [x >> 1 ^ (0xEDB88320 if x & 1 else 0) for x in out]
    return out


def crc32_sql(text: str) -> str:
    """DuckDB expression: unsigned crc32 of a text's UTF-8 bytes."""
    made = f"[{','.join(map(str, crc_table()))}]::BIGINT[]"
    raw = f"[('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT for i in range(octet_length(encode({text})))]"
    return f"""xor(list_reduce(list_concat([4294967295::BIGINT], {raw}),
  lambda c, b: xor(({made})[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::BIGINT)"""


def remainder(key: str, parts: int) -> Column:
    """crc32 of the key as text; a row without a key is in no part."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(parts))


@query("op1_suffix_repeats", r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
fives AS (SELECT *, lead(i, 4) OVER o AS last,
  concat_ws(' ', word, lead(word) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) AS gram
  FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM fives WHERE last IS NOT NULL) WHERE n > 1),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 5)) AS i FROM again),
sums AS (SELECT doc_id, count(*) AS n, sum(length(word)) AS chars FROM covered JOIN words USING (doc_id, i) GROUP BY doc_id),
long AS (SELECT a.doc_id, a.i, string_agg(w.word, ' ' ORDER BY w.i) AS passage, count(*) AS n
  FROM again a JOIN words w ON w.doc_id = a.doc_id AND w.i BETWEEN a.i AND a.i + 50 GROUP BY a.doc_id, a.i),
too_long AS (SELECT DISTINCT doc_id FROM long WHERE n = 51 GROUP BY doc_id, passage HAVING count(*) > 1),
m AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum([length(x) for x in w]), 0)::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines,
  coalesce(sums.n, 0)::BIGINT AS n_repeat_words, coalesce(sums.chars, 0) AS chars, too_long.doc_id IS NOT NULL AS over
  FROM d LEFT JOIN sums USING (doc_id) LEFT JOIN too_long USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * chars <= 20 * word_chars AND NOT over AS kept
FROM m""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeat_rules(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op2_pair_index_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


@query("op3_bounded_ring")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring_shards(table(spark, sf_dir, "documents"), 24)


@query("op4_bbit_minhash", rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
fives AS (SELECT *, lead(i, 4) OVER o AS last,
  concat_ws(' ', word, lead(word) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) AS gram
  FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
sets AS (SELECT DISTINCT doc_id, gram FROM fives WHERE last IS NOT NULL
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM sets a JOIN sets b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d LEFT JOIN sizes USING (doc_id) JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = d.doc_id""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), 85)


@query("op5_digest_cache")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a cache of its own, empty before: what a first run over a corpus costs."""
    return cached_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), shared_dir(spark), 512)


@query("op6_line_dedup", rf"""
WITH lines AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM lines),
held AS (SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT k.*, coalesce(k.doc_id <> h.keeper, false) AS gone FROM keyed k LEFT JOIN held h ON h.key = k.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op7_compression_classifier")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    model = fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return scored(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op8_recurrent_lm")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"), remainder("doc_id", 7) == 2)


@query("op9_training_suffix_arrays", rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
starts AS (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, w[i : i + n - 1] AS win FROM starts),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
ahead AS (SELECT doc_id, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS next FROM words),
at_len AS (SELECT doc_id, i, n, next[1 : n] AS win FROM ahead, (SELECT DISTINCT n FROM windows) WHERE len(next) >= n),
hits AS (SELECT doc_id, i, n, item_id FROM at_len JOIN windows USING (n, win)),
hit_words AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS i FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS item_list
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items,
  sha256(coalesce(item_list, '')) AS items_sha256, coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN items i USING (doc_id)""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def number_of(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("int")


FIRST_DAY = "2024-01-01"


def dated_entries(pages: DataFrame) -> DataFrame:
    """A list made from the pages' own hosts and sections: a quarter of them is listed, taken off, and half of these listed again."""
    host = url_lists.host_of(F.col("url"))
    site = F.regexp_replace(host, r"^[^.]+\.([^.]+\.[^.]+\.[^.]+)$", "$1")
    section = F.regexp_extract(url_lists.path_of(F.col("url")), "^/*([^/]+)", 1)
    both = F.array(site, F.when(section != "", F.concat(host, F.lit("/"), section)))
    patterns = pages.filter(host != "").select(F.explode(both).alias("pattern")).filter("pattern is not null").distinct()
    patterns = patterns.withColumn("n", number_of(F.col("pattern"))).filter("n % 4 = 0")
    dated = patterns.select("pattern", "n", F.explode(F.expr("""array(
        struct(n % 180 as day, 'add' as action), struct(n % 180 + 20 + n % 60 as day, 'remove' as action),
        if(n % 8 = 0, struct(n % 180 + 100 + n % 30 as day, 'add' as action), null))""")).alias("e")).filter("e is not null")
    return dated.select("pattern", F.date_add(F.lit(FIRST_DAY).cast("date"), F.col("e.day")).alias("dated"), F.col("e.action").alias("action"))


@query("op10_temporal_list_join", rf"""
WITH p AS (SELECT page_id, url, DATE '{FIRST_DAY}' + (('0x' || md5(concat_ws(' ', page_id::VARCHAR, url))[1:6])::INTEGER % 365) AS fetched,
  translate(regexp_replace(regexp_replace(regexp_replace(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1),
    '^.*@', ''), ':[0-9]*$', ''), '\.$', ''), '{UPPER}', '{LOWER}') AS host,
  [s for s in string_split(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1), '/') if s <> ''] AS seg FROM pages),
patterns AS (SELECT DISTINCT pattern, ('0x' || md5(pattern)[1:6])::INTEGER AS n FROM (
  SELECT regexp_replace(host, '^[^.]+\.([^.]+\.[^.]+\.[^.]+)$', '\1') AS pattern FROM p WHERE host <> ''
  UNION ALL SELECT host || '/' || seg[1] FROM p WHERE host <> '' AND len(seg) > 0)),
entries AS (SELECT pattern, n % 180 AS day, 'add' AS action FROM patterns WHERE n % 4 = 0
  UNION ALL SELECT pattern, n % 180 + 20 + n % 60, 'remove' FROM patterns WHERE n % 4 = 0
  UNION ALL SELECT pattern, n % 180 + 100 + n % 30, 'add' FROM patterns WHERE n % 8 = 0),
by_day AS (SELECT pattern, day, max(action) AS action FROM entries GROUP BY pattern, day),
spans AS (SELECT *, lead(day) OVER (PARTITION BY pattern ORDER BY day) AS until FROM by_day),
labels AS (SELECT page_id, fetched, seg, string_split(host, '.') AS l FROM p WHERE host <> ''),
hosts AS (SELECT page_id, fetched, seg, array_to_string(l[k:], '.') AS h FROM
  (SELECT *, unnest(range(1, greatest(len(l) - 1, 1) + 1)) AS k FROM labels)),
asked AS (SELECT DISTINCT page_id, fetched, h || CASE WHEN k = 0 THEN '' ELSE '/' || array_to_string(seg[1:k], '/') END AS pattern FROM
  (SELECT *, unnest(range(0, len(seg) + 1)) AS k FROM hosts)),
hits AS (SELECT page_id, asked.pattern FROM asked JOIN spans ON spans.pattern = asked.pattern AND action = 'add'
  AND fetched >= DATE '{FIRST_DAY}' + day AND (until IS NULL OR fetched < DATE '{FIRST_DAY}' + until)),
found AS (SELECT page_id, count(*) AS n, string_agg(pattern, ',' ORDER BY pattern) AS patterns FROM hits GROUP BY page_id)
SELECT page_id, fetched, coalesce(n, 0)::BIGINT AS n_active, coalesce(patterns, '') AS active_entries, n IS NOT NULL AS blocked
FROM p LEFT JOIN found USING (page_id)""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables have no fetch times and no list: days come from a digest of each page's id and url, the list from the pages' hosts."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    day = F.pmod(number_of(F.concat_ws(" ", F.col("page_id").cast("string"), "url")), F.lit(365))
    captures = pages.withColumn("fetched", F.date_add(F.lit(FIRST_DAY).cast("date"), day))
    return url_lists.listed(captures, dated_entries(pages))


@query("op11_guess_cost")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(table(spark, sf_dir, "documents"))


@query("op12_vector_trie", rf"""
WITH RECURSIVE runs AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{{7,}}')) AS run FROM documents),
low AS (SELECT doc_id, translate(run, '{UPPER}', '{LOWER}') AS run, count(*) AS n FROM runs GROUP BY ALL),
dig AS (SELECT *, {crc32_sql("doc_id::VARCHAR || ':' || run")} AS h FROM low),
cut AS (SELECT CASE WHEN h % 31 = 0 THEN run[1 : (h % length(run))::BIGINT] || run[(h % length(run))::BIGINT + 2 :] ELSE run END AS word, n FROM dig),
v AS (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
less AS (SELECT word, n, i, word[1 : i - 1] || word[i + 1 :] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
pairs AS (SELECT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT less.word, v.word, v.n FROM less JOIN v ON less.rest = v.word
  UNION SELECT v.word, less.word, less.n FROM less JOIN v ON less.rest = v.word),
best AS (SELECT word, count(*) AS n_near, max(n) AS top FROM pairs GROUP BY word),
forms AS (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN top >= 10 * v.n THEN top END AS form_n,
  CASE WHEN top >= 10 * v.n THEN (SELECT min(other) FROM pairs p WHERE p.word = v.word AND p.n = top) END AS form FROM v LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root FROM forms UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.root WHERE form IS NOT NULL),
ends AS (SELECT chain.word, root FROM chain JOIN forms ON forms.word = root WHERE form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(vocabulary(table(spark, sf_dir, "documents")))


@query("op13_batch_resampling", rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
words AS (SELECT doc_id, unnest(w) AS word FROM d),
known AS (SELECT word, {crc32_sql("word")} % 10000 AS bucket FROM (SELECT word FROM words UNION SELECT word FROM b)),
s AS (SELECT bucket, count(*) AS n FROM words JOIN known USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM b JOIN known USING (word) GROUP BY bucket),
gain AS (SELECT bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM words) + 10000)::DOUBLE)
  / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM b) + 10000)::DOUBLE)))::BIGINT AS gain FROM s FULL JOIN t USING (bucket)),
sums AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM words JOIN known USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scores AS (SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
  + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN sums USING (doc_id)),
places AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scores WHERE n_features >= 20)
SELECT scores.*, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM scores LEFT JOIN places USING (doc_id)""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

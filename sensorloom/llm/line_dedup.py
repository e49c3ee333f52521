"""Line dedup across documents, in DataFrame functions only.

Lines are exploded with a digest of their key (blanks stripped, A-Z lower-cased); digests are counted by distinct
documents; a line whose digest is in too many documents is dropped, except in the smallest document that holds it; the
rest is put together again by position.

Null or empty text: one empty line, never dropped. Rows without a key keep all lines and are not counted. Repeated rows of
one key count as one document and are treated alike. Short keys are never dropped. Empty table: empty result.
A very common line is one row per document at most before the shuffle, is counted map-side first, and its join may be
split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.llm.texts import LOWER, SPACES, UPPER, stored

LEAST_POINTS = 10
LEAST_DOCUMENTS = 2


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def line_digest(line: Column) -> Column:
    """128-bit digest of a line's key; null for a short key."""
    key = line_key(line)
    return F.when(F.char_length(key) >= LEAST_POINTS, F.unhex(F.md5(key)))


def lines_of(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def drops(docs: DataFrame, key: str, text: str, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(document, digests of the lines it loses)"""
    digests = F.array_distinct(F.filter(F.transform(lines_of(text), line_digest), lambda d: d.isNotNull()))
    lines = docs.filter(F.col(key).isNotNull()).select(F.col(key).alias("doc"), F.explode(digests).alias("digest"))
    if least == 2:  # two documents: the smallest is not the largest
        common = lines.groupBy("digest").agg(F.min("doc").alias("keeper"), F.max("doc").alias("last")).filter("keeper <> last")
    else:
        common = lines.groupBy("digest").agg(F.min("doc").alias("keeper"), F.count_distinct("doc").alias("n")).filter(F.col("n") >= least)
    common = stored(common.select("digest", "keeper"))  # a table of its own, so that the join's hot digests may be split
    lost = lines.join(common, "digest").filter(F.col("doc") != F.col("keeper"))
    return lost.groupBy("doc").agg(F.collect_set("digest").alias("dropped"))


def without_common_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_DOCUMENTS) -> DataFrame:
    """All columns of `docs`, with the text put together from the lines that stay, and two line counts."""
    lost = drops(docs, key, text, least).select(F.col("doc").alias("_doc"), F.col("dropped").alias("_dropped")).hint("shuffle_hash")
    whole = docs.join(lost, docs[key] == lost["_doc"], "left")
    lines = F.transform(lines_of(text), lambda x: F.struct(x.alias("line"), line_digest(x).alias("digest")))
    stay = F.filter(
        lines, lambda x: F.col("_dropped").isNull() | x["digest"].isNull() | ~F.array_contains("_dropped", x["digest"])
    )
    whole = whole.withColumn("_stay", F.when(F.col("_dropped").isNotNull(), stay["line"]))
    text_now = F.when(F.col("_dropped").isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(F.array_join("_stay", "\n"))
    n = F.size(lines_of(text))
    return whole.select(
        *[docs[c] for c in docs.columns],
        text_now.alias("_text"), n.cast("long").alias("_n_lines"),
        F.when(F.col("_dropped").isNull(), F.lit(0)).otherwise(n - F.size("_stay")).cast("long").alias("_n_dropped"),
    )


def line_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_DOCUMENTS) -> DataFrame:
    """Key, lines before, lines dropped, new text."""
    done = without_common_lines(docs.select(key, text), key, text, least)
    return done.select(key, F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.col("_text").alias("kept_text"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_DOCUMENTS) -> DataFrame:
    """`docs` with the common lines taken out of the text; a null text stays null."""
    done = without_common_lines(docs, key, text, least)
    kept = F.when(done[text].isNotNull(), done["_text"])
    return done.select(*[kept.alias(c) if c == text else done[c] for c in docs.columns])

"""Dated URL lists, joined as of the time of fetching.

A list is a table of dated entries: a pattern was added or removed on a day. The entries of one pattern become validity
intervals, each up to the next entry. A pattern is a host, which also holds for its subdomains, or a host with the first
segments of a path. Each capture offers all its patterns (an equi-join), and the interval that holds its fetch time
decides. Intervals of a pattern don't overlap, so a capture meets at most one per pattern.

Null or unusual url, or null time: no match, not blocked. An entry without pattern, day or known action is no entry. Of
entries of one pattern and day, removal holds. Repeated captures are rows of their own, and are looked up once. Empty list:
nothing is blocked. A host with very many captures is one key of the join, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorloom.llm.texts import LOWER, UPPER

ADDED, REMOVED = "add", "remove"


def host_of(url: Column) -> Column:
    """Host without user, port or a last dot; empty if there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    bare = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", "")
    return F.translate(F.regexp_replace(bare, r"\.$", ""), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def patterns_of(url: Column, deepest: int) -> Column:
    """All patterns that hold for a url: its host and parent domains, alone and with the path's first segments, `deepest` at most."""
    labels = F.split(host_of(url), r"\.", -1)
    n = F.size(labels)
    last = F.greatest(n - 2, F.lit(0))  # a parent domain has two labels at least
    hosts = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(labels, i + 1, n), "."))
    segments = F.slice(F.filter(F.split(path_of(url), "/", -1), lambda s: s != ""), 1, deepest)
    starts = F.transform(
        F.sequence(F.lit(0), F.size(segments)),
        lambda k: F.when(k == 0, F.lit("")).otherwise(F.concat(F.lit("/"), F.array_join(F.slice(segments, 1, k), "/"))),
    )
    every = F.flatten(F.transform(hosts, lambda h: F.transform(starts, lambda s: F.concat(h, s))))
    return F.when(host_of(url) != "", F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """(pattern, valid_from, valid_to) of the times at which a pattern is listed; valid_to is null for the last."""
    dated = entries.filter(F.col("action").isin(ADDED, REMOVED) & F.col("pattern").isNotNull() & F.col("dated").isNotNull())
    by_day = dated.groupBy("pattern", "dated").agg(F.max("action").alias("action"))  # removal comes last
    following = F.lead("dated").over(Window.partitionBy("pattern").orderBy("dated"))
    spans = by_day.select("pattern", "action", F.col("dated").alias("valid_from"), following.alias("valid_to"))
    return spans.filter(F.col("action") == ADDED).drop("action")


def listed(captures: DataFrame, entries: DataFrame, key: str = "page_id", url: str = "url", fetched: str = "fetched") -> DataFrame:
    """Key, fetch time, number of entries active then, these entries, and the verdict, for every capture."""
    plain = captures.select(F.col(key).alias("_key"), F.col(url).alias("_url"), F.col(fetched).alias("_at"))
    spans = intervals(entries)
    # no pattern of the list goes deeper: a url with a thousand segments has as many patterns as can be met, and none is lost
    deepest = spans.agg(F.max(F.size(F.split("pattern", "/")) - 1)).first()[0] or 0
    asked = plain.select("_url", "_at").distinct().select("_url", "_at", F.explode(patterns_of(F.col("_url"), deepest)).alias("pattern"))
    active = (F.col("_at") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("_at") < F.col("valid_to")))
    hits = asked.join(spans, "pattern").filter(active)
    found = hits.groupBy(F.col("_url").alias("_u"), F.col("_at").alias("_t")).agg(
        F.count("*").alias("n"), F.array_sort(F.collect_set("pattern")).alias("patterns")
    )
    same = F.col("_url").eqNullSafe(F.col("_u")) & F.col("_at").eqNullSafe(F.col("_t"))
    return plain.join(found, same, "left").select(
        F.col("_key").alias(key), F.col("_at").alias(fetched), F.coalesce("n", F.lit(0)).alias("n_active"),
        F.coalesce(F.array_join("patterns", ","), F.lit("")).alias("active_entries"), F.col("n").isNotNull().alias("blocked"),
    )

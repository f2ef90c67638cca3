"""URL filters by a temporal list join (DataFrame functions only).

List entries are dated events of a key: ``block``, ``allow`` or ``remove``. The events of a key become validity
intervals, each up to the key's next event. A capture, a URL with its fetch date, has candidate keys: its host and
the domains above it (``d:``), each path prefix (``p:``) and the whole URL (``u:``). An as-of join finds the entries
of those keys that were active on the fetch date; the most specific one decides.

Intervals are cut at months and joined on (key, month), so a key with many captures or many events is spread over
months, and the captures of one month and key are an ordinary skewed side. Captures are reduced to distinct (URL,
date) first and joined back, so copies cost nothing.

Defined results: events of one key on one day count as one, block before allow before remove. Without an active
entry, and for null URLs or dates and URLs without a host, the decision is ``none`` with null rule and date. Rows stay
as they are, repeated ones too. Null keys, dates and unknown actions of entries are ignored. Empty lists decide none.
Columns of the captures stay, whatever their names, but for those named as a result column, which it replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)"
# Ranks of keys by kind; within a kind, more labels or segments are more specific.
PATH_RANK, URL_RANK = 1_000, 1_000_000
ACTIONS = ("remove", "allow", "block")


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _HOST, 1))


def segments(url: Column) -> Column:
    return F.filter(F.split(F.regexp_extract(url, _PATH, 1), "/"), lambda s: s != "")


def _runs(items: Column, key) -> Column:
    """``key(i)`` of 1..size, an empty array for no items."""
    return F.when(F.size(items) > 0, F.transform(F.sequence(F.lit(1), F.size(items)), key)).otherwise(F.array())


def candidates(url: Column) -> Column:
    """Array of (key, rank) of a URL's candidate keys; empty without a host."""
    labels, parts = F.split(host(url), r"\."), segments(url)
    entry = lambda key, rank: F.struct(key.alias("key"), rank.cast("int").alias("rank"))
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: entry(F.concat(F.lit("d:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")), F.size(labels) - i + 1),
    )
    ranks = F.when(F.size(parts) > 0, F.sequence(F.lit(1), F.size(parts))).otherwise(F.array().cast("array<int>"))
    paths = F.transform(
        ranks, lambda i: entry(F.concat(F.lit("p:"), host(url), F.lit("/"), F.array_join(F.slice(parts, 1, i), "/")), i + PATH_RANK)
    )
    whole = F.array(entry(F.concat(F.lit("u:"), url), F.lit(URL_RANK)))
    return F.when(host(url) != "", F.concat(domains, paths, whole))


def validity(entries: DataFrame) -> DataFrame:
    """(key, action, valid_from, valid_to) of block and allow entries; valid_to is exclusive, null while open."""
    level = F.array_position(F.array(*map(F.lit, ACTIONS)), F.col("action"))
    events = entries.select("key", F.col("listed_on").cast("date").alias("valid_from"), level.alias("level"))
    events = events.where("key is not null and valid_from is not null and level > 0")
    # At most one event of a key and day: a key's window holds no more rows than there are days.
    events = events.groupBy("key", "valid_from").agg(F.max("level").alias("level"))
    following = F.lead("valid_from").over(Window.partitionBy("key").orderBy("valid_from"))
    events = events.withColumn("valid_to", following).where("level > 1")
    return events.select("key", F.element_at(F.array(*map(F.lit, ACTIONS)), F.col("level").cast("int")).alias("action"), "valid_from", "valid_to")


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def decide(captures: DataFrame, entries: DataFrame, url: str = "url", fetched_on: str = "fetched_on") -> DataFrame:
    """The captures with decision, rule and listed_since."""
    seen = captures.select(F.col(url).alias("_url"), F.col(fetched_on).cast("date").alias("_day"))
    seen = seen.where("_url is not null and _day is not null").distinct()
    last = seen.agg(F.max("_day")).first()[0]
    spans = validity(entries).where(F.col("valid_from") <= F.lit(last))
    final = F.least(F.coalesce(F.date_sub("valid_to", 1), F.lit(last)), F.lit(last))
    spans = spans.withColumn("month", F.explode(F.sequence(_month(F.col("valid_from")), _month(final))))
    asked = seen.select("_url", "_day", _month(F.col("_day")).alias("month"), F.explode(candidates(F.col("_url"))).alias("c"))
    asked = asked.select("_url", "_day", "month", "c.key", "c.rank")
    active = (F.col("valid_from") <= F.col("_day")) & (F.col("valid_to").isNull() | (F.col("_day") < F.col("valid_to")))
    hits = asked.join(spans, ["key", "month"]).where(active)
    best = F.max(F.struct("rank", "key", "action", "valid_from")).alias("best")
    found = hits.groupBy("_url", "_day").agg(best)
    # The capture travels as one struct, so its column names meet no others.
    rows = captures.select(F.struct("*").alias("_row"), F.col(url).alias("_url"), F.col(fetched_on).cast("date").alias("_day"))
    ruled = ("decision", "rule", "listed_since")
    return rows.join(found, ["_url", "_day"], "left").select(
        *(F.col("_row").getField(c).alias(c) for c in captures.columns if c.lower() not in ruled),
        F.coalesce("best.action", F.lit("none")).alias("decision"),
        F.col("best.key").alias("rule"),
        F.col("best.valid_from").alias("listed_since"),
    )

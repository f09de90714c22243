"""URL filters: every capture is judged by the list entries that were active when it was fetched.

Dated additions and removals of an entry become validity intervals. A capture asks for the entries of its host, its parent domains and
the beginnings of its path: a handful of keys, joined by equality; the as-of condition picks the interval that holds the
fetch time. The longest active entry decides, and of entries of one length a blocking one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripweave.llm.common import Scratch

#: Fixed value: the end of an interval that nothing ended.
OPEN = "9999-12-31"
#: Bytes of entries that may be broadcast, and of one entry beside its value.
BROADCAST_BYTES, ENTRY_BYTES = 16 << 20, 64


def validity(events: DataFrame) -> DataFrame:
    """(value, verdict, begin, end) from events (value, verdict, day, added), the end exclusive.

    A value may hold a blocking and an allowing entry at once; each is added and removed by itself. Events of one entry are taken in order of
    time, at one time the removal first. An event ends what held of that entry before, so adding it twice renews it, and a removal
    of what is not there does nothing. Times are kept as they are; a date is its midnight. Rows with a null are no events.
    """
    own = W.partitionBy("value", "verdict").orderBy("day", "added")
    known = events.select("value", "verdict", F.col("day").cast("timestamp").alias("day"), "added").dropna()
    dated = known.withColumn("end", F.coalesce(F.lead("day").over(own), F.lit(OPEN).cast("timestamp")))
    return dated.where(F.col("added") & (F.col("day") < F.col("end"))).select("value", "verdict", F.col("day").alias("begin"), "end")


def bare_url(url: Column) -> Column:
    """Host in lower case and path, without scheme, credentials, port, query, fragment and end slashes."""
    body = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"[?#].*$", "")
    host = F.lower(F.regexp_replace(F.regexp_replace(F.regexp_extract(body, r"^[^/]*", 0), r"^.*@", ""), r":[0-9]*$", ""))
    return F.concat(host, F.regexp_replace(F.regexp_replace(body, r"^[^/]*", ""), r"/+$", ""))


def keys_of(url: Column) -> Column:
    """What a list may name a capture by: the host and its parents of two labels or more, and each beginning of host and path."""
    parts = F.split(bare_url(url), "/")
    labels = F.split(F.element_at(parts, 1), r"\.")
    parents = F.when(F.size(labels) > 2, F.transform(F.sequence(F.lit(2), F.size(labels) - 1), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels)), "."))).otherwise(F.expr("CAST(array() AS array<string>)"))
    paths = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    return F.array_distinct(F.filter(F.concat(parents, paths), lambda k: k != ""))


def judge_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """One row per input row of ``captures`` (page_id, url, fetched): n_active, decided_by and ``blocked``.

    ``entries`` are intervals as of ``validity``. A null or empty url has no keys, and a null time meets no interval: neither is blocked.
    Equal rows are judged alike, each by itself; other columns are not read. Without entries nothing is blocked, and no captures
    give no rows.
    """
    scratch = Scratch(captures.sparkSession, "urls")
    # Each distinct (url, time) is judged once, so copies of a capture, however many, do not load the join.
    seen = captures.select("page_id", "url", F.col("fetched").cast("timestamp").alias("fetched"))
    distinct = seen.select("url", "fetched").where(F.col("url").isNotNull() & F.col("fetched").isNotNull()).distinct()
    asked = distinct.select("url", "fetched", F.explode(keys_of(F.col("url"))).alias("value"))
    entries = scratch.keep(entries, "entries")
    size = entries.agg(F.sum(F.octet_length("value") + ENTRY_BYTES)).first()[0] or 0
    active = asked.join(F.broadcast(entries) if size <= BROADCAST_BYTES else entries, "value").where(
        (F.col("begin") <= F.col("fetched")) & (F.col("fetched") < F.col("end")))
    found = active.groupBy("url", "fetched").agg(
        F.count("*").alias("n_active"),
        F.max(F.struct(F.length("value").alias("n"), (F.col("verdict") == "block").alias("blocked"), F.col("value"))).alias("top"))
    return seen.join(found, ["url", "fetched"], "left").select(
        "page_id", "url", "fetched", F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
        F.col("top.value").alias("decided_by"), F.coalesce("top.blocked", F.lit(False)).alias("blocked"))

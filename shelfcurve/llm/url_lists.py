"""URL filters by a temporal list join, with DataFrame functions only.

List entries are dated: an entry adds or removes a pattern (a host with all hosts below it, or a
host and its first path segment) on a day. Between an addition and the next change the pattern is
active: the changes of a pattern become intervals [from, until). A capture is evaluated against the
entries active on the day it was fetched.

Captures are reduced to the distinct (host, segment, day) first, so that a host that a third of all
captures share is looked up once a day. The lookup is an equi-join on the pattern and on a block of
days: an interval is entered once for each block that it touches, so the entries of a pattern that
changes often are not compared with all its captures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK = 32


def host_of(url: Column) -> Column:
    """The host in lower case, without user, port and final dot; empty if there is none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.coalesce(F.lower(F.regexp_replace(found, r"\.$", "")), F.lit(""))


def segment_of(url: Column) -> Column:
    """The first path segment; empty if there is none."""
    return F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]*)", 1), F.lit(""))


def validity(changes: DataFrame) -> DataFrame:
    """(pattern, from_day, until_day): when each pattern of ``changes`` (pattern, day, added) is
    active. until_day is null while it still is.

    Several changes of a pattern on one day: a removal wins. Changes that change nothing are merged
    with what is there. Rows with a null in any of the three columns say nothing.
    """
    days = changes.dropna(subset=["pattern", "day", "added"]).groupBy("pattern", "day").agg(F.bool_and("added").alias("added"))
    order = Window.partitionBy("pattern").orderBy("day")
    turns = days.withColumn("was", F.lag("added").over(order)).where("was IS NULL OR was <> added")
    spans = turns.withColumn("until_day", F.lead("day").over(order))
    return spans.where("added").select("pattern", F.col("day").alias("from_day"), "until_day")


def filter_urls(captures: DataFrame, changes: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per row of ``captures`` (page_id, url, fetched_day): page_id, url, fetched_day, host,
    n_active, patterns, blocked.

    ``patterns`` are the matching active patterns, sorted and comma-joined. A null URL, a URL without
    a host and a null day match nothing. Repeated rows appear each; other columns are not read.
    """
    seen = captures.select("page_id", "url", "fetched_day", host_of(F.col("url")).alias("host"), segment_of(F.col("url")).alias("segment"))
    labels = F.split("host", r"\.")
    size = F.size(labels)
    above = F.transform(F.sequence(F.lit(1), size), lambda k: F.array_join(F.slice(labels, k, size), "."))
    asked = seen.where("host <> '' AND fetched_day IS NOT NULL").select("host", "segment", "fetched_day").distinct()
    tried = asked.withColumn("pattern", F.explode(F.array_distinct(F.concat(above, F.array(F.concat_ws("/", "host", "segment"))))))
    tried = tried.withColumn("part", F.floor(F.col("fetched_day") / block))

    horizon = captures.agg(F.max("fetched_day")).scalar()
    end = F.least(F.coalesce("until_day", horizon + 1), horizon + 1)
    entered = validity(changes).where(F.col("from_day") <= horizon).withColumn("stop", end).where("stop > from_day").withColumn(
        "part", F.explode(F.sequence(F.floor(F.col("from_day") / block), F.floor((F.col("stop") - 1) / block)))
    )
    hits = tried.join(entered.select("pattern", "part", "from_day", "stop"), ["pattern", "part"]).where("fetched_day >= from_day AND fetched_day < stop")
    found = hits.groupBy("host", "segment", "fetched_day").agg(F.sort_array(F.collect_set("pattern")).alias("found"))
    joined = seen.join(found, ["host", "segment", "fetched_day"], "left")
    return joined.select(
        "page_id", "url", "fetched_day", "host",
        F.coalesce(F.size("found"), F.lit(0)).cast("bigint").alias("n_active"),
        F.coalesce(F.array_join("found", ","), F.lit("")).alias("patterns"),
        F.col("found").isNotNull().alias("blocked"),
    )

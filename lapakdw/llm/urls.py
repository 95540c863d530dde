"""URL filters: dated list entries become validity intervals, captures are judged as of their fetch time.

A list entry says that on a day a key was added to or removed from the list. A
key is a domain (which covers its subdomains) or a host with leading path
segments. All entries of a key make one row with its sorted intervals; a
capture looks up all keys that cover its address, by equality, and each row
yields at most one of the intervals that were open when the capture was fetched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapakdw.llm.text import broadcast_if_measured
from lapakdw.runtime import materialize

ADD, REMOVE = "add", "remove"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; empty where there is none."""
    authority = F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://([^/?#\s]*)", 1)
    host = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d*$", "")
    return F.lower(F.regexp_replace(host, r"\.$", ""))


def path_of(url: Column) -> Column:
    """Path segments joined by slashes, without query, fragment and empty segments."""
    path = F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.regexp_replace(F.regexp_replace(path, r"/+", "/"), r"^/|/$", "")


def covering_keys(url: Column) -> Column:
    """Keys whose entries cover an address: its domains, shortest first, then host and path prefixes.

    The place in the array tells how specific a key is.
    """
    host, path = host_of(url), path_of(url)
    labels, segments = F.split(host, r"\."), F.split(path, "/")
    n, m = F.size(labels), F.size(segments)
    domains = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, -i, i), "."))
    prefixes = F.transform(
        F.sequence(F.lit(1), m), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, 1, i), "/"))
    )
    none = F.array().cast("array<string>")
    return F.when(host == "", none).otherwise(F.concat(domains, F.when(path == "", none).otherwise(prefixes)))


def validity_intervals(entries: DataFrame, by_category: bool = False) -> DataFrame:
    """One row per key: ``key, intervals``, an array of (listed_from, listed_to, category) by day.

    ``entries`` has ``key, day, action, category``. An interval runs from the
    day of an addition up to, not including, the day of the key's next entry;
    the last one has no end. Of several entries of one key and day, a removal
    wins, then the greatest category. Entries without key or day, and with
    other actions, are ignored. The entries of a key are first reduced to one
    per day, so a key is bounded by the number of days.

    ``by_category`` keeps the categories of a key apart, as lists of their own:
    the next entry of the same key and category ends an interval, and those of
    several categories may be open together. A missing category is one too.
    Where ``day`` is a timestamp, all this holds by the entries' times instead.
    """
    timed = isinstance(entries.schema["day"].dataType, (T.TimestampType, T.TimestampNTZType))
    at = F.col("day") if timed else F.col("day").cast("date")
    listed = ["key", "category"] if by_category else ["key"]
    known = entries.where(
        F.col("key").isNotNull() & F.col("day").isNotNull() & F.col("action").isin(ADD, REMOVE)
    )
    daily = known.groupBy(*listed, at.alias("day")).agg(
        F.max(F.struct("action", "category")).alias("last")
    )
    following = F.lead("day").over(Window.partitionBy(*listed).orderBy("day"))
    spans = daily.withColumn("until", following).where(F.col("last.action") == ADD)
    one = F.struct(
        F.col("day").alias("listed_from"), F.col("until").alias("listed_to"), F.col("last.category").alias("category")
    )
    return spans.groupBy("key").agg(F.sort_array(F.collect_list(one)).alias("intervals"))


def filter_captures(captures: DataFrame, entries: DataFrame, by_category: bool = False) -> DataFrame:
    """Judge captures ``(page_id, url, fetched)``: the same columns and
    ``blocked, list_key, category, listed_from, listed_to`` of the most specific open entry.

    A null or malformed address and a missing fetch day match nothing. Repeated
    captures are looked up once and returned as often as they came. Other
    columns are ignored. Both tables may be empty. ``by_category`` is that of
    ``validity_intervals``; of several open entries of a key the one listed last
    is told, then the one of the greatest category.
    """
    unique = captures.groupBy("page_id", "url", "fetched").agg(F.count("*").cast("int").alias("copies"))
    lists = materialize(validity_intervals(entries, by_category), "intervals")
    keys = unique.select(
        "page_id", "url", "fetched", "copies", F.posexplode_outer(covering_keys(F.col("url"))).alias("rank", "key")
    )
    joined = keys.join(broadcast_if_measured(lists.select(F.col("key").alias("list_key"), "intervals")),
                       F.col("key") == F.col("list_key"), "left")
    open_ones = F.filter(
        "intervals",
        lambda x: (x["listed_from"] <= F.col("fetched"))
        & (x["listed_to"].isNull() | (x["listed_to"] > F.col("fetched"))),
    )
    hit = F.array_max(F.transform(open_ones, lambda x: F.struct(x["listed_from"], x["category"], x["listed_to"])))
    held = joined.select("page_id", "url", "fetched", "copies", "rank", "list_key", hit.alias("hit"))
    best = F.max_by(
        F.struct("list_key", "hit.category", "hit.listed_from", "hit.listed_to"),
        F.when(F.col("hit").isNotNull(), F.col("rank")),
    )
    judged = held.groupBy("page_id", "url", "fetched", "copies").agg(best.alias("best"))
    return judged.select(
        "page_id",
        "url",
        "fetched",
        F.col("best").isNotNull().alias("blocked"),
        "best.*",
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")

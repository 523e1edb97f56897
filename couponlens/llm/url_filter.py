"""URL filters by a temporal list join (DataFrame functions only).

List entries are dated actions: from ``add`` until the next action on the
same list and key the key is listed. These validity intervals are joined to
captures as of their fetch time: a capture asks for its host, every parent
domain and every path prefix, by key and month, and the interval that holds
the fetch time decides. The month in the join key cuts long histories and
spreads hot hosts; what is left of the skew AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from couponlens.llm.common import ROW, numbered, stored

HOST = r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
PATH = r"^[a-z][a-z0-9+.\-]*://[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    """Lower-case host without trailing dot; empty where there is none."""
    return F.rtrim(F.regexp_extract(F.lower(F.trim(F.coalesce(url, F.lit("")))), HOST, 1), F.lit("."))


def keys_of(url: Column, domain: Column, path: Column) -> Column:
    """Keys a capture may be listed under: host, its parent domains, and host + every path prefix at a slash.

    Only keys of at most ``domain`` characters (host and parents) and
    ``path`` characters (with a path), the longest that are listed: no longer
    one can match. So the keys of a URL of any length are no more than a
    listed key is long, and what lies beyond is cut off before it is split.
    """
    host = host_of(url)
    # One character more than may match shows whether the cut is at the end of a label or step.
    tail = F.right(host, domain + 1)
    labels = F.split(F.when(F.length(host) > domain, F.regexp_replace(tail, r"^[^.]*\.?", "")).otherwise(host), r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    room = F.greatest(path - F.length(host), F.lit(0))
    steps = F.regexp_replace(F.regexp_extract(F.trim(F.coalesce(url, F.lit(""))), "(?i)" + PATH, 1), "/+", "/")
    begin = F.substring(steps, F.lit(1), room + 1)
    steps = F.when(F.length(steps) > room, F.regexp_replace(begin, "/[^/]*$", "")).otherwise(steps)
    steps = F.filter(F.split(steps, "/"), lambda s: s != "")
    paths = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(steps, F.lit(1), i), "/")))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.filter(
        F.array_distinct(F.concat(domains, F.filter(paths, lambda p: ~p.endswith("/")))), lambda k: k != ""))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, key, valid_from, valid_to) from dated entries (list, key, action add or remove, dated).

    ``valid_to`` is exclusive and null while no later action is known. Of
    actions dated alike ``remove`` counts last; entries without key or date
    are no entries; repeated entries change nothing.
    """
    order = W.partitionBy("list", "key").orderBy("dated", "action")
    known = entries.select("list", "key", "action", "dated").where(
        F.col("key").isNotNull() & F.col("dated").isNotNull() & F.col("action").isin("add", "remove")).distinct()
    return (known.withColumn("valid_to", F.lead("dated").over(order)).where("action = 'add'")
            .select("list", "key", F.col("dated").alias("valid_from"), "valid_to")
            .where("valid_to IS NULL OR valid_to > valid_from"))


def filter_captures(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url",
                    time_col: str = "fetched_at") -> DataFrame:
    """One row per capture: page_id, url, fetched_at, host, blocked, matched_list, matched_key, listed_since, matches.

    A capture is blocked if any of its keys is listed at its fetch time; the
    longest such key is named, ties by key and then list, and ``matches``
    counts (list, key) pairs. A null or odd URL has no key, a null time
    falls into no interval: neither is ever blocked. Repeated rows are
    answered one by one; an empty list blocks nothing. A URL of any length
    is asked for as many keys, at most, as the longest listed key has
    characters.
    """
    rows = stored(numbered(captures.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(time_col).alias("fetched_at"))), "captures")
    span = rows.agg(F.min("fetched_at").alias("first"), F.max("fetched_at").alias("last"))  # one row
    known = stored(intervals(entries), "intervals")
    longest = lambda condition: F.coalesce(F.max(F.when(condition, F.length("key"))), F.lit(0))
    slash = F.contains("key", F.lit("/"))
    reach = known.agg(longest(~slash).alias("domain"), longest(slash).alias("path"))  # one row
    month = lambda c: F.trunc(c, "month")
    listed = (known.crossJoin(F.broadcast(span))
              .where("valid_from <= last AND (valid_to IS NULL OR valid_to > first)")
              .withColumn("month", F.explode(F.sequence(month(F.greatest("valid_from", "first")),
                                                        month(F.least(F.coalesce("valid_to", "last"), "last")), F.expr("interval 1 month"))))
              .drop("first", "last"))
    asked = rows.crossJoin(F.broadcast(reach)).select(
        ROW, "fetched_at", month("fetched_at").alias("month"), F.explode(keys_of(F.col("url"), F.col("domain"), F.col("path"))).alias("key"))
    hits = (asked.join(listed, ["key", "month"]).where("fetched_at >= valid_from AND (valid_to IS NULL OR fetched_at < valid_to)")
            .groupBy(ROW).agg(F.count("*").alias("matches"), F.min(F.struct(
                (-F.length("key")).alias("rank"), "key", "list", "valid_from")).alias("hit")))
    return rows.join(hits, ROW, "left").select(
        "page_id", "url", "fetched_at", F.nullif(host_of(F.col("url")), F.lit("")).alias("host"), F.col("hit").isNotNull().alias("blocked"),
        F.col("hit.list").alias("matched_list"), F.col("hit.key").alias("matched_key"), F.col("hit.valid_from").alias("listed_since"),
        F.coalesce("matches", F.lit(0).cast("long")).alias("matches"))

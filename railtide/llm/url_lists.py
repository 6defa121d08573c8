"""Block and allow lists with dated entries, evaluated as they stood when a URL was fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railtide.llm.common import spread_join


def url_host(url: Column) -> Column:
    """Lower-case host without user, port and a leading ``www.``; null where there is none."""
    authority = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r"(:[0-9]*)?$", "")
    host = F.regexp_replace(host, r"^www\.", "")
    return F.when(host != "", host)


def url_keys(url: Column) -> Column:
    """Keys under which a list may name the URL: host suffixes of two or more labels, and the host
    followed by every leading run of path segments. Letter case of the path counts."""
    host = url_host(url)
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    path = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([^?#]*)", 1)
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    prefixes = F.transform(
        F.filter(F.sequence(F.lit(0), F.size(segments)), lambda i: i > 0),
        lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i), "/")))
    return F.array_distinct(F.concat(suffixes, prefixes))


def intervals(entries: DataFrame) -> DataFrame:
    """Dated ``add`` and ``remove`` entries (list, key, dated, action) to validity intervals.

    Returns list, key, valid_from, valid_to: from the date of an add up to, not including, the next
    dated entry of the same list and key (null: still valid). Of entries with the same list, key and
    date a removal wins. Entries with a null list, key, date or action are left out, as they can
    never apply; so is any action but add and remove.
    """
    known = entries.where(F.col("action").isin("add", "remove")).dropna(subset=["list", "key", "dated"])
    # "remove" sorts after "add".
    daily = known.groupBy("list", "key", "dated").agg(F.max("action").alias("action"))
    following = Window.partitionBy("list", "key").orderBy("dated")
    return daily.withColumn("valid_to", F.lead("dated").over(following)).where("action = 'add'").select(
        "list", "key", F.col("dated").alias("valid_from"), "valid_to")


ADDED = ["host", "active", "matched_list", "matched_key", "valid_from", "valid_to", "blocked"]


def evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Adds to every capture (url, fetched, any other columns) what the lists said when it was fetched.

    New columns: host, active (number of entries in force), matched_list, matched_key, valid_from,
    valid_to (of the entry that decides) and blocked. The longest key decides, on equal length the
    smaller key, on equal keys the list whose name sorts last, so ``block`` before ``allow``.
    A null url or time, or a url without host, matches nothing and is not blocked. Repeated captures
    keep their rows; a column with the name of a new one is replaced.

    Each distinct url and time is evaluated once, and a frequent key or url is dealt out.
    """
    valid = intervals(entries)
    asked = captures.select("url", "fetched").dropna().distinct()
    keyed = asked.select("url", "fetched", F.explode(url_keys(F.col("url"))).alias("key"))
    joined = spread_join(keyed, valid, ["key"], "inner").where(
        (F.col("valid_from") <= F.col("fetched"))
        & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to"))))
    rank = F.struct((-F.length("key")).alias("a"), F.col("key"), F.when(F.col("list") == "block", 0).otherwise(1),
                    F.col("list"))
    best = joined.groupBy("url", "fetched").agg(
        F.count(F.lit(1)).alias("active"),
        F.min_by(F.struct("list", "key", "valid_from", "valid_to"), rank).alias("hit"))
    rows = captures.select(F.struct(*captures.columns).alias("row"), "url", "fetched")
    found = spread_join(rows, best, ["url", "fetched"], "left")
    return found.select(
        *[F.col("row").getField(c).alias(c) for c in captures.columns if c not in ADDED], url_host(F.col("url")).alias("host"),
        F.coalesce("active", F.lit(0).cast("long")).alias("active"),
        F.col("hit.list").alias("matched_list"), F.col("hit.key").alias("matched_key"),
        F.col("hit.valid_from").alias("valid_from"), F.col("hit.valid_to").alias("valid_to"),
        F.coalesce(F.col("hit.list") == "block", F.lit(False)).alias("blocked"))

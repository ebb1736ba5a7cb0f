"""Op 5: URL filters by a temporal join with dated lists.

A list is a log of dated entries (list_name, kind, key, action, at): from ``at`` on a
host, a domain or a path prefix is on the list ('add') or off it ('remove').
Entries become validity intervals [from, to): consecutive entries of one key
are ordered, an entry ends where the next one of its key begins. Every capture
(url, fetched) then meets the entries active when it was fetched, as of its
fetch time: by its host, every parent domain, and host plus path prefixes.

As-of join: intervals are cut at the borders of time buckets (``bucket_days``), so
captures and intervals meet in an equi-join on (key, bucket), where a key has
only the few intervals that touch the bucket; the exact time decides the rest.
Skew: captures are reduced to distinct (key, day) combinations first, and hot
hosts are split over their buckets and by adaptive execution.

Nulls and edges: a null or unparsable url, or a null fetch time, matches nothing
and is allowed; entries with a null key, action or date are ignored; of entries
of one key and date the last by action and reason holds ('remove' over 'add');
repeated captures come out as often as they went in; empty lists block nothing;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.reuse import materialize
from .text import lookup_table

BUCKET_DAYS = 30
#: Path prefixes that the query's SQL looks up per url (the registered lists have
#: one segment); the operator looks up as many as its deepest entry has.
PREFIX_SEGMENTS = 2


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and trailing dot; null if there is none."""
    found = F.regexp_extract(url, r"(?i)^\s*(?:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]+)", 1)
    host = F.regexp_replace(F.lower(found), r"\.+$", "")
    return F.when(host != "", host)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"(?i)^\s*(?:[a-z][a-z0-9+.\-]*:)?//[^/?#\s]+(/[^?#\s]*)", 1)


def lookup_keys(url: Column, least: int, most: int) -> Column:
    """All keys under which a url can be listed: its host, the domains above it,
    and its host followed by least to most leading path segments."""
    host = host_of(url)
    parts = F.split(host, r"\.")
    n = F.size(parts)
    domains = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
                          lambda i: F.concat(F.lit("d:"), F.array_join(F.slice(parts, i, n), ".")))
    segments = F.filter(F.split(path_of(url), "/"), lambda x: x != "")
    upto = F.least(F.size(segments), F.lit(most))
    prefixes = F.transform(F.filter(F.sequence(F.lit(0), upto), lambda i: i >= least), lambda i: F.concat(
        F.lit("p:"), host, F.when(i > 0, F.concat(F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i), "/"))).otherwise("")))
    return F.array_distinct(F.concat(F.array(F.concat(F.lit("h:"), host)), domains, prefixes))


def entry_key(kind: Column, key: Column) -> Column:
    """Key of an entry: kind is host, domain (it and all below) or prefix (a host,
    in any case, and whole path segments)."""
    letter = F.when(kind == "host", "h:").when(kind == "domain", "d:").when(kind == "prefix", "p:")
    host = F.lower(F.regexp_extract(key, "^[^/]*", 0))
    prefix = F.concat(host, F.regexp_replace(F.regexp_replace(F.regexp_extract(key, "/.*$", 0), "/+", "/"), "/$", ""))
    return F.concat(letter, F.when(kind == "prefix", prefix).otherwise(F.lower(key)))


def intervals(entries: DataFrame) -> DataFrame:
    """list_name, key, valid_from, valid_to (null: still valid) of all 'add' entries."""
    known = entries.select("list_name", entry_key(F.col("kind"), F.col("key")).alias("key"), "action", F.col("at").cast("timestamp").alias("at"))
    known = known.filter("list_name is not null and key is not null and at is not null and action in ('add', 'remove')")
    known = known.groupBy("list_name", "key", "at").agg(F.max("action").alias("action"))
    nxt = F.lead("at").over(Window.partitionBy("list_name", "key").orderBy("at"))
    return known.withColumn("valid_to", nxt).filter("action = 'add'").select("list_name", "key", F.col("at").alias("valid_from"), "valid_to")


def _bucket(at: Column, days: int) -> Column:
    return F.floor(F.unix_seconds(at) / (days * 86400)).cast("long")


def blocked_lists(captures: DataFrame, entries: DataFrame, bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """One row per capture: all given columns, blocked_by (sorted names of the
    lists that held it when it was fetched) and allowed."""
    out = ("blocked_by", "allowed")
    mine = [c for c in captures.columns if c not in out]
    rows = materialize(captures.select(F.struct(*mine).alias("row"), F.col("url").alias("u"),
                                       F.col("fetched").cast("timestamp").alias("f"), F.monotonically_increasing_id().alias("n")))
    valid = materialize(intervals(entries))
    last = rows.agg(F.max("f")).first()[0]
    if last is None:
        return rows.select("row.*", F.array().cast("array<string>").alias("blocked_by"), F.lit(True).alias("allowed"))
    end = F.least(F.coalesce("valid_to", F.lit(last)), F.lit(last))
    pieces = valid.filter(F.col("valid_from") <= F.lit(last)).withColumn(
        "bucket", F.explode(F.sequence(_bucket(F.col("valid_from"), bucket_days), F.greatest(_bucket(end, bucket_days), _bucket(F.col("valid_from"), bucket_days)))))
    # Only as many leading path segments are looked up as the prefixes have.
    depth = F.size(F.split("key", "/")) - 1
    least, most = valid.filter(F.col("key").startswith("p:")).agg(F.min(depth), F.max(depth)).first()
    least, most = (1, 0) if most is None else (least, most)
    # What is asked: each key and moment once, however many captures share them.
    asked = rows.filter("u is not null and f is not null").select("n", "f", F.explode(lookup_keys(F.col("u"), least, most)).alias("key"))
    asked = materialize(asked.filter("key is not null"))
    moments = asked.select("key", "f").distinct().withColumn("bucket", _bucket(F.col("f"), bucket_days))
    active = moments.join(pieces, ["key", "bucket"]).filter("f >= valid_from and (valid_to is null or f < valid_to)")
    active = lookup_table(active.select("key", "f", "list_name").distinct())
    hits = asked.join(active, ["key", "f"]).groupBy("n").agg(F.sort_array(F.collect_set("list_name")).alias("blocked_by"))
    none = F.array().cast("array<string>")
    return rows.join(hits, "n", "left").select("row.*", F.coalesce("blocked_by", none).alias("blocked_by"), F.col("blocked_by").isNull().alias("allowed"))

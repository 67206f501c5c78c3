"""URL filters by temporal list join: entries active at fetch time.

A list is a log of dated changes: (pattern, active, at). Changes of a pattern become disjoint validity intervals
[from, to); a capture is looked up by its host, each parent domain of at least two labels and host/path for each leading
run of path segments, and an as-of join keeps the interval that holds its fetch time. DataFrame operations only.

Defined results: hosts, of patterns and of captures, are compared in lower case without a trailing dot, paths as they
are but without slashes at their end; changes with null pattern, null active or null date are ignored; of changes of a pattern at the same time an active
one wins, repeated ones count once; captures with null or malformed URL or null fetch time are not listed; a capture is
blocked if any interval holds it, and carries the longest pattern (ties: the smaller); repeated rows get equal results;
URLs of any length are looked up whole, by as many keys as the host has labels and the path segments; an empty list blocks nothing, empty
captures give an empty result; extra columns of captures stay, whatever their names, but for ``blocked`` and ``pattern``,
which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_names, other_columns


def host_of(url: Column) -> Column:
    """Host in lower case, without user, port and trailing dot; empty if there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+?)\.?(?::[0-9]*)?(?:[/?#]|$)", 1))


def path_of(url: Column) -> Column:
    """What stands between the host's slash and a query or fragment; empty if there is nothing."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)", 1)


def normal(pattern: Column) -> Column:
    """A pattern with its host, up to the first slash, in lower case and without a trailing dot, and no slashes at its end."""
    host = F.regexp_replace(F.lower(F.substring_index(pattern, "/", 1)), r"\.$", "")
    return F.concat(host, F.rtrim(F.regexp_extract(pattern, r"(?s)^[^/]*(/.*)?$", 1), F.lit("/")))


def intervals(changes: DataFrame) -> DataFrame:
    """(pattern, active, at) -> (pattern, valid_from, valid_to) of the active times; valid_to is null while it lasts."""
    clean = (
        changes.where("pattern is not null and active is not null and at is not null")
        .groupBy(normal(F.col("pattern")).alias("pattern"), "at")
        .agg(F.max("active").alias("active"))
    )
    after = F.lead("at").over(Window.partitionBy("pattern").orderBy("at"))
    return clean.withColumn("valid_to", after).where("active").select("pattern", F.col("at").alias("valid_from"), "valid_to")


def patterns_of(url: Column) -> Column:
    """All patterns that a URL can match."""
    host, segments = host_of(url), F.split(path_of(url), "/", -1)
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(labels) - 1)),
        lambda i: F.array_join(F.slice(F.split(host, r"\."), i, F.size(F.split(host, r"\."))), "."),
    )
    ends = F.filter(F.sequence(F.lit(1), F.size(segments)), lambda i: F.element_at(segments, i) != "")
    paths = F.transform(ends, lambda i: F.concat_ws("/", host, F.array_join(F.slice(segments, F.lit(1), i), "/")))
    return F.when(host != "", F.concat(domains, paths)).otherwise(F.array().cast("array<string>"))


def filter_captures(captures: DataFrame, changes: DataFrame, url: str = "url", at: str = "fetched") -> DataFrame:
    """``captures`` with blocked boolean and pattern string (the longest that was active, or null)."""
    names = free_names([*captures.columns, "pattern", "valid_from", "valid_to"], "looked", "moment", "listed")
    looked_url, moment, listed = names
    looked = captures.select(F.col(url).alias(looked_url), F.col(at).alias(moment)).where(f"{looked_url} is not null and {moment} is not null").distinct()
    hits = (
        looked.withColumn("pattern", F.explode(patterns_of(F.col(looked_url))))
        .join(intervals(changes), "pattern")
        .where(f"valid_from <= {moment} and (valid_to is null or {moment} < valid_to)")
        .groupBy(looked_url, moment)
        .agg(F.min(F.struct((-F.length("pattern")).alias("n"), "pattern"))["pattern"].alias(listed))
    )
    joined = captures.join(hits, (captures[url] == hits[looked_url]) & (captures[at] == hits[moment]), "left")
    kept = [captures[c] for c in other_columns(captures.columns, "blocked", "pattern")]
    return joined.select(*kept, F.col(listed).isNotNull().alias("blocked"), F.col(listed).alias("pattern"))

"""URL allow and block rules by a sort-merge range join, in DataFrame functions only.

A host turned round (``net.example.blog.``) puts a domain before all its subdomains, so a rule covers the interval of keys
that start with its own.  Rule intervals nest: where one begins, the rules in force are those of the domain and of the
domains above it; where it ends, those above remain.  URLs and these events are sorted together by key and swept: each URL
takes the stack of the last event at or before it, and the longest of its rules whose path begins the URL's path wins.
URLs are dealt to many sweeps by hash, each with all events, so a host with any share of the rows is spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# The rules of the contract, (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
DEFAULT = "allow"  # where no rule fits
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty where it is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Labels turned round, each closed by a dot: every key of a subdomain starts with its domain's."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def events(rules: DataFrame) -> DataFrame:
    """``(key, stack)``: from ``key`` on, the rules in force.  A domain's interval begins at its key and ends before the
    key with ``/`` in place of the closing dot (the next character), which no host key of the domain reaches."""
    keyed = rules.select(host_key(F.col("host")).alias("key"),
                         F.struct(F.length(F.concat("host", "path")).alias("size"), F.col("verdict"),
                                  F.concat("host", "path").alias("rule"), "path").alias("r"))
    domains = keyed.groupBy("key").agg(F.collect_list("r").alias("own"))
    # the domains above: every prefix of labels
    above = domains.select("key", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(F.split("key", r"\.")) - 1),
        lambda n: F.concat(F.array_join(F.slice(F.split("key", r"\."), F.lit(1), n), "."), F.lit(".")))).alias("over"))
    nested = above.join(domains.select(F.col("key").alias("over"), "own"), "over").groupBy("key").agg(
        F.flatten(F.collect_list("own")).alias("begin"),
        F.flatten(F.collect_list(F.when(F.col("over") != F.col("key"), F.col("own")))).alias("end"))
    return nested.select(F.explode(F.array(
        F.struct("key", F.col("begin").alias("stack")),
        F.struct(F.concat(F.expr("substring(key, 1, length(key) - 1)"), F.lit("/")).alias("key"), F.col("end").alias("stack"))
    )).alias("e")).select("e.*")


def judge(pages: DataFrame, rules: DataFrame, sweeps: int, default: str = DEFAULT) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` per row of ``pages (page_id, url)``.

    ``rules (verdict, host, path)``: a rule fits its host and all subdomains where the URL's path starts with the rule's;
    the longest rule (host and path) wins, a block before an allow of the same length, then the greater text.  A null URL, or one
    without ``://``, has an empty host and path, which no rule fits; a null ``page_id`` and repeated rows stay.  Other
    columns are ignored; empty tables give an empty result, empty rules the default for all."""
    host, path = url_parts(F.col("url"))
    urls = pages.select(F.col("page_id").cast("long"), "url").select("page_id", host.alias("host"), path.alias("path"))
    urls = urls.select(F.pmod(F.xxhash64("page_id", "host", "path"), F.lit(sweeps)).alias("sweep"),
                       host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), "page_id", "host", "path")
    begun = events(rules).select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(sweeps - 1).cast("long"))).alias("sweep"),
                                 "key", F.lit(0).alias("kind"), "stack")
    swept = begun.unionByName(urls, allowMissingColumns=True).withColumn(
        "stack", F.last("stack", ignorenulls=True).over(Window.partitionBy("sweep").orderBy("key", "kind")))
    fitting = F.filter("stack", lambda r: F.startswith(F.col("path"), r["path"]))
    longest = F.array_max(F.transform(fitting, lambda r: F.struct(r["size"], r["verdict"], r["rule"])))
    ranked = swept.where("kind = 1").withColumn("r", longest)
    return ranked.select("page_id", "host", "path", F.col("r.rule").alias("rule"),
                         F.coalesce("r.verdict", F.lit(default)).alias("verdict"))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Rules as a table of SQL literals."""
    if not rules:
        return spark.sql("SELECT '' AS verdict, '' AS host, '' AS path WHERE false")
    quoted = [", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in r) for r in rules]
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"({q})" for q in quoted) + " AS t(verdict, host, path)")

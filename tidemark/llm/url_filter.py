"""URL filters: host-suffix and path-prefix expressions looked up by hash prefix.

A URL is expanded into the expressions that a rule could be stored under: every suffix of its host at a label boundary
with every prefix of its path that ends in "/" (and the whole path). Expressions meet the rules in an equi-join on the
first 4 bytes of their SHA-256; the full digests then confirm a match, and the longest rule wins.

Only DataFrame functions are used. Which (labels, path depth) shapes the rules have is read first, so that a URL is only
expanded into shapes that some rule has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """From behind the first :// up to /, ?, # or the end, A-Z lower-cased; empty without :// or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From behind the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _shapes(rules: DataFrame) -> list[tuple[int, int]]:
    labels = F.size(F.split("host", r"\."))
    depth = F.when(F.col("path").endswith("/"), F.length("path") - F.length(F.regexp_replace("path", "/", ""))).otherwise(0)
    return sorted((r.labels, r.depth) for r in rules.select(labels.alias("labels"), depth.alias("depth")).distinct().toLocalIterator())


def expressions(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The array of expressions; depth 0 stands for the whole path (a rule that doesn't end in "/")."""
    slashes = F.length(path) - F.length(F.regexp_replace(path, "/", ""))
    out = []
    for labels, depth in shapes:
        suffix = F.substring_index(host, ".", -labels)
        enough = F.size(F.split(host, r"\.")) >= labels
        if depth:
            prefix = F.concat(F.substring_index(path, "/", depth), F.lit("/"))
            out.append(F.when(enough & (slashes >= depth), F.concat(suffix, prefix)))
        else:
            out.append(F.when(enough & ~path.endswith("/"), F.concat(suffix, path)))
    return F.array_compact(F.array(*out)) if out else F.array().cast("array<string>")


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, url, host, path, rule (null without one), verdict for each row of pages.

    rules: host, path, action. A rule fits its host and all subdomains where the path starts with the rule's; rule
    paths end in "/" or name a whole path. The longest rule wins; of equal ones block does. Null URLs and URLs without
    "://" have an empty host and path and get the default verdict. Repeated rows each get a row; an empty rule table
    gives the default everywhere; other columns are ignored.
    """
    pages = pages.select("page_id", F.col("url").cast("string").alias("url")).select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rules = rules.select(F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "action").distinct()
    keyed = rules.select(F.concat("host", "path").alias("rule"), "action").withColumn("digest", F.sha2("rule", 256)).select("rule", "action", "digest", F.substring("digest", 1, 8).alias("prefix"))
    # hosts and paths repeat much less often than rows: each pair is looked up once
    own = pages.select("host", "path").distinct()
    asked = own.select("host", "path", F.explode(expressions(F.col("host"), F.col("path"), _shapes(rules))).alias("expression")).withColumn("full", F.sha2("expression", 256))
    met = asked.withColumn("prefix", F.substring("full", 1, 8)).join(keyed, "prefix").where("full = digest")
    best = met.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("length"), F.col("action").alias("action"), F.col("rule").alias("rule"))).alias("best")).select("host", "path", "best.rule", "best.action")
    return pages.join(best, ["host", "path"], "left").select("page_id", "url", "host", "path", "rule", F.coalesce("action", F.lit(default)).alias("verdict"))



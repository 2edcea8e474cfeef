"""URL filters: host-suffix and path-prefix expressions meet rules by short hash prefixes; full digests and precedence decide.

A rule has a host, a path and a verdict, block or allow. It fits a URL whose host is the rule's or a subdomain of it and whose path starts
with the rule's path. A rule is filed under its host and the folders of its path, up to the last slash; a URL asks for every suffix of
its host at a dot with every folder of its path, as deep as any rule goes. Both are hashed, the first 32 bits meet in an equi-join, and
the whole SHA-256 and the rest of the rule's path confirm what met. Among fitting rules the longest wins (host and path together), then
the one with the longer host, then a block. Rules are joined by size: adaptive execution broadcasts small lists and splits hot hosts of
large ones. A URL's own rows are combined before they are shuffled, so one row a URL travels.

Defined results. A URL that is null or has no "://" has an empty host and path, which no rule fits. A rule with a null verdict counts as
allow, null hosts and paths of rules as empty; an empty host fits only hosts that are empty or end with a dot. Rules that repeat count
once, as a block if any is. Without rules, or where none fits, the verdict is the default. Rows with null or equal ids stay rows of their
own; other columns of the input are dropped, whatever their names. URLs of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def url_host(url: Column) -> Column:
    """What stands between the first "://" and the next "/", "?", "#" or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1), UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    """What follows the host up to "?", "#" or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def _marks(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def _folders(path: Column) -> Column:
    """A path up to its last slash."""
    return F.regexp_extract(path, r"^(?s:.*)/", 0)


def _digest(host: Column, folders: Column) -> Column:
    """A host has no slash, so the two parts can't be told apart wrongly."""
    return F.sha2(F.concat(F.regexp_replace(host, "/", ""), F.lit("/"), folders).cast("binary"), 256)


def _short(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def filed_rules(rules: DataFrame) -> DataFrame:
    """(short, digest, rule_host, rule_path, block) of rules(host, path, verdict)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    plain = rules.select(F.translate(text("host"), UPPER, UPPER.lower()).alias("rule_host"), text("path").alias("rule_path"), (text("verdict") == "block").alias("block"))
    once = plain.where(~F.contains("rule_host", F.lit("/"))).groupBy("rule_host", "rule_path").agg(F.max("block").alias("block"))
    digest = _digest(F.col("rule_host"), _folders(F.col("rule_path")))
    return once.select(_short(digest).alias("short"), digest.alias("digest"), "rule_host", "rule_path", "block")


def expressions(urls: DataFrame, labels: int, folders: int) -> DataFrame:
    """urls(host, path, ...) with a row for each suffix of up to so many labels of the host and each of up to so many folders of the path."""
    upto = lambda low, count, most: F.explode(F.sequence(F.lit(low), F.least(count, F.lit(most))))
    each = urls.withColumn("n_labels", upto(1, _marks(F.col("host"), ".") + 1, labels)).withColumn("n_folders", upto(0, _marks(F.col("path"), "/"), folders))
    suffix = F.call_function("substring_index", "host", F.lit("."), -F.col("n_labels"))
    first = F.when(F.col("n_folders") > 0, F.concat(F.call_function("substring_index", "path", F.lit("/"), F.col("n_folders")), F.lit("/"))).otherwise(F.lit(""))
    return each.select("*", _digest(suffix, first).alias("digest")).drop("n_labels", "n_folders")


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", *, default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict) for every row of pages; rule is the winner's host and path, null where none fits."""
    filed = filed_rules(rules)
    deep = filed.agg(F.max(_marks(F.col("rule_host"), ".") + 1), F.max(_marks(F.col("rule_path"), "/"))).first()  # two numbers
    url = F.col(url_col).cast("string")
    urls = pages.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), url_host(url).alias("host"), url_path(url).alias("path"))
    asked = expressions(urls, deep[0] or 1, deep[1] or 0).withColumnRenamed("digest", "own").withColumn("own_short", _short(F.col("own")))
    confirmed = (F.col("own_short") == F.col("short")) & (F.col("own") == F.col("digest")) & F.startswith("path", "rule_path")
    met = asked.join(filed, confirmed, "left")
    # Precedence as one number: total length, then host length, then block. With the URL it also names the rule.
    hosts, paths = F.length("rule_host").cast("long"), F.length("rule_path").cast("long")
    rank = F.shiftleft(hosts + paths, 32).bitwiseOR(F.shiftleft(hosts, 1)).bitwiseOR(F.col("block").cast("long"))
    best = met.groupBy("row", "id", "host", "path").agg(F.max(rank).alias("rank"))
    host_length = F.shiftright("rank", 1).bitwiseAND(F.lit((1 << 31) - 1)).cast("int")
    path_length = (F.shiftright("rank", 32) - host_length).cast("int")
    rule = F.when(F.col("rank").isNotNull(), F.concat(F.right("host", host_length), F.left("path", path_length)))
    verdict = F.when(F.col("rank").isNull(), F.lit(default)).when(F.col("rank").bitwiseAND(F.lit(1)) == 1, "block").otherwise("allow")
    return best.select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"), verdict.alias("verdict"))

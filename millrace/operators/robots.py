"""Robots files of many hosts: groups, rules and delays of each, and which URLs they allow.

Files are lines(host, pos, line); one file is a small, bounded text, so only its own lines are put in order. URLs meet the rules of their host by
an equi-join: a rule is filed under the literal start of its pattern, up to the first * or $, and a URL asks for its target's starts of
the lengths that occur among its host's rules. Only what meets is matched, by a regex where the pattern has more than its start.

Defined results. Lines before the first user agent, comments, lines without a colon and rules without a pattern go. A user-agent line after
a rule or delay starts a group. A delay that is no number leaves the one before. Of a host's groups those whose agents stand in the token
count, else those for *; the longest of their delays counts. The longest matching pattern decides, allow on a tie; without one, and for
/robots.txt, a URL is allowed. URLs without a host, null ones too, are allowed. URLs that repeat are rows of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def robots_rules(lines: DataFrame) -> DataFrame:
    """(host, group_no, agents, allow, pattern, crawl_delay) of robots lines(host, pos, line); a group without rules has one row of nulls."""
    text = F.trim(F.substring_index("line", "#", 1))
    parsed = lines.select("host", "pos", F.lower(F.trim(F.substring_index(text, ":", 1))).alias("key"), F.trim(F.regexp_replace(text, "^[^:]*:", "")).alias("value"), text.alias("_text")).where("instr(_text, ':') > 0")
    parsed = parsed.where("key in ('user-agent', 'allow', 'disallow', 'crawl-delay')")
    w = Window.partitionBy("host").orderBy("pos")
    starts = (F.col("key") == "user-agent") & (F.coalesce(F.lag("key").over(w), F.lit("rule")) != "user-agent")
    grouped = parsed.withColumn("_start", starts.cast("int")).withColumn("group_no", F.sum("_start").over(w)).where("group_no > 0")
    number = F.col("value").try_cast("double")
    groups = grouped.groupBy("host", "group_no").agg(
        F.array_sort(F.collect_set(F.when(F.col("key") == "user-agent", F.lower("value")))).alias("agents"),
        F.max_by(number, F.when((F.col("key") == "crawl-delay") & number.isNotNull(), F.col("pos"))).alias("crawl_delay"),
    )
    rules = grouped.where("key in ('allow', 'disallow') and value <> ''").select("host", "group_no", (F.col("key") == "allow").alias("allow"), F.col("value").alias("pattern"))
    return groups.join(rules, ["host", "group_no"], "left").select("host", "group_no", "agents", "allow", "pattern", "crawl_delay")


def rules_for(rules: DataFrame, token: str) -> DataFrame:
    """The rules of each host's groups whose agents stand in the token, else of its groups for *."""
    mine = rules.withColumn("_own", F.exists("agents", lambda a: (a != "*") & F.contains(F.lit(token), a)))
    picked = mine.withColumn("_any", F.max("_own").over(Window.partitionBy("host")))
    return picked.where(F.col("_own") | (~F.col("_any") & F.array_contains("agents", "*"))).drop("_own", "_any")


def crawl_delays(rules: DataFrame) -> DataFrame:
    """(host, crawl_delay): the longest delay of rules_for() by host; hosts without one have no row."""
    return rules.groupBy("host").agg(F.max("crawl_delay").alias("crawl_delay")).where("crawl_delay is not null")


def pattern_regex(pattern: Column) -> Column:
    """A robots pattern as an anchored regex: * matches anything, a final $ the end."""
    body = F.regexp_replace(pattern, r"\$$", "")
    quoted = F.regexp_replace(body, r"([.^$+?()\[\]{}|\\])", r"\\$1")
    return F.concat(F.lit("(?s)^"), F.replace(quoted, F.lit("*"), F.lit(".*")), F.when(pattern.endswith("$"), F.lit("$")).otherwise(F.lit("")))


def url_policy(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """urls(url, …) with allowed, by the rules_for() of their hosts."""
    path = F.nullif(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), F.lit(""))
    held = urls.withColumns({"_host": F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), "_target": F.concat(F.coalesce(path, F.lit("/")), F.regexp_extract("url", r"^[^?#]*(\?[^#]+)", 1))})
    filed = rules.where("pattern is not null").select(F.col("host").alias("_host"), "allow", "pattern", F.regexp_extract("pattern", r"^[^*$]*", 0).alias("_start")).distinct()
    lengths = filed.groupBy("_host").agg(F.collect_set(F.length("_start")).alias("_lengths"))  # as many as a robots file has
    asked = held.select("_host", "_target").distinct().join(lengths, "_host").select("_host", "_target", F.explode("_lengths").alias("_n"))
    asked = asked.where("_n <= length(_target)").select("_host", "_target", F.left("_target", F.col("_n")).alias("_start"))
    more = F.col("pattern") != F.col("_start")
    hit = asked.join(filed, ["_host", "_start"]).where(~more | F.rlike(F.col("_target"), pattern_regex(F.col("pattern"))))
    best = hit.groupBy("_host", "_target").agg(F.max(F.length("pattern") * 2 + F.col("allow").cast("int")).alias("_best"))
    allowed = (F.col("_target") == "/robots.txt") | F.coalesce(F.col("_best") % 2 == 1, F.lit(True))
    return held.join(best, ["_host", "_target"], "left").withColumn("allowed", F.coalesce(allowed, F.lit(True))).select(*urls.columns, "allowed")

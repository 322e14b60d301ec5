"""URL filters: host and path rules, then pattern rules indexed by their rarest literal token (operator 4).

DataFrame functions only. Every distinct url is judged once.

*Host and path rules* ``(host, path, verdict)`` fit a host and its subdomains when the url's path
starts with the rule's; the longest rule wins. A url looks its host's suffixes up by an equi-join.

*Pattern rules* block what no host rule decided. A pattern is text in which ``*`` stands for any
characters, ``^`` for a separator (neither a letter, digit, nor one of ``_ . % -``) or the end, and
``|`` at its ends for the url's. A letter-or-digit run that other literal characters enclose is a
*token*: every url that the pattern fits holds it as a whole run. Each pattern is filed under its
token with the fewest urls (counted over the table), a url's tokens fetch its candidate patterns by
an equi-join, and only those run as regular expressions. Patterns without a token run on every url.

Cases: a url that is null or has no ``://`` has empty host and path and is allowed unless a pattern
fits; pages keep their row each, repeated or without an id; equal rules: the lesser verdict string;
extra columns are ignored; an empty table or no rules give an empty result or plain allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Host, path, verdict.
HOST_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
# Patterns of pages that are not worth keeping.
PATTERN_RULES = [
    "?page=*&ref=^",
    "/login^",
    "/cart^",
    "/wp-admin/",
    "/tag/*/feed|",
    "&sessionid=",
    ".cheap-pills.",
    ".zip|",
    ".exe|",
    "#comment",
    "/search?q=",
    "print=1",
]


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    start = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise(F.lit(""))
    host = F.substring_index(F.translate(rest, "?#", "//"), "/", 1)
    path = F.substring_index(F.substring_index(F.substr(rest, F.length(host) + 1), "?", 1), "#", 1)
    return lower_ascii(host), path


def host_verdicts(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, verdict) of urls that a host rule fits; urls has ``url, host, path``."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    asked = urls.where("host <> ''").select("url", "path", F.explode(suffixes).alias("rule_host"))
    fits = asked.join(rules, "rule_host").where(F.col("path").startswith(F.col("rule_path")))
    rule = F.concat("rule_host", "rule_path")
    best = fits.groupBy("url").agg(F.min(F.struct((-F.length(rule)).alias("size"), rule.alias("rule"), "rule_verdict")).alias("m"))
    return best.select("url", F.col("m.rule").alias("rule"), F.col("m.rule_verdict").alias("rule_verdict"))


def compiled(patterns: DataFrame) -> DataFrame:
    """(pattern, regex, tokens) of a table of patterns."""
    text = lower_ascii(F.col("pattern"))
    body = F.regexp_replace(F.regexp_replace(text, r"^\||\|$", ""), r"[.+?(){}\[\]\\$|]", r"\\$0")
    body = F.regexp_replace(F.regexp_replace(body, r"\^", r"(?:[^a-z0-9_.%-]|\$)"), r"\*", ".*")
    regex = F.concat(F.when(text.startswith("|"), "^").otherwise(""), body, F.when(text.endswith("|"), "$").otherwise(""))
    tokens = F.regexp_extract_all(text, F.lit(r"(?<=[^a-z0-9*])([a-z0-9]+)(?=[^a-z0-9*])"))
    return patterns.where("pattern is not null and pattern <> ''").select("pattern", F.concat(F.lit("(?s)"), regex).alias("regex"), F.array_distinct(tokens).alias("tokens")).distinct()


def url_tokens(urls: DataFrame) -> DataFrame:
    text = lower_ascii(F.col("url"))
    return urls.select("url", F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit("[a-z0-9]+"), F.lit(0)))).alias("token"))


def filed(patterns: DataFrame, tokens: DataFrame) -> DataFrame:
    """(token, pattern, regex): each pattern under its rarest token; null for patterns without one."""
    each = patterns.select("pattern", "regex", F.explode_outer("tokens").alias("token"))
    wanted = tokens.join(each.select("token").where("token is not null").distinct(), "token", "left_semi")
    often = wanted.groupBy("token").agg(F.count("*").alias("urls"))
    ranked = each.join(often, "token", "left").groupBy("pattern", "regex").agg(F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), "token")).alias("m"))
    return ranked.select(F.col("m.token").alias("token"), "pattern", "regex")


def pattern_matches(urls: DataFrame, patterns: DataFrame) -> DataFrame:
    """(url, pattern): the least pattern that fits, of the urls that one fits."""
    tokens = url_tokens(urls)
    index = filed(compiled(patterns), tokens)
    fits = F.expr("rlike(translate(url, '%s', '%s'), regex)" % (UPPER, LOWER))
    found = tokens.join(index, "token").where(fits).select("url", "pattern")
    loose = index.where("token is null").agg(F.collect_list(F.struct("regex", "pattern")))  # rules of the given list, never urls
    anyway = urls.where("url is not null").select("url", F.explode(loose.scalar()).alias("r")).select("url", "r.regex", "r.pattern").where(fits).select("url", "pattern")
    return found.unionByName(anyway).groupBy("url").agg(F.min("pattern").alias("pattern"))


def url_filter(pages: DataFrame, host_rules: DataFrame, patterns: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per page ``page_id, host, path, rule, pattern, verdict``.

    ``host_rules`` has ``host, path, verdict``; ``patterns`` has ``pattern``.
    """
    pages = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    host, path = host_and_path(F.col("url"))
    urls = pages.select("url").distinct().select("url", host.alias("host"), path.alias("path"))
    rules = host_rules.select(lower_ascii(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"))
    decided = urls.where("url is not null").join(host_verdicts(urls, rules), "url", "left").join(pattern_matches(urls, patterns), "url", "left")
    verdict = F.coalesce("rule_verdict", F.when(F.col("pattern").isNotNull(), "block"), F.lit("allow"))
    out = pages.join(decided.select("url", "host", "path", "rule", F.when(F.col("rule_verdict").isNull(), F.col("pattern")).alias("pattern"), verdict.alias("verdict")), "url", "left")
    return out.select("page_id", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "rule", "pattern", F.coalesce("verdict", F.lit("allow")).alias("verdict"))


def default_rules(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    quote = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    hosts = ", ".join(f"({', '.join(map(quote, r))})" for r in HOST_RULES)
    patterns = ", ".join(f"({quote(p)})" for p in PATTERN_RULES)
    return spark.sql(f"select * from values {hosts} as t(host, path, verdict)"), spark.sql(f"select * from values {patterns} as t(pattern)")

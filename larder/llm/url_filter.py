"""URL filter: pattern rules indexed by their rarest literal token.

A rule is (rule, verdict, host, path, pattern, token): a host rule fits its host and all
subdomains if the URL's path starts with the rule's path; a pattern rule is a regular expression
over the whole URL with the literal tokens it needs. Tokens are runs of [a-z0-9] in the
lower-cased URL. How often each token occurs in the table is counted, every rule is filed under
the rarest of its own tokens, each URL fetches the rules filed under its tokens, and only those
are tried. The longest fitting host rule decides; without one, a fitting blocking pattern does;
else the URL is allowed.

DataFrame operations only. The token counts are a partial aggregation kept to the rules' tokens;
the join with the filed rules moves (row key, token) rows only if the rules are too large
for Spark's own broadcast limit.

Null URLs and those without ``://`` have an empty host and path and are allowed unless a
pattern fits. Repeated rows give repeated results. A null id is carried along. Of two rules of
equal length that fit, the one first in alphabetical order decides.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import LOWER, UPPER, ascii_lower


#: What a token is, in rules and in addresses.
TOKEN = re.compile("[a-z0-9]+")
_FOLD = str.maketrans(UPPER, LOWER)


@dataclass(frozen=True)
class Rule:
    rule: str
    verdict: str
    host: str | None = None
    path: str | None = None
    pattern: str | None = None
    tokens: tuple[str, ...] = ()


def host_rule(text: str, verdict: str) -> Rule:
    """'example.net/en/' as a rule on a host and a path prefix. A host that fits holds the rule's host behind a
    dot or as a whole, so it holds each of its tokens, cut as in addresses, as a whole token."""
    host, slash, path = text.partition("/")
    return Rule(text, verdict, host.translate(_FOLD), slash + path, None, tuple(dict.fromkeys(TOKEN.findall(host.translate(_FOLD)))))


def pattern_rule(pattern: str, *tokens: str) -> Rule:
    """A blocking regular expression and literal tokens that every match of it holds as whole tokens."""
    return Rule(f"~{pattern}", "block", None, None, pattern, tokens)


#: The host rules of the contract.
HOST_RULES = (host_rule("net/", "block"), host_rule("example.net/en/", "allow"),
              host_rule("example.com/de/", "block"), host_rule("org/fr/", "allow"))
#: The method's own rules: tracking, session, login and calendar-trap addresses.
PATTERN_RULES = (
    pattern_rule(r"[?&]sessionid=[0-9a-z]+", "sessionid"), pattern_rule(r"[?&]phpsessid=", "phpsessid"),
    pattern_rule(r"//ads\.", "ads"), pattern_rule(r"/wp-login\.php(\?|$)", "wp", "login", "php"),
    pattern_rule(r"/cart/checkout(/|$)", "cart", "checkout"), pattern_rule(r"/calendar/\d{4}/\d{2}", "calendar"),
    pattern_rule(r"[?&]replytocom=\d+", "replytocom"), pattern_rule(r"/login(\.html?|/|\?|$)", "login"))

_SCHEMA = "rule string, verdict string, host string, path string, pattern string, token string"


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def url_tokens(url: Column) -> Column:
    parts = F.split(ascii_lower(F.coalesce(url, F.lit(""))), "[^a-z0-9]+", -1)
    return F.array_distinct(F.filter(parts, lambda t: t != ""))


def filed_rules(spark: SparkSession, urls: DataFrame, rules: tuple[Rule, ...], url_col: str) -> DataFrame:
    """The rules with the rarest of their tokens in ``urls``; of equally rare ones the first by name."""
    rows = [(r.rule, r.verdict, r.host, r.path, r.pattern, t) for r in rules for t in r.tokens]
    if {r.rule for r in rules} != {r[0] for r in rows}:
        raise ValueError("every rule needs a literal token")
    if lost := sorted({r[0] for r in rows if not TOKEN.fullmatch(r[5])}):
        raise ValueError(f"rules filed under a token that no address can hold: {lost}")
    table = spark.createDataFrame(rows, _SCHEMA)
    wanted = table.select("token").distinct()
    tokens = urls.select(F.explode(url_tokens(F.col(url_col))).alias("token"))
    counts = tokens.join(wanted, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    ranked = table.join(counts, "token", "left").groupBy(
        "rule", "verdict", "host", "path", "pattern").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("token"))).alias("rarest"))
    return ranked.select("rule", "verdict", "host", "path", "pattern", F.col("rarest.token").alias("token"))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
               rules: tuple[Rule, ...] = HOST_RULES + PATTERN_RULES) -> DataFrame:
    """(id, host, path, rule, verdict, pattern) per row of ``pages``."""
    # A distinct address is judged once; rows with the same address share its verdict.
    urls = pages.select(F.col(url_col).alias("url")).distinct()
    filed = filed_rules(pages.sparkSession, pages, rules, url_col).alias("r")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    tokens = urls.filter(F.col("url").isNotNull()).select(
        "url", host.alias("url_host"), path.alias("url_path"), F.explode(url_tokens(F.col("url"))).alias("token"))
    tried = tokens.join(filed, "token")
    fits_host = ((F.col("url_host") == F.col("host")) | F.endswith("url_host", F.concat(F.lit("."), F.col("host")))) \
        & F.startswith("url_path", F.col("path"))
    fits = F.when(F.col("pattern").isNull(), fits_host).otherwise(F.rlike(ascii_lower(F.col("url")), F.col("pattern")))
    is_host = F.col("pattern").isNull()
    best = tried.filter(fits).groupBy("url").agg(
        F.min(F.when(is_host, F.struct((-F.length("rule")).alias("k"), "rule", "verdict"))).alias("by_host"),
        F.min(F.when(~is_host, F.col("rule"))).alias("by_pattern"))
    u = F.col(url_col)
    joined = pages.select(F.col(id_col), u).join(best.withColumnRenamed("url", "_url"), u == F.col("_url"), "left")
    return joined.select(
        F.col(id_col), host_of(u).alias("host"), path_of(u).alias("path"), F.col("by_host.rule").alias("rule"),
        F.coalesce("by_host.verdict", F.when(F.col("by_pattern").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        F.col("by_pattern").alias("pattern"))

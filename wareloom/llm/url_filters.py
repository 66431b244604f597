"""URL allow / block rules by hashed host-suffix and path-prefix expressions.

Native DataFrame functions only.  A rule (host, path, verdict) fits a URL
when the URL's host is the rule's host or a subdomain of it and the URL's
path starts with the rule's path.  The rule with the longest ``host || path``
wins; equal lengths go to the longer host, then to the smaller rule string,
then to ``block`` before ``allow``.

How: a rule is filed under its *anchor*, its host and its path up to the last
``/``.  Every (host suffix, path prefix ending in ``/``) of a URL is an
expression; expressions and anchors meet in an equi-join on the first 32 bits
of their SHA-256, then the full digest and the whole rule path are confirmed.
Distinct (host, path) pairs are judged once, so copies of a URL collapse
map-side before anything is expanded; the verdicts join back by (host, path),
as one struct, so that the join's sides come from shuffles and AQE splits a hot URL.
Expressions with more labels, more slashes or more characters than any rule
has are not made: they cannot equal an anchor.

Defined cases: a null URL, or one without ``://``, has empty host and path; an
empty path starts with no rule path but the empty one; rules with a null host,
path or verdict never apply; repeated rows are judged alike; an empty rule
table gives every URL the default verdict; columns ``host``, ``path``,
``rule`` and ``verdict`` of the input are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareloom.llm.text_hash import spare

#: host, path, verdict: fixed values of the pages query
PAGE_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: F.Column) -> tuple[F.Column, F.Column]:
    """(host, path) of a URL: host lower-cased in A-Z, path up to ``?`` or ``#``."""
    has = F.coalesce(url.contains("://"), F.lit(False))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    empty = F.lit("")
    return F.when(has, F.translate(host, UPPER, LOWER)).otherwise(empty), F.when(has, path).otherwise(empty)


def _anchor_path(path: F.Column) -> F.Column:
    return F.regexp_extract(path, r"(?s)^(.*/)?", 0)


def _keyed(df: DataFrame, expression: F.Column) -> DataFrame:
    """Adds the full digest and its short prefix."""
    df = df.withColumn("_digest", F.sha2(expression.cast("binary"), 256))
    return df.withColumn("_short", F.substring("_digest", 1, 8))


def judge_urls(urls: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``urls`` with host, path, rule (its string, else null) and verdict."""
    made = ["host", "path", "rule", "verdict"]
    host, path = host_path(F.col(url_col))
    pages = urls.drop(*[c for c in made if c != url_col]).withColumns({"host": host, "path": path})

    usable = rules.where("host is not null and path is not null and verdict is not null").select(
        F.col("host").alias("_rule_host"), F.col("path").alias("_rule_path"), F.col("verdict").alias("_rule_verdict"),
        _anchor_path(F.col("path")).alias("_anchor"))
    most = usable.agg(
        F.max(F.size(F.split("_rule_host", r"\."))).alias("labels"),
        F.max(F.length(F.regexp_replace("_anchor", "[^/]", ""))).alias("slashes"),
        F.max(F.length("_anchor")).alias("chars")).first()
    if most.labels is None:
        return pages.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})

    filed = _keyed(usable, F.concat("_rule_host", F.lit(" "), "_anchor"))
    distinct = pages.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most.labels))),
                           lambda n: F.concat_ws(".", F.slice(labels, F.size(labels) - n + 1, n)))
    # the path prefixes that end in "/", the empty one first; none longer than any anchor
    pieces = F.split(F.substring("path", 1, most.chars), "/")
    prefixes = F.transform(F.sequence(F.lit(0), F.least(F.size(pieces) - 1, F.lit(most.slashes))),
                           lambda n: F.when(n > 0, F.concat(F.concat_ws("/", F.slice(pieces, 1, n)), F.lit("/"))).otherwise(F.lit("")))
    expressions = (distinct.withColumn("_suffix", F.explode(F.array_distinct(suffixes)))
                   .withColumn("_prefix", F.explode(prefixes)))
    expressions = _keyed(expressions, F.concat("_suffix", F.lit(" "), "_prefix")).select("host", "path", "_digest", "_short")
    fits = (expressions.join(filed.withColumnRenamed("_digest", "_rule_digest"), "_short")
            .where(F.col("_digest") == F.col("_rule_digest"))
            .where(F.col("path").startswith(F.col("_rule_path"))))
    rule = F.concat("_rule_host", "_rule_path")
    rank = F.struct(F.length(rule), F.length("_rule_host"))
    best = (fits.withColumns({"_rule": rule, "_rank": rank})
            .groupBy("host", "path")
            .agg(F.min(F.struct((-F.col("_rank")["col1"]).alias("a"), (-F.col("_rank")["col2"]).alias("b"),
                                F.col("_rule").alias("rule"), (F.col("_rule_verdict") != "block").alias("c"),
                                F.col("_rule_verdict").alias("verdict"))).alias("_best"))
            .select("host", "path", F.col("_best.rule").alias("rule"), F.col("_best.verdict").alias("_verdict")))
    key, rule, verdict = (spare(n, pages.columns) for n in ("at", "its_rule", "its_verdict"))
    best = best.select(F.struct("host", "path").alias(key), F.col("rule").alias(rule), F.col("_verdict").alias(verdict))
    out = pages.withColumn(key, F.struct("host", "path")).join(best, key, "left")
    return out.select(*[F.col(f"`{c}`") for c in pages.columns], F.col(rule).alias("rule"), F.coalesce(verdict, F.lit(default)).alias("verdict"))

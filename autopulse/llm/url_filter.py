"""URL rules: host-suffix and path-prefix expressions, a join on short hash prefixes, full digests.

A URL's host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end (A-Z
lower-cased), its path what follows up to ``?``, ``#`` or the end.  A rule fits its host and
all subdomains when the URL's path starts with the rule's path.  Each distinct URL is
expanded once, into the expressions whose shape (host labels, path length) some rule has;
expressions meet rules on 32 bits of SHA-256 and count only if the whole digest agrees.
The longest rule wins (host and path length, then host length); of two rules with the same
host and path, ``block`` wins.

Defined cases: a null URL or one without ``://`` has empty host and path and fits only a rule
with both empty; a URL that no rule fits has rule NULL and the default verdict; repeated rows
are all answered; an empty table gives an empty result; columns other than the id and the URL
are not read, so clashing names do no harm.  Copies of one URL are judged once, and the way
back to the rows is an inner join that AQE splits when a URL is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_DIGITS = 8
RULES_SCHEMA = "action string, host string, path string"


def url_host(url: Column) -> Column:
    found = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"://([^/?#]*)", 1)).otherwise(F.lit(""))
    return F.translate(F.coalesce(found, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    found = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))
    return F.coalesce(found, F.lit(""))


def host_labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def expression_digest(host: Column, path: Column) -> Column:
    """SHA-256 of an expression; a host holds no line feed, so the pair is unambiguous."""
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _keyed_rules(rules: DataFrame) -> DataFrame:
    """One row per host and path (``block`` before ``allow``), with its digest."""
    host = F.translate(F.col("host"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return (rules.select(host.alias("r_host"), F.col("path").alias("r_path"), F.col("action"))
            .where("r_host IS NOT NULL AND r_path IS NOT NULL AND action IS NOT NULL")
            .groupBy("r_host", "r_path").agg(F.max("action").alias("r_action"))
            .withColumn("r_digest", expression_digest(F.col("r_host"), F.col("r_path")))
            .withColumn("r_prefix", F.substring("r_digest", 1, PREFIX_DIGITS)))


def expand(urls: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """One row per URL and expression; ``shapes``: (host labels, path length) pairs that occur in rules."""
    found = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(n).alias("n")) for k, n in shapes]) if shapes else F.array()
    if not shapes:
        return urls.select("url", "host", "path", F.lit("").alias("digest"), F.lit("").alias("prefix")).where("false")
    fits = F.filter(found, lambda s: (s["k"] <= host_labels(F.col("host"))) & (s["n"] <= F.length("path")))
    rows = urls.select("url", "host", "path", F.explode(fits).alias("s"))
    part = F.expr("substring_index(host, '.', -s.k)")
    digest = expression_digest(part, F.expr("substring(path, 1, s.n)"))
    return rows.select("url", "host", "path", digest.alias("digest")).withColumn(
        "prefix", F.substring("digest", 1, PREFIX_DIGITS))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    The shapes collected from the rules are bounded by the labels a host can have times the
    distinct path lengths in the rules, never by the pages.
    """
    keyed = _keyed_rules(rules)
    shapes = sorted({(r["k"], r["n"]) for r in keyed.select(
        host_labels(F.col("r_host")).alias("k"), F.length("r_path").alias("n")).distinct().collect()})
    rows = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"))
    urls = rows.select("url").distinct().select("url", url_host(F.col("url")).alias("host"),
                                                url_path(F.col("url")).alias("path"))
    matched = expand(urls, shapes).join(keyed, (F.col("prefix") == F.col("r_prefix"))
                                        & (F.col("digest") == F.col("r_digest")))
    best = matched.groupBy("url").agg(F.max(F.struct(
        (F.length("r_host") + F.length("r_path")).alias("size"), F.length("r_host").alias("host_size"),
        F.concat("r_host", "r_path").alias("rule"), F.col("r_action").alias("verdict"))).alias("best"))
    judged = urls.join(best, "url", "left").select(
        "url", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"))
    return rows.join(judged, "url").select("page_id", "host", "path", "rule", "verdict")

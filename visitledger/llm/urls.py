"""URL rules by host-suffix and path-prefix expressions.

A URL is expanded into every (host suffix, path up to a slash) pair that a rule could have. Pairs meet the rules in an
equi-join on a short prefix of their SHA-256 digest; the whole digest and the rule's path then confirm the match, and
the longest rule wins (of equal ones, block). URLs are reduced to distinct ones first, and no expression is longer than
the deepest rule, so a hot URL or a URL of thousands of segments costs no more than others. The join's hot keys (a rule
that fits a third of the pages) are an inner join's, which Spark splits.

Defined results: a null URL or one without ``://`` has an empty host and path, fits no rule and gets the default;
repeated rows each get their verdict; a rule list without rows leaves the default for all; rules with a null host or
path are ignored; empty labels (``a..com``) are labels like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import free_name, named

#: Hexadecimal digits of the digest that the join compares.
SHORT = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _folder(path: Column) -> Column:
    """The path up to its last slash; any rule's path starts there."""
    return F.regexp_replace(path, "[^/]*$", "")


def _keyed(rules: DataFrame) -> DataFrame:
    clean = rules.select(
        F.translate(F.col("host"), _UPPER, _LOWER).alias("host"), F.col("path").alias("path"), F.col("verdict").alias("verdict"),
    ).filter("host IS NOT NULL AND path IS NOT NULL").distinct()
    digest = F.sha2(F.concat("host", _folder(F.col("path"))), 256)
    return clean.withColumns({"digest": digest, "short": F.substring(digest, 1, SHORT)})


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` and a struct ``judged``: host, path, rule (host and path of the one that won, else null), verdict.

    ``rules``: host, path, verdict (``allow`` or ``block``). The column gets another name if ``judged`` is taken.
    """
    listed = _keyed(rules)
    depth = listed.agg(F.max(F.size(F.split("host", r"\."))).alias("n")).scalar()
    slashes = listed.agg(F.max(F.size(F.split(_folder(F.col("path")), "/"))).alias("n")).scalar()
    urls = pages.select(named(url).alias("url")).filter(F.col("url").contains("://")).distinct()
    parts = urls.select(
        "url", path_of(F.col("url")).alias("path"), F.split(host_of(F.col("url")), r"\.").alias("labels"),
        F.split(path_of(F.col("url")), "/").alias("segments"), depth.alias("depth"), slashes.alias("slashes"))
    hosts = F.expr("transform(sequence(greatest(1, size(labels) - depth + 1), size(labels)), "
                   "i -> array_join(slice(labels, i, size(labels)), '.'))")
    folders = F.expr("transform(sequence(1, least(size(segments), slashes)), "
                     "k -> array_join(transform(slice(segments, 1, k - 1), s -> concat(s, '/')), ''))")
    spread = (parts.filter("depth IS NOT NULL").select("url", "path", F.explode(hosts).alias("suffix"), folders.alias("folders"))
              .select("url", "path", F.explode("folders").alias("folder"), "suffix")
              .withColumn("digest", F.sha2(F.concat("suffix", "folder"), 256))
              .select("url", "path", F.substring("digest", 1, SHORT).alias("short"), "digest"))
    met = spread.alias("u").join(listed.alias("r"), F.col("u.short") == F.col("r.short"))
    sure = met.filter((F.col("u.digest") == F.col("r.digest")) & F.col("u.path").startswith(F.col("r.path")))
    rule = F.concat("r.host", "r.path")
    best = sure.groupBy("u.url").agg(F.max(F.struct(
        F.length(rule).alias("length"), (F.col("r.verdict") == "block").alias("strict"), rule.alias("rule"),
        F.col("r.verdict").alias("verdict"))).alias("best")).select(F.col("url").alias("key"), "best")
    out = free_name(pages.columns, "judged")
    taken = pages.alias("p").join(best.alias("b"), F.col(f"p.`{url}`") == F.col("b.key"), "left")
    return taken.select(*[F.col("p.`" + c.replace("`", "``") + "`") for c in pages.columns], F.struct(
        host_of(F.col(f"p.`{url}`")).alias("host"), path_of(F.col(f"p.`{url}`")).alias("path"),
        F.col("b.best.rule").alias("rule"), F.coalesce("b.best.verdict", F.lit(default)).alias("verdict")).alias(out))

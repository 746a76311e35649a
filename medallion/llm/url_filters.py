"""URL filters (op 11) by host suffixes, path prefixes and short hash prefixes.

A rule has a host, a path and a verdict. It fits a URL whose host is the rule's or a
subdomain of it and whose path starts with the rule's. The longest rule wins (host and path
counted together; of equally long ones the longer host, then ``block`` before others).

1. Each distinct (host, path) is expanded into host-suffix + path-prefix expressions, only
   those with as many labels and as many path characters as some rule has.
2. The first four bytes of an expression's SHA-256 are joined with those of the rules. A
   rule costs this join one long, so the prefixes are broadcast while their counted number
   is at most ``BROADCAST_RULES``; beyond that it is a shuffle join. Nearly all expressions end here.
3. What is left joins the rules on the prefix, and only equal digests are taken.
4. The best rule of each (host, path), written once, goes back to the rows, whose hot
   URLs a plain shuffle on both sides lets Spark split.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
user and port stay part of it. Path: then up to ``?``, ``#`` or the end. Null, empty and URLs
without ``://`` have both empty and no rule fits. Rules that can fit no URL (null or
empty host, host with ``/``, path that begins otherwise than with ``/``) fit none; a null path is empty. Rules of one
host and path count once, ``block`` before others. Whatever the length of a URL, its expressions are at most
as many as the rules have shapes (labels, path length). Shapes are collected: they are pairs of
numbers, at most one for each pair of a host's depth and a path's length among the rules, whatever the number of
pages. No rules, or no pages: every row gets the default, or there is no row. Repeated rows are all
returned. A kept column named like a result column gives way to it.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm._blocks import written

RESULTS = ("host", "path", "rule", "verdict")
#: Most rules whose 4-byte prefixes (as longs, some 16 MB) are broadcast.
BROADCAST_RULES = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The rules that the registered query applies (fixed values).
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both never null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _hashed(df: DataFrame) -> DataFrame:
    """With the full digest of ``expression`` and its first four bytes as a number."""
    df = df.withColumn("digest", F.sha2("expression", 256))
    return df.withColumn("prefix", F.conv(F.substring("digest", 1, 8), 16, 10).cast("long"))


def _listed(rules: DataFrame) -> DataFrame:
    """One row for each rule that can fit: expression, digest, prefix, and what decides between rules."""
    r = rules.select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), F.lower("verdict").alias("verdict"))
    r = r.where("host <> '' and not contains(host, '/') and (path = '' or startswith(path, '/'))")
    order = F.struct((F.col("verdict") == "block").alias("blocks"), "verdict")
    r = r.groupBy("host", "path").agg(F.max(order).getField("verdict").alias("verdict"))
    r = r.withColumn("expression", F.concat("host", "path"))
    rank = F.struct(
        F.char_length("expression").alias("size"), F.char_length("host").alias("host_size"),
        F.col("expression").alias("rule"), F.col("verdict"),
    )
    return _hashed(r.select("expression", (F.size(F.split("host", "\\.")).alias("labels")), F.char_length("path").alias("chars"), rank.alias("rank")))


def decide(targets: DataFrame, listed: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of the distinct targets (host, path) that a rule fits."""
    shapes = [[r.labels, r.chars] for r in listed.select("labels", "chars").distinct().collect()]
    known = F.from_json(F.lit(json.dumps(shapes)), "array<array<int>>")
    fitting = F.filter(known, lambda s: (s[0] <= F.col("labels")) & (s[1] <= F.col("chars")))
    expression = lambda s: F.concat(F.call_function("substring_index", F.col("host"), F.lit("."), -s[0]), F.substr(F.col("path"), F.lit(1), s[1]))
    expanded = (
        targets.where("host <> ''")
        .withColumns({"labels": F.size(F.split("host", "\\.")), "chars": F.char_length("path")})
        .select("host", "path", F.explode(F.transform(fitting, expression)).alias("expression"))
    )
    prefixes = listed.select("prefix").distinct()
    if listed.count() <= BROADCAST_RULES:
        prefixes = F.broadcast(prefixes)
    near = _hashed(expanded).join(prefixes, "prefix", "left_semi").select("host", "path", "prefix", "digest")
    rules = listed.select("prefix", F.col("digest").alias("full"), "rank")
    fits = near.join(rules, "prefix").where("digest = full")
    best = fits.groupBy("host", "path").agg(F.max("rank").alias("best"))
    return best.select("host", "path", "best.rule", "best.verdict")


def filter_urls(pages: DataFrame, rules: DataFrame, keep: list[str], url: str = "url", default: str = "allow") -> DataFrame:
    """``keep`` columns, host, path, rule (host and path of the one that wins; null if none
    fits) and verdict (the rule's, else ``default``). ``rules``: host, path, verdict."""
    host, path = host_and_path(F.col(url))
    keep = [k for k in keep if k not in RESULTS]
    rows = pages.select(F.struct(*keep).alias("_keep"), host.alias("host"), path.alias("path"))
    listed = written(_listed(rules), "url-rules")
    decided = written(decide(rows.select("host", "path").distinct(), listed), "url-verdicts")
    judged = rows.join(decided.hint("merge"), ["host", "path"], "left")
    return judged.select("_keep.*", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def op11_url_filters(spark, sf_dir: str) -> DataFrame:
    """Every url of ``pages`` against the query's rules."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return filter_urls(pages, rules, ["page_id"])

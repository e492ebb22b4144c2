"""URL filters by a sort-merge range join: a sorted sweep of urls and rule bounds, in DataFrame functions only.

A rule names a host and the begin of a path. It fits its host and all subdomains of it, if the url's path starts
with the rule's. For every host that a url lies under, from the top domain on, the canonical key is the host's
labels in reverse order, a slash, and the path. Under such keys a rule is one interval, from its own key to the
last key that it is a prefix of, and two intervals are nested or apart. One sort puts urls and bounds in order:
at a start the rule goes on the stack of active rules, at an end it comes off. What is on top after a bound is
known from the rules alone, so the sweep is a running ``last`` over the sorted rows. Over all hosts of a url
the longest rule wins.

Urls are judged once each and joined back. Keys are dealt out by host and ``salts`` shares of the urls, and every
share gets its host's bounds: a host with a third of all urls is spread, and rules are copied ``salts`` times. Only as
many hosts are made of a url as the deepest rule has labels.

Defined cases: host and path are empty if the url is null or has no ``://``; such rows get the default verdict.
Of rules of equal length that fit, the one with the longer host wins; of equal rules, a block. A null host is no rule,
a null path is the empty one. Repeated rows stay. Empty tables give empty results or the default verdict. Columns
other than page_id and url are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64
DEFAULT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _key(reversed_host: Column, path: Column) -> Column:
    return F.encode(F.concat(reversed_host, F.lit("/"), path), "UTF-8")


def _bounds(rules: DataFrame) -> DataFrame:
    """Start and end of every rule's interval, with the rule that is on top of the stack from there on."""
    named = (
        rules.where("host IS NOT NULL").select(F.lower("host").alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
        .withColumn("rev", F.array_join(F.reverse(F.split("host", r"\.")), "."))
    )
    top = F.struct(
        (F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"),
        F.concat("host", "path").alias("rule"), "verdict",
    )
    stacked = named.withColumn("top", top)
    # The rule below it on the stack has the longest path that is a shorter prefix of its own.
    outer = stacked.select(F.col("rev").alias("o_rev"), F.col("path").alias("o_path"), F.col("top").alias("o_top"))
    shorter = stacked.where(F.length("path") > 0).select("rev", "path", F.explode(F.sequence(F.lit(0), F.length("path") - 1)).alias("n"))
    below = (
        shorter.withColumn("prefix", F.expr("substring(path, 1, n)"))
        .join(outer, (F.col("rev") == F.col("o_rev")) & (F.col("prefix") == F.col("o_path")))
        .groupBy("rev", "path").agg(F.max("o_top").alias("below"))
    )
    stacked = stacked.join(below, ["rev", "path"], "left")
    nothing = F.struct(F.lit(-1).alias("size"), F.lit(-1).alias("host_size"), F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    start = F.struct(_key(F.col("rev"), F.col("path")).alias("key"), F.lit(0).alias("kind"), F.col("top").alias("top"))
    # No byte of UTF-8 is FF, so this sorts after every key with the prefix.
    end = F.struct(F.concat(_key(F.col("rev"), F.col("path")), F.expr("X'FF'")).alias("key"), F.lit(2).alias("kind"), F.coalesce("below", nothing).alias("top"))
    return stacked.select("rev", F.explode(F.array(start, end)).alias("bound")).select("rev", "bound.*")


def judge(urls: DataFrame, rules: DataFrame, default: str = DEFAULT, salts: int = SALTS) -> DataFrame:
    """Per distinct url of ``urls`` (column url) that a rule fits: url, rule, verdict."""
    depth = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    host, path = host_and_path(F.col("url"))
    labels = F.reverse(F.split("host", r"\."))
    levels = F.transform(F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(max(depth, 1)))), lambda n: F.array_join(F.slice("labels", 1, n), "."))
    keys = (
        urls.where("url IS NOT NULL").select("url").distinct()
        .select("url", host.alias("host"), path.alias("path")).where("host <> ''").withColumn("labels", labels)
        .select("url", "path", F.explode(levels).alias("rev"))
        .select("rev", F.pmod(F.xxhash64("url"), F.lit(salts)).alias("salt"), _key(F.col("rev"), F.col("path")).alias("key"), F.lit(1).alias("kind"), "url")
    )
    bounds = _bounds(rules).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    sweep = Window.partitionBy("rev", "salt").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    active = (
        keys.unionByName(bounds, allowMissingColumns=True)
        .withColumn("active", F.last("top", ignorenulls=True).over(sweep))
        .where((F.col("kind") == 1) & F.col("active.rule").isNotNull())
    )
    return active.groupBy("url").agg(F.max("active").alias("best")).select("url", "best.rule", "best.verdict")


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT, salts: int = SALTS) -> DataFrame:
    """(page_id, host, path, rule, verdict) per row of ``pages``; ``rules`` has host, path, verdict."""
    rows = pages.select("page_id", "url")
    host, path = host_and_path(F.col("url"))
    judged = judge(rows, rules, default, salts)
    return rows.join(judged, "url", "left").select(
        "page_id", host.alias("host"), path.alias("path"), "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )

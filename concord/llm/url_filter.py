"""URL rules by a sort-merge range join on canonical keys, in DataFrame operations only.

A canonical key is a host with its labels reversed, ``/``, and a path (``org.example.www//es/1``; a host
has no ``/``).  A rule fits a host and all its subdomains, so a URL stands for one key per ancestor
host.  A rule is the interval of the keys that begin with its own; such intervals nest.  Rule borders
and URL keys are range-partitioned by key (splitters that Spark samples) and swept in order, range by
range, with a stack of the rules that are open:

* the depth of the stack is a running sum, +1 where a rule opens and -1 where it closes;
* the top of the stack is the last rule that opened at that depth, a running ``last`` per depth;
* a rule whose interval crosses range borders is handed to each range that it reaches, as one more
  opening: a range gets as many as the rules nest there, however many rules there are in all.

Hot hosts and hot ancestors: URLs are first reduced to distinct (host, path) by a hash aggregate with map-side
combination, and the keys of all their ancestors to distinct (ancestor, path) with the number of hosts below, so no
key is swept twice, however many hosts an ancestor has, and ranges split its paths.  A key's rule comes back to
its hosts by a join in which frequent keys are broadcast (``skew``).  Rows without a host and path, however many, meet a
broadcast of one row instead of a shuffle.  Nothing else is broadcast by hand.

Defined results: a null URL or one without ``://`` has an empty host and path and no rule but one
for the empty host; rows are never merged or dropped, whether repeated or with null ids; an empty table
gives an empty table; no rules give the default verdict; rules with a null part are left out.  Ties: of
rules of equal total length the one with the longer host wins; equal (host, path) with different
verdicts: block wins.  Columns of any name are kept, but host, path, rule and verdict are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .skew import split_join
from .store import stored
from .text import free_name

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_frame(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    rows = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(r, ("host", "path", "verdict"))]) for r in rules]) if rules else F.array().cast("array<struct<host:string,path:string,verdict:string>>")
    return spark.range(1).select(F.inline(rows))


def _key(host: Column, path: Column) -> Column:
    """The canonical key, as bytes."""
    return F.encode(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("/"), path), "utf-8")


def _ancestors(keys: DataFrame) -> DataFrame:
    """(host, path) once for each ancestor of the host, itself included, as ``level``."""
    labels = F.split("host", r"\.")
    levels = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return keys.select("host", "path", F.explode(levels).alias("level"))


def _events(points: DataFrame, rules: DataFrame) -> DataFrame:
    """Openings (step 1) and ends (-1) of the rules' intervals, and each distinct (level, path) to be judged (0) with its number of hosts."""
    rules = rules.where("host is not null and path is not null and verdict is not null")
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # 'block' > 'allow'
    # 0xff is in no UTF-8 text: behind it end all keys that begin alike.
    ends = F.array(*[F.struct(k.alias("key"), F.lit(turn).alias("turn"), F.lit(step).alias("step")) for k, turn, step in ((_key(F.col("host"), F.col("path")), 1, 1), (F.concat(_key(F.col("host"), F.col("path")), F.lit(bytearray(b"\xff"))), 0, -1))])
    borders = rules.select(F.struct("host", "path", "verdict").alias("rule"), F.inline(ends))
    once = points.groupBy("level", "path").agg(F.count("*").alias("n"))
    return once.select(_key(F.col("level"), F.col("path")).alias("key"), F.lit(2).alias("turn"), F.lit(0).alias("step"), "level", "path", "n").unionByName(borders, allowMissingColumns=True)


def sweep(events: DataFrame, ranges: int) -> DataFrame:
    """level, path, n and the innermost rule around each key that has one."""
    dealt = stored(events.repartitionByRange(ranges, "key").withColumn("range", F.spark_partition_id()), "ranges")
    reach = dealt.where("step <> 0").groupBy("rule").agg(F.max(F.when(F.col("step") == 1, F.col("range"))).alias("first"), F.max("range").alias("last"), F.min("key").alias("key"))
    handed = reach.where("last > first").select("rule", "key", F.lit(1).alias("turn"), F.lit(1).alias("step"), F.explode(F.sequence(F.col("first") + 1, F.col("last"))).alias("range"))
    whole = dealt.unionByName(handed, allowMissingColumns=True)
    # What is handed on has a key before all others of the range, the outer rule first.
    so_far = W.orderBy("key", "turn").rowsBetween(W.unboundedPreceding, 0)
    deep = whole.withColumn("depth", F.sum("step").over(so_far.partitionBy("range")))
    top = F.last(F.when(F.col("step") == 1, F.col("rule")), ignorenulls=True).over(so_far.partitionBy("range", "depth"))
    return deep.withColumn("top", top).where("step = 0 and top is not null").select("level", "path", "n", F.col("top").alias("rule"))


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", ranges: int | None = None) -> DataFrame:
    """Adds host, path, rule (host + path of the rule that holds, else null) and verdict.

    ``ranges``: of the sort, by default as many as shuffle partitions, so they grow with the cluster.
    """
    ranges = ranges or int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = ("host", "path", "rule", "verdict")
    others = [c for c in pages.columns if c.lower() not in own]
    # In a struct of their own, the other columns may have any name.
    rows = pages.select(F.struct(F.lit(0).alias(free_name(others, "_")), *[F.col(f"`{c}`") for c in others]).alias("page"), url_host(F.col(f"`{url}`")).alias("host"), url_path(F.col(f"`{url}`")).alias("path"))
    points = _ancestors(rows.select("host", "path").distinct())
    swept = stored(sweep(_events(points, rules.select("host", "path", "verdict")), ranges), "swept")
    held = split_join(points, swept, ["level", "path"], "n")
    size = F.length("rule.host") + F.length("rule.path")
    best = held.groupBy("host", "path").agg(F.max(F.struct(size.alias("size"), F.length("rule.host").alias("of_host"), F.concat("rule.host", "rule.path").alias("rule"), F.col("rule.verdict").alias("verdict"))).alias("best"))
    blank = (F.col("host") == "") & (F.col("path") == "")
    one = best.where(blank).groupBy("host").agg(F.max("best").alias("best"))  # one row at most
    named = rows.where(~blank).join(best, ["host", "path"], "left").select("page", "host", "path", "best")
    named = named.unionByName(rows.where(blank).join(F.broadcast(one), "host", "left").select("page", "host", "path", "best"))
    return named.select(*[F.col(f"page.`{c}`") for c in others], "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))

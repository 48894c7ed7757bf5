"""URL rules by a sorted sweep over reversed-host keys. DataFrame functions only.

A rule is a host and a path prefix; it fits its host and every subdomain. Every
url asks once per suffix of its host (``a.b.org`` asks as ``a.b.org``, ``b.org``
and ``org``), under the key ``reversed host + "/" + path``. A rule then covers
exactly the keys from its own key ``k`` up to ``k`` followed by byte 0xFF (which
UTF-8 never uses), so rules are intervals that nest or are disjoint.

Keys and interval ends are sorted together and swept by window functions: the
running depth is the number of open rules, and the last rule opened at each
depth is that level of the stack; its top is the longest rule for this suffix.
The longest over the suffixes wins.

Urls are dealt out by a salt (a hash of the row), so a hot host is spread over
all partitions; the rules, the small side, are repeated once per salt. Each salt
is swept on its own, and the suffixes of one row meet in the same salt, so one
shuffle of urls serves both the sweep and the choice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from forecheck.llm.common import table

# the rules of op10: host, path, verdict
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"),
         ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
DEFAULT_VERDICT = "allow"       # where no rule fits

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII
    lower case; path: from there up to ``?``, ``#`` or the end. Both are empty
    for NULL or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _key(host: Column, path: Column) -> Column:
    backwards = F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")
    return F.concat(backwards, F.lit("/"), path).cast("binary")


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules or [], "host string, path string, verdict string")


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = DEFAULT_VERDICT, salts: int | None = None) -> DataFrame:
    """Per input row: id, ``host``, ``path``, ``rule`` (host + path of the longest
    rule that fits, else NULL) and ``verdict`` (its verdict, else ``default``).

    ``rules`` has ``host``, ``path``, ``verdict`` ("allow" or "block"); hosts are
    compared in ASCII lower case, NULL paths count as empty, rules without a host
    are left out, and of repeated (host, path) pairs "block" wins. Repeated rows
    are all returned; an empty table gives no rows, no rules give the default.
    ``salts`` (the number of sweeps, by default the shuffle partitions) changes
    no result.
    """
    spark = pages.sparkSession
    salts = salts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = (rules.select(F.translate(F.col("host").cast("string"), _UPPER, _LOWER).alias("h"),
                        F.coalesce(F.col("path").cast("string"), F.lit("")).alias("p"),
                        F.col("verdict").cast("string").alias("v"))
           .where("h is not null and h != ''").groupBy("h", "p").agg(F.max("v").alias("v")))
    own = own.select(_key(F.col("h"), F.col("p")).alias("key"), F.col("h"),
                     F.struct((F.length("h") + F.length("p")).alias("size"),
                              F.concat("h", "p").alias("rule"), F.col("v").alias("verdict"))
                     .alias("top"))
    # two events a rule: it opens at its key and closes after all that begin with it
    ends = own.withColumn("kind", F.explode(F.array(F.lit(0), F.lit(2)))).withColumn(
        "key", F.when(F.col("kind") == 2, F.concat("key", F.lit(b"\xff"))).otherwise(F.col("key")))
    step = F.when(F.col("kind") == 0, 1).when(F.col("kind") == 2, -1).otherwise(0)
    # rules nest only within one host; the deepest nesting sizes the stack
    nested = ends.withColumn("depth", F.sum(step).over(
        W.partitionBy("h").orderBy("key", "kind")))
    levels = nested.agg(F.max("depth")).first()[0] or 0

    host, path = host_and_path(pages[url_col].cast("string"))
    rows = (pages.select(pages[id_col].alias("id"), pages[url_col].cast("string").alias("url"),
                         host.alias("host"), path.alias("path"))
            .withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.lit(salts)).cast("int")))
    labels = F.split("host", r"\.", -1)
    count = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), count), lambda k: F.array_join(
        F.slice(labels, k, count), "."))
    asked = (rows.withColumn("n", F.when(F.col("host") == "", F.lit(1)).otherwise(count))
             .withColumn("suffix", F.explode(F.when(F.col("host") == "", F.array(F.lit("")))
                                             .otherwise(suffixes)))
             .select("salt", _key(F.col("suffix"), F.col("path")).alias("key"),
                     F.lit(1).alias("kind"), F.lit(None).cast(own.schema["top"].dataType).alias("top"),
                     "id", "url", "host", "path", "n"))
    dealt = (ends.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
             .select("salt", "key", "kind", "top"))
    swept = W.partitionBy("salt").orderBy("key", "kind")
    running = swept.rowsBetween(W.unboundedPreceding, W.currentRow)
    events = (asked.unionByName(dealt, allowMissingColumns=True)
              .withColumn("depth", F.sum(step).over(running)))
    stack = [F.last(F.when((F.col("kind") == 0) & (F.col("depth") == level), F.col("top")),
                    ignorenulls=True).over(running) for level in range(1, levels + 1)]
    top = F.lit(None).cast(own.schema["top"].dataType)
    for level, held in enumerate(stack, 1):
        top = F.when(F.col("depth") == level, held).otherwise(top)
    best = (events.withColumn("found", top).where("kind = 1")
            .groupBy("salt", "id", "url", "host", "path", "n")
            .agg(F.max("found").alias("found"), F.count(F.lit(1)).alias("asked")))
    copies = F.explode(F.array_repeat(F.lit(1), (F.col("asked") / F.col("n")).cast("int")))
    return (best.select("id", "host", "path", F.col("found.rule").alias("rule"),
                        F.coalesce(F.col("found.verdict"), F.lit(default)).alias("verdict"),
                        copies.alias("copy"))
            .drop("copy").withColumnRenamed("id", id_col))


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every url of ``pages`` against the fixed rules."""
    return judge(table(spark, sf_dir, "pages"), rule_table(spark, RULES))

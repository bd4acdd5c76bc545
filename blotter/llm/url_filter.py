"""URL block and allow lists by host-suffix and path-prefix expressions.

Every URL is expanded into host suffixes (cut at dots) of the numbers of labels that rules have; those that are the host of a rule, into
pairs with the path prefixes of the lengths that rules of this host have: no other expression can match.
Both times expressions and rules are joined on a short prefix of their SHA-256 digests; full
digests confirm a match, and the longest confirmed rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The rules of the registered query: (verdict, host, path).  Fixed values.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Hex digits of the digest that are joined on.
PREFIX = 8
#: Rules that are broadcast at most; more are joined by a shuffle.
BROADCAST_RULES = 100_000
#: Shares into which rows without a host are spread.
SPREAD = 4096


def rules_table(spark, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; without ``://`` empty."""
    return F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; without ``://`` empty."""
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _host_suffixes(host: Column, counts: list[int]) -> Column:
    """The last n labels of a host, for each n of ``counts`` that it has."""
    labels = F.split(host, r"\.")
    fits = F.filter(F.array(*map(F.lit, counts)), lambda n: n <= F.size(labels))
    return F.transform(fits, lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))


def _path_prefixes(path: Column, lengths: Column) -> Column:
    """The first n characters of a path, for each n of ``lengths`` that it has."""
    return F.transform(F.filter(lengths, lambda n: n <= F.length(path)), lambda n: F.substring(path, F.lit(1), n))


def _digest(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("\0", *parts).cast("binary"), 256)


def _bounded(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES else table


def judge_urls(df: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict`` per input row.

    A rule fits its host and all subdomains if the path of the URL starts with the rule's; of several the longest
    (host and path together, then host) wins, ``block`` on a tie of the same rule.  ``rule`` is host and path as text, null where none
    fits: the verdict is then ``default``.  A null URL or one without ``://`` has empty host and path and fits no rule;
    ids are only carried along, repeated rows each get their row, and an empty table gives an empty result."""
    own = rules.select("verdict", F.lower("host").alias("host"), F.coalesce("path", F.lit("")).alias("path")).filter(F.col("host") != "").distinct()
    counts = [r.n for r in own.select(F.size(F.split("host", r"\.")).alias("n")).distinct().collect()]  # labels of a host: a few numbers
    rank = F.struct((F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"), F.col("verdict").alias("verdict"),
                    F.concat("host", "path").alias("rule"))
    short = lambda c: F.substring(c, 1, PREFIX)
    table = own.select(_digest(F.col("host"), F.col("path")).alias("full"), rank.alias("hit"))
    table = _bounded(table.groupBy("full").agg(F.max("hit").alias("hit")).withColumn("short", short("full")))
    # Per host of a rule the lengths of its paths (at most as many as a path has characters).
    hosts = own.groupBy(_digest(F.col("host")).alias("host_full")).agg(F.collect_set(F.length("path")).alias("lengths"))
    hosts = _bounded(hosts.withColumn("host_short", short("host_full")))
    pages = df.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(host_of(F.col(url_col)), F.lit("")).alias("host"),
                      F.coalesce(path_of(F.col(url_col)), F.lit("")).alias("path"))
    places = pages.select("host", "path").filter(F.col("host") != "").distinct()
    tried = places.select("host", "path", F.explode(_host_suffixes(F.col("host"), counts)).alias("suffix"))
    tried = tried.withColumn("host_digest", _digest(F.col("suffix"))).withColumn("host_short", short("host_digest"))
    ruled = tried.join(hosts, "host_short").filter(F.col("host_digest") == F.col("host_full"))
    paths = ruled.select("host", "path", "suffix", F.explode(_path_prefixes(F.col("path"), F.col("lengths"))).alias("prefix"))
    hashed = paths.select("host", "path", _digest(F.col("suffix"), F.col("prefix")).alias("digest")).withColumn("short", short("digest"))
    hits = hashed.join(table, "short").filter(F.col("digest") == F.col("full"))
    best = hits.groupBy("host", "path").agg(F.max("hit").alias("hit")).withColumn("_share", F.lit(0))
    # Rows without a host (null URLs, too) have no rule: they are spread over shares that no rule has.
    share = F.when(F.col("host") == "", F.pmod(F.xxhash64("page_id"), F.lit(SPREAD)) + 1).otherwise(0).cast("int")
    return pages.withColumn("_share", share).join(best, ["host", "path", "_share"], "left").select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce(F.col("hit.verdict"), F.lit(default)).alias("verdict"))


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    """The five fixed rules over every URL of ``pages``; URLs that no rule fits are allowed."""
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules_table(spark))


OP6_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(verdict, host, path) AS (VALUES """ + ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES) + r"""),
m AS (
  SELECT p.page_id, r.verdict, r.host || r.path AS rule,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS k
  FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, coalesce(p.host, '') AS host, coalesce(p.path, '') AS path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM p LEFT JOIN m ON p.page_id = m.page_id AND m.k = 1
"""

"""Cross-site boilerplate lines, by the spread of a line over sites.

DataFrame functions only.  A line's spread is the number of distinct sites that
carry it.  It is estimated with one HyperLogLog sketch per line hash, merged by
aggregation; where the estimate is near the threshold the distinct sites are
counted exactly.  Lines at or above the threshold are boilerplate: their first
occurrence stays and all others are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import _text as tx

#: Characters that do not count at either end of a line.
BLANKS = " \t\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def line_table(df: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """``key, twin, site, pos, line``: the hash of every line that is not blank, with its place.  ``key`` and ``twin``
    (a hash of the whole text) name the row; a null site is a site of its own."""
    rows = df.select(tx.doc_key(id_col).alias("key"), F.xxhash64(text_col).alias("twin"), F.xxhash64(F.coalesce(F.col(site_col).cast("string"), F.lit("\0"))).alias("site"),
                     F.posexplode(_lines(F.col(text_col))).alias("pos", "raw"))
    kept = rows.withColumn("raw", F.btrim("raw", F.lit(BLANKS))).filter(F.col("raw") != "")
    return kept.select("key", "twin", "site", "pos", F.xxhash64("raw").alias("line"))


def boilerplate(spread: DataFrame, min_sites: int, lg_k: int = 12, margin: float = 0.2) -> DataFrame:
    """``line`` of every line on ``min_sites`` distinct sites or more.  Estimates outside ``min_sites * (1 +- margin)`` (over
    twelve standard errors of the sketch) decide by themselves, the others are counted."""
    low, high = min_sites * (1 - margin) - 1, min_sites * (1 + margin) + 1
    sketches = spread.groupBy("line").agg(F.hll_sketch_agg("site", lg_k).alias("sketch"))
    estimates = cut_lineage(sketches.select("line", F.hll_sketch_estimate("sketch").alias("sites")))
    sure = estimates.filter(F.col("sites") > high).select("line")
    unsure = estimates.filter(F.col("sites").between(low, high)).select("line")
    counted = spread.select("line", "site").join(unsure, "line", "left_semi").distinct().groupBy("line").agg(F.count("*").alias("sites"))
    return sure.union(counted.filter(F.col("sites") >= min_sites).select("line"))


def removed_lines(df: DataFrame, min_sites: int, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """``key, twin, gone``: per row the positions of the lines to remove."""
    lines = line_table(df, id_col, text_col, site_col)
    # A line on one site only has one smallest and largest site: no sketch for it.
    spread = lines.groupBy("line").agg(F.min("site").alias("low"), F.max("site").alias("high"))
    # Cut off here, so that the join below has plain shuffles on both sides: Spark can split a hot line's.
    several = cut_lineage(spread.filter("low != high").select("line"))
    found = cut_lineage(lines.join(several, "line", "left_semi"))
    place = F.struct("key", "twin", "pos")
    # The first place is found before any join, with partial aggregation: a hot line is a row per task.
    first = found.groupBy("line").agg(F.min(place).alias("first"))
    common = cut_lineage(boilerplate(found, min_sites).join(first, "line"))
    later = found.join(common, "line").filter(place != F.col("first"))
    return later.groupBy("key", "twin").agg(F.collect_set("pos").alias("gone"))


def dedup_lines(df: DataFrame, min_sites: int = 10, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """All columns of ``df`` with the text's boilerplate lines removed, and ``n_lines``, ``n_removed`` (long) behind them
    (a column of ``df`` by one of these names is replaced).

    Lines end at ``\\n``; spaces, tabs and CR at either end do not count; blank lines are never removed and kept lines
    stay as they are.  Of a boilerplate line the occurrence with the smallest id and position stays.  A null text has no
    lines and stays null; a text that loses all lines becomes empty; a null id orders first; repeated rows are the same
    place and get the same result; an empty table gives an empty result."""
    gone = removed_lines(df, min_sites, id_col, text_col, site_col)
    names = [c for c in df.columns if c not in ("n_lines", "n_removed")]
    rows = df.select(F.struct(*names).alias("row"), tx.doc_key(id_col).alias("key"), F.xxhash64(text_col).alias("twin"))
    joined = rows.join(gone, ["key", "twin"], "left")
    text = F.col(f"row.`{text_col}`")
    lines = _lines(text)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    rest = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    out = joined.select("row", F.when(F.col("gone").isNull(), text).otherwise(rest).alias("rest"),
                        F.when(text.isNull(), 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1).cast("long").alias("n_lines"),
                        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"))
    columns = [(F.col("rest") if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in names]
    return out.select(*columns, "n_lines", "n_removed")


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Lines on 10 sources or more, over the whole ``documents`` table; the remaining text as its MD5."""
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
    return out.select("doc_id", "n_lines", "n_removed", F.md5(F.col("text").cast("binary")).alias("kept_md5"))


OP1_SQL = """
WITH l AS (
  SELECT doc_id, coalesce(source, chr(1)) AS source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL),
k AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS bare FROM l),
b AS (
  SELECT bare, min(struct_pack(d := doc_id, p := pos)) AS first FROM k WHERE bare <> ''
  GROUP BY bare HAVING count(DISTINCT source) >= 10),
m AS (
  SELECT k.*, b.bare IS NOT NULL AND struct_pack(d := doc_id, p := pos) <> b.first AS gone
  FROM k LEFT JOIN b ON k.bare = b.bare),
t AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept
  FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, md5(kept) AS kept_md5
FROM documents d LEFT JOIN t ON d.doc_id = t.doc_id
"""

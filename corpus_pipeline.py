"""Corpus pipeline: language, boilerplate lines, near-duplicates, benchmark leaks, tokens.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next stage's ``docs``.  All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.llm import _text as tx
from blotter.llm import bpe, decontaminate, langid, line_dedup, simhash
from blotter.session import ensure_checkpoint_dir, ship_package

#: Posterior under which a language is not accepted.
LEAST_SCORE = 0.5


def _stage(fn):
    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, docs, sf_dir)

    return run_stage


@_stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of no language: null text, no letter, or no language with a posterior of ``LEAST_SCORE``.  The model
    learns from the labelled rows that are not held out; without any labelled row nothing can be judged, and nothing goes."""
    model = langid.fit(docs.filter(~langid.held_out()), langid.vocabulary_path())
    if not model["languages"]:
        return docs
    known = langid.identify(docs, model)
    return known.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(docs.columns)


@_stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove lines that stand on 10 sources or more, but for their first occurrence; ``n_chars`` follows the text."""
    out = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id stays (without an id first, then by the hash of
    the text), once if its row is repeated."""
    kept = simhash.representatives(docs)
    named = docs.withColumns({"_key": tx.doc_key("doc_id"), "_twin": F.xxhash64(F.col("text").cast("binary"))})
    rows = named.join(kept, (named["_key"] == kept["key"]) & (named["_twin"] == kept["twin"]), "left_semi")
    first = F.row_number().over(Window.partitionBy("_key", "_twin").orderBy("_key"))
    return rows.withColumn("_nth", first).filter("_nth = 1").select(docs.columns)


@_stage
def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that share a passage with the benchmark."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(docs.columns)


@_stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document (little-endian unsigned 32-bit integers), with the digests of the ids and of the text decoded
    from them."""
    return bpe.round_trip(docs, bpe.tokenizer_path(), with_ids=True)


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("tokens", tokens)]

#: SQL cannot express language ID, SimHash and BPE; the tests hold run() against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; what a stage returns is written under the shared checkpoint folder."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

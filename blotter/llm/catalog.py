"""Registered queries of the training-data operators: key -> (query, DuckDB SQL or None).

Keys without SQL are tested against brute force, an exact round trip or
held-out accuracy in ``tests/llm``."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package
from . import (bpe, centroids, decontaminate, divergence, langid, line_dedup, quality, simhash, substring_dedup, suffix_dedup,
               token_counts, url_filter, warc)

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def _add(fn: QueryFn, sql: str | None = None) -> None:
    @functools.wraps(fn)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    REGISTRY[fn.__name__] = (query, sql)


_add(substring_dedup.op3_substring_dedup)
_add(bpe.op7_bpe_codec)
_add(simhash.op9_simhash_near_dedup)
_add(langid.op10_language_id)
_add(line_dedup.op1_line_dedup, line_dedup.OP1_SQL)
_add(decontaminate.op2_decontamination)
_add(url_filter.op6_url_filter, url_filter.OP6_SQL)
_add(quality.op8_quality_rules)
_add(warc.op4_warc_round_trip, warc.OP4_SQL)
_add(suffix_dedup.op5_suffix_dedup)
_add(divergence.op11_source_divergence, divergence.OP11_SQL)
_add(centroids.op12_centroid_clustering, centroids.OP12_SQL)
_add(token_counts.op13_token_counts)

"""One query for each operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import orbitlake
from orbitlake.llm import oracles
from orbitlake.llm.decontaminate import contamination
from orbitlake.llm.kneser_ney import lm_scores
from orbitlake.llm.lexical import lexical_search
from orbitlake.llm.licenses import license_report
from orbitlake.llm.mixing import mixture
from orbitlake.llm.passages import passage_report
from orbitlake.llm.quality import quality_scores
from orbitlake.llm.simhash import simhash_groups
from orbitlake.llm.suffixes import removal_report
from orbitlake.llm.tables import read
from orbitlake.llm.toxicity import toxicity_scores
from orbitlake.llm.urls import url_verdicts
from orbitlake.llm.vectors import vector_groups
from orbitlake.llm.whitening import whiten
from orbitlake.session import configure, ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on; code travels with the tasks."""
    ship(orbitlake)
    return configure(spark)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(prepare(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


@query("op7_simhash_pivots")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(read(spark, sf_dir, "documents"))


@query("op1_toxicity_cnn")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op2_decontaminate_prefix", oracles.CONTAMINATION)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op3_kneser_ney")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(read(spark, sf_dir, "documents"))


@query("op4_mix_systematic")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(read(spark, sf_dir, "documents"))


@query("op5_quality_pu")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op6_embeddings_pca")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_groups(read(spark, sf_dir, "embeddings"))


@query("op8_url_trust", oracles.VERDICTS)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(read(spark, sf_dir, "pages"))


@query("op9_license_fuzzy")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(read(spark, sf_dir, "documents"))


@query("op10_suffix_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_report(read(spark, sf_dir, "documents"))


@query("op11_whitening_chebyshev")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))


@query("op12_passages_blocks", oracles.REPEATED_PASSAGES)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_report(read(spark, sf_dir, "documents")).drop("spans")


@query("op13_lexical_blocks", oracles.RANKED)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))

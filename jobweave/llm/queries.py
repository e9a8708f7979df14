"""The registered queries of the subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweave.llm import (
    collocations, decontamination, hilbert_sharding, html_density, jaccard_join, line_crf, ppm_language, rule_ensemble, suffix_dedup, token_counts,
    warc_derivatives, whitening, word_bpe,
)
from jobweave.llm.oracles import ORACLES  # noqa: F401  registered beside the queries


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_report(suffix_dedup.suffix_dedup(_table(spark, sf_dir, "documents")))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op3_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return ppm_language.identify(docs, ppm_language.fit(docs))


def op4_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_sharding.document_shards(_table(spark, sf_dir, "documents"))


def op5_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = word_bpe.bpe_round_trip(_table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
    return coded.select("doc_id", *word_bpe.digest_columns())


def op6_html_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_density.extract_pages(_table(spark, sf_dir, "pages"))


def op7_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return line_crf.judge(docs, line_crf.fit(docs, _table(spark, sf_dir, "labels"))).drop("content")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontamination.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return decontamination.contamination_report(hits)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op10_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = warc_derivatives.page_responses(_table(spark, sf_dir, "pages"))
    return warc_derivatives.build_derivatives(responses, columns=("page_id", "url"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_lanczos_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.col("deviation").cast("long"))


def op13_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    ensemble = rule_ensemble.fit(docs, _table(spark, sf_dir, "labels"))
    return rule_ensemble.classify(docs, ensemble).select("doc_id", "held_out", "score", "predicted")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_token_counts, op3_ppm_language, op4_hilbert_sharding, op5_word_bpe, op6_html_density, op7_line_crf,
        op8_decontamination, op9_jaccard_join, op10_warc_derivatives,
        op11_collocations, op12_lanczos_whitening, op13_rule_ensemble,
    )
}

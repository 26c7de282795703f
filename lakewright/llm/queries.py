"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakewright.llm import decontamination, divergence, interpolation, jaccard, line_crf, mixing, packing, pages, pieces, pii, quotes, survival, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.conversations(_table(spark, sf_dir, "conversations"))


def op2_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation.score_texts(interpolation.learn(_table(spark, sf_dir, "documents")))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def op4_host_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_texts(_table(spark, sf_dir, "pages"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), packing.Vocabulary.read())


def op6_skip_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pii.find(docs, pii.learn(docs))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score_texts(docs, toxicity.learn(docs, _table(spark, sf_dir, "labels")))


def op8_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_texts(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_line_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return line_crf.judge_texts(docs, line_crf.learn(docs, _table(spark, sf_dir, "labels")))


def op11_pattern_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_piece_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(_table(spark, sf_dir, "documents"), pieces.Model.read())


def op13_survival_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survival.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_quote_links": op1_quote_links,
    "op2_interpolation": op2_interpolation,
    "op3_mixing": op3_mixing,
    "op4_host_suffixes": op4_host_suffixes,
    "op5_packing": op5_packing,
    "op6_skip_chain": op6_skip_chain,
    "op7_toxicity": op7_toxicity,
    "op8_spaced_seeds": op8_spaced_seeds,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_line_labels": op10_line_labels,
    "op11_pattern_tree": op11_pattern_tree,
    "op12_piece_spans": op12_piece_spans,
    "op13_survival_words": op13_survival_words,
}
ORACLES = {
    "op8_spaced_seeds": decontamination.ORACLE,
    "op11_pattern_tree": divergence.ORACLE,
    "op13_survival_words": survival.ORACLE,
}

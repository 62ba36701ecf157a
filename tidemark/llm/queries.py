"""The queries opN_<name> and the SQL that some of them can be held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, exact_dedup, html_text, language, mixing, ngram_join, pii, secrets, toxicity, urlrules


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_pii(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urlrules.judge_urls(pages, urlrules.fixed_rules(pages))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_languages(table(spark, sf_dir, "documents"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_secret_scan, op2_pii_surrogates, op3_toxicity, op4_mix_sources, op5_url_rules, op6_exact_dedup, op7_decontaminate, op8_language_id, op9_html_text, op10_ngram_join)
}

ORACLE_SQL = {"op5_url_rules": urlrules.ORACLE_SQL, "op6_exact_dedup": exact_dedup.ORACLE_SQL, "op10_ngram_join": ngram_join.ORACLE_SQL}

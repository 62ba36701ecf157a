"""The corpus pipeline: documents to a mix of sources, in five stages.

1. language: documents whose language can't be told go.
2. exact_dedup: one document of each group of equal texts stays.
3. near_dedup: one document, that with the least id, of each component of
   n-gram links (five words, Jaccard 0.8) stays.
4. decontaminate: documents that hold a benchmark item go.
5. mix: the rest is mixed to the target weights of its sources.

All stages but the last return the columns of documents. The chain can't be put
in SQL as a whole (stages 1, 4 and 5 can't), so ORACLE_SQL is None and the tests
hold it against a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import keep, settle, without_ids, without_space
from tidemark.llm.decontaminate import contaminated
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.language import UNDETERMINED, fit, identify
from tidemark.llm.mixing import mix_sources
from tidemark.llm.ngram_join import link_components


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a language by cross-parsing; learned from the labelled rows that are not held out."""
    model = fit(docs.select("doc_id", "text", "lang"))
    judged = identify(docs, model, lang_as="_tidemark_lang", score_as="_tidemark_score")
    return judged.filter(F.col("_tidemark_lang") != UNDETERMINED).select(*docs.columns)


def _named(docs: DataFrame) -> DataFrame:
    """Documents with ``_row``, a hash of id and text: null and repeated ids tell rows apart by it."""
    return docs.withColumn("_row", F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text"))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that stay in their group of equal texts, one for each group."""
    judged = exact_dedup(docs)
    name = F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text_sha256")
    sha = F.sha2(without_space(F.col("text")).cast("binary"), 256)
    named = docs.withColumn("_row", F.xxhash64(F.col("doc_id").isNull(), F.col("doc_id").cast("long"), sha))
    kept = without_ids(named, judged.filter("NOT kept").select(name.alias("_row")), "_row")
    # rows of one id and text: only where they repeat is there anything to do, and only those rows move
    twice = judged.filter("kept AND group_size > 1").groupBy(name.alias("_row")).count().filter("count > 1").select("_row")
    twice = keep(twice)
    if twice.isEmpty():
        return kept.select(*docs.columns)
    once = without_ids(kept, twice, "_row")
    longest = F.max_by(F.struct(*docs.columns), F.length(F.coalesce("text", F.lit(""))))
    again = kept.join(twice, "_row", "left_semi").groupBy("_row").agg(longest.alias("_best")).select("_best.*")
    return once.select(*docs.columns).unionByName(again)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the least id of each component; a row without an id stays only where none has one."""
    named = _named(docs)
    # ids in the order by which a component's row is chosen, with what tells rows of one id apart
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("_row").alias("row"))
    linked = link_components(named.select(order.alias("doc_id"), "text"), size=5, percent=80, id_type=None)
    return without_ids(named, linked.filter("doc_id <> component_id").select(F.col("doc_id.row").alias("_row")), "_row").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    named = _named(docs)
    found = contaminated(named.select(F.col("_row").alias("doc_id"), "text"), benchmark)
    return without_ids(named, found.select(F.col("doc_id").alias("_row")), "_row").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row."""
    return mix_sources(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("exact_dedup", dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages, in order, to the documents under ``sf_dir``; each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Corpus pipeline: quality rules, quality classifier, near-duplicates, repeated strings, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of `documents`. `run`
writes each result to the shared folder and rereads it as the next stage's input. Labels are read from `sf_dir`; each stage
fits on its own input. Null or empty texts pass through by the operators' own rules, as do rows with null ids and repeated rows,
but that of near-duplicate rows one stays, whatever their ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custlens.llm import order_minhash, packing, quality_classifier, quality_rules, suffix_dedup
from custlens.llm.queries import END_ID, WORD_BPE
from custlens.runtime import discard, materialize, stage_tables

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _renamed(docs: DataFrame) -> DataFrame:
    """The columns of documents under names that no statistic has."""
    return docs.select(*[F.col(c).alias(f"_document_{c}") for c in COLUMNS])


def _named_back(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.col(f"_document_{c}").alias(c) for c in COLUMNS])


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no base rule and no certified cutoff. Statistics for the fit are written without texts; the verdict takes them anew."""
    stats = materialize(quality_rules.with_statistics(docs.select("doc_id", "lang", "text"), keep_text=False))
    cutoffs = quality_rules.fit_cutoffs(stats, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _named_back(quality_rules.judge(quality_rules.with_statistics(_renamed(docs), "_document_text"), cutoffs, "_document_lang").where("kept"))


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is accepted. Statistics for the fit are written without texts; the verdict takes them anew."""
    stats = materialize(quality_classifier.with_statistics(docs.select("doc_id", "text"), keep_text=False))
    model = quality_classifier.fit_on(stats, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality_classifier.with_score(quality_classifier.with_statistics(_renamed(docs), "_document_text"), model)
    return _named_back(scored.where(F.col("score") >= quality_classifier.ACCEPT))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates: that with the smallest id, a null one last. Rows are told apart by number, not by id."""
    rows = materialize(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row")))
    found = order_minhash.near_duplicates(rows, "_row").select(F.col("id").alias("_row"), "class_id")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))["_row"].alias("_row")
    kept = rows.select("_row", "doc_id").join(found, "_row").groupBy("class_id").agg(first)
    return rows.join(kept, "_row", "left_semi").select(*COLUMNS)


def repeated_strings_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings that repeat; characters cut in part go whole."""
    cut = suffix_dedup.without_spans(suffix_dedup.at_characters(suffix_dedup.repeated_spans(docs.select(*COLUMNS))))
    text = F.when(F.size("spans") == 0, F.col("text")).otherwise(F.col("kept").cast("string"))
    n_chars = F.when(F.size("spans") == 0, F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.withColumn("text", text).withColumn("n_chars", n_chars).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences."""
    pieces = packing.pack(docs.select("doc_id", packing.document_parts().alias("parts")), WORD_BPE, END_ID)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules_stage),
    ("quality classifier", quality_classifier_stage),
    ("near duplicates", near_duplicates_stage),
    ("repeated strings", repeated_strings_stage),
    ("packing", packing_stage),
]

# SQL cannot express boosted trees, alignment or a tokenizer: tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's own tables and its input are deleted once its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        with stage_tables(spark) as keep:
            after = keep(stage(spark, docs, sf_dir))
        if i:
            discard(docs)
        docs = after
    return docs

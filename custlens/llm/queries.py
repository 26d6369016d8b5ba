"""Named queries of the training-data operators over the driver tables, each with the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custlens.llm import bpe_codec, order_minhash, packing, periodic_runs, quality_classifier, quality_rules, sharding, suffix_dedup, token_counts, toxicity, vantage_tree, warc_fixity, whitening
from custlens.runtime import materialize

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
TOKEN_LIMIT = 512
# All tokens of a document but its first bear loss: this limit holds sequences of few documents back by up to four tokens.
DOCUMENT_LIMITS = packing.Limits(tokens=4096, segments=24, loss=4092)
CONVERSATION_LIMITS = packing.Limits(tokens=4096, segments=16, loss=2048)
SHARDS = 8
NEAREST = 5
# Less than 1 prunes more than the triangle inequality allows.
PRUNE_FACTOR = 0.9


def query(name: str, sql: str | None = None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_vector_packing")
def op1_vector_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", packing.document_parts().alias("parts"))
    pieces = packing.pack(docs, WORD_BPE, END_ID, limits=DOCUMENT_LIMITS)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "segment", "loss_tokens")


@query("conversation_packing")
def conversation_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Instruction data: only the assistant's turns bear loss, so the three limits differ."""
    examples = packing.conversation_examples(table(spark, folder, "conversations"))
    pieces = packing.pack(examples, WORD_BPE, END_ID, key="conv_id", limits=CONVERSATION_LIMITS)
    return pieces.select("conv_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "segment", "loss_tokens")


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    counted = token_counts.count_tokens(docs, BYTE_BPE)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


@query("op10_bpe_codec")
def op10_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = bpe_codec.encode(docs, WORD_BPE, ids="ids", decoded="decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op2_boosted_quality")
def op2_boosted_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    stats = materialize(quality_classifier.with_statistics(docs, keep_text=False))
    model = quality_classifier.fit_on(stats, table(spark, folder, "labels"))
    scored = quality_classifier.with_score(stats, model)
    return scored.select("doc_id", quality_classifier.held_out().alias("held_out"), "score", (F.col("score") >= quality_classifier.ACCEPT).cast("int").alias("predicted"))


@query("op4_risk_controlled_rules")
def op4_risk_controlled_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    stats = materialize(quality_rules.with_statistics(docs, keep_text=False))
    judged = quality_rules.judge(stats, quality_rules.fit_cutoffs(stats, table(spark, folder, "labels")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op7_jump_sharding")
def op7_jump_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, folder, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = sharding.assign(docs, "doc_id", SHARDS, ["text_crc32", "size"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query("op9_vantage_trees")
def op9_vantage_trees(spark: SparkSession, folder: str) -> DataFrame:
    rows = vantage_tree.usable(table(spark, folder, "embeddings"), "vec_id", "embedding")
    index = vantage_tree.build_index(rows, NEAREST)
    return vantage_tree.neighbours(index, rows.where("id % 50 = 0"), NEAREST, PRUNE_FACTOR)


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    vectors = whitening.integer_vectors(table(spark, folder, "embeddings"), "vec_id", "embedding")
    white = whitening.whiten(vectors, whitening.fit(vectors))
    return white.select(F.col("id").alias("vec_id"), "component", "n", F.expr("try_cast(deviation as long)").alias("deviation"), "whitened", "explained", "identity_error")


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", periodic_runs.planted("doc_id", "text").alias("text"))
    found = periodic_runs.periodic_runs(docs, keep_text=False).withColumn("longest", periodic_runs.longest())
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "longest.start",
        "longest.length",
        "longest.period",
        F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op13_toxic_spans")
def op13_toxic_spans(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.with_score(docs, toxicity.fit(docs, table(spark, folder, "labels")))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= toxicity.ACCEPT).cast("int").alias("predicted"), "spans")


@query("op6_order_minhash")
def op6_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    found = order_minhash.near_duplicates_of_all(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "text_id", "n_words")


@query("op5_suffix_dedup")
def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    marked = suffix_dedup.repeated_spans(table(spark, folder, "documents").select("doc_id", "text"))
    cut = suffix_dedup.without_spans(marked)
    # the same as text: of a character that is cut in part nothing stays
    cut = suffix_dedup.without_spans(suffix_dedup.at_characters(cut.withColumn("_spans", F.col("spans"))), "kept_text").withColumn("kept_text", F.col("kept_text").cast("string")).withColumn("spans", F.col("_spans"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select("doc_id", F.length("data").cast("long").alias("n_bytes"), removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), "kept_text")


def _mark(salt: str):
    """A number below 65536 from the page's address: which records of the second replica are damaged."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), F.coalesce("url", F.lit(""))).cast("binary")), 1, 4), 16, 10).cast("int")


@query(
    "op3_merkle_fixity",
    """
    WITH r AS (
      SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html,
        CAST('0x' || substr(md5('lost' || coalesce(url, '')), 1, 4) AS INTEGER) % 199 = 7 AS lost,
        CAST('0x' || substr(md5('bits' || coalesce(url, '')), 1, 4) AS INTEGER) % 97 = 7 AS flipped
      FROM pages
    ), w AS (
      SELECT *, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Length: '
        || CAST(strlen(html) AS VARCHAR) || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10) AS rec FROM r
    ), s AS (
      SELECT page_id, lost, flipped, sha256(rec) AS first_sha256, sha256(left(rec, length(rec) - 1) || '?') AS flipped_sha256, CAST(strlen(rec) AS BIGINT) AS record_length,
        CAST(sum(strlen(rec)) OVER (ORDER BY page_id NULLS FIRST, sha256(rec) ROWS UNBOUNDED PRECEDING) AS BIGINT) - CAST(strlen(rec) AS BIGINT) AS record_offset FROM w
    )
    SELECT page_id, record_offset, record_length, CASE WHEN lost THEN 'lost' ELSE 'changed' END AS damage, first_sha256, CASE WHEN lost THEN NULL ELSE flipped_sha256 END AS second_sha256
    FROM s WHERE lost OR flipped
    """,
)
def op3_merkle_fixity(spark: SparkSession, folder: str) -> DataFrame:
    """A second replica of the archived pages lacks some records and has the last byte of others changed; the audit finds them."""
    pages = table(spark, folder, "pages").select("page_id", warc_fixity.record(F.col("url"), F.col("html")).alias("record"), _mark("lost").alias("lost"), _mark("bits").alias("bits"))
    changed = F.concat(F.expr("left(record, length(record) - 1)"), F.lit("?"))
    replica = F.when(F.col("lost") % 199 == 7, None).when(F.col("bits") % 97 == 7, changed).otherwise(F.col("record"))
    hashed = pages.select("page_id", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("first_sha256"), F.sha2(replica, 256).alias("second_sha256"))
    placed = materialize(warc_fixity.lay_out(materialize(hashed), ["page_id", "first_sha256"]))
    trees = [warc_fixity.build_tree(placed.select("offset", "length", F.col(c).alias("hash")).where("hash is not null")) for c in ("first_sha256", "second_sha256")]
    found = warc_fixity.audit(*trees)
    return placed.join(found, "offset").select("page_id", F.col("offset").alias("record_offset"), F.col("length").alias("record_length"), "damage", "first_sha256", "second_sha256")

"""One query per operator, over its whole table with production parameters, in the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidecast.llm import (
    chat, filter_audit, fingerprint, language_id, mixing, neighbours, ngram_join, packing, prefix_trie, quality, suffix_dedup, token_counts, warc,
)
from tidecast.llm.common import fold_column, read_table
from tidecast.llm.oracle import ORACLE as ORACLE
from tidecast.workspace import new_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
WORD_VOCABULARY, PIECE_VOCABULARY, BYTE_VOCABULARY = "word_bpe_49k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"
#: A conversation whose texts hold the usual marks of chat templates.
PROBE = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]
HELD_OUT_FOLD = 1


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.removed(read_table(spark, sf_dir, "documents"), keep=("doc_id",))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
                       (F.col("n_removed") > 0).alias("has_repeat"))


@query
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.copies(read_table(spark, sf_dir, "documents"))
    return rows.select(F.col("key").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


@query
def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read_table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0)


@query
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.createDataFrame(PROBE, "conv_id long, turn int, role string, text string"))
    path = public_tokenizers.path(BYTE_VOCABULARY)
    rows = chat.read_back(chat.format_chats(turns, path), path)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return rows.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"), "formatted_chars")


@query
def op5_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(read_table(spark, sf_dir, "documents"))


@query
def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(read_table(spark, sf_dir, "documents"))


@query
def op7_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def quality_model(spark: SparkSession, sf_dir: str) -> dict | None:
    """Learned from labelled documents outside the held-out fold."""
    labels = read_table(spark, sf_dir, "labels").where(fold_column("doc_id") != HELD_OUT_FOLD)
    return quality.fit(read_table(spark, sf_dir, "documents"), labels, label="quality")


@query
def op8_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality_model(spark, sf_dir))
    return scored.select("doc_id", F.coalesce(fold_column("doc_id") == HELD_OUT_FOLD, F.lit(False)).alias("held_out"), "score", "predicted")


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, public_tokenizers.path(PIECE_VOCABULARY)).drop("text")


def language_model(docs: DataFrame) -> dict | None:
    """Learned from documents with a language outside the held-out fold."""
    return language_id.fit(docs.select("doc_id", "text", "lang").where(fold_column("doc_id") != HELD_OUT_FOLD))


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = language_id.identify(docs.select("doc_id", "text"), language_model(docs))
    return found.select("doc_id", F.coalesce(fold_column("doc_id") == HELD_OUT_FOLD, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op11_warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_archives(read_table(spark, sf_dir, "pages"), new_folder(spark, "archives"), key="page_id", uri="url", payload="html")
    rows = warc.records(warc.read_archives(spark, path, with_data=False))
    return rows.select(F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    masks = filter_audit.failures(read_table(spark, sf_dir, "documents"))
    return filter_audit.audit(spark, filter_audit.labelled_counts(masks, read_table(spark, sf_dir, "labels")))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(read_table(spark, sf_dir, "conversations"))))

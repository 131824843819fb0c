"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treadle.llm import conversations, embeddings, jaccard, licenses, packing, pii, quality, sentencepiece_codec, subwords, token_counts, toxicity, warc, whitening
from treadle.session import run_folder

PIECES, WORDS = "piece_bpe_32k.model", "word_bpe_49k.json"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Near duplicates among all vectors."""
    return embeddings.near_duplicates(spark, _table(spark, folder, "embeddings")).withColumnRenamed("id", "vec_id")


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to archives and read back from them."""
    archives = warc.archive(spark, _table(spark, folder, "pages"))
    return warc.read_records(archives, payloads=False).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics and verdict of every document."""
    judged = quality.assess(spark, _table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return judged.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept", "rule")


def stored_stage(spark: SparkSession, docs: DataFrame, name: str) -> str:
    """The folder a stage's rows were written to."""
    folder = run_folder(spark, name.replace(" ", "-"))
    docs.write.parquet(folder)
    return folder


def packed(spark: SparkSession, docs: DataFrame, window: int = 2048) -> DataFrame:
    """Pieces of the documents with checksums of their ids and their places in the sequences."""
    pieces = packing.stored_pieces(spark, docs, public_tokenizers.path(WORDS), end_id=1, window=window)
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.place(digests, window).select(
        F.col("id").alias("doc_id"), "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens",
        "sequence_id", "offset")


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in windows of 2048 tokens."""
    return packed(spark, _table(spark, folder, "documents"))


def op5_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents with a similarity of 0.9 in three-word shingles."""
    return jaccard.similar_documents(spark, _table(spark, folder, "documents"), size=3, part=90).withColumnRenamed("id", "doc_id")


def op6_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License notices of every document."""
    return licenses.scan(_table(spark, folder, "documents")).drop("spans").withColumnRenamed("id", "doc_id")


def held_out() -> Column:
    """Rows whose labels are not learned from."""
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def toxic_lexicon(spark: SparkSession, docs: DataFrame, folder: str) -> toxicity.Lexicon:
    return toxicity.learn(spark, docs, _table(spark, folder, "labels").where(~held_out()))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document."""
    docs = _table(spark, folder, "documents")
    scored = toxicity.weigh(docs, toxic_lexicon(spark, docs, folder)).withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document."""
    return pii.scan(_table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


def op9_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and decoded text of every document, as counts and hashes."""
    return sentencepiece_codec.round_trip(
        _table(spark, folder, "documents"), public_tokenizers.path(PIECES)).withColumnRenamed("id", "doc_id")


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token count of every document, and whether it is over 4096."""
    return token_counts.count_tokens(
        _table(spark, folder, "documents"), public_tokenizers.path(PIECES), limit=4096).withColumnRenamed("id", "doc_id")


def op11_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document."""
    docs = _table(spark, folder, "documents")
    classifier = subwords.learn(spark, docs, _table(spark, folder, "labels").where(~held_out()))
    return subwords.score(docs, classifier).withColumnRenamed("id", "doc_id").select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """The eight largest components of every vector, whitened."""
    return whitening.whiten(spark, _table(spark, folder, "embeddings")).withColumnRenamed("id", "vec_id")


def op13_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Faults of every damaged conversation and its cheapest repair."""
    given = _table(spark, folder, "conversations")
    messages = conversations.damage(given)
    return conversations.summaries(messages, conversations.edits(spark, messages), given.select(
        F.col("conv_id").alias("conv")).distinct()).withColumnRenamed("conv", "conv_id")


QUERIES = {f.__name__: f for f in (
    op1_embeddings, op2_warc, op3_quality, op4_packing, op5_jaccard, op6_licenses, op7_toxicity, op8_pii,
    op9_sentencepiece, op10_token_counts, op11_classifier, op12_whitening, op13_conversations)}

#: DuckDB SQL of those that SQL can express; tests/llm holds the others against brute force.
ORACLES: dict[str, str] = {"op1_embeddings": embeddings.oracle(), "op2_warc": warc.oracle(), "op5_jaccard": jaccard.oracle(3, 90, 100), "op6_licenses": licenses.oracle()}

"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm.alignment import align_tokenizers
from starfold.llm.byte_bpe import decimal_ids, decode_documents, encode_documents
from starfold.llm.common import fresh_path, load
from starfold.llm.exact_dedup import exact_dedup
from starfold.llm.jaccard_join import similarity_classes
from starfold.llm.language import predict_language
from starfold.llm.packing import encode_pieces, pack_documents
from starfold.llm.pii import KINDS, as_text, personal_data
from starfold.llm.periodic_runs import periodic_runs
from starfold.llm.quality import quality_scores
from starfold.llm.substring_dedup import remove_repeats
from starfold.llm.token_files import read_documents, write_token_files
from starfold.llm.top_k import exact_top_k
from starfold.llm.warc import read_archive, rebuild, write_archive


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written as Arrow stream files and read back."""
    path = fresh_path(spark, "token-files")
    write_token_files(load(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_documents(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of windows of 13 words that an earlier document has are removed."""
    found = remove_repeats(load(spark, sf_dir, "documents"), window=13)
    return found.select("doc_id", "passages.n_words", "passages.n_removed", F.sha2(F.col("passages.kept_text").cast("binary"), 256).alias("kept_sha256"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of whole texts by a rank file, and the bytes they decode to."""
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = encode_documents(load(spark, sf_dir, "documents"), ranks, pattern)
    decoded = decimal_ids(decode_documents(encoded, ranks, pattern))
    return decoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("decimal").cast("binary"), 256).alias("ids_sha256"), F.sha2("content", 256).alias("decoded_sha256"),
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record per page, written and read back with its payload."""
    path = fresh_path(spark, "warc")
    write_archive(load(spark, sf_dir, "pages"), path, least_bytes=0)
    headers, payloads = read_archive(spark, path, content=False)
    whole = rebuild(headers, payloads, "payload_bytes", "payload_digest")
    return whole.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pieces in sequences of at most 4096 ids."""
    pieces = encode_pieces(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=4096)
    packed = pack_documents(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), 4096)
    return packed.select("key", "piece", "start", "length", "ids_crc32", F.col("sequence").alias("sequence_id"), "offset").withColumnRenamed("key", "doc_id")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    scored = quality_scores(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best integer inner products of every twentieth vector."""
    return exact_top_k(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 4-word shingles have a similarity of 0.85 or more."""
    found = similarity_classes(load(spark, sf_dir, "documents"), n=4, percent=85)
    return found.select("doc_id", F.col("n_grams").alias("n_shingles"), "component_id")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of identical texts and the row of each that stays."""
    found = exact_dedup(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return predict_language(load(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of fixed form, and what its contexts tell besides."""
    found = personal_data(load(spark, sf_dir, "documents"))
    counts = [F.expr(f"size(filter(base, s -> s.kind = {k}))").cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(as_text("base").cast("binary"), 256).alias("base_sha256"), as_text("spans").alias("spans"))


def _with_periods(docs: DataFrame) -> DataFrame:
    """Every tenth document by the hash of its id repeats a block of its own words from some word on."""
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = docs.select("doc_id", "text", (hashed / 10).cast("long").alias("g"), F.when(hashed % 10 == 0, words).alias("w"))
    n = F.size("w")  # -1 or null for documents that stay
    placed = split.select("*", F.when(n > 0, F.pmod("g", n).cast("int")).alias("a"))
    block = F.lit(1) + ((n - F.col("a")) / (3 + F.col("g") % 8)).cast("int")
    turns = ((n - F.col("a")) / block).cast("int") + 1
    tail = F.slice(F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, block), turns)), F.lit(1), n - F.col("a"))
    whole = F.concat_ws(" ", F.slice("w", F.lit(1), F.col("a")), tail)
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), whole).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of at least six words and four periods, the longest of each document, and the words that they leave."""
    found = periodic_runs(_with_periods(load(spark, sf_dir, "documents")), length=6, exponent=4)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    told = found.select("*", best.alias("best"))
    return told.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.l").alias("length"),
        (-F.col("best.p")).alias("period"), F.expr("1000 * best.l div -best.p").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers aligned by bytes, with the corpus-wide counts of the linked pairs."""
    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    found = align_tokenizers(load(spark, sf_dir, "documents"), *files, digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_files, op2_substring_dedup, op3_byte_bpe, op4_warc, op5_best_fit_packing, op6_quality,
        op7_exact_top_k, op8_jaccard_join, op9_exact_dedup, op10_language_id, op11_pii, op12_periodic_runs, op13_alignment,
    )
}

"""From raw documents to packed training sequences: five stages, each on what the one before kept.

    run(spark, sf_dir)   # applies STAGES to the documents of a folder

Every stage but the last returns the columns of ``documents``; each result is
written as Parquet in the shared folder and read again. Null texts count as empty
in every stage, other columns pass through as they are, whatever their names; ``n_chars``, where there
is one, follows the text. An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm.common import fresh_path, load, quoted, ready, unused
from starfold.llm.exact_dedup import keep_one
from starfold.llm.jaccard_join import keep_one_of_each
from starfold.llm.packing import encode_pieces, pack_documents
from starfold.llm.quality import keep_good
from starfold.llm.substring_dedup import remove_repeats
from starfold.sources import write_table

CAPACITY, END_ID = 4096, 1


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.3 or more."""
    return keep_good(docs, load(spark, sf_dir, "labels"), least=0.3)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the largest doc_id."""
    ready(spark)
    return keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by sets of five-word shingles with a similarity of 0.8 or more, the smallest doc_id."""
    ready(spark)
    return keep_one_of_each(docs, n=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of 13-word windows that an earlier document has; other texts stay as they are."""
    ready(spark)
    into = unused(docs, "passages")
    found = remove_repeats(docs, window=13, into=into)
    passages = F.col(quoted(into))
    changed = {"text": passages["kept_text"], "n_chars": F.char_length(passages["kept_text"])}

    def own(name: str) -> Column:
        column, kind = F.col(quoted(name)), docs.schema[name].dataType
        return F.when(passages["n_removed"] > 0, changed[name].cast(kind)).otherwise(column).alias(name) if name in changed else column

    return found.select(*[own(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their sequence and place: doc_id, piece, start, length, ids, sequence_id, offset."""
    ready(spark)
    pieces = encode_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID, CAPACITY)
    packed = pack_documents(pieces, CAPACITY)
    return packed.select(F.col("key").alias("doc_id"), "piece", "start", "length", "ids", F.col("sequence").alias("sequence_id"), "offset")


STAGES = [
    ("quality", quality),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]

#: The classifier and the tokenizer are not expressible in SQL; tests/llm compares run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), fresh_path(spark, f"pipeline-{name}"))
    return docs

"""From raw documents to packed training sequences: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airgrid.llm import exact_dedup, mixing, ngram_join, packing, quality_rules
from airgrid.llm.common import cut, dealt, drop_dir, shared_dir, words_of
from airgrid.shipping import ship

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects, with their columns as they are.

    A null or empty text is rejected; repeated rows share their verdict; an empty table stays empty.
    """
    return quality_rules.survivors(docs.select(*COLUMNS))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each normalised text: the longest original, then the smallest id, null ids last.

    Of rows that repeat that id and text one stays; null counts as the empty text; an empty table stays empty.
    """
    return exact_dedup.deduplicate(docs, columns=COLUMNS).where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the smallest id.

    Rows are dropped by id and text, so of rows that repeat an id only those whose own text is a near copy go; of those
    that repeat an id and its words one stays. Rows with a null id or without words are no near copies and stay; an empty
    table stays empty.
    """
    ship(spark)
    docs = docs.select(*COLUMNS)
    dropped = ngram_join.join(docs).where("not represents").select("doc_id", "t1", "t2").distinct()
    left = docs.select(*COLUMNS, *ngram_join.text_hashes(F.col("text"))).join(dropped, ["doc_id", "t1", "t2"], "left_anti").select(*COLUMNS)
    again = cut(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1 and doc_id is not null").select("doc_id"))
    if again.isEmpty():
        return left
    words = words_of(F.col("text"))
    once = left.join(again, "doc_id", "left_semi").withColumn("words", F.when(F.size(words) > 0, F.concat_ws(" ", words)).otherwise(F.col("text")))
    once = once.dropDuplicates(["doc_id", "words"]).select(*COLUMNS)
    return left.join(again, "doc_id", "left_anti").select(*COLUMNS).unionByName(once)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    Rows that repeat an id are taken each for itself; a null source is a source; texts without words are not taken; an
    empty table stays empty.
    """
    return mixing.rows_taken(docs.select(*COLUMNS))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens. A null or empty text is its end token alone; an empty table stays empty."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("sequences", sequences),
]

#: Minhash buckets, apportionment and tokenizing have no SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage over what the stages before it wrote. A stage's table goes once the next one is written; the last table stays for the result."""
    docs = dealt(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    written = None
    for name, stage in STAGES[:-1]:
        path = shared_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if written:
            drop_dir(spark, written)
        written = path
    return STAGES[-1][1](spark, docs, sf_dir)

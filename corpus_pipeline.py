"""The corpus pipeline. Every stage takes (spark, docs, sf_dir), works on all rows of docs and returns a DataFrame that is
written as Parquet and read again as the next stage's docs. All but the last return the columns of `documents`.

Rows keep their extra columns' names out: only the columns of `documents` go through. Null and empty texts pass every
stage (an empty text is accepted or rejected by the classifier's bias like any other); tables may be empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm import bpe, decontam, entries, linededup, minhash, quality
from skyloom.llm.common import table, without, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. It is trained on labelled rows of the corpus as delivered."""
    scored = quality.scored(docs.select(*COLUMNS), entries.quality_weights(spark, sf_dir))
    return scored.where(F.col("score") >= entries.ACCEPT).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that earlier ones match; a document that loses every line goes. n_chars follows the text."""
    cut = linededup.deduplicated(docs.select(*COLUMNS))
    left = cut.where((F.size("removed") == 0) | (F.size("removed") < F.col("n_lines")))
    return left.withColumn("n_chars", F.when(F.size("removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: the one with the least doc_id, then the least hash of its text.

    Rows are told apart by doc_id and text, so another text under a doc_id that goes stays. Of rows that are equal in both, one stays
    if they hold a word.
    """
    docs = docs.select(*COLUMNS)
    found = written(minhash.near_duplicates(docs).select("doc_id", "tag", "n_shingles", "first"))
    left = without(docs, found.where("NOT first"))
    again = written(found.where("first AND n_shingles > 0").groupBy("doc_id", "tag").count().where("count > 1").select("doc_id", "tag"))
    if again.isEmpty():
        return left
    # rows given several times: the same table without them, and one of each
    twice = left.withColumn("_tag", F.xxhash64(F.col("text").cast("string"))).join(again.withColumnsRenamed({"doc_id": "_of", "tag": "_as"}), F.col("doc_id").cast("long").eqNullSafe(F.col("_of")) & (F.col("_tag") == F.col("_as")), "left_semi")
    return without(left, again).unionByName(twice.dropDuplicates(["doc_id", "_tag"]).drop("_tag"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no passage of the benchmark; another text under the doc_id of one that does stays."""
    docs = docs.select(*COLUMNS)
    return without(docs, decontam.passages(docs, table(spark, sf_dir, "benchmark")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit), and whether they decode to the text."""
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = bpe.encode_and_decode(docs, ranks)
    return coded.select("doc_id", F.expr("cast(length(ids) div 4 AS long)").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("text_sha256"))


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", dedup_lines),
    ("MinHash near-dedup", dedup_documents),
    ("benchmark decontamination", decontaminate),
    ("byte-level BPE", encode),
]
#: The classifier, the set joins and BPE aren't expressible in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs

"""From raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; the result of each is written as
Parquet and read back as the next one's `docs`. All but the last return the columns of `documents`
(and any others that came along).

1. quality rules: documents that fail the surface rules or whose n-grams look unlike trusted ones go;
2. line dedup: later copies of runs of lines with 50 words or more are deleted, documents left empty go;
3. n-gram Jaccard join: of each class of near duplicates the document with the lowest id stays;
4. decontamination: documents that hold a benchmark item go;
5. packing: token pieces of full sequences.

Null and empty texts fail stage 1; stages 2 to 5 pass them on as their operators define. Rows equal in
id and text are one document. An empty table gives an empty result in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontam, jaccard_join, line_dedup, packing, quality
from quarry.llm.common import materialize, table
from quarry.llm.queries import END_ID, SEQUENCE_TOKENS, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one_per_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack(docs, tokenizer_path("word_bpe_49k.json"), SEQUENCE_TOKENS, END_ID)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", sequence_packing),
]

#: The exact joins, edit distances and tokens of these stages have no SQL; tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: quality, exact copies, near copies, mixture, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. Every stage but the last returns the columns of ``documents``;
each result is written as Parquet to the shared folder and read again as the
next stage's documents. The stages' own choices for nulls, ties, repeated rows and
empty tables are those of their operators (see ``ledgerline/llm``):

* quality: rows that the classifier rejects go; without labels all stay.
* exact_dedup: of equal texts the row with the largest doc_id stays.
* near_dedup: of each group of documents linked at Jaccard 0.75 over 5-word shingles
  the one with the smallest doc_id stays (a null id is the largest; of equal ids, the text with the
  smallest digest); documents without words stay.
* mix: sources at weights 1, 2, 3, repeating; a document comes once for each pass that takes
  it, always with its whole text (a source's words are off its target by half a document
  at most); documents without words are in no mix.
* pack: every piece's place in sequences of at most 4096 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm.common import documents, keep_table
from ledgerline.llm.exact_dedup import drop_copies
from ledgerline.llm.mixing import mixed_documents
from ledgerline.llm.ngram_join import drop_near_copies
from ledgerline.llm.packing import pack
from ledgerline.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mix", mix), ("pack", pack_sequences)]

# the classifier, the hash-ordered mixture and the tokenizer have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = keep_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""A training corpus from raw documents: five stages, each one operator of ``quantloom.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
frame.  ``run`` applies them to the documents table; each result is written to the
shared folder and read again as the next stage's documents.

Defined cases, in every stage: null and empty texts go through like others (they are copies
of one another for near-dedup) and a null doc_id is a row like another; very long texts are
worked on whole; rows written twice are judged alike and one stays after near-dedup; extra
columns, whatever their names, are kept up to the last stage; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quantloom.llm import decontaminate, line_dedup, packing, quality, queries, simhash
from quantloom.llm._spark import bound_batches, materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: the documents that it rejects go."""
    bound_batches(spark)
    return quality.keep_good(docs, quality.fit(docs, queries.table(spark, sf_dir, "labels")))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines of many sites stay in one document only."""
    bound_batches(spark)
    return line_dedup.remove_boilerplate(docs, min_sites=8).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each group of near copies (five-word shingles, similarity of 0.8 and more) the document with the smallest doc_id stays, and one row of it."""
    bound_batches(spark)
    return simhash.drop_near_duplicates(docs, size=simhash.STAGE_SHINGLE, similarity=simhash.SIMILARITY)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: passages of test items are cut; what is mostly such a passage goes."""
    return decontaminate.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"), window=decontaminate.WINDOW)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: where each piece of each document lies in the training sequences."""
    bound_batches(spark)
    return packing.pack_documents(docs, queries.tokenizer_path(), length=packing.LENGTH, end_id=packing.END_ID)


STAGES = [
    ("quality classifier", drop_poor),
    ("line dedup", drop_boilerplate),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("best-fit packing", pack),
]

#: The classifier and the similarity groups are beyond SQL; tests/llm compares line dedup, near-dedup, decontamination and packing with plain versions, and the classifier with held-out labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs, "stage")
    return docs

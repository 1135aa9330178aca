"""Corpus pipeline: five operators over the documents, each stage on what its predecessor kept.

1. quality: documents the classifier rejects go;
2. near duplicates: one document (the least id) of each group of similar texts stays;
3. decontamination: documents holding a benchmark passage go;
4. secrets: every secret found is masked in the text, widely copied or not;
5. tokens: what is left is encoded and decoded again.

Every stage but the last returns the columns of ``documents``.  Rows alike in
id and text are alike to every decision, so no stage needs another row key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity.llm.bpe import encode_texts
from veracity.llm.decontaminate import drop_leaks
from veracity.llm.jaccard_join import keep_one_of_each
from veracity.llm.quality import keep_good
from veracity.llm.queries import vocabulary_path
from veracity.llm.secrets import mask_secrets
from veracity.session import materialize, scratch_tables

#: The rows depend on trained weights and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaks(docs, _table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mask_secrets(docs, copied=True).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_texts(docs, vocabulary_path(), digest=True)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage over its predecessor's table; earlier tables, and those stages leave, go once their successor is written."""
    with scratch_tables() as tables:
        docs = _table(spark, sf_dir, "documents")
        for name, stage in STAGES[:-1]:
            before = docs
            with scratch_tables() as own:
                docs = own.keep(materialize(stage(spark, before, sf_dir), f"pipeline-{name}"))
            tables.drop(before)
        tables.keep(docs)
    return STAGES[-1][1](spark, docs, sf_dir)

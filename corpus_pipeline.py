"""A training corpus in five stages: quality rules, line dedup, near-duplicate
removal, mixing of sources, packing into sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents. All but the last
return the columns of ``documents``; a changed text gets its own n_chars.

Nulls and edges: a null, empty or wordless text fails the first stage's base rules and goes;
null ids and sources, repeated rows and very long texts pass as each operator's docstring says;
extra columns, also of names that operators use inside, are kept up to the last
stage; an empty table gives no rows in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.llm import line_dedup, minhash, mixing, packing, quality_rules
from pickwise.session import ensure_checkpoint_dir


def _with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.select(*columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the tokeniser-fertility bands keep."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that ten or more sources share."""
    return _with_length(line_dedup.dedup_lines(docs), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return minhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    return _with_length(mixing.mixed_rows(docs), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in sequences of 4096 ids."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]

#: SQL can express neither tokenisation nor MinHash classes; tests/llm/test_pipeline.py
#: compares every stage of run() with brute force or SQL on the stage's own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of sf_dir; each stage's output is written to
    the shared checkpoint folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = ensure_checkpoint_dir(spark)
    run_id = spark.sparkContext._jvm.java.util.UUID.randomUUID().toString()
    for i, (name, stage) in enumerate(STAGES):
        out = f"{base.rstrip('/')}/pipeline-{run_id}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs

"""The corpus pipeline: five stages from raw documents to packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.common import saved
from millrace.llm.line_dedup import dedup_lines
from millrace.llm.ngram_join import keep_one_of_class
from millrace.llm.packing import pack_documents
from millrace.llm.pii import mask_documents
from millrace.llm.quality import keep_good

#: Each takes (spark, docs, sf_dir); all but the last return the columns of ``documents``.
STAGES = [
    ("quality_classifier", keep_good),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", keep_one_of_class),
    ("pii", mask_documents),
    ("best_fit_packing", pack_documents),
]
#: SQL can express neither a trained classifier nor a random field; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that the stages keep; each stage is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs

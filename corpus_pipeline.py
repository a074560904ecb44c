"""A training-corpus pipeline over ``documents``: language ID, exact, near and
substring deduplication, packing.  Every stage works on all that the stage
before it kept; all but the last return the columns of ``documents``."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from marketlens.llm import exact, langid, near, packing, substring  # noqa: E402
from marketlens.llm.common import prepare, stored  # noqa: E402


#: Rows and bytes of an Arrow batch in the pipeline: its stages run one after the
#: other in the same Python workers, so each gets less memory than an operator alone.
BATCH_ROWS, BATCH_BYTES = 1000, 1 << 19


def begin(spark: SparkSession) -> None:
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's language is told by its codeword; documents without a
    letter, and those that fit their language worse than texts of their length
    may, so that they are in none of the learned ones, go; the others stay as
    they are."""
    begin(spark)
    codes, fits = langid.learned_and_known(docs)
    return langid.accepted(docs, fits, codes)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, one document stays."""
    begin(spark)
    return exact.exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by shingles of five words at a similarity of 0.8,
    the document of smallest id stays."""
    begin(spark)
    return near.near_dedup(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows of 50 that a document of smaller id also holds go; a
    text that loses none is not touched.  A null text becomes empty."""
    begin(spark)
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    rows = docs.select("doc_id", "text", F.struct(*others).alias("document"))
    cut = substring.remove_repeated_windows(rows, carry=["document"], untouched=True)
    left = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return cut.select(*[left[c].alias(c) if c in left else F.col("document").getField(c).alias(c) for c in docs.columns])


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 4096 tokens."""
    begin(spark)
    return packing.digest(docs)


STAGES = [("language", language), ("exact", exact_copies), ("near", near_copies), ("substring", repeated_passages), ("packing", sequences)]

#: Models and tokenizers can't be expressed in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    begin(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

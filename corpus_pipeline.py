"""The corpus pipeline: quality rules, line dedup, near copies, benchmark decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a table that is written and read again as the next one's ``docs``; all but
the last return the columns of documents. Extra columns of documents pass through all but the last.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.llm import benchmark_decontamination, line_dedup, ngram_jaccard, quality_rules, sentencepiece_codec
from veilspark.sources.scratch import delete, shared_folder, temporary

#: Near copies: five words and a similarity of 0.8.
SHINGLE, PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the trees keep."""
    trees = quality_rules.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    judged = quality_rules.judge(docs, trees, keep={f"c{i}": F.col(c) for i, c in enumerate(docs.columns)})
    return judged.filter("kept").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line equals within the edits, short ones exactly; n_chars follows the text."""
    out = line_dedup.dedup_lines(docs, short_copies=True, removed=None)
    return out.select(*[F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the least doc_id, of equal ones the text with the least hash. Empty texts
    link with nothing and stay."""
    return ngram_jaccard.keep_one(docs, SHINGLE, PERCENT)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of benchmark windows; a document without hits is unchanged."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    out = benchmark_decontamination.clean_texts(docs, benchmark)
    return out.select(*[F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and n_tokens of every document."""
    return sentencepiece_codec.encode(docs, sentencepiece_codec.load_pieces(sentencepiece_codec.default_model()))


STAGES = [("quality rules", quality), ("line dedup", lines), ("near copies", near_copies), ("decontamination", decontaminated), ("tokens", tokens)]
#: SQL can't express the trees of the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, each written as Parquet in the shared folder and read again. A stage's own tables, and the
    table that it has read, are deleted once it is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        path = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
        with temporary(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)

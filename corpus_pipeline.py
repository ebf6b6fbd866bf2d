"""The corpus pipeline: quality, line dedup, n-gram Jaccard join, decontamination, byte-level BPE.

Every stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes
each stage's result and reads it back as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.llm import crf_quality, decontaminate, line_dedup, ngram_join, queries
from vireo.llm.common import Scratch, read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line CRF does not reject."""
    return crf_quality.keep_good(docs, queries.quality_model(docs, spark, sf_dir), queries.GOOD)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that another line stands for, n_chars with them; documents of which nothing is left go."""
    kept = line_dedup.dedup_lines(docs, drop_emptied=True)
    return kept.withColumns({c: F.length("text").cast(kind) for c, kind in docs.dtypes if c == "n_chars"})


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return ngram_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word of an occurring benchmark window."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of what is left."""
    return queries.token_digests(docs)


STAGES = [("quality", quality), ("line_dedup", line_dedup_stage), ("ngram_jaccard", ngram_jaccard), ("decontamination", decontamination), ("byte_bpe", bpe)]

#: No stage's rows can be stated in SQL (a trained model comes first); the tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    scratch = Scratch(spark)
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.cut(stage(spark, docs, sf_dir), name)
        if i:
            scratch.drop(STAGES[i - 1][0])
    return docs

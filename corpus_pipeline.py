"""A corpus pipeline of five stages: reject, clean, dedup, mix, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
docs of the next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswh.llm.bpe import encode_decode
from saleswh.llm.crf_quality import keep_good
from saleswh.llm.line_runs import dedup_lines
from saleswh.llm.pareto_mix import WORDS, pareto_mix
from saleswh.llm.parity_join import jaccard_join
from saleswh.llm.staging import settle


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject, each row on its own; a null text counts as empty."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated line runs; a document of nothing else goes, one that was empty stays."""
    found = dedup_lines(docs).filter("n_removed < n_lines or n_lines = 0")
    changed = F.col("n_removed") > 0
    put = {"text": F.col("kept_text"), "n_chars": F.length("kept_text")}
    return found.select(*[
        F.when(changed, put[f.name].cast(f.dataType)).otherwise(F.col("row").getField(f.name)).alias(f.name)
        if f.name in put else F.col("row").getField(f.name).alias(f.name)
        for f in docs.schema
    ])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies; of rows that repeat key and text, one.

    Documents without words are never near copies. Keys name documents: rows that share a kept key but differ in text all stay, as
    do rows without a key in a group that has no other key.
    """
    groups = jaccard_join(docs)
    kept = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("kept_id")).distinct()
    left = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")
    return left.dropDuplicates(["doc_id", "text"]).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; documents without words go.

    Rows that repeat key and size are taken alike, as often as the one of them that is taken most.
    """
    taken = pareto_mix(docs).groupBy("doc_id", "size").agg(F.max("copies").alias("copies")).filter("copies > 0")
    taken = taken.toDF("taken_id", "taken_size", "taken_copies")
    size = F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0))
    same = F.col("doc_id").eqNullSafe(F.col("taken_id")) & (size == F.col("taken_size"))
    times = F.explode(F.sequence(F.lit(1), F.col("taken_copies")))
    return docs.join(taken, same).withColumn("taken_nth", times).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left, a row for every copy."""
    return encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("mixing sources to target weights", mix),
    ("byte-level BPE", encode),
]

#: The classifier and the tokens are not SQL; tests compare each stage with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = settle(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

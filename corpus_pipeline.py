"""The training-data pipeline: language filter, near-duplicates, repeated passages,
benchmark contamination, encoding.

``STAGES`` lists (name, function) pairs; each function takes (spark, docs,
sf_dir) and returns a DataFrame, which ``run`` writes as Parquet into the shared
folder and rereads as the next stage's docs. All but the last return the columns
of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.llm import byte_bpe, decontamination, jaccard_join, language_id, suffix_dedup
from cartlens.llm.common import stored

#: Least share of a text's letters that its main language must have.
MIN_SHARE = 0.35
#: Shortest repeated passage that is cut, in words: over 50.
PASSAGE = 51


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised main language; without any labelled document nothing is rejected."""
    model = language_id.fit(docs)
    if not model.langs:
        return docs
    out = language_id.identify(docs, model, carry=docs.columns)
    kept = out.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SHARE))
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents."""
    return jaccard_join.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand elsewhere too; a document without any other word goes."""
    out = suffix_dedup.dedup(docs, carry=tuple(docs.columns), words=PASSAGE, with_text=True)
    new = {"text": F.when((F.col("n_removed") > 0) & F.col(f"c{docs.columns.index('text')}").isNotNull(), F.col("kept"))
           .otherwise(F.col(f"c{docs.columns.index('text')}"))}
    if "n_chars" in docs.columns:
        at = F.col(f"c{docs.columns.index('n_chars')}")
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(at).cast(dict(docs.dtypes)["n_chars"])
    kept = out.where((F.col("n_removed") == 0) | F.col("kept").rlike(r"[\p{L}\p{N}]"))
    return kept.select(*[new.get(c, F.col(f"c{i}")).alias(c) for i, c in enumerate(docs.columns)])


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    return decontamination.drop(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), short=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every kept text, with the digests of ids and decoded bytes."""
    return byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                           with_ids=True)


STAGES = [("language_id", language), ("jaccard_join", near_duplicates), ("suffix_dedup", repeated_passages),
          ("decontamination", benchmark_leaks), ("byte_bpe", encode)]

#: A trained classifier, suffix sorting, tiling and BPE have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = out if i == len(STAGES) - 1 else stored(out, f"stage-{name}")
    return docs

"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Every stage works on all rows that the one before kept, and returns the columns of ``documents``.  Defined
results: null, empty and very long texts go through every stage like others (a null text has no words, is no
near copy, and becomes an empty one in substring dedup); rows with the same text are near copies of each
other, so one stays; of repeated rows with one doc_id one stays, rows without doc_id all stay; an empty table
gives an empty result; further columns are carried through.  A stage's folder is deleted when the next stage
is written; the last one holds the result and belongs to the caller.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm import toxicity as tox
from spanloom.llm.common import delete_folder, forget_shuffles, read, shared_folder
from spanloom.llm.decontaminate import drop_contaminated
from spanloom.llm.mixing import emit
from spanloom.llm.ngram_jaccard import keep_one_each
from spanloom.llm.substring_dedup import dedup_substrings

#: Near copies of the pipeline: words of a shingle, and the least similarity.
SHINGLE, SIMILARITY = 5, (80, 100)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; the classifier is fitted to the labelled documents."""
    model = tox.fit(docs, read(spark, sf_dir, "labels"), learn_from=~tox.held_out())
    return tox.drop_toxic(docs, model)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that near-copy links join (shingles of 5 words, Jaccard 0.8 or more) the one
    with the smallest id stays, of rows that share this id one."""
    return keep_one_each(docs, n=SHINGLE, threshold=SIMILARITY)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 20 words that started earlier leave the texts; the kept words are joined by one blank, n_chars
    is counted again; texts may become empty, no document goes."""
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    slim = docs.select("doc_id", "text", F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(others))).alias("row"))
    kept = dedup_substrings(slim, carry=["row"])
    columns = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")} | {c: F.col("row")[f"c{i}"] for i, c in enumerate(others)}
    return kept.select(*(columns[c].alias(c) for c in docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with at least a twentieth of their words in benchmark windows go."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    return emit(docs)


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard", ngram_jaccard),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]
#: A trained classifier decides in the first stage, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over sf_dir's documents; their tables lie in the shared checkpoint folder."""
    folder = f"{shared_folder(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs, before = read(spark, sf_dir, "documents"), None
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(path := f"{folder}/{i}-{name}")
        docs = spark.read.parquet(path)
        if before is not None:
            delete_folder(spark, before)
        before = path
        forget_shuffles(spark)
    return docs

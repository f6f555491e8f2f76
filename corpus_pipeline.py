"""A training-data pipeline over ``documents``: stages that each work on what the one before kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spokecast.llm import bpe, decontaminate, jaccard, recompression, toxicity
from spokecast.llm.registered import table, vocabulary
from spokecast.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic; its labels come from the table ``labels``.

    Null and empty texts score as texts without votes; without labels of both classes, and on an empty table, all stay.
    """
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles, the one of the least key.

    Null and empty texts are in no group and stay; of repeated rows one stays, and a row without a key only where its
    group has no other.
    """
    return jaccard.representatives(docs, width=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that repeat an earlier passage of 20 words; ``n_chars`` follows the text.

    Every row stays, if only with an empty text; null texts stay null.  Rows without a key count as the earliest.
    """
    return recompression.without_repeats(docs, length_col="n_chars")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty stands in a benchmark window.

    Rows are judged one by one; null and empty texts have no words and stay, and so do all where the benchmark is empty.
    """
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, how many they are, and the SHA-256 of the text that they decode to.

    A row for each document, repeated keys and those without one included; null and empty texts have no ids.
    """
    path = vocabulary()
    ids = bpe.encode(docs, path)
    decoded = bpe.decode(ids, path)
    return decoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("text_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", tokens),
]

#: Trained classifiers and BPE are beyond SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are kept in the shared folder for the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        path = scratch_path(spark, f"stage-{i}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

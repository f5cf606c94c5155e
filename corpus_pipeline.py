"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next stage's docs. All stages but the last return the columns of documents.

A null text fails the quality rules. Rows that repeat a doc_id with the same text are one document
after the second stage; a null doc_id is carried along. Empty tables pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metroscope.llm.decision_lists import learned_rules, verdicts_of
from metroscope.llm.jaccard_join import similar_components
from metroscope.llm.mixing import in_mixed_order
from metroscope.llm.packing import packed
from metroscope.llm.queries import MIX_BLOCK, MIX_DEFAULT, MIX_PARTS
from metroscope.llm.secret_scan import redact_secrets
from metroscope.llm.storage import documents, labels, staged
from metroscope.llm.tokens import vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the learned decision list; the others go."""
    rules = learned_rules(docs, labels(spark, sf_dir))
    # Once the rules are known, one scan applies them: no text is written besides the result.
    return verdicts_of(docs, F.struct(*COLUMNS), rules).where("kept").select(*[F.col(f"row.{c}").alias(c) for c in COLUMNS])


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the one whose doc_id is the smallest."""
    kept = similar_components(docs, percent=80, size=5, orders=3).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("kept"))
    same = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.lit(0))
    # The rows with an id join on it alone, so that one shuffle serves the join and the window.
    numbered = docs.select(*COLUMNS).join(kept, F.col("doc_id") == F.col("kept"), "left_semi")
    others = docs.select(*COLUMNS).where("doc_id is null").join(kept.where("kept is null"), F.col("doc_id").eqNullSafe(F.col("kept")), "left_semi")
    first = [rows.withColumn("copy", F.row_number().over(same)).where("copy = 1").select(*COLUMNS) for rows in (numbered, others)]
    return first[0].unionByName(first[1])


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    return redact_secrets(docs, COLUMNS, rate=0.01, level=0.001)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix: the files written hold consecutive slots, each file sorted."""
    return in_mixed_order(docs, COLUMNS, MIX_PARTS, MIX_DEFAULT, MIX_BLOCK)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences. Every file, and so every run of mixed slots, is packed by itself: sequences hold neighbours of the mix."""
    return packed(docs, vocabulary("byte_bpe_50k.json"), end_id=0)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("secret scans", secret_scans),
    ("mixing sources", source_mixing),
    ("packing", packing),
]

# Learned rules and tokens are beyond SQL; the stages are tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

"""The corpus pipeline: quality, exact and near duplicates, test items, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a DataFrame; all but the last return the columns of ``documents``.
Between stages the rows are written as Parquet and read back. A row is judged
by its text (null counts as empty) and named by ``doc_id``; rows repeating a
``doc_id`` (or having none) are judged each by its own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricelake.llm import decontam, exact_dedup, near_dedup, packing, quality
from pricelake.llm.common import ship, stage, table
from pricelake.llm.queries import packed_pieces


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.drop_rejected(docs, table(spark, sf_dir, "labels"))


def keep_first_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def keep_one_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, 0.8)."""
    return near_dedup.drop_near_copies(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packed_pieces(packing.pack(docs))


STAGES = [("quality", keep_quality), ("exact_dedup", keep_first_copy), ("near_dedup", keep_one_near),
          ("decontamination", keep_clean), ("packing", pack)]

#: Model scores, signatures, alignments and token ids have no SQL form; the
#: stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, keep in STAGES[:-1]:
        docs = stage(keep(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

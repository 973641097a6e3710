"""A corpus from raw documents to packed sequences: five stages, each one an operator of ``tablejobs.llm``.

A stage takes what its predecessor kept, written as Parquet and read again; all but the last return the columns of
``documents``.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablejobs.llm import decontaminate, language, line_dedup, near_copies, packing  # noqa: E402
from tablejobs.llm.common import fold, read  # noqa: E402
from tablejobs.storage import materialize  # noqa: E402


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be recognised; texts without letters and unlike any language go."""
    found = language.identify(docs, fold(F.col("doc_id"), 4) != 2, keep_rows=True)
    return found.where(~F.col("rejected")).select("row.*")


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines and passages that an earlier document has go; so does a document that holds nothing else."""
    found = line_dedup.dedup_texts(docs).where("kept")
    columns = {name: F.col(f"row.`{name}`") for name in docs.columns if name != "text"}
    columns["text"] = F.col("text")
    if "n_chars" in columns:
        changed = (F.col("n_dropped") > 0) | (F.col("n_cut") > 0)
        columns["n_chars"] = F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType))
        columns["n_chars"] = F.coalesce(columns["n_chars"], F.col("row.n_chars"))
    return found.select(*[columns[name].alias(name) for name in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that pairs of at least 0.8 (five-word Jaccard) connect stays, the one with the lowest id.

    Pairs come from SimHash fingerprints and vantage-point trees, as in op4, and from a prefix filter that finds those
    fingerprints miss; each is verified on the whole sets.
    """
    return near_copies.first_of_each_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item, or a whole shorter item, go."""
    return decontaminate.clean_rows(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, packed into sequences of 4,096 tokens."""
    import public_tokenizers

    packed = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packed.withColumnRenamed("id", "doc_id")


#: Rows, most of them a few thousand characters, that a stage sends to a worker at once where the session says nothing
#: else: on both sides a batch takes memory for each task.
BATCH = 2_000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _in_small_batches(stage):
    """The stage, with ``BATCH`` set in its session: what it returns is computed later, so the setting stays."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if int(spark.conf.get(_ROWS)) == 10_000:  # Spark's default
            spark.conf.set(_ROWS, str(BATCH))
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    (name, _in_small_batches(stage))
    for name, stage in (
        ("language_id", identify_language),
        ("line_dedup", drop_recurring_lines),
        ("near_dedup", drop_near_duplicates),
        ("decontamination", drop_contaminated),
        ("packing", pack),
    )
]

#: No SQL: models, trees and packing lie beyond it. Tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs

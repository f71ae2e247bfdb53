"""The corpus pipeline: five operators over documents, each on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillspan.llm.common import small_batches, written
from quillspan.llm.language import with_language
from quillspan.llm.mixing import mixed
from quillspan.llm.packing import pack_documents
from quillspan.llm.queries import table, tokenizer_path
from quillspan.llm.simhash import deduplicated
from quillspan.llm.toxicity import without_toxic


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter (null and empty texts too), and those whose language stays unclear, go; see with_language for odd rows."""
    small_batches(spark)
    return with_language(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; null and empty texts stay. Labels come from the table labels. See without_toxic for odd rows."""
    small_batches(spark)
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents alike in their five-word shingles (0.8 or more) that of the smallest doc_id stays. See deduplicated for odd rows."""
    small_batches(spark)
    return deduplicated(docs, n=5, similarity=0.8)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stand as often as their source's target asks for; null sources are a source of their own. See mix for odd rows."""
    small_batches(spark)
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens; null and empty texts are an end id. See pack_documents for odd rows."""
    small_batches(spark)
    return pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

#: The stages rest on trained models and fingerprints, which SQL can't express; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; each stage's rows are a table that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

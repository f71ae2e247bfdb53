"""The compressed form of results: a default status and the positions that differ from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def decode_statuses(results: DataFrame, chunk_size: int) -> DataFrame:
    """key, pos, status of each observed position.

    results: key, candidate_source, chunk_id, candidates_probed_unique, default_status, exceptions (an array of
    [position, status]). Positions of exceptions are global for specs and epochs, local for batches. Results
    without a default status have no observations. Where results list `positions`, those were observed; else the
    first candidates_probed_unique.
    """
    src = F.coalesce("candidate_source", F.lit(""))
    offset = F.when(((src == "spec") | src.startswith("epoch:")) & F.col("chunk_id").isNotNull(), F.col("chunk_id") * chunk_size).otherwise(F.lit(0))
    n = F.coalesce("candidates_probed_unique", F.lit(0)).cast("long")
    empty = F.expr("cast(array() as array<bigint>)")
    prefix = F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(empty)
    observed = F.coalesce("positions", prefix) if "positions" in results.columns else prefix
    x = results.where(F.coalesce("default_status", F.lit("")) != "").select(
        "key", F.col("default_status").alias("__d"), offset.alias("__o"), observed.alias("__n"),
        F.expr("array_sort(transform(coalesce(exceptions, cast(array() as array<array<string>>)), (e, i) -> named_struct('k', cast(e[0] as bigint), 'i', i, 'v', e[1])))").alias("__e"),
    )
    # a position given twice keeps its last status
    last = F.expr("map_from_entries(transform(filter(__e, (e, i) -> i = size(__e) - 1 or get(__e, i + 1).k <> e.k), e -> named_struct('k', e.k, 'v', e.v)))")
    x = x.select("key", "__d", "__o", last.alias("__m"), F.explode("__n").alias("pos"))
    return x.select("key", "pos", F.coalesce(F.try_element_at("__m", F.col("pos") + F.col("__o")), "__d").alias("status"))


def encode_statuses(observed: DataFrame) -> DataFrame:
    """key, default_status (the most frequent, ties to the one seen first), exceptions by position, statuses, n; of (key, pos, status)."""
    counts = observed.groupBy("key", "status").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"))
    w = Window.partitionBy("key").orderBy(F.desc("n"), "first")
    ranked = counts.withColumn("r", F.row_number().over(w))
    heads = ranked.groupBy("key").agg(F.max(F.when(F.col("r") == 1, F.col("status"))).alias("default_status"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("statuses"), F.sum("n").alias("n"))
    odd = observed.join(heads.select("key", "default_status"), "key").where("status <> default_status")
    lists = odd.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("pos", "status"))).alias("exceptions"))
    return heads.join(lists, "key", "left").select("key", "default_status", F.coalesce("exceptions", F.expr("cast(array() as array<struct<pos:bigint,status:string>>)")).alias("exceptions"), "statuses", "n")


def batch_positions(batches: DataFrame) -> DataFrame:
    """batch_id, pos and the candidate's fields of retry batches (candidates: an array of structs)."""
    return batches.select("batch_id", F.posexplode("candidates").alias("pos", "c")).select("batch_id", F.col("pos").cast("long").alias("pos"), "c.*")

"""Predicted windows of series without an observation: from neighbours, from the suffix family, or by regression."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import series_number, series_suffix

# How far apart neighbours' numbers are at most, and the half width in ms around a single neighbour.
NEIGHBOUR_DISTANCE, SINGLE_MS = 3, 5_000
#: The regression's window is so many of its largest residuals to either side.
RESIDUALS = 5.0


def neighbours(series: DataFrame, anchors: DataFrame) -> DataFrame:
    """map_id, contributors, lo, hi, confidence: from anchors with a number at most 3 away. A band join, made an equi-join on the distance."""
    s = series.select("map_id", series_number(F.col("map_id")).alias("__n"))
    s = s.where("__n is not null").withColumn("__k", F.explode(F.sequence(F.col("__n") - NEIGHBOUR_DISTANCE, F.col("__n") + NEIGHBOUR_DISTANCE)))
    a = anchors.select(F.col("map_id").alias("other"), "anchor_ms", series_number(F.col("map_id")).alias("__k"))
    near = s.join(a, "__k").where("other <> map_id")
    g = near.groupBy("map_id").agg(F.count(F.lit(1)).alias("contributors"), F.min("anchor_ms").alias("a"), F.max("anchor_ms").alias("b"))
    single = F.col("contributors") == 1
    return g.select(
        "map_id", "contributors",
        F.when(single, F.col("a") - SINGLE_MS).otherwise(F.col("a")).alias("lo"), F.when(single, F.col("b") + SINGLE_MS).otherwise(F.col("b")).alias("hi"),
        F.when(single, "MEDIUM").when(F.col("a") == F.col("b"), "HIGH").otherwise("LOW").alias("confidence"),
    )


def family_pool(anchors: DataFrame) -> DataFrame:
    """suffix, contributors, lo, hi: the span of the anchors that share a suffix."""
    a = anchors.withColumn("suffix", series_suffix(F.col("map_id"))).where("suffix is not null")
    return a.groupBy("suffix").agg(F.count(F.lit(1)).alias("contributors"), F.min("anchor_ms").alias("lo"), F.max("anchor_ms").alias("hi"))


def regression(anchors: DataFrame) -> DataFrame:
    """One row: n, slope, intercept and the largest residual of the anchors on their numbers. Values are centred, which keeps the sums exact enough."""
    a = anchors.select(series_number(F.col("map_id")).cast("double").alias("x"), F.col("anchor_ms").cast("double").alias("y")).where("x is not null and y is not null")
    base = a.agg(F.avg("x").alias("mx"), F.avg("y").alias("my"))
    c = a.join(F.broadcast(base)).select("x", "y", "mx", "my", (F.col("x") - F.col("mx")).alias("dx"), (F.col("y") - F.col("my")).alias("dy"))
    fit = c.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("dx") * F.col("dy")).alias("sxy"), F.sum(F.col("dx") * F.col("dx")).alias("sxx"), F.first("mx").alias("mx"), F.first("my").alias("my"))
    fit = fit.select("n", F.when(F.col("sxx") > 0, F.col("sxy") / F.col("sxx")).otherwise(F.lit(0.0)).alias("slope"), "mx", "my")
    r = a.join(F.broadcast(fit)).agg(F.max(F.abs(F.col("y") - F.col("my") - F.col("slope") * (F.col("x") - F.col("mx")))).alias("residual"))
    return fit.join(F.broadcast(r)).select("n", "slope", (F.col("my") - F.col("slope") * F.col("mx")).alias("intercept"), "mx", "my", "residual")


def predict(series: DataFrame, anchors: DataFrame) -> DataFrame:
    """map_id, predictor, contributors, lo, hi (ms), confidence, for each of series: D (neighbours), else B (suffix family), else E (regression)."""
    d = neighbours(series, anchors).withColumn("predictor", F.lit("D"))
    rest = series.select("map_id").join(d.select("map_id"), "map_id", "left_anti")
    pool = family_pool(anchors)
    b = rest.withColumn("suffix", series_suffix(F.col("map_id"))).join(F.broadcast(pool), "suffix")
    b = b.select("map_id", "contributors", "lo", "hi", F.lit("LOW").alias("confidence"), F.lit("B").alias("predictor"))
    rest = rest.join(b.select("map_id"), "map_id", "left_anti").withColumn("x", series_number(F.col("map_id")).cast("double")).where("x is not null")
    e = rest.join(F.broadcast(regression(anchors))).where("n > 0")
    centre, half = F.col("my") + F.col("slope") * (F.col("x") - F.col("mx")), F.lit(RESIDUALS) * F.col("residual")
    e = e.select("map_id", F.col("n").alias("contributors"), F.round(centre - half).cast("long").alias("lo"), F.round(centre + half).cast("long").alias("hi"), F.lit("LOW").alias("confidence"), F.lit("E").alias("predictor"))
    return d.unionByName(b).unionByName(e).select("map_id", "predictor", "contributors", "lo", "hi", "confidence")

"""Expansion around hits: windows on related series, and packing of windows to bounded packages."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import is_ring, path_family
from .accounting import first_wins

# Half widths in milliseconds around a hit, and the most candidates of an expansion package.
SIBLING_MS, BUNDLE_MS, ALL_SERIES_MS = 90_000, 2_500, 600_000
PACKAGE_TARGET = 18_000_000


def families(plan_items: DataFrame) -> DataFrame:
    """family, map_id, path_fmt: the first path of each series of the inner ring, by path family. plan_items: seq, tier, map_id, path_fmt."""
    x = plan_items.where(is_ring(F.col("tier"))).withColumn("family", path_family(F.col("path_fmt"))).where("family is not null")
    return first_wins(x, ["family", "map_id"], "path_fmt", "seq")


def all_series(ranges: DataFrame) -> DataFrame:
    """map_id, path_fmt: the first path of each series of the spec. ranges: seq, map_id, path_fmt."""
    return first_wins(ranges, ["map_id"], "path_fmt", "seq")


def cascade(hits: DataFrame, family: DataFrame, series: DataFrame) -> DataFrame:
    """url, ring (c1, c2), part, map_id, path_fmt, t0, t1: the windows that a hit opens on other series.

    Ring 1: siblings of the hit's path family, 90 s to either side; for hits on maps the bundles (ids in m) get
    2.5 s instead. Ring 2: all series, 600 s. The series tables are registries: a hit meets each entry of its family once.
    """
    h = hits.select(F.col("map_id").alias("hit"), F.col("ts_ms").alias("ts"), "url").withColumn("hit_family", path_family(F.col("url")))
    bundle = (F.col("family") == "maps") & F.col("map_id").startswith("m")
    half = F.when(bundle, F.lit(BUNDLE_MS)).otherwise(F.lit(SIBLING_MS))
    one = h.join(family, (h["hit_family"] == family["family"]) & (h["hit"] != family["map_id"]))
    one = one.select("url", F.lit("c1").alias("ring"), bundle.cast("int").alias("part"), "map_id", "path_fmt", "ts", half.alias("half"))
    two = h.join(series, h["hit"] != series["map_id"]).select("url", F.lit("c2").alias("ring"), F.lit(0).alias("part"), "map_id", "path_fmt", "ts", F.lit(ALL_SERIES_MS).alias("half"))
    return one.unionByName(two).select("url", "ring", "part", "map_id", "path_fmt", (F.col("ts") - F.col("half")).alias("t0"), (F.col("ts") + F.col("half")).alias("t1"))


def new_hits(hits: DataFrame, known_urls: DataFrame, most: int | None = 4) -> DataFrame:
    """Hits not yet expanded, by URL; at most `most` a cycle."""
    fresh = hits.dropDuplicates(["url"]).join(known_urls.select("url"), "url", "left_anti").orderBy("url")
    return fresh if most is None else fresh.limit(most)


def overlay(known: DataFrame, hits: DataFrame, most: int = 4, kept: int = 64) -> DataFrame:
    """url, expanded, kept after one cycle of the cascade: hits (seq, url) not known yet, the first `most` of them, are expanded.

    Hits of equal seq go by URL, so that reruns and partitions agree on them. Of all URLs known by then only the last
    `kept` in their order stay known, as the published rule has it: an older one may come up again. Without a row that
    is expanded the overlay and its revision stay as they were.
    """
    fresh = hits.groupBy("url").agg(F.min("seq").alias("seq")).join(known.select("url"), "url", "left_anti").orderBy("seq", "url").limit(most)
    every = known.select("url", F.lit(False).alias("expanded")).distinct().unionByName(fresh.select("url", F.lit(True).alias("expanded")))
    last = every.orderBy(F.desc("url")).limit(kept).select("url", F.lit(True).alias("kept"))
    return every.join(last, "url", "left").withColumn("kept", F.coalesce("kept", F.lit(False)))


def greedy_bins(items: DataFrame, keys: list[str], order: list[str], size: str, cap: int) -> DataFrame:
    """items with bin and offset: in order, a new bin begins where the next item doesn't fit; an item over cap has its own.

    Where a bin ends depends on all items before it, so each group is folded in order as it streams by.
    """
    names = items.columns

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, bin_, fill = None, 0, 0
        for pdf in frames:
            bins, offsets = [], []
            for key, n in zip(zip(*[pdf[k] for k in keys], strict=True) if keys else [()] * len(pdf), pdf[size], strict=True):
                if now is None or key != now:
                    now, bin_, fill = key, 0, 0
                if fill and fill + n > cap:
                    bin_, fill = bin_ + 1, 0
                bins.append(bin_)
                offsets.append(fill)
                fill += int(n)
            yield pdf.assign(bin=bins, offset=offsets)[[*names, "bin", "offset"]]

    schema = T.StructType([*items.schema.fields, T.StructField("bin", T.IntegerType()), T.StructField("offset", T.LongType())])
    dealt = items.repartition(*keys) if keys else items.coalesce(1)
    return dealt.sortWithinPartitions(*keys, *order).mapInPandas(fold, schema)

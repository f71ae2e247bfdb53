"""Ordinal streams: universes of candidates as ordered items, their offsets, chunks and packages.

Candidates are virtual: an ordinal is turned to its series and instant by a join, never stored in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import chunk_key, package_id
from ..functions.numbers import ceil_div, div
from ..functions.times import day, hour_number, hour_of_day
from .running import running, slabs

DEFAULT_PRIORITY = 99


def tier_ranges(spec: DataFrame) -> DataFrame:
    """tier, priority, path_fmt, map_id, t0, t1, seq of a spec's ranges, in its order; empty ranges go.

    spec: one row with url_path_fmt and tiers, an array of structs (tier_id, priority, path_fmt, ranges).
    """
    t = spec.select("url_path_fmt", F.posexplode("tiers").alias("ti", "t"))
    r = t.select("url_path_fmt", "ti", "t", F.posexplode("t.ranges").alias("ri", "r"))
    out = r.select(
        F.col("t.tier_id").alias("tier"),
        F.coalesce("t.priority", F.lit(DEFAULT_PRIORITY)).cast("int").alias("priority"),
        F.coalesce(F.nullif("t.path_fmt", F.lit("")), "url_path_fmt").alias("path_fmt"),
        F.col("r.map_id").alias("map_id"),
        (F.col("r.base") + F.col("r.start_offset_ms")).alias("t0"),
        (F.col("r.base") + F.col("r.end_offset_ms")).alias("t1"),
        (F.col("ti").cast("long") * F.lit(1 << 32) + F.col("ri")).alias("seq"),
    )
    return out.where("t1 > t0")


def anchor_items(ids: DataFrame, anchors: DataFrame, excluded: DataFrame) -> DataFrame:
    """map_id, anchor, ts_ms: every id at every anchor but the excluded pairs. Both sides are small registries."""
    pairs = ids.select("map_id").join(F.broadcast(anchors.select("anchor", "ts_ms")))
    return pairs.join(excluded.select("map_id", "anchor"), ["map_id", "anchor"], "left_anti")


def anchor_count(ids: DataFrame, anchors: DataFrame, excluded: DataFrame, compat: bool = False) -> int:
    """How many anchor items there are. compat: the published figure, which also takes exclusions of unknown ids off."""
    if compat:
        return ids.count() * anchors.count() - excluded.count()
    return anchor_items(ids, anchors, excluded).count()


def with_offsets(items: DataFrame, n: Column, seq: str = "seq") -> DataFrame:
    """items with n and ordinal0, the sum of the n before in the order of seq (a long, unique)."""
    items = items.withColumn("n", F.greatest(n, F.lit(0)).cast("long"))
    out = running(items, [], [seq], slabs(items, F.col(seq)), {"ordinal0": ("sum", F.col("n"))})
    return out.withColumn("ordinal0", F.coalesce("ordinal0", F.lit(0)).cast("long"))


def total(items: DataFrame, n: Column) -> int:
    return int(items.agg(F.sum(F.greatest(n, F.lit(0)))).first()[0] or 0)


def decode(ordinals: DataFrame, items: DataFrame, width: int, at: str = "ordinal") -> DataFrame:
    """ordinals joined with the item that holds each (columns ordinal0, n), and `within`, the place in it.

    An equi-join on buckets of `width` ordinals; empty items hold none.
    """
    first, last = div(F.col("ordinal0"), width), div(F.col("ordinal0") + F.col("n") - 1, width)
    i = items.where("n > 0").withColumn("__b", F.explode(F.sequence(first, last)))
    o = ordinals.withColumn("__ob", div(F.col(at), width))
    on = (o["__ob"] == i["__b"]) & (o[at] >= i["ordinal0"]) & (o[at] < i["ordinal0"] + i["n"])
    return o.join(i, on).drop("__b", "__ob").withColumn("within", F.col(at) - F.col("ordinal0"))


def candidates(spark: SparkSession, items: DataFrame, start: int, end: int, width: int) -> DataFrame:
    """ordinal, map_id, ts_ms, tier of the ordinals [start, end), made up as they are asked for."""
    o = spark.range(start, end).withColumnRenamed("id", "ordinal")
    near = items.where((F.col("ordinal0") < end) & (F.col("ordinal0") + F.col("n") > start))
    return decode(o, near, width).select("ordinal", "map_id", (F.col("t0") + F.col("within")).alias("ts_ms"), "tier")


def chunk_bounds(total_: int, chunk_size: int, chunk: int) -> tuple[int, int]:
    """The half-open slice of a chunk; IndexError if it is empty."""
    start = chunk * chunk_size
    if chunk < 0 or start >= total_:
        raise IndexError(f"chunk {chunk} of {total_} candidates is empty")
    return start, min(start + chunk_size, total_)


def chunks(spark: SparkSession, total_: int, chunk_size: int, epoch: int = 1) -> DataFrame:
    """chunk, key, start, end, size of every chunk."""
    c = spark.range(-(-total_ // chunk_size)).withColumnRenamed("id", "chunk")
    start = F.col("chunk") * chunk_size
    end = F.least(start + chunk_size, F.lit(total_))
    return c.select("chunk", chunk_key(F.lit(epoch), F.col("chunk")).alias("key"), start.alias("start"), end.alias("end"), (end - start).alias("size"))


def num_chunks(n: Column, chunk_size: int) -> Column:
    return ceil_div(n, chunk_size)


def hour_major(items: DataFrame, day_weight: DataFrame, hour_density: DataFrame) -> DataFrame:
    """items with `rank`, from 1: by priority, tier, then days and hours by falling weight.

    day_weight (day, weight): 0.5 where a day has none; hour_density (hour 0..23, density): 0 where an hour has
    none. Of several weights of a day the largest counts. Tiers keep the order of their first item.
    """
    weights = day_weight.groupBy("day").agg(F.max("weight").alias("__w"))
    density = hour_density.groupBy("hour").agg(F.max("density").alias("__d"))
    tiers = items.groupBy("tier").agg(F.min("seq").alias("__first"))
    x = items.withColumns({"__day": day(F.col("t0")), "__h": hour_number(F.col("t0")), "__hour": hour_of_day(F.col("t0"))})
    x = x.join(F.broadcast(weights), x["__day"] == weights["day"], "left").drop("day")
    x = x.join(F.broadcast(density), x["__hour"] == density["hour"], "left").drop("hour")
    x = x.join(F.broadcast(tiers), "tier")
    order = ["priority", "__first", F.coalesce("__w", F.lit(0.5)).desc(), "__day", F.coalesce("__d", F.lit(0.0)).desc(), "__h", "map_id", "t0", "seq"]
    return x.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long")).select(*items.columns, "rank")


def cut_packages(items: DataFrame, target: int) -> DataFrame:
    """package, pid, ordinal0, item_ordinal0 and the item's columns with t0 and t1 narrowed: packages of exactly `target` ordinals.

    items: with ordinal0 and n of the ordered stream. A package is the ordinals [k * target, (k + 1) * target), so an
    item's parts are known from its own ordinals. Each part keeps its own tier.
    """
    x = items.where("n > 0")
    x = x.withColumn("package", F.explode(F.sequence(div(F.col("ordinal0"), target), div(F.col("ordinal0") + F.col("n") - 1, target))))
    low = F.greatest(F.col("package") * target, F.col("ordinal0"))
    high = F.least((F.col("package") + 1) * target, F.col("ordinal0") + F.col("n"))
    t0 = F.col("t0") + (low - F.col("ordinal0"))
    x = x.withColumns({"__low": low, "__high": high, "__t0": t0})
    return x.select("package", package_id(F.col("package")).alias("pid"), *[c for c in items.columns if c not in ("t0", "t1", "ordinal0", "n")], F.col("__t0").alias("t0"), (F.col("__t0") + F.col("__high") - F.col("__low")).alias("t1"), F.col("__low").alias("item_ordinal0"))


def packages(parts: DataFrame) -> DataFrame:
    """One row per package: its span and size, and the parts in order."""
    part = F.struct("item_ordinal0", "map_id", "path_fmt", "t0", "t1", "tier")
    return parts.groupBy("package", "pid").agg(F.min("item_ordinal0").alias("ordinal0"), F.sum(F.col("t1") - F.col("t0")).alias("candidates"), F.min("priority").alias("priority"), F.array_sort(F.collect_list(part)).alias("items"))


def breaks(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Spans (ordinal0, n) that don't begin where the one before ends; the first must begin at 0."""
    before = Window.partitionBy(*keys).orderBy("ordinal0")
    expected = F.coalesce(F.lag(F.col("ordinal0") + F.col("n")).over(before), F.lit(0))
    return spans.withColumn("expected", expected).where("ordinal0 <> expected")


def conservation(items: DataFrame, parts: DataFrame) -> DataFrame:
    """tier, expected, actual of the tiers whose candidates a plan doesn't keep."""
    want = items.groupBy("tier").agg(F.sum("n").alias("expected"))
    have = parts.groupBy("tier").agg(F.sum(F.col("t1") - F.col("t0")).alias("actual"))
    return want.join(have, "tier", "full").select("tier", F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("actual", F.lit(0)).alias("actual")).where("expected <> actual")


def plan_stats(parts: DataFrame, rate: float = 60_000.0) -> DataFrame:
    """tier (null: all), packages, candidates and hours at `rate` per second."""
    g = parts.rollup("tier").agg(F.count_distinct("package").alias("packages"), F.sum(F.col("t1") - F.col("t0")).alias("candidates"))
    return g.withColumn("hours", F.bround(F.col("candidates") / F.lit(rate) / F.lit(3600.0), 2))


def systematic_sample(ordinals: DataFrame, at: str, step: int, edges: DataFrame) -> DataFrame:
    """Every step-th ordinal, and those that the one-column table edges names."""
    regular = ordinals.where(F.pmod(at, F.lit(step)) == 0)
    return regular.unionByName(ordinals.join(edges.toDF(at), at, "left_semi")).distinct()


def spot_check(df: DataFrame, share: float = 0.0005, seed: int = 20211031) -> DataFrame:
    """A seeded Bernoulli sample: a feature for checks, not for results."""
    return df.where(F.rand(seed) < share)


def blocks(items: DataFrame, size: int = 1000) -> DataFrame:
    """item columns, block and length: each item cut to blocks of at most `size`."""
    x = items.where("n > 0").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), div(F.col("n") - 1, size))))
    return x.withColumn("length", F.least(F.lit(size), F.col("n") - F.col("block") * size))


def universe(spec: DataFrame, compat: bool = False) -> DataFrame:
    """tier, map_id, t0, t1, seq, n, ordinal0 of all of a spec: ranges as they stand, anchor tiers as items of one instant.

    An anchor tier pairs every id of all_map_ids with its anchors, ids first, without the excluded pairs. compat: its
    published size, which also takes exclusions of unknown ids off; that drops as many items at its end.
    """
    t = spec.select("all_map_ids", "anchors_ms", F.posexplode("tiers").alias("ti", "t"))
    seq = F.col("ti").cast("long") * F.lit(1 << 40)
    ranges = t.where("coalesce(t.kind, '') <> 'anchors'").select("ti", "t", F.posexplode("t.ranges").alias("ri", "r"))
    ranges = ranges.select(F.col("t.tier_id").alias("tier"), F.col("r.map_id").alias("map_id"), (F.col("r.base") + F.col("r.start_offset_ms")).alias("t0"), (F.col("r.base") + F.col("r.end_offset_ms")).alias("t1"), (seq + F.col("ri")).alias("seq")).where("t1 > t0")
    a = t.where("t.kind = 'anchors'").select("ti", "t", "anchors_ms", F.posexplode("all_map_ids").alias("mi", "map_id"))
    a = a.select("ti", "t", "anchors_ms", "mi", "map_id", F.posexplode("t.anchors").alias("ai", "anchor"))
    out = F.expr("exists(coalesce(t.exclude, array()), e -> e.map_id = map_id and array_contains(e.anchors, anchor))")
    a = a.where(~out).withColumn("t0", F.try_element_at("anchors_ms", F.col("anchor")))
    anchors = a.select(F.col("t.tier_id").alias("tier"), "map_id", "t0", (F.col("t0") + 1).alias("t1"), (seq + F.col("mi").cast("long") * F.lit(1 << 16) + F.col("ai")).alias("seq"), "ti", "t")
    if compat:
        known = t.where("t.kind = 'anchors'").select("ti", F.expr("size(all_map_ids) * size(t.anchors) - aggregate(coalesce(t.exclude, array()), 0, (s, e) -> s + size(e.anchors))").alias("__size"))
        rank = F.row_number().over(Window.partitionBy("ti").orderBy("seq"))
        anchors = anchors.withColumn("__n", rank).join(F.broadcast(known), "ti").where(F.col("__n") <= F.col("__size"))
    items = ranges.unionByName(anchors.select("tier", "map_id", "t0", "t1", "seq"))
    return with_offsets(items, F.col("t1") - F.col("t0"))


def tier_table(items: DataFrame) -> DataFrame:
    """tier, start_ordinal, count of the tiers of a universe, in order."""
    return items.groupBy("tier").agg(F.min("ordinal0").alias("start_ordinal"), F.sum("n").alias("count")).orderBy("start_ordinal")


def family_windows(ids: DataFrame, anchors: dict[str, int], order: list[str], forward: tuple[int, int] | None, backward: tuple[int, int] | None) -> DataFrame:
    """map_id, lo, hi, label: for every id the windows (seconds) after and before each anchor. The anchors are a configuration."""
    spans = [(f"{name}_{a}", anchors[a] + span[0] * 1000, anchors[a] + span[1] * 1000) for a in order for name, span in (("fwd", forward), ("back", backward)) if span]
    all_ = F.array(*[F.struct(F.lit(lo).cast("long").alias("lo"), F.lit(hi).cast("long").alias("hi"), F.lit(label).alias("label")) for label, lo, hi in spans])
    return ids.select("map_id", F.explode(all_).alias("w")).select("map_id", "w.lo", "w.hi", "w.label")


def static_epoch(ranges: DataFrame, covered: DataFrame, width: int) -> DataFrame:
    """ranges (tier, priority, path_fmt, map_id, seq, lo, hi) without what is covered (path_fmt, map_id, lo, hi) or stands in an earlier range.

    Series of one name under two paths are apart. Tiers keep their columns, and those with nothing left aren't in the result.
    """
    from .intervals import non_empty, overlapping, subtract

    key = ["path_fmt", "map_id"]
    left = subtract(ranges.select("tier", "priority", *key, "seq", "lo", "hi"), covered, key, width)
    # cut at every end, so that pieces are the same or apart; each belongs to the first range that has it
    ends = left.select(*key, F.explode(F.array("lo", "hi")).alias("lo")).distinct()
    cells = ends.withColumn("hi", F.lead("lo").over(Window.partitionBy(*key).orderBy("lo"))).where("hi is not null")
    first = overlapping(left, cells, key, width).groupBy(*key, "clo", "chi").agg(F.min(F.struct("seq", "tier", "priority")).alias("own"))
    owned = non_empty(first.select(*key, "own.*", F.col("clo").alias("lo"), F.col("chi").alias("hi")))
    # neighbours of one range are one piece again
    w = Window.partitionBy(*key, "seq").orderBy("lo")
    marked = owned.withColumn("new", (F.coalesce(F.lag("hi").over(w), F.lit(-1)) != F.col("lo")).cast("int")).withColumn("run", F.sum("new").over(w))
    return marked.groupBy("tier", "priority", *key, "seq", "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("run")


def first_candidates(ordinals: DataFrame, at: str, most: int) -> DataFrame:
    """The first `most` ordinals: a limit that a run was asked for."""
    return ordinals.orderBy(at).limit(most)


def in_universe(ordinals: DataFrame, total: int, at: str = "ordinal") -> DataFrame:
    """The rows, once each ordinal has been seen to lie in [0, total); any other one is an error."""
    bad = (F.col(at) < 0) | (F.col(at) >= total)
    return ordinals.withColumn(at, F.when(bad, F.raise_error(F.concat(F.lit("outside the universe: "), F.col(at).cast("string"))).cast("long")).otherwise(F.col(at)))

"""Interval algebra on tables of half-open intervals [lo, hi) of longs, by key.

Columns are named lo and hi; keys is the list of key columns (none: one line for all). Intervals with hi <= lo,
or with a null end, are empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .running import ROWS_PER_SLAB, running, slabs


def non_empty(df: DataFrame) -> DataFrame:
    return df.where("hi > lo")


def merge(df: DataFrame, keys: list[str], touch: int = 0, rows_per_slab: int = ROWS_PER_SLAB) -> DataFrame:
    """Disjoint maximal intervals: those that overlap or touch are joined. touch: a gap of up to so many is closed too.

    An interval starts an island if its lo lies beyond the running maximum of the hi before it, which holds under
    nesting. Islands are then folded by their start, with partial aggregation.
    """
    df = non_empty(df).select(*keys, "lo", "hi").distinct()
    slab = slabs(df, F.col("lo"), rows_per_slab)
    order = ["lo", "hi"]
    marked = running(df, keys, order, slab, {"reach": ("max", F.col("hi"))})
    start = F.when(F.col("reach").isNull() | (F.col("lo") > F.col("reach") + touch), F.col("lo"))
    marked = marked.withColumn("start", start)
    islands = running(marked, keys, order, slab, {"island": ("max", F.col("start"))})
    return islands.withColumn("island", F.coalesce("start", "island")).groupBy(*keys, "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("island")


def merge_closed(df: DataFrame, keys: list[str]) -> DataFrame:
    """Ranges [a, b] with both ends in: joined if they overlap or follow on one another. Columns a and b."""
    half = df.where("b >= a").select(*keys, F.col("a").alias("lo"), (F.col("b") + 1).alias("hi"))
    return merge(half, keys).select(*keys, F.col("lo").alias("a"), (F.col("hi") - 1).alias("b"))


def _buckets(lo: Column, hi: Column, width: int) -> Column:
    first, last = F.floor(lo / F.lit(width)).cast("long"), F.floor((hi - 1) / F.lit(width)).cast("long")
    return F.explode(F.sequence(first, last))


def overlapping(left: DataFrame, right: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Pairs of overlapping intervals, each once: the columns of left, then clo and chi of right.

    Both sides are cut to buckets of `width`, which makes it an equi-join; a pair is kept in the bucket where it begins.
    Choose width near the usual length of an interval.
    """
    a = non_empty(left).withColumn("__b", _buckets(F.col("lo"), F.col("hi"), width))
    b = non_empty(right).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("lo").alias("clo"), F.col("hi").alias("chi")).withColumn("__cb", _buckets(F.col("clo"), F.col("chi"), width))
    on = (F.col("__b") == F.col("__cb")) & (F.col("lo") < F.col("chi")) & (F.col("clo") < F.col("hi"))
    for i, k in enumerate(keys):
        on = on & (a[k] == b[f"__k{i}"])
    pairs = a.join(b, on).where(F.floor(F.greatest("lo", "clo") / F.lit(width)) == F.col("__b"))
    return pairs.select(*left.columns, "clo", "chi")


def subtract(windows: DataFrame, covered: DataFrame, keys: list[str], width: int) -> DataFrame:
    """What is left of each window outside the covered set, as rows of windows with lo and hi narrowed.

    covered needn't be merged. Rows of windows alike in all columns count once.
    """
    windows = non_empty(windows).distinct()
    names = windows.columns
    pieces = overlapping(windows, merge(covered, keys), keys, width)
    own = [f"__w_{c}" for c in names]
    w = Window.partitionBy(*own).orderBy("clo")
    touched = pieces.select(*[F.col(c).alias(f"__w_{c}") for c in names], "clo", "chi")
    gaps = touched.select(*own, F.coalesce(F.lag("chi").over(w), F.col("__w_lo")).alias("lo"), F.least("clo", "__w_hi").alias("hi"))
    tails = touched.groupBy(*own).agg(F.max("chi").alias("lo")).select(*own, "lo", F.col("__w_hi").alias("hi"))
    other = [c for c in names if c not in ("lo", "hi")]
    left = gaps.unionByName(tails).where("hi > lo").select(*[F.col(f"__w_{c}").alias(c) for c in other], F.greatest("lo", "__w_lo").alias("lo"), "hi")
    on = F.lit(True)
    distinct = touched.select(*own).distinct()
    for c in names:
        on = on & windows[c].eqNullSafe(distinct[f"__w_{c}"])
    return left.unionByName(windows.join(distinct, on, "left_anti")).select(*names)


def first_owner(windows: DataFrame, keys: list[str], labels: list[str]) -> DataFrame:
    """Windows cut so that every point belongs to the first window, in the order (lo, hi, labels), that holds it.

    As windows come by lo, what earlier ones hold of a window is a piece at its start.
    """
    w = non_empty(windows).distinct()
    held = running(w, keys, ["lo", "hi", *labels], slabs(w, F.col("lo")), {"__held": ("max", F.col("hi"))})
    return held.withColumn("lo", F.greatest("lo", F.coalesce("__held", F.col("lo")))).where("hi > lo").select(*windows.columns)


def fresh(windows: DataFrame, covered: DataFrame, keys: list[str], labels: list[str], width: int) -> DataFrame:
    """The parts of windows that neither the covered set nor an earlier window holds."""
    return subtract(first_owner(windows, keys, labels), covered, keys, width)


def containing(points: DataFrame, covered: DataFrame, keys: list[str], at: str, width: int, how: str = "left_semi") -> DataFrame:
    """points whose value `at` lies in the covered set (left_semi), or outside it (left_anti). The set is merged first."""
    c = merge(covered, keys).withColumn("__b", _buckets(F.col("lo"), F.col("hi"), width))
    p = points.withColumn("__pb", F.floor(F.col(at) / F.lit(width)).cast("long"))
    on = (p["__pb"] == c["__b"]) & (p[at] >= c["lo"]) & (p[at] < c["hi"])
    for k in keys:
        on = on & (p[k] == c[k])
    return p.join(c, on, how).drop("__pb")


def covered_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys, covered: how many points the intervals of a key cover, each once."""
    return merge(df, keys).groupBy(*keys).agg(F.sum(F.col("hi") - F.col("lo")).alias("covered"))


def clip(df: DataFrame, low: Column, high: Column) -> DataFrame:
    return df.withColumns({"lo": F.greatest("lo", low), "hi": F.least("hi", high)}).where("hi > lo")


def compress(points: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Closed ranges a, b of consecutive values; repeated values count once."""
    ones = points.where(F.col(at).isNotNull()).select(*keys, F.col(at).alias("a"), F.col(at).alias("b"))
    return merge_closed(ones, keys)


def expand(ranges: DataFrame, keys: list[str], at: str) -> DataFrame:
    """The values of closed ranges a, b, one row each."""
    return ranges.where("b >= a").select(*keys, F.explode(F.sequence("a", "b")).alias(at))


def contiguous_prefix(points: DataFrame, keys: list[str], at: str, start: int = 0) -> DataFrame:
    """keys, through: the first value from `start` on that isn't there; groups without `start` itself give `start`."""
    r = compress(points.where(F.col(at) >= start), keys, at)
    return r.groupBy(*keys).agg(F.coalesce(F.max(F.when(F.col("a") == start, F.col("b") + 1)), F.lit(start).cast("long")).alias("through"))


def recorded_prefix(points: DataFrame, keys: list[str], at: str, ok: str, arrival: str, cap: int, start: int = 0) -> DataFrame:
    """contiguous_prefix over clean values and over the first `cap` dirty ones by arrival, of a key; later dirt stalls the cursor."""
    w = Window.partitionBy(*keys).orderBy(arrival)
    dirty = points.where(~F.col(ok)).groupBy(*keys, at).agg(F.min(arrival).alias(arrival))
    kept = dirty.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= cap)
    return contiguous_prefix(points.where(F.col(ok)).select(*keys, at).unionByName(kept.select(*keys, at)), keys, at, start)


def spread_epochs(epochs: list[DataFrame], covered: DataFrame, keys: list[str], labels: list[str], width: int, keep=None) -> list[DataFrame]:
    """What each epoch adds, in their order: windows fresh against the covered set and all epochs before.

    keep, e.g. DataFrame.checkpoint, cuts the lineage from one epoch to the next: the work is linear in the epochs.
    """
    keep = keep or (lambda df: df)
    out = []
    for windows in epochs:
        new = keep(fresh(windows, covered, keys, labels, width))
        out.append(new)
        covered = keep(merge(covered.select(*keys, "lo", "hi").unionByName(new.select(*keys, "lo", "hi")), keys))
    return out

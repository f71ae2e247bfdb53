"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length. A source whose target is at least its size is taken whole as often as
fits; the budget that remains is fitted on the table of lengths: each length gives its share, and a
bounded-knapsack program settles what is left to the word. Which documents of a length are taken is decided by
a seeded hash. Only tables of lengths are gathered; no document meets another in a task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import WORD_PATTERN, written

WEIGHTS = (5.0, 2.0, 1.0)
#: A source's words are taken at most this often.
MOST_REPEATS = 3
#: Words that the knapsack program settles at least; longer documents widen it.
PROGRAM_WORDS = 1 << 16
#: Width up to which the program counts single words; beyond (documents of over four million words), long ones are settled in coarser units first.
WIDEST = 1 << 24
#: Documents of a hash bucket on average: of each length one bucket at most is ranked, the others go whole.
BUCKET_ROWS = 500
#: Rows up to which the table of lengths is broadcast; beyond, it is joined by a shuffle.
BROADCAST_ROWS = 200_000


def word_count(text: Column) -> Column:
    """Words of a text as a long; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, most: float = MOST_REPEATS) -> DataFrame:
    """source, source_size, target: weights repeat over the sources by code point, null last; a target stops at `most`
    times its source's size, and the excess is shared anew by weight until no target is above.

    That fixed point is min(most * size, level * weight) for the level at which all add up, found from the order of
    size / weight. The table has a row per source.
    """
    n = len(weights)
    order = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(n)) + 1).cast("int"))
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(F.lit(0))
    t = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    t = t.withColumn("budget", F.sum("source_size").over(whole) * F.lit(float(share)))
    # the level if the sources before this one are capped and the rest share by weight
    t = t.withColumn("level", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    t = t.withColumn("level", F.max(F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.col("level"))).over(whole))
    return t.select("source", "source_size", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int, limit: int = PROGRAM_WORDS) -> np.ndarray:
    """How many of each length to take so that the words come as near to the budget as they can.

    Shares first: of every length the part that budget / total gives, the fraction carried to the next shorter one.
    That leaves less open than the longest document has. The rest, with some of what was taken, goes through the
    knapsack program, whose width is `limit` words or four times the longest document.
    """
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return np.zeros(len(lengths), np.int64)
    if budget >= total:
        return counts.copy()
    order = np.argsort(-lengths, kind="stable")
    take, carry = np.zeros(len(lengths), np.int64), 0.0
    for i in order.tolist():
        size, n = int(lengths[i]), int(counts[i])
        if not size:
            continue
        want = n * budget / total + carry / size
        got = min(n, max(0, int(want)))
        take[i], carry = got, (want - got) * size
    left = budget - int((lengths * take).sum())
    # give back some words, so that the program has room on both sides of the budget: a few of each length, then more
    width = max(limit, 4 * int(lengths[counts > 0].max()))
    for most in (64, budget):
        for i in order.tolist():
            size = int(lengths[i])
            if size and left < width // 2:
                back = min(int(take[i]), -(-(width // 2 - left) // size), most)
                take[i] -= back
                left += back * size
    if width > WIDEST:
        unit = -(-width // WIDEST)
        long = np.where(lengths > limit, (lengths + unit // 2) // unit, 0)
        got = _knapsack(long, counts - take, max(left, 0) // unit)
        take, left = take + got, left - int((lengths * got).sum())
        lengths = np.where(lengths > limit, 0, lengths)
        left = min(left, limit)
    return take + _knapsack(lengths, counts - take, max(left, 0))


def _nearest(reach: int, budget: int) -> int:
    """The reached sum that is nearest to the budget, the lower of two."""
    low = (reach & ((1 << (budget + 1)) - 1)).bit_length() - 1
    above = reach >> (budget + 1)
    high = budget + (above & -above).bit_length() if above else None
    return high if high is not None and high - budget < budget - low else low


def _knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack on lengths, as near to the budget as can be, above it too. Reached sums are bits; a sum remembers the item that first reached it."""
    out = np.zeros(len(lengths), np.int64)
    if budget <= 0:
        return out
    top = 2 * budget  # a sum beyond that is no nearer than none
    reach, full = 1, (1 << (top + 1)) - 1
    first = np.full(top + 1, -1, np.int32)
    items: list[tuple[int, int, int]] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        size, n = int(lengths[i]), int(counts[i])
        if not 0 < size <= top:
            continue
        n, k = min(n, top // size), 1
        while n > 0 and not reach >> budget & 1:
            k = min(k, n)
            new = (reach << (k * size)) & full & ~reach
            if new:
                bits = np.unpackbits(np.frombuffer(new.to_bytes(top // 8 + 1, "little"), np.uint8), bitorder="little")
                first[np.flatnonzero(bits)] = len(items)
                reach |= new
            items.append((i, k, k * size))
            n, k = n - k, 2 * k
        if reach >> budget & 1:
            break
    at = _nearest(reach, budget)
    while at:
        i, k, words = items[first[at]]
        out[i] += k
        at -= words
    return out


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, most: int = MOST_REPEATS, seed: int = 0) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken and th (a hash of the text) of every row.

    copies is how often the mix takes the document, taken its words times that. Null text: size 0; a document of
    no words adds nothing and is taken as often as its source is taken whole. Null source: a source of its own, the
    last. Null doc_id, ties and repeated rows: each row is decided by a hash of its id, its text and the seed, rows
    alike in all of these are taken for one another. All sizes 0: every target is 0. Empty table: no rows. Extra
    columns are ignored.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(text).alias("size"), F.xxhash64("text").alias("th"))
    rows = written(rows.withColumn("__h", F.xxhash64(F.lit(seed), "doc_id", "th")), "sizes")
    lengths = written(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "lengths")
    aims = written(targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, most), "targets")

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        whole = min(int(target // size), most) if size else 0
        over = round(target) - whole * size
        pdf["whole"] = whole
        pdf["take"] = fit(pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64), over) if over > 0 and whole < most else 0
        return pdf

    joined = lengths.join(F.broadcast(aims) if aims.count() <= BROADCAST_ROWS else aims, lengths.source.eqNullSafe(aims.source)).select(lengths.source, "size", "n", "source_size", "target")
    plan = joined.groupBy("source").applyInPandas(settle, "source string, size long, n long, source_size long, target double, whole long, take long")
    plan = written(plan.withColumn("buckets", F.ceil(F.col("n") / BUCKET_ROWS)), "plan")
    table = F.broadcast(plan) if plan.count() <= BROADCAST_ROWS else plan
    on = rows.source.eqNullSafe(plan.source) & (rows["size"] == plan["size"])
    r = rows.join(table, on).select(rows["*"], "n", "source_size", "target", "whole", "take", F.pmod("__h", "buckets").alias("__b"))
    # lengths of which some documents go: whole buckets first, one bucket by rank
    key = ["source", "size"]
    some = r.where("take > 0 and take < n")
    buckets = some.groupBy(*key, "__b").agg(F.count(F.lit(1)).alias("in"), F.first("take").alias("take"))
    before = F.coalesce(F.sum("in").over(W.partitionBy(*key).orderBy("__b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    buckets = written(buckets.withColumn("room", F.col("take") - before).select(*key, "__b", "in", "room"), "buckets")
    few = F.broadcast(buckets) if buckets.count() <= BROADCAST_ROWS else buckets
    on = some.source.eqNullSafe(buckets.source) & (some["size"] == buckets["size"]) & (some["__b"] == buckets["__b"])
    cut = some.join(few, on).select(*[some[c] for c in some.columns], "in", "room")
    split = cut.where("room > 0 and room < in").withColumn("rank", F.row_number().over(W.partitionBy(*key, "__b").orderBy("__h", "doc_id", "th")))
    cols = ["doc_id", "source", "size", "source_size", "target", "th", "whole"]
    extra = split.select(*cols, (F.col("rank") <= F.col("room")).cast("long").alias("extra"))
    extra = extra.unionAll(cut.where("room <= 0 or room >= in").select(*cols, (F.col("room") > 0).cast("long").alias("extra")))
    extra = extra.unionAll(r.where("take <= 0 or take >= n").select(*cols, (F.col("take") > 0).cast("long").alias("extra")))
    copies = F.col("whole") + F.col("extra")
    return extra.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), "th")


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The rows of docs, all columns, each as often as the mix takes it.

    Of rows alike in doc_id, text and source, each is given as often as the most taken of them. Null, empty and very
    long texts, ties and an empty table: as `mix` has it. Columns of any name stay.
    """
    chosen = mix(docs, **how).groupBy("doc_id", "th", "source").agg(F.max("copies").cast("int").alias("copies")).where("copies > 0")
    key = [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), F.col("source").cast("string").alias("source")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *key)
    on = rows.doc_id.eqNullSafe(chosen.doc_id) & (rows.th == chosen.th) & rows.source.eqNullSafe(chosen.source)
    return rows.join(chosen, on).select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy")).select("row.*")

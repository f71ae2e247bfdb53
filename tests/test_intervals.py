"""Interval algebra against sets of points: many random cases at once, each under a key of its own."""

import random

import pytest

from quillspan.operators import intervals as I

CASES = 150


def frame(spark, rows, schema="k long, lo long, hi long"):
    return spark.createDataFrame(rows, schema)


def cells(rows):
    return {(k, x) for k, lo, hi, *_ in rows for x in range(lo, hi)}


def cases(seed, most=14):
    """Empty, inverted, adjacent, nested and repeated intervals."""
    rng = random.Random(seed)
    out = []
    for k in range(CASES):
        for _ in range(rng.randrange(most)):
            lo = rng.randrange(-20, 40)
            out.append((k, lo, lo + rng.randrange(-3, 12)))
    return out


@pytest.mark.parametrize("slab", [1_000_000, 300])
def test_merge(spark, slab):
    rows = cases(1)
    got = [tuple(r) for r in I.merge(frame(spark, rows), ["k"], rows_per_slab=slab).collect()]
    have = cells(rows)
    assert cells(got) == have and len(got) == len({(k, lo) for k, lo, _ in got})
    for k, lo, hi in got:  # apart, not empty
        assert hi > lo and (k, hi) not in have and (k, lo - 1) not in have


def test_subtract_and_containment(spark):
    windows, covered = cases(2), cases(3)
    w, c = frame(spark, windows), frame(spark, covered)
    got = [tuple(r) for r in I.subtract(w, c, ["k"], 5).select("k", "lo", "hi").collect()]
    assert cells(got) == cells(windows) - cells(covered)
    points = sorted({(k, lo) for k, lo, _ in windows})
    p = spark.createDataFrame(points, "k long, x long")
    inside = {tuple(r) for r in I.containing(p, c, ["k"], "x", 5).collect()}
    outside = {tuple(r) for r in I.containing(p, c, ["k"], "x", 5, "left_anti").collect()}
    assert inside == set(points) & cells(covered) and outside == set(points) - cells(covered)


def test_epochs_take_what_is_new(spark):
    """Window by window, as a cursor would: each takes what neither the covered set nor a window before it has."""
    base = cases(4, 3)
    epochs = [[(*s, f"w{i % 3}") for i, s in enumerate(cases(5, 6))], [(*s, "x") for s in cases(6, 6)]]
    have, want = cells(base), []
    for e in epochs:
        own = set()
        for k, lo, hi, label in sorted(set(e)):
            new = {(k, x, label) for x in range(lo, hi) if (k, x) not in have}
            have |= {(k, x) for k, x, _ in new}
            own |= new
        want.append(own)
    frames = [frame(spark, e, "k long, lo long, hi long, label string") for e in epochs]
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    out = I.spread_epochs(frames, frame(spark, base), ["k"], ["label"], 5, lambda df: df.checkpoint())
    got = [{(r.k, x, r.label) for r in df.collect() for x in range(r.lo, r.hi)} for df in out]
    assert got == want


@pytest.mark.parametrize(
    "closed, want", [([[1, 3], [2, 5], [7, 7]], [[1, 5], [7, 7]]), ([[1, 2], [3, 4]], [[1, 4]]), ([[5, 4]], []), ([], []), ([[2**40, 2**40 + 1], [-3, -3]], [[-3, -3], [2**40, 2**40 + 1]])]
)
def test_closed_ranges(spark, closed, want):
    df = spark.createDataFrame([("p", a, b) for a, b in closed], "pid string, a long, b long")
    assert [[r.a, r.b] for r in I.merge_closed(df, ["pid"]).orderBy("a").collect()] == want


def test_compress_and_expand(spark):
    df = spark.createDataFrame([("p", x) for x in (7, 10, 11, 12, 99, 11)], "pid string, x long")
    ranges = I.compress(df, ["pid"], "x")
    assert [(r.a, r.b) for r in ranges.orderBy("a").collect()] == [(7, 7), (10, 12), (99, 99)]
    assert sorted(r.x for r in I.expand(ranges, ["pid"], "x").collect()) == [7, 10, 11, 12, 99]


def test_prefixes(spark):
    df = spark.createDataFrame([("p", x, x != 2, x) for x in (0, 1, 2, 3, 5)] + [("q", 1, True, 0)], "pid string, x long, ok boolean, seq long")
    assert {r.pid: r.through for r in I.contiguous_prefix(df.where("ok"), ["pid"], "x").collect()} == {"p": 2, "q": 0}
    assert {r.pid: r.through for r in I.recorded_prefix(df, ["pid"], "x", "ok", "seq", 1).collect()} == {"p": 4, "q": 0}
    assert {r.pid: r.through for r in I.recorded_prefix(df, ["pid"], "x", "ok", "seq", 0).collect()} == {"p": 2, "q": 0}


def test_large_and_null_ends(spark):
    df = frame(spark, [(1, 2**40, 2**40 + 5), (1, 2**40 + 5, 2**41), (1, None, 3), (1, 5, None)])
    assert [tuple(r) for r in I.merge(df, ["k"]).collect()] == [(1, 2**40, 2**41)]
    assert I.merge(df.limit(0), ["k"]).count() == 0

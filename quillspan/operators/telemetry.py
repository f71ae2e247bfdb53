"""Telemetry windows and the rate laws that fold over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import floor_rank, nearest_rank

# The constants of the rate laws.
BUDGET_LAW = {"low": 150.0, "high": 16_000.0}
GOVERNOR_LAW = {"low": 10_000.0, "high": 120_000.0, "samples": 2000}
WORKER_LAW = {"start": 100.0, "low": 12.0, "high": 2000.0, "step": 25.0, "factor": 0.5}
WORKER_HIT = {"bad": 12, "all": 25, "pause_s": 2.0, "longest_s": 60.0}
GRID_HIT = {"streak": 20, "pause_s": 1.5}
GRID_LAW = {"start": 600.0, "low": 150.0, "high": 8000.0, "step": 200.0, "mild": 0.9, "severe": 0.7}
WINDOW_SLOTS = ("dur_s", "rps", "n200", "n404", "n503", "ntimeout", "nneterr", "p50_ms", "p95_ms", "concurrency")
LEDGER_S, TRAIL_S = 3 * 3600, 1500


def named_windows(df: DataFrame, windows: str = "windows") -> DataFrame:
    """One row per window of an array of positional arrays, slots named; the tenth slot is null where there are nine."""
    other = [c for c in df.columns if c != windows]
    x = df.select(*other, F.posexplode(windows).alias("seq", "w"))
    return x.select(*other, "seq", *[F.get("w", F.lit(i)).alias(n) for i, n in enumerate(WINDOW_SLOTS)])


def tumbling(events: DataFrame, keys: list[str], ts: str, seconds: int = 10) -> DataFrame:
    """keys, window_start, n and counts by outcome, rps, p50 and p95 of latency; events: status and latency_s (may be null)."""
    w = F.window(ts, f"{seconds} seconds")
    count = lambda s: F.count_if(F.col("status") == s)
    g = events.groupBy(*keys, w.alias("w")).agg(F.count(F.lit(1)).alias("n"), count("200").alias("n200"), count("404").alias("n404"), count("503").alias("n503"), count("TIMEOUT").alias("ntimeout"), count("NETERR").alias("nneterr"), F.collect_list("latency_s").alias("__l"))
    return g.select(*keys, F.col("w.start").alias("window_start"), "n", "n200", "n404", "n503", "ntimeout", "nneterr", (F.col("n") / F.lit(float(seconds))).alias("rps"), floor_rank(F.col("__l"), 0.5, 0.30).alias("p50_s"), floor_rank(F.col("__l"), 0.95, 1.0).alias("p95_s"))


def latency_percentiles(events: DataFrame, keys: list[str]) -> DataFrame:
    """p50 and p95 of latency_s by nearest rank; for groups whose latencies one task can hold (a worker's last 4096)."""
    g = events.groupBy(*keys).agg(F.collect_list("latency_s").alias("__l"))
    return g.select(*keys, nearest_rank(F.col("__l"), 50).alias("p50"), nearest_rank(F.col("__l"), 95).alias("p95"))


def exact_percentile(df: DataFrame, keys: list[str], value: str, share: float) -> DataFrame:
    """keys, value at floor(share * n) in order, for groups of any size: found from counts of distinct values, pre-aggregated."""
    from pyspark.sql import Window

    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys)
    before = F.coalesce(F.sum("n").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    x = counts.withColumns({"before": before, "all": F.sum("n").over(w)})
    at = F.least(F.floor(F.col("all") * share), F.col("all") - 1)
    return x.where((F.col("before") <= at) & (at < F.col("before") + F.col("n"))).select(*keys, value)


def bad_fraction(counts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, bad, probed, bad_frac of ledger rows (status, n): undetermined and OTHER outcomes over all; 0 if there are none."""
    from ..functions.status import is_bad

    g = counts.groupBy(*keys).agg(F.sum(F.when(is_bad(F.col("status")), F.col("n")).otherwise(0)).alias("bad"), F.sum("n").alias("probed"))
    return g.withColumn("bad_frac", F.coalesce(F.col("bad") / F.nullif(F.col("probed"), F.lit(0)), F.lit(0.0)))


def fleet_bad_fraction(windows: DataFrame, keys: list[str]) -> DataFrame:
    """As bad_fraction, from windows: all is at least 1 a window, and OTHER doesn't count."""
    n = F.greatest(F.lit(1), F.bround(F.col("rps") * F.col("dur_s"))).cast("long")
    bad = (F.col("n503") + F.col("ntimeout") + F.col("nneterr")).cast("long")
    g = windows.groupBy(*keys).agg(F.sum(n).alias("probed"), F.sum(bad).alias("bad"))
    return g.withColumn("bad_frac", F.col("bad") / F.col("probed"))


def tail(df: DataFrame, keys: list[str], order: list, k: int) -> DataFrame:
    """The last k rows of each key."""
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= k).drop("__n")


def recent(ledger: DataFrame, now: Column, seconds: int = TRAIL_S) -> DataFrame:
    """Ledger rows (finished_s, mode) of the last `seconds`, without tests."""
    return ledger.where(F.col("finished_s").isNotNull() & (F.coalesce("mode", F.lit("")) != "test") & (now - F.col("finished_s") < seconds))


def budget_step(budget: Column, bad: Column, has_data: Column) -> Column:
    """The global budget after one cycle."""
    low, high = F.lit(BUDGET_LAW["low"]), F.lit(BUDGET_LAW["high"])
    moved = F.when(bad > 0.08, F.greatest(low, budget * 0.6)).when(bad > 0.03, F.greatest(low, budget * 0.8)).when(bad < 0.01, F.least(high, budget * 1.15)).otherwise(budget)
    return F.when(has_data, moved).otherwise(budget)


def governor_step(budget: Column, bad: Column, samples: Column) -> Column:
    """The fleet governor after one cycle; it holds on few samples."""
    low, high = GOVERNOR_LAW["low"], GOVERNOR_LAW["high"]
    moved = F.when(bad < 0.003, budget * 1.15).when(bad > 0.015, budget * 0.7).otherwise(budget)
    return F.when(samples >= GOVERNOR_LAW["samples"], F.least(F.greatest(moved, F.lit(low)), F.lit(high))).otherwise(budget)


def worker_step(rate: Column, bad: Column, err: Column, cap: Column) -> Column:
    """A worker's rate after one window: additive increase, multiplicative decrease, under the cap."""
    k = WORKER_LAW
    r = F.least(rate, F.greatest(cap, F.lit(k["low"])))
    clean, poor = (bad <= 0.005) & (err <= 0.01), (bad > 0.02) | (err > 0.03)
    return F.when(clean, F.least(r + k["step"], cap, F.lit(k["high"]))).when(poor, F.greatest(F.lit(k["low"]), r * k["factor"])).otherwise(r)


def grid_step(state: Column, bad: Column, err: Column, cap: Column) -> Column:
    """struct(rate, best) after one window: four bands, with a floor at half the best clean rate."""
    k = GRID_LAW
    c = F.greatest(cap, F.lit(k["low"]))
    rate, best = state["rate"], state["best"]
    floor = F.greatest(F.lit(k["low"]), best * 0.5)
    clean, soft, mild = (bad <= 0.015) & (err <= 0.02), (bad <= 0.03) & (err <= 0.04), (bad <= 0.08) & (err <= 0.08)
    new_best = F.when(clean | soft, F.greatest(best, rate)).otherwise(best)
    moved = F.when(clean, F.least(rate + k["step"], c, F.lit(k["high"]))).when(soft, rate).when(mild, F.greatest(floor, rate * k["mild"])).otherwise(F.greatest(floor, rate * k["severe"]))
    return F.struct(F.least(F.greatest(moved, F.lit(k["low"])), c, F.lit(k["high"])).alias("rate"), new_best.alias("best"))


def fold(windows: DataFrame, keys: list[str], order: str, values: list[str], start: Column, step) -> DataFrame:
    """keys, state: a law folded over each key's windows in order. step(state, row) gives the next state.

    A fold needs a key's windows in one place; there are one per 10 s, so a key's are few.
    """
    rows = F.array_sort(F.collect_list(F.struct(order, *values)))
    g = windows.groupBy(*keys).agg(rows.alias("__rows"))
    return g.select(*keys, F.aggregate("__rows", start, step).alias("state"))


def fold_grid(windows: DataFrame, keys: list[str], order: str, cap: float = GRID_LAW["high"]) -> DataFrame:
    """keys, rate, best of the grid law over windows with bad and err."""
    start = F.struct(F.lit(GRID_LAW["start"]).alias("rate"), F.lit(0.0).alias("best"))
    out = fold(windows, keys, order, ["bad", "err"], start, lambda s, w: grid_step(s, w["bad"], w["err"], F.lit(cap)))
    return out.select(*keys, "state.*")


def fold_worker(windows: DataFrame, keys: list[str], order: str, cap: float = WORKER_LAW["high"]) -> DataFrame:
    """keys, rate of the worker law over windows with bad and err."""
    out = fold(windows, keys, order, ["bad", "err"], F.lit(WORKER_LAW["start"]), lambda s, w: worker_step(s, w["bad"], w["err"], F.lit(cap)))
    return out.select(*keys, F.col("state").alias("rate"))


def fold_budget(windows: DataFrame, keys: list[str], order: str, start: float = 1500.0) -> DataFrame:
    """keys, budget of the global law over cycles with bad and samples; each cycle sees the ledger before its own rows."""
    out = fold(windows, keys, order, ["bad", "samples"], F.lit(start), lambda s, w: budget_step(s, w["bad"], w["samples"] > 0))
    return out.select(*keys, F.col("state").alias("budget"))


def recent_means(df: DataFrame) -> DataFrame:
    """Mean rps, p50 and p95 over recent results; a null counts as 0."""
    mean = lambda c: F.sum(F.coalesce(c, F.lit(0.0))) / F.greatest(F.lit(1), F.count(F.lit(1)))
    return df.agg(mean("rps").alias("rps"), mean("p50").alias("p50"), mean("p95").alias("p95"))


def bad_streaks(events: DataFrame, keys: list[str], order: str) -> DataFrame:
    """keys, hits: how often 20 bad outcomes piled up, where each good one takes one off. events: bad, in order.

    For the events of one worker's window, which one task holds.
    """
    rows = F.array_sort(F.collect_list(F.struct(order, "bad")))
    start = F.struct(F.lit(0).alias("streak"), F.lit(0).alias("hits"))

    def step(s: Column, e: Column) -> Column:
        n = F.when(e["bad"], s["streak"] + 1).otherwise(F.greatest(s["streak"] - 1, F.lit(0)))
        return F.struct(F.when(n >= 20, 0).otherwise(n).alias("streak"), (s["hits"] + (n >= 20).cast("int")).alias("hits"))

    return events.groupBy(*keys).agg(rows.alias("__r")).select(*keys, F.aggregate("__r", start, step)["hits"].alias("hits"))


def fold_governor(cycles: DataFrame, keys: list[str], order: str, start: float = 60_000.0) -> DataFrame:
    """keys, budget, hint, revisions: the fleet governor over cycles (bad, samples, fresh, dispatched).

    The hint is the fleet that workers should assume: those seen, or those just dispatched, one at least. A cycle is
    recorded, with the budget to a tenth, if the budget moved by more than 1 or the hint changed.
    """
    first = F.struct(F.lit(start).alias("budget"), F.lit(0).cast("long").alias("hint"), F.lit(0).cast("long").alias("revisions"))

    def step(s: Column, w: Column) -> Column:
        hint = F.greatest(w["fresh"], w["dispatched"], F.lit(1)).cast("long")
        new = governor_step(s["budget"], w["bad"], w["samples"])
        moved = (F.abs(new - s["budget"]) > 1) | (hint != s["hint"])
        return F.struct(F.when(moved, F.round(new, 1)).otherwise(s["budget"]).alias("budget"), F.when(moved, hint).otherwise(s["hint"]).alias("hint"), (s["revisions"] + moved.cast("long")).alias("revisions"))

    return fold(cycles, keys, order, ["bad", "samples", "fresh", "dispatched"], first, step).select(*keys, "state.*")


def fold_worker_events(events: DataFrame, keys: list[str], order: str, cap: float = WORKER_LAW["high"]) -> DataFrame:
    """keys, rate, backoff, pause_until: the worker law over single outcomes and windows.

    events: at (seconds), tick (the end of a window, with bad_frac and err_frac) or an outcome that is bad or not. As soon
    as 12 bad outcomes of 25 or more piled up the rate halves, and a pause begins that doubles from hit to hit.
    """
    k, hit = WORKER_LAW, WORKER_HIT
    zero = F.lit(0).cast("long")
    first = F.struct(F.lit(k["start"]).alias("rate"), zero.alias("backoff"), F.lit(0.0).alias("pause_until"), zero.alias("bad"), zero.alias("all"))

    def step(s: Column, e: Column) -> Column:
        bad, all_ = s["bad"] + e["bad"].cast("long"), s["all"] + 1
        hits = ~e["tick"] & e["bad"] & (bad >= hit["bad"]) & (all_ >= hit["all"])
        clean, poor = (e["bad_frac"] <= 0.005) & (e["err_frac"] <= 0.01), (e["bad_frac"] > 0.02) | (e["err_frac"] > 0.03)
        pause = F.least(F.lit(hit["pause_s"]) * F.pow(F.lit(2.0), s["backoff"]), F.lit(hit["longest_s"]))
        rate = F.when(e["tick"], worker_step(s["rate"], e["bad_frac"], e["err_frac"], F.lit(cap))).when(hits, F.greatest(F.lit(k["low"]), s["rate"] * k["factor"])).otherwise(s["rate"])
        backoff = F.when(e["tick"], F.when(clean, F.greatest(zero, s["backoff"] - 1)).when(poor, s["backoff"] + 1).otherwise(s["backoff"])).otherwise(s["backoff"] + hits.cast("long"))
        counted = lambda n, c: F.when(e["tick"], s[c]).when(hits, zero).otherwise(n).alias(c)
        until = F.when(hits, F.greatest(s["pause_until"], e["at"] + pause)).otherwise(s["pause_until"])
        return F.struct(rate.alias("rate"), backoff.alias("backoff"), until.alias("pause_until"), counted(bad, "bad"), counted(all_, "all"))

    return fold(events, keys, order, ["at", "tick", "bad", "bad_frac", "err_frac"], first, step).select(*keys, "state.rate", "state.backoff", "state.pause_until")


def fold_grid_events(events: DataFrame, keys: list[str], order: str, cap: float = GRID_LAW["high"]) -> DataFrame:
    """keys, rate, best, pause_until: the grid law over single outcomes and windows, events as in fold_worker_events.

    Each bad outcome adds one to a streak and each good one takes one off; at 20 the rate falls and a short pause begins.
    """
    k, hit = GRID_LAW, GRID_HIT
    zero = F.lit(0).cast("long")
    first = F.struct(F.lit(k["start"]).alias("rate"), F.lit(0.0).alias("best"), zero.alias("streak"), F.lit(0.0).alias("pause_until"))

    def step(s: Column, e: Column) -> Column:
        streak = F.when(e["tick"], s["streak"]).when(e["bad"], s["streak"] + 1).otherwise(F.greatest(zero, s["streak"] - 1))
        hits = ~e["tick"] & (streak >= hit["streak"])
        after = grid_step(s, e["bad_frac"], e["err_frac"], F.lit(cap))
        rate = F.when(e["tick"], after["rate"]).when(hits, F.greatest(F.lit(k["low"]), s["rate"] * k["severe"])).otherwise(s["rate"])
        until = F.when(hits, F.greatest(s["pause_until"], e["at"] + hit["pause_s"])).otherwise(s["pause_until"])
        return F.struct(rate.alias("rate"), F.when(e["tick"], after["best"]).otherwise(s["best"]).alias("best"), F.when(hits, zero).otherwise(streak).alias("streak"), until.alias("pause_until"))

    return fold(events, keys, order, ["at", "tick", "bad", "bad_frac", "err_frac"], first, step).select(*keys, "state.rate", "state.best", "state.pause_until")


def peaks(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """The rows with peak: the largest value of the key up to each row."""
    from pyspark.sql import Window

    return df.withColumn("peak", F.max(value).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))

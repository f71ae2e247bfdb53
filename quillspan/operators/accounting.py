"""Canonical coverage accounting: each candidate counts once, by the strongest of its observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import claim_order
from ..functions.numbers import fraction
from ..functions.status import BUCKETS, bucket, rank
from .intervals import merge_closed


def canonical(observations: DataFrame, keys: list[str], order: str = "round") -> DataFrame:
    """keys, status, observations: the strongest status of each candidate; of equals the one seen first.

    Rows of mode 'test' don't count, if there is such a column.
    """
    if "mode" in observations.columns:
        observations = observations.where(F.coalesce("mode", F.lit("")) != "test")
    best = F.max_by("status", F.struct(rank(F.col("status")), -F.col(order)))
    return observations.where("status is not null").groupBy(*keys).agg(best.alias("status"), F.count(F.lit(1)).alias("observations"))


def bucket_counts() -> list[Column]:
    return [F.count_if(bucket(F.col("status")) == b).alias(b) for b in BUCKETS]


def accounting(canon: DataFrame, universe: DataFrame, by: str) -> DataFrame:
    """A row per group of the universe (by, total), and one for all (null): counts by bucket, unsearched, coverage, duplicates.

    canon: rows of `canonical` with the column `by`.
    """
    seen = canon.groupBy(by).agg(F.count(F.lit(1)).alias("probed_unique"), F.sum("observations").alias("attempts"), *bucket_counts())
    each = universe.select(by, "total").join(seen, by, "left").na.fill(0)
    sums = [F.sum(c).alias(c) for c in ("total", "probed_unique", "attempts", *BUCKETS)]
    out = each.rollup(by).agg(F.grouping(by).alias("all_groups"), *sums)
    return out.select(
        by, F.col("all_groups").cast("int").alias("all_groups"), "total", "probed_unique", (F.col("total") - F.col("probed_unique")).alias("unsearched"),
        *BUCKETS, "attempts", F.greatest(F.col("attempts") - F.col("probed_unique"), F.lit(0)).alias("duplicates"), fraction(F.col("probed_unique"), F.col("total")).alias("coverage"),
    )


def lineage(batch_candidates: DataFrame, max_depth: int = 8) -> DataFrame:
    """batch_id, pos, root_key, root_pos, depth: the chunk position that a retry candidate goes back to, over any number of rounds.

    batch_candidates: batch_id, pos, source_key, source_ordinal. Candidates whose line ends in a missing batch,
    or doesn't end within max_depth (a cycle), have no root.
    """
    own = batch_candidates.where("source_key is not null").select("batch_id", "pos", F.col("source_key").alias("k"), F.col("source_ordinal").cast("long").alias("p"))
    parent = own.select(F.col("batch_id").alias("__pb"), F.col("pos").alias("__pp"), F.col("k").alias("__k"), F.col("p").alias("__p"))
    out, open_ = None, own.withColumn("depth", F.lit(1))
    for d in range(max_depth):
        done = open_.where(~F.col("k").startswith("batch-"))
        out = done if out is None else out.unionByName(done)
        if d + 1 < max_depth:
            up = open_.where(F.col("k").startswith("batch-"))
            open_ = up.join(parent, (up["k"] == parent["__pb"]) & (up["p"] == parent["__pp"])).select("batch_id", "pos", F.col("__k").alias("k"), F.col("__p").alias("p"), (F.col("depth") + 1).alias("depth"))
    return out.select("batch_id", "pos", F.col("k").alias("root_key"), F.col("p").alias("root_pos"), "depth")


def observed_candidates(primary: DataFrame, retries: DataFrame, roots: DataFrame) -> DataFrame:
    """key, pos, status, round of all observations: chunk results at round 1, each retry at its depth plus 1, by its root."""
    first = primary.select("key", "pos", "status", F.lit(1).alias("round"))
    r = retries.join(roots, (retries["key"] == roots["batch_id"]) & (retries["pos"] == roots["pos"]))
    return first.unionByName(r.select(F.col("root_key").alias("key"), F.col("root_pos").alias("pos"), "status", (F.col("depth") + 1).alias("round")))


def cross_check(live: DataFrame, recount: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Groups in which live tallies and a recount differ, with both."""
    a = live.select(*keys, *[F.col(c).alias(f"live_{c}") for c in columns])
    b = recount.select(*keys, *[F.col(c).alias(f"recount_{c}") for c in columns])
    differ = F.lit(False)
    for c in columns:
        differ = differ | ~F.col(f"live_{c}").eqNullSafe(F.col(f"recount_{c}"))
    return a.join(b, keys, "full").where(differ)


def tallies(results: DataFrame, by: str) -> DataFrame:
    """Tallies by bucket, attempts and chunks_done of results with a map `statuses`."""
    e = results.select(by, F.explode("statuses").alias("status", "v"))
    counts = e.groupBy(by).agg(*[F.sum(F.when(bucket(F.col("status")) == b, F.col("v")).otherwise(0)).alias(b) for b in BUCKETS])
    done = results.groupBy(by).agg(F.sum("candidates_probed_unique").alias("probed"), F.sum("head_attempts_total").alias("head_attempts"), F.count(F.lit(1)).alias("chunks_done"))
    return done.join(counts, by, "left").na.fill(0)


def reconciled(tally: DataFrame, moved: DataFrame, by: str) -> DataFrame:
    """Tallies after retries: what a retry settled leaves `undetermined`, down to 0, and joins its bucket. moved: by, status."""
    m = moved.withColumn("b", bucket(F.col("status"))).where("b <> 'undetermined'")
    got = m.groupBy(by).agg(F.count(F.lit(1)).alias("__out"), *[F.count_if(F.col("b") == b).alias(f"__{b}") for b in BUCKETS if b != "undetermined"])
    x = tally.join(got, by, "left").na.fill(0)
    new = {b: F.col(b) + F.col(f"__{b}") for b in BUCKETS if b != "undetermined"}
    return x.withColumns(new | {"undetermined": F.greatest(F.col("undetermined") - F.col("__out"), F.lit(0))}).select(*tally.columns)


def merge_partials(records: DataFrame) -> DataFrame:
    """pid, through, dirty (closed ranges a, b) of packages that several workers report on; all ordinals are global.

    records: pid, seq, probed_through, dirty_ranges (array of [a, b]). The furthest cursor counts (of equals the
    first by seq) with its debt; of the others' debt what lies beyond it.
    """
    best = records.groupBy("pid").agg(F.max_by(F.struct("seq", "probed_through"), F.struct(F.coalesce("probed_through", F.lit(0)), -F.col("seq"))).alias("best"))
    x = records.join(best, "pid").select("pid", (F.col("seq") == F.col("best.seq")).alias("own"), F.coalesce("best.probed_through", F.lit(0)).cast("long").alias("through"), "dirty_ranges")
    debt = x.select("pid", "own", "through", F.explode("dirty_ranges").alias("r"))
    low = F.when(F.col("own"), F.col("r")[0]).otherwise(F.greatest(F.col("r")[0], F.col("through")))
    merged = merge_closed(debt.select("pid", low.cast("long").alias("a"), F.col("r")[1].cast("long").alias("b")), ["pid"])
    lists = merged.groupBy("pid").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("dirty"))
    heads = x.groupBy("pid").agg(F.first("through").alias("through"))
    return heads.join(lists, "pid", "left").select("pid", "through", F.coalesce("dirty", F.expr("cast(array() as array<struct<a:bigint,b:bigint>>)")).alias("dirty"))


def package_states(shards: DataFrame) -> DataFrame:
    """pid, done: over all workers; done anywhere beats partial. shards: worker, packages (map of pid to struct with status)."""
    p = shards.select(F.explode("packages").alias("pid", "rec"))
    return p.groupBy("pid").agg(F.bool_or(F.col("rec.status") == "done").alias("done"))


def tier_progress(plan: DataFrame, states: DataFrame) -> DataFrame:
    """tier, packages, done, candidates, candidates_done, pending. plan: pid, tier, candidates."""
    x = plan.join(states, "pid", "left").withColumn("done", F.coalesce("done", F.lit(False)))
    g = x.groupBy("tier").agg(F.count(F.lit(1)).alias("packages"), F.count_if("done").alias("done"), F.sum("candidates").alias("candidates"), F.sum(F.when(F.col("done"), F.col("candidates")).otherwise(0)).alias("candidates_done"))
    return g.withColumn("pending", F.col("candidates") - F.col("candidates_done"))


def eta_hours(pending: Column, budget: Column) -> Column:
    return F.bround(pending / F.greatest(budget, F.lit(1.0)) / F.lit(3600.0), 2)


def claimable(plan: DataFrame, states: DataFrame, claimed: DataFrame) -> DataFrame:
    """Packages neither done nor claimed, in the order in which they are taken."""
    open_ = plan.join(states.where("done"), "pid", "left_anti").join(claimed.select("pid"), "pid", "left_anti")
    return open_.orderBy(*claim_order(F.col("pid")))


def first_wins(df: DataFrame, keys: list[str], value: str, seq: str) -> DataFrame:
    """keys and the value that comes first by seq."""
    return df.groupBy(*keys).agg(F.min_by(value, seq).alias(value))


def upsert(base: DataFrame, ours: DataFrame, theirs: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """A three-way merge of keyed rows: a row that we changed, added or removed is ours, all others are theirs."""
    side = lambda df, p: df.select(*keys, F.struct(*columns).alias(p))
    x = side(base, "b").join(side(ours, "o"), keys, "full").join(side(theirs, "t"), keys, "full")
    touched = ~F.col("o").eqNullSafe(F.col("b"))
    return x.withColumn("r", F.when(touched, F.col("o")).otherwise(F.col("t"))).where("r is not null").select(*keys, "r.*")


def outstanding(chunks: DataFrame, seen: DataFrame, entries: DataFrame) -> DataFrame:
    """key, unsearched, abandoned: what is missing of each chunk (key, size) after distinct observations (key, n); abandoned ones stand apart."""
    gone = entries.where("status = 'ABANDONED'").select("key", F.lit(True).alias("abandoned")).distinct()
    x = chunks.join(seen.select("key", "n"), "key", "left").join(gone, "key", "left")
    return x.select("key", (F.col("size") - F.coalesce("n", F.lit(0))).alias("unsearched"), F.coalesce("abandoned", F.lit(False)).alias("abandoned")).where("unsearched > 0")


def merged_maps(a, b):
    """Two maps as one; where both have a key, that of the second counts."""
    return F.map_zip_with(a, b, lambda k, x, y: F.coalesce(y, x))


def named(df: DataFrame, registry: DataFrame, key: str, name: str) -> DataFrame:
    """The rows with the registry's name for their key: null where the key is null, isn't listed, or is listed without a name."""
    known = registry.select(F.col(key).alias("__key"), F.col(name)).dropDuplicates(["__key"])
    return df.join(known, df[key] == F.col("__key"), "left").drop("__key")

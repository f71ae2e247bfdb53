"""The work queue as tables: entries, what may be dispatched, what went stale, retries, and the replay of outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import batch_id, chunk_key
from ..functions.status import retryable
from ..functions.times import parse_utc

# Attempts of an entry, requeues of it, rounds of a candidate, delays in minutes, and caps of a cycle.
ATTEMPTS, REQUEUES, ROUNDS = 4, 3, 3
REQUEUE_DELAY_MIN, STALE_DELAY_MIN = 120, 2
RETRY_DELAY_MIN = {2: 15, 3: 60}
CLAIM_GRACE_MIN, DEADLINE_MIN, QUEUED_ZOMBIE_MIN, HEARTBEAT_S = 8, 100, 30, 900
DISPATCH_PER_CYCLE, ACTIVE_CAP, FRONTIER_WINDOW, BATCH_SIZE = 60, 100, 600, 20_000


def dispatchable(entries: DataFrame, now: Column) -> DataFrame:
    ready = F.col("status").isin("PENDING", "RETRY") & (F.coalesce("job_attempts", F.lit(0)) < ATTEMPTS) & (F.coalesce("not_before", F.lit(0.0)) <= now)
    return entries.where(ready)


def dispatch(entries: DataFrame, now: Column, active: int) -> DataFrame:
    """The entries to start in this cycle: chunks by key before batches, within the caps."""
    return dispatchable(entries, now).orderBy(F.col("key").startswith("batch-"), "key").limit(max(0, min(DISPATCH_PER_CYCLE, ACTIVE_CAP - active)))


def stale(entries: DataFrame, claims: DataFrame, live_runs: DataFrame, now: Column) -> DataFrame:
    """RUNNING entries that are dead: the claim's run isn't live or is over its deadline; without a claim, past the grace period or undated."""
    c = claims.select("key", F.col("run_id").alias("__run"), parse_utc(F.col("started_utc")).alias("__s"), F.lit(True).alias("__claimed"))
    r = live_runs.select(F.col("run_id").alias("__live")).distinct()
    x = entries.where("status = 'RUNNING'").join(c, "key", "left").join(r, F.col("__run") == F.col("__live"), "left")
    at = parse_utc(F.col("dispatched_at"))
    dead = F.when(F.col("__claimed"), F.col("__live").isNull() | ((now - F.col("__s")) / 60 > DEADLINE_MIN)).otherwise((at == 0) | ((now - at) / 60 > CLAIM_GRACE_MIN))
    return x.where(dead).select(entries.columns)


def live_runs(runs: DataFrame, now: Column, zombie_min: int = QUEUED_ZOMBIE_MIN) -> DataFrame:
    """Runs in progress, and queued ones that aren't zombies yet: younger than so many minutes, 30 as published."""
    queued = (F.col("status") == "queued") & ((now - parse_utc(F.col("created_utc"))) / 60 < zombie_min)
    return runs.where((F.col("status") == "in_progress") | queued)


def fresh_shards(shards: DataFrame, now: Column) -> DataFrame:
    """Shards whose heartbeat is younger than 15 minutes; unreadable ones aren't fresh."""
    beat = parse_utc(F.col("heartbeat_utc"))
    return shards.where((beat > 0) & (now - beat < HEARTBEAT_S))


def releasable(claims: DataFrame, fresh: DataFrame) -> DataFrame:
    """Claims whose package no fresh shard works on."""
    return claims.join(fresh.select(F.col("current_pid").alias("pid")), "pid", "left_anti")


def ownership(claims: DataFrame, entries: DataFrame) -> DataFrame:
    """claims with reject: null if the worker may go on, else why not. claims: key, token, spec_sha256."""
    e = entries.select("key", F.col("status").alias("__st"), F.col("dispatch_token").alias("__t"), F.col("spec_sha256").alias("__sha"), F.col("has_result").alias("__r"))
    x = claims.join(e, "key", "left")
    why = F.when(F.col("__st").isNull(), "no entry").when(F.col("__st") != "RUNNING", "not running").when(~F.col("__t").eqNullSafe(F.col("token")), "token differs").when(F.coalesce("__r", F.lit(False)), "has a result").when(F.col("__sha").isNotNull() & ~F.col("__sha").eqNullSafe(F.col("spec_sha256")), "spec differs")
    return x.withColumn("reject", why).select(*claims.columns, "reject")


def frontier(spark: SparkSession, epochs: DataFrame, queued: DataFrame, window: int = FRONTIER_WINDOW) -> DataFrame:
    """epoch, chunk, key of the chunks to queue next, in order, so that `window` are open. epochs: epoch, chunks; queued: epoch, chunk."""
    open_ = queued.count()
    all_ = epochs.where("chunks > 0").select("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
    return all_.join(queued.select("epoch", "chunk"), ["epoch", "chunk"], "left_anti").orderBy("epoch", "chunk").limit(max(0, window - open_)).withColumn("key", chunk_key(F.col("epoch"), F.col("chunk")))


def ingestible(results: DataFrame, entries: DataFrame) -> DataFrame:
    """Results that still own an entry: each is taken in once. Of repeated ones the first by attempt."""
    owned = results.join(entries.select("key"), "key", "left_semi")
    w = Window.partitionBy("key").orderBy("attempt")
    return owned.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def retry_batches(undetermined: DataFrame, next_number: int = 0, size: int = BATCH_SIZE) -> DataFrame:
    """batch_id, retry_level, parent_result, place and the candidate, for outcomes to try again within the rounds.

    undetermined: key, retry_level (null for chunks), pos, status and any fields of the candidate. A parent's
    candidates go to batches of `size` by position; batches are numbered by parent.
    """
    level = F.coalesce("retry_level", F.lit(1)) + 1
    x = undetermined.where(retryable(F.col("status"))).withColumn("__level", level).where(F.col("__level") <= ROUNDS)
    x = x.withColumn("__n", F.row_number().over(Window.partitionBy("key").orderBy("pos")) - 1)
    x = x.withColumns({"__part": F.floor(F.col("__n") / size).cast("long"), "place": F.pmod("__n", F.lit(size)).cast("int")})
    parts = x.groupBy("key").agg(F.max("__part").alias("__last"))
    before = F.coalesce(F.sum(F.col("__last") + 1).over(Window.orderBy("key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    x = x.join(parts.withColumn("__first", before).select("key", "__first"), "key")
    rest = [c for c in undetermined.columns if c not in ("key", "retry_level", "pos", "status")]
    return x.select(batch_id(F.col("__first") + F.col("__part") + next_number).alias("batch_id"), F.col("__level").alias("retry_level"), F.col("key").alias("parent_result"), "place", F.col("key").alias("source_key"), F.col("pos").alias("source_ordinal"), F.col("status").alias("prior_status"), *rest)


def resume(work: DataFrame, confirmed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a resumed run has left to probe, and the confirmed rows that its result takes over. Both by key and pos."""
    return work.join(confirmed.select("key", "pos"), ["key", "pos"], "left_anti"), confirmed.join(work.select("key", "pos"), ["key", "pos"], "left_semi")


def ordered_work(expansion: DataFrame, debt: DataFrame, main: DataFrame) -> DataFrame:
    """One stream of ordinals: expansion windows, then retry debt, then the rest, each in its order (seq). Repeats count at their first."""
    tag = lambda df, p: df.select("ordinal", "seq", F.lit(p).alias("priority"))
    x = tag(expansion, 0).unionByName(tag(debt, 1)).unionByName(tag(main, 2))
    best = x.groupBy("ordinal").agg(F.min(F.struct("priority", "seq")).alias("b"))
    return best.select("ordinal", "b.priority", "b.seq").orderBy("priority", "seq", "ordinal")


def replay(events: DataFrame) -> DataFrame:
    """key, status, job_attempts, requeues, not_before after all events of each key (key, seq, at, kind).

    kinds: dispatched, completed, partial, stale, test. A partial or stale run takes an attempt; after the fourth
    the entry is requeued, and abandoned at the fourth requeue. Settled entries change no more. An entry's events are few.
    """
    state = "struct<status:string,job_attempts:int,requeues:int,not_before:double>"
    start = F.struct(F.lit("PENDING").alias("status"), F.lit(0).alias("job_attempts"), F.lit(0).alias("requeues"), F.lit(0.0).alias("not_before")).cast(state)

    def step(s: Column, e: Column) -> Column:
        settled = s["status"].isin("COMPLETED", "ABANDONED", "IGNORED_TEST")
        failed = e["kind"].isin("partial", "stale")
        attempts = s["job_attempts"] + 1
        out_of = attempts >= ATTEMPTS
        requeues = s["requeues"] + 1
        delay = F.when(e["kind"] == "stale", F.lit(STALE_DELAY_MIN)).when(attempts + 1 == 2, F.lit(RETRY_DELAY_MIN[2])).otherwise(F.lit(RETRY_DELAY_MIN[3]))
        status = F.when(~failed, F.when(e["kind"] == "dispatched", "RUNNING").when(e["kind"] == "completed", "COMPLETED").when(e["kind"] == "test", "IGNORED_TEST").otherwise(s["status"])).when(~out_of, "RETRY").when(requeues > REQUEUES, "ABANDONED").otherwise("PENDING")
        new = F.struct(
            status.alias("status"),
            F.when(failed, attempts).otherwise(s["job_attempts"]).alias("job_attempts"),
            F.when(failed & out_of, requeues).otherwise(s["requeues"]).alias("requeues"),
            F.when(failed & ~out_of, e["at"] + delay * 60).when(failed & (requeues <= REQUEUES), e["at"] + F.lit(REQUEUE_DELAY_MIN * 60)).otherwise(s["not_before"]).alias("not_before"),
        ).cast(state)
        return F.when(settled, s).otherwise(new)

    rows = F.array_sort(F.collect_list(F.struct("seq", F.col("at").cast("double").alias("at"), "kind")))
    return events.groupBy("key").agg(rows.alias("__e")).select("key", F.aggregate("__e", start, step).alias("s")).select("key", "s.*")


def histogram(entries: DataFrame) -> DataFrame:
    return entries.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def drained(entries: DataFrame, exhausted: bool) -> bool:
    """No epoch is left and no entry is open: time for the final accounting."""
    return exhausted and entries.where(F.col("status").isin("PENDING", "RETRY", "RUNNING")).isEmpty()


def pruned(shards: DataFrame, now: Column, hours: int = 48) -> DataFrame:
    """Shards whose heartbeat is younger than so many hours; unreadable ones go."""
    beat = parse_utc(F.col("heartbeat_utc"))
    return shards.where((beat > 0) & (now - beat < hours * 3600))

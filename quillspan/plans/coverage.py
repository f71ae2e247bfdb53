"""Queries of coverage accounting, intervals and ordinals, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions.numbers import div
from ..functions.status import bucket, retryable
from ..operators import accounting as A
from ..operators import codec as C
from ..operators import intervals as I
from ..operators import ordinals as O
from .tables import DAY_MS, ITEMS, OBSERVATIONS, WINDOWS, items, left_sql, merged_sql, observations, order_windows, shipped, table

QUERIES, SQL = {}, {}
_WIDTH = 4 * DAY_MS


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_TOTALS = "universe AS (SELECT epoch, CAST(count(DISTINCT series) * 20 AS BIGINT) AS total FROM obs GROUP BY epoch)"
_COUNTS = ", ".join(f"CAST(count(*) FILTER (bucket = '{b}') AS BIGINT) AS {b}" for b in ("found_200", "found_invalid", "confirmed_404", "undetermined", "other"))
_SUMS = ", ".join(f"CAST(coalesce(sum({b}), 0) AS BIGINT) AS {b}" for b in ("total", "probed_unique", "attempts", "found_200", "found_invalid", "confirmed_404", "undetermined", "other"))


@query(f"""WITH {OBSERVATIONS}, {_TOTALS},
g AS (SELECT epoch, CAST(count(*) AS BIGINT) AS probed_unique, CAST(sum(observations) AS BIGINT) AS attempts, {_COUNTS} FROM canon GROUP BY epoch),
r AS (SELECT u.epoch AS epoch, CAST(grouping(u.epoch) AS INTEGER) AS all_groups, {_SUMS} FROM universe u LEFT JOIN g ON u.epoch = g.epoch GROUP BY ROLLUP (u.epoch))
SELECT epoch, all_groups, total, probed_unique, total - probed_unique AS unsearched, found_200, found_invalid, confirmed_404, undetermined, other, attempts,
  greatest(attempts - probed_unique, 0) AS duplicates, CASE WHEN total = 0 THEN 0.0 ELSE round_even(probed_unique / total, 6) END AS coverage FROM r""")
def coverage_accounting(spark, d):
    obs = observations(spark, d)
    universe = obs.groupBy("epoch").agg((F.count_distinct("series") * 20).alias("total"))
    return A.accounting(A.canonical(obs, ["candidate", "epoch"]), universe, "epoch")


@query(f"WITH {OBSERVATIONS} SELECT candidate, status, CAST(observations AS BIGINT) AS observations FROM canon")
def canonical_status(spark, d):
    return A.canonical(observations(spark, d), ["candidate"])


@query(f"""WITH {OBSERVATIONS} SELECT bucket, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (status = '503' OR status LIKE 'OTHER_%') AS BIGINT) AS again FROM ranked GROUP BY bucket""")
def status_buckets(spark, d):
    x = observations(spark, d).select(bucket(F.col("status")).alias("bucket"), retryable(F.col("status")).alias("again"))
    return x.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.count_if("again").alias("again"))


@query(f"WITH {WINDOWS}, {merged_sql('m', 'win')} SELECT k, lo, hi FROM m")
def interval_merge(spark, d):
    return I.merge(order_windows(spark, d), ["k"])


@query(f"WITH {WINDOWS}, {merged_sql('m', 'win')} SELECT k, CAST(sum(hi - lo) AS BIGINT) AS covered FROM m GROUP BY k")
def covered_count(spark, d):
    return I.covered_count(order_windows(spark, d), ["k"])


@query(f"WITH {WINDOWS}, {merged_sql('c', 'ship')}, {left_sql('x', 'win', 'c')} SELECT k, lo, hi, label FROM x")
def interval_subtract(spark, d):
    return I.subtract(order_windows(spark, d), shipped(spark, d), ["k"], _WIDTH)


_OWNED = "owned AS (SELECT k, greatest(lo, coalesce(reach, lo)) AS lo, hi, label FROM (SELECT *, max(hi) OVER (PARTITION BY k ORDER BY lo, hi, label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM (SELECT DISTINCT * FROM win WHERE hi > lo)))"


@query(f"WITH {WINDOWS}, {_OWNED}, {merged_sql('c', 'ship')}, {left_sql('x', 'owned', 'c')} SELECT k, lo, hi, label FROM x")
def fresh_windows(spark, d):
    return I.fresh(order_windows(spark, d), shipped(spark, d), ["k"], ["label"], _WIDTH)


def _points(spark, d):
    return order_windows(spark, d).select("k", (F.col("lo") + DAY_MS).alias("instant")).distinct()


@query(f"WITH {WINDOWS}, {merged_sql('c', 'ship')}, p AS (SELECT DISTINCT k, lo + 86400000 AS instant FROM win) SELECT k, instant FROM p WHERE EXISTS (SELECT 1 FROM c WHERE c.k = p.k AND c.lo <= p.instant AND p.instant < c.hi)")
def points_inside(spark, d):
    return I.containing(_points(spark, d), shipped(spark, d), ["k"], "instant", _WIDTH)


@query(f"WITH {WINDOWS}, {merged_sql('c', 'ship')}, p AS (SELECT DISTINCT k, lo + 86400000 AS instant FROM win) SELECT k, instant FROM p WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.k = p.k AND c.lo <= p.instant AND p.instant < c.hi)")
def points_outside(spark, d):
    return I.containing(_points(spark, d), shipped(spark, d), ["k"], "instant", _WIDTH, "left_anti")


@query(f"WITH {WINDOWS} SELECT k, greatest(lo, 820454400000) AS lo, least(hi, 915148800000) AS hi, label FROM win WHERE least(hi, 915148800000) > greatest(lo, 820454400000)")
def interval_clip(spark, d):
    return I.clip(order_windows(spark, d), F.lit(820454400000), F.lit(915148800000))


@query("SELECT p_brand, min(p_partkey) AS a, max(p_partkey) AS b FROM (SELECT *, p_partkey - row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS g FROM (SELECT left(p_brand, 7) AS p_brand, p_partkey FROM part WHERE p_size > 9)) GROUP BY p_brand, g")
def range_compress(spark, d):
    return I.compress(table(spark, d, "part").where("p_size > 9").select(F.expr("left(p_brand, 7)").alias("p_brand"), "p_partkey"), ["p_brand"], "p_partkey")


@query("SELECT p_brand, p_partkey AS at FROM part WHERE p_size > 9")
def range_expand(spark, d):
    return I.expand(I.compress(table(spark, d, "part").where("p_size > 9"), ["p_brand"], "p_partkey"), ["p_brand"], "at")


_RUNS = "pt AS (SELECT event_id // 50 AS g, event_id % 50 AS place, event_type <> 'error' AS ok, event_id FROM events)"


@query(f"WITH {_RUNS} SELECT g, coalesce(min(r) FILTER (place <> r), max(place) + 1) AS through FROM (SELECT g, place, row_number() OVER (PARTITION BY g ORDER BY place) - 1 AS r FROM pt WHERE ok) GROUP BY g")
def contiguous_prefix(spark, d):
    e = table(spark, d, "events").select(div(F.col("event_id"), 50).alias("g"), F.pmod("event_id", F.lit(50)).alias("place"), "event_type")
    return I.contiguous_prefix(e.where("event_type <> 'error'"), ["g"], "place")


@query(f"WITH {_RUNS}, kept AS (SELECT g, place FROM pt WHERE ok UNION SELECT g, place FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY event_id) AS n FROM pt WHERE NOT ok) WHERE n <= 3) SELECT g, coalesce(min(r) FILTER (place <> r), max(place) + 1) AS through FROM (SELECT g, place, row_number() OVER (PARTITION BY g ORDER BY place) - 1 AS r FROM kept) GROUP BY g")
def recorded_prefix(spark, d):
    e = table(spark, d, "events").select(div(F.col("event_id"), 50).alias("g"), F.pmod("event_id", F.lit(50)).alias("place"), (F.col("event_type") != "error").alias("ok"), "event_id")
    return I.recorded_prefix(e, ["g"], "place", "ok", "event_id", 3)


def _placed(spark, d):
    return O.with_offsets(items(spark, d), F.col("n"))


@query(f"WITH {ITEMS} SELECT seq, n, ordinal0 FROM placed")
def prefix_offsets(spark, d):
    return _placed(spark, d).select("seq", "n", "ordinal0")


@query(f"WITH {ITEMS}, o AS (SELECT event_id * 37 AS ordinal FROM events) SELECT o.ordinal, p.map_id, p.t0 + o.ordinal - p.ordinal0 AS ts_ms, p.tier FROM o JOIN placed p ON o.ordinal >= p.ordinal0 AND o.ordinal < p.ordinal0 + p.n")
def ordinal_decode(spark, d):
    o = table(spark, d, "events").select((F.col("event_id") * 37).alias("ordinal"))
    return O.decode(o, _placed(spark, d), 4096).select("ordinal", "map_id", (F.col("t0") + F.col("within")).alias("ts_ms"), "tier")


@query(f"WITH {ITEMS}, o AS (SELECT unnest(range(20000, 40000)) AS ordinal) SELECT o.ordinal, p.map_id, p.t0 + o.ordinal - p.ordinal0 AS ts_ms, p.tier FROM o JOIN placed p ON o.ordinal >= p.ordinal0 AND o.ordinal < p.ordinal0 + p.n")
def chunk_candidates(spark, d):
    x = _placed(spark, d)
    start, end = O.chunk_bounds(O.total(x, F.col("n")), 20_000, 1)
    return O.candidates(spark, x, start, end, 4096)


@query(f"WITH {ITEMS}, t AS (SELECT CAST(sum(n) AS BIGINT) AS total FROM items), c AS (SELECT unnest(range(0, (total + 19999) // 20000)) AS chunk, total FROM t) SELECT chunk, format('e1-chunk-{{:06d}}', chunk) AS key, chunk * 20000 AS start, least(chunk * 20000 + 20000, total) AS \"end\", least(chunk * 20000 + 20000, total) - chunk * 20000 AS size FROM c")
def chunk_table(spark, d):
    return O.chunks(spark, O.total(items(spark, d), F.col("n")), 20_000)


_CUT = """cut AS (
  SELECT pk AS package, format('b{:05d}', pk) AS pid, tier, map_id, priority, t0 + greatest(pk * 170000, ordinal0) - ordinal0 AS t0,
    t0 + least((pk + 1) * 170000, ordinal0 + n) - ordinal0 AS t1, greatest(pk * 170000, ordinal0) AS item_ordinal0
  FROM (SELECT *, unnest(range(ordinal0 // 170000, (ordinal0 + n - 1) // 170000 + 1)) AS pk FROM placed WHERE n > 0))"""


@query(f"WITH {ITEMS}, {_CUT} SELECT pid, tier, map_id, t0, t1, item_ordinal0 FROM cut")
def cut_packages(spark, d):
    return O.cut_packages(_placed(spark, d), 170_000).select("pid", "tier", "map_id", "t0", "t1", "item_ordinal0")


@query(f"WITH {ITEMS}, {_CUT} SELECT pid, min(item_ordinal0) AS ordinal0, CAST(sum(t1 - t0) AS BIGINT) AS candidates, CAST(count(*) AS BIGINT) AS parts, min(priority) AS priority FROM cut GROUP BY pid")
def package_table(spark, d):
    return O.packages(O.cut_packages(_placed(spark, d), 170_000)).select("pid", "ordinal0", "candidates", F.size("items").cast("long").alias("parts"), "priority")


@query(f"WITH {ITEMS}, {_CUT} SELECT tier, CAST(count(DISTINCT package) AS BIGINT) AS packages, CAST(sum(t1 - t0) AS BIGINT) AS candidates, round_even(CAST(sum(t1 - t0) AS DOUBLE) / 60000.0 / 3600.0, 2) AS hours FROM cut GROUP BY ROLLUP (tier)")
def plan_stats(spark, d):
    return O.plan_stats(O.cut_packages(_placed(spark, d), 170_000))


_DAYS = "dw AS (SELECT strftime(make_timestamp_ms(1600000000000 + p_partkey * 86400000), '%Y-%m-%d') AS day, max(p_retailprice) AS weight FROM part WHERE p_partkey % 3 = 0 GROUP BY 1), hd AS (SELECT p_partkey % 24 AS hour, max(p_retailprice) AS density FROM part WHERE p_size < 20 GROUP BY 1)"


@query(f"""WITH {ITEMS}, {_DAYS}, first AS (SELECT tier, min(seq) AS f FROM items GROUP BY tier)
SELECT seq, row_number() OVER (ORDER BY priority, f, coalesce(weight, 0.5) DESC, strftime(make_timestamp_ms(t0), '%Y-%m-%d'), coalesce(density, 0.0) DESC, t0 // 3600000, map_id, t0, seq) AS rank
FROM items i JOIN first USING (tier) LEFT JOIN dw ON dw.day = strftime(make_timestamp_ms(t0), '%Y-%m-%d') LEFT JOIN hd ON hd.hour = (t0 // 3600000) % 24""")
def hour_major_order(spark, d):
    p = table(spark, d, "part")
    w = p.where("p_partkey % 3 = 0").select(F.date_format(F.timestamp_millis(F.lit(1_600_000_000_000) + F.col("p_partkey") * DAY_MS), "yyyy-MM-dd").alias("day"), F.col("p_retailprice").alias("weight"))
    h = p.where("p_size < 20").select(F.pmod("p_partkey", F.lit(24)).alias("hour"), F.col("p_retailprice").alias("density"))
    return O.hour_major(items(spark, d), w, h).select("seq", "rank")


@query(f"WITH {ITEMS}, odd AS (SELECT seq, ordinal0, CASE WHEN seq % 90 = 0 THEN n - 1 ELSE n END AS n FROM placed), e AS (SELECT *, coalesce(lag(ordinal0 + n) OVER (ORDER BY ordinal0, seq), 0) AS expected FROM odd WHERE n > 0) SELECT seq, ordinal0, n, expected FROM e WHERE ordinal0 <> expected")
def continuity_breaks(spark, d):
    odd = _placed(spark, d).select("seq", "ordinal0", F.when(F.pmod("seq", F.lit(90)) == 0, F.col("n") - 1).otherwise(F.col("n")).alias("n"))
    return O.breaks(odd.where("n > 0"), [])


@query(f"WITH {ITEMS}, {_CUT}, lost AS (SELECT * FROM cut WHERE package <> 3), w AS (SELECT tier, CAST(sum(n) AS BIGINT) AS expected FROM items GROUP BY tier), h AS (SELECT tier, CAST(sum(t1 - t0) AS BIGINT) AS actual FROM lost GROUP BY tier) SELECT tier, expected, coalesce(actual, 0) AS actual FROM w LEFT JOIN h USING (tier) WHERE expected <> coalesce(actual, 0)")
def conservation_breaks(spark, d):
    parts = O.cut_packages(_placed(spark, d), 170_000)
    return O.conservation(items(spark, d), parts.where("package <> 3"))


@query(f"WITH {ITEMS} SELECT DISTINCT ordinal0 AS ordinal FROM placed WHERE ordinal0 % 700 = 0 OR seq % 250 = 1")
def systematic_sample(spark, d):
    x = _placed(spark, d)
    return O.systematic_sample(x.select(F.col("ordinal0").alias("ordinal")), "ordinal", 700, x.where("seq % 250 = 1").select("ordinal0"))


@query(f"WITH {ITEMS} SELECT seq, b AS block, least(1000, n - b * 1000) AS length FROM (SELECT seq, n, unnest(range(0, (n - 1) // 1000 + 1)) AS b FROM items WHERE n > 0)")
def item_blocks(spark, d):
    return O.blocks(items(spark, d)).select("seq", "block", "length")


_RESULTS = "res AS (SELECT c_custkey AS c, format('e1-chunk-{:06d}', c_custkey) AS key, c_custkey % 9 AS n, CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN '404' ELSE '503' END AS dflt FROM customer)"


def _results(spark, d):
    c = table(spark, d, "customer")
    n = F.pmod("c_custkey", F.lit(9))
    off = F.col("c_custkey") * 9
    return c.select(
        K.chunk_key(F.lit(1), F.col("c_custkey")).alias("key"), F.lit("epoch:1").alias("candidate_source"), F.col("c_custkey").alias("chunk_id"), n.alias("candidates_probed_unique"),
        F.when(F.pmod("c_custkey", F.lit(11)) == 0, F.lit(None).cast("string")).when(F.pmod("c_custkey", F.lit(2)) == 0, "404").otherwise("503").alias("default_status"),
        F.array(F.array((off + 2).cast("string"), F.lit("200")), F.array((off + 5).cast("string"), F.lit("TIMEOUT"))).alias("exceptions"),
    )


@query(f"WITH {_RESULTS} SELECT key, pos, CASE pos WHEN 2 THEN '200' WHEN 5 THEN 'TIMEOUT' ELSE dflt END AS status FROM (SELECT *, unnest(range(0, n)) AS pos FROM res WHERE dflt IS NOT NULL)")
def decode_statuses(spark, d):
    return C.decode_statuses(_results(spark, d), 9)


@query(f"""WITH {OBSERVATIONS}, c AS (SELECT series, status, count(*) AS n, min(event_id) AS f FROM obs GROUP BY series, status),
h AS (SELECT series, status AS default_status FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY n DESC, f) AS r FROM c) WHERE r = 1)
SELECT CAST(series AS VARCHAR) AS key, default_status, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (status <> default_status) AS BIGINT) AS odd, coalesce(min(event_id) FILTER (status <> default_status), -1) AS first_odd FROM obs JOIN h USING (series) GROUP BY series, default_status""")
def encode_statuses(spark, d):
    x = C.encode_statuses(observations(spark, d).select(F.col("series").cast("string").alias("key"), F.col("event_id").alias("pos"), "status"))
    return x.select("key", "default_status", "n", F.size("exceptions").cast("long").alias("odd"), F.coalesce(F.get("exceptions", F.lit(0))["pos"], F.lit(-1)).alias("first_odd"))


_LINES = "bc AS (SELECT format('batch-{:04d}', o_orderkey % 3 * 50 + o_orderkey // 3 % 50) AS batch_id, o_orderkey // 150 AS pos, CASE WHEN o_orderkey % 3 = 0 THEN format('e1-chunk-{:06d}', o_orderkey // 3 % 50) ELSE format('batch-{:04d}', (o_orderkey % 3 - 1) * 50 + o_orderkey // 3 % 50) END AS source_key FROM orders)"


def _batches(spark, d):
    k = F.col("o_orderkey")
    level, b = F.pmod(k, F.lit(3)), F.pmod(div(k, 3), F.lit(50))
    source = F.when(level == 0, K.chunk_key(F.lit(1), b)).otherwise(K.batch_id((level - 1) * 50 + b))
    return table(spark, d, "orders").select(K.batch_id(level * 50 + b).alias("batch_id"), div(k, 150).alias("pos"), source.alias("source_key"), div(k, 150).alias("source_ordinal"))


@query(f"WITH RECURSIVE {_LINES}, up AS (SELECT batch_id, pos, source_key, pos AS p, 1 AS depth FROM bc UNION ALL SELECT u.batch_id, u.pos, b.source_key, b.pos, u.depth + 1 FROM up u JOIN bc b ON u.source_key = b.batch_id AND u.p = b.pos WHERE u.depth < 8) SELECT batch_id, pos, source_key AS root_key, p AS root_pos, depth FROM up WHERE source_key NOT LIKE 'batch-%'")
def retry_lineage(spark, d):
    return A.lineage(_batches(spark, d))


@query(f"""WITH {OBSERVATIONS}, t AS (SELECT epoch, CAST(count(*) AS BIGINT) AS probed, {_COUNTS} FROM ranked WHERE event_id % 2 = 0 GROUP BY epoch),
m AS (SELECT epoch, count(*) AS moved, count(*) FILTER (bucket = 'found_200') AS a, count(*) FILTER (bucket = 'found_invalid') AS b, count(*) FILTER (bucket = 'confirmed_404') AS c, count(*) FILTER (bucket = 'other') AS o FROM ranked WHERE event_id % 10 = 1 AND bucket <> 'undetermined' GROUP BY epoch)
SELECT epoch, probed, CAST(found_200 + coalesce(a, 0) AS BIGINT) AS found_200, CAST(found_invalid + coalesce(b, 0) AS BIGINT) AS found_invalid, CAST(confirmed_404 + coalesce(c, 0) AS BIGINT) AS confirmed_404, CAST(greatest(undetermined - coalesce(moved, 0), 0) AS BIGINT) AS undetermined, CAST(other + coalesce(o, 0) AS BIGINT) AS other FROM t LEFT JOIN m USING (epoch)""")
def reconciled_tallies(spark, d):
    obs = observations(spark, d)
    t = obs.where("event_id % 2 = 0").groupBy("epoch").agg(F.count(F.lit(1)).alias("probed"), *A.bucket_counts())
    return A.reconciled(t, obs.where("event_id % 10 = 1").select("epoch", "status"), "epoch")


@query(f"WITH {OBSERVATIONS}, a AS (SELECT epoch, CAST(count(*) AS BIGINT) AS n FROM obs WHERE NOT (epoch = 3 AND event_id % 5 = 0) GROUP BY epoch), b AS (SELECT epoch, CAST(count(*) AS BIGINT) AS n FROM obs GROUP BY epoch) SELECT epoch, a.n AS live_n, b.n AS recount_n FROM a FULL JOIN b USING (epoch) WHERE a.n IS DISTINCT FROM b.n")
def tally_cross_check(spark, d):
    obs = observations(spark, d)
    n = lambda x: x.groupBy("epoch").agg(F.count(F.lit(1)).alias("n"))
    return A.cross_check(n(obs.where("not (epoch = 3 and event_id % 5 = 0)")), n(obs), ["epoch"], ["n"])


def _records(spark, d):
    p, s = table(spark, d, "part"), F.col("p_size").cast("long")
    return p.select(F.concat(F.lit("b"), F.pmod("p_partkey", F.lit(100))).alias("pid"), F.col("p_partkey").alias("seq"), (s * 10).alias("probed_through"), F.array(F.array(s * 7, s * 7 + 3), F.array(s * 12, s * 12 + 5)).alias("dirty_ranges"))


_PARTIALS = f"""rec AS (SELECT 'b' || CAST(p_partkey % 100 AS VARCHAR) AS pid, p_partkey AS seq, CAST(p_size AS BIGINT) AS s FROM part),
best AS (SELECT pid, seq AS bseq, s * 10 AS through FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY s DESC, seq) AS r FROM rec) WHERE r = 1),
debt AS (SELECT pid, seq, s * 7 AS a, s * 7 + 3 AS b FROM rec UNION ALL SELECT pid, seq, s * 12, s * 12 + 5 FROM rec),
clipped AS (SELECT pid, CASE WHEN seq = bseq THEN a ELSE greatest(a, through) END AS lo, b + 1 AS hi FROM debt JOIN best USING (pid)),
{merged_sql('m', 'clipped', 'pid')}"""


@query(f"WITH {_PARTIALS} SELECT pid, through, lo AS a, hi - 1 AS b FROM best JOIN m USING (pid)")
def merged_partials(spark, d):
    x = A.merge_partials(_records(spark, d))
    return x.select("pid", "through", F.explode("dirty").alias("r")).select("pid", "through", "r.a", "r.b")


_PLAN = "plan AS (SELECT format('b{:05d}', p_partkey) AS pid, left(p_brand, 7) AS tier, CAST(p_size AS BIGINT) AS candidates FROM part), st AS (SELECT format('b{:05d}', l_partkey) AS pid, bool_or(l_returnflag = 'R' AND l_quantity > 45) AS done FROM lineitem GROUP BY 1)"


def _plan(spark, d):
    return table(spark, d, "part").select(K.package_id(F.col("p_partkey")).alias("pid"), F.expr("left(p_brand, 7)").alias("tier"), F.col("p_size").cast("long").alias("candidates"))


def _states(spark, d):
    x = table(spark, d, "lineitem").select(K.package_id(F.col("l_partkey")).alias("pid"), F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45), "done").otherwise("partial").alias("status"))
    shards = x.select(F.create_map("pid", F.struct("status")).alias("packages"))
    return A.package_states(shards)


@query(f"WITH {_PLAN} SELECT tier, CAST(count(*) AS BIGINT) AS packages, CAST(count(*) FILTER (coalesce(done, false)) AS BIGINT) AS done, CAST(sum(candidates) AS BIGINT) AS candidates, CAST(sum(CASE WHEN done THEN candidates ELSE 0 END) AS BIGINT) AS candidates_done, CAST(sum(CASE WHEN done THEN 0 ELSE candidates END) AS BIGINT) AS pending, round_even(CAST(sum(CASE WHEN done THEN 0 ELSE candidates END) AS DOUBLE) / 7.0 / 3600.0, 2) AS eta_h FROM plan LEFT JOIN st USING (pid) GROUP BY tier")
def tier_progress(spark, d):
    return A.tier_progress(_plan(spark, d), _states(spark, d)).withColumn("eta_h", A.eta_hours(F.col("pending"), F.lit(7.0)))


@query(f"WITH {_PLAN} SELECT pid, candidates FROM plan p WHERE NOT EXISTS (SELECT 1 FROM st WHERE st.pid = p.pid AND done) AND candidates % 7 <> 0")
def claimable_packages(spark, d):
    p = _plan(spark, d)
    return A.claimable(p, _states(spark, d), p.where("candidates % 7 = 0")).select("pid", "candidates")


@query(f"WITH {ITEMS} SELECT map_id, path_fmt FROM (SELECT *, row_number() OVER (PARTITION BY map_id ORDER BY seq) AS r FROM items) WHERE r = 1")
def first_paths(spark, d):
    return A.first_wins(items(spark, d), ["map_id"], "path_fmt", "seq")


_THREE = "b AS (SELECT o_orderkey AS k, o_orderstatus AS v FROM orders WHERE o_orderkey % 4 <> 0), o AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS v FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 4 <> 0), t AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 'Y' ELSE o_orderstatus END AS v FROM orders WHERE o_orderkey % 11 <> 0)"


@query(f"WITH {_THREE}, j AS (SELECT coalesce(b.k, o.k, t.k) AS k, CASE WHEN o.v IS DISTINCT FROM b.v THEN o.v ELSE t.v END AS v FROM b FULL JOIN o ON b.k = o.k FULL JOIN t ON coalesce(b.k, o.k) = t.k) SELECT k, v FROM j WHERE v IS NOT NULL")
def three_way_merge(spark, d):
    x = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("v"))
    base = x.where("k % 4 <> 0")
    ours = base.where("k % 7 <> 0").withColumn("v", F.when(F.pmod("k", F.lit(5)) == 0, "X").otherwise(F.col("v")))
    theirs = x.where("k % 11 <> 0").withColumn("v", F.when(F.pmod("k", F.lit(3)) == 0, "Y").otherwise(F.col("v")))
    return A.upsert(base, ours, theirs, ["k"], ["v"])

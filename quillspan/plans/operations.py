"""Queries of expansion, prediction, telemetry, the work queue and the scalar functions, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import content as X
from ..functions import keys as K
from ..functions import numbers as N
from ..functions import times as T
from ..functions.status import is_bad
from ..operators import expand as E
from ..operators import ordinals as O
from ..operators import predict as P
from ..operators import queue as Q
from ..operators import telemetry as M
from ..sources.files import updated_manifest
from .tables import ITEMS, OBSERVATIONS, items, observations, table

QUERIES, SQL = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_FAMILIES = """fam AS (SELECT family, map_id, path_fmt FROM (SELECT *, CASE WHEN path_fmt LIKE '%/maps/%' THEN 'maps' ELSE 'plugins' END AS family, row_number() OVER (PARTITION BY (path_fmt LIKE '%/maps/%'), map_id ORDER BY seq) AS r FROM items WHERE tier LIKE 'h1%') WHERE r = 1),
ser AS (SELECT map_id, path_fmt FROM (SELECT *, row_number() OVER (PARTITION BY map_id ORDER BY seq) AS r FROM items) WHERE r = 1),
hit AS (SELECT map_id, t0 AS ts, replace(replace(path_fmt, '{map_id}', map_id), '{ts_ms}', CAST(t0 AS VARCHAR)) AS url FROM items)"""


def _hits(spark, d):
    x = items(spark, d)
    return x.select("map_id", F.col("t0").alias("ts_ms"), K.render_url(F.col("path_fmt"), F.col("map_id"), F.col("t0")).alias("url"))


@query(f"""WITH {ITEMS}, {_FAMILIES}
SELECT url, 'c1' AS ring, CAST(family = 'maps' AND f.map_id LIKE 'm%' AS INTEGER) AS part, f.map_id AS map_id, f.path_fmt AS path_fmt, ts - CASE WHEN family = 'maps' AND f.map_id LIKE 'm%' THEN 2500 ELSE 90000 END AS t0, ts + CASE WHEN family = 'maps' AND f.map_id LIKE 'm%' THEN 2500 ELSE 90000 END AS t1
FROM hit h JOIN fam f ON f.map_id <> h.map_id AND f.family = CASE WHEN url LIKE '%/maps/%' THEN 'maps' ELSE 'plugins' END
UNION ALL SELECT url, 'c2', 0, s.map_id, s.path_fmt, ts - 600000, ts + 600000 FROM hit h JOIN ser s ON s.map_id <> h.map_id""")
def cascade_windows(spark, d):
    x = items(spark, d)
    return E.cascade(_hits(spark, d), E.families(x), E.all_series(x))


@query(f"WITH {ITEMS}, {_FAMILIES} SELECT map_id, ts AS ts_ms, url FROM hit WHERE url NOT LIKE '%plugins%'")
def new_hits(spark, d):
    h = _hits(spark, d)
    return E.new_hits(h, h.where("url like '%plugins%'"), None).select("map_id", "ts_ms", "url")


@query("""WITH RECURSIVE i AS (SELECT p_brand, p_partkey, CAST(p_size AS BIGINT) AS n, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS r FROM part),
f AS (SELECT p_brand, p_partkey, n, r, 0 AS bin, CAST(0 AS BIGINT) AS "offset" FROM i WHERE r = 1
UNION ALL SELECT i.p_brand, i.p_partkey, i.n, i.r, CASE WHEN f."offset" + f.n + i.n > 90 THEN f.bin + 1 ELSE f.bin END, CASE WHEN f."offset" + f.n + i.n > 90 THEN 0 ELSE f."offset" + f.n END FROM f JOIN i ON i.p_brand = f.p_brand AND i.r = f.r + 1)
SELECT p_brand, p_partkey, n, bin, "offset" FROM f""")
def greedy_bins(spark, d):
    p = table(spark, d, "part").select("p_brand", "p_partkey", F.col("p_size").cast("long").alias("n"))
    return E.greedy_bins(p, ["p_brand"], ["p_partkey"], "n", 90)


_SERIES = """s AS (SELECT 'm' || CAST(c_custkey * 2 AS VARCHAR) || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '_' || CAST(c_custkey % 5 AS VARCHAR) END AS map_id, c_custkey * 2 AS n, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey % 5 END AS suffix FROM customer),
a AS (SELECT 'm' || CAST(s_suppkey * 7 AS VARCHAR) || CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE '_' || CAST(s_suppkey % 4 AS VARCHAR) END AS other, s_suppkey * 7 AS n, CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE s_suppkey % 4 END AS suffix, 1600000000000 + s_nationkey * 1000000 AS y FROM supplier)"""


@query(f"""WITH {_SERIES}, near AS (SELECT map_id, count(*) AS contributors, min(y) AS lo, max(y) AS hi FROM s JOIN a ON abs(s.n - a.n) <= 3 AND other <> map_id GROUP BY map_id),
dd AS (SELECT map_id, 'D' AS predictor, contributors, CASE WHEN contributors = 1 THEN lo - 5000 ELSE lo END AS lo, CASE WHEN contributors = 1 THEN hi + 5000 ELSE hi END AS hi, CASE WHEN contributors = 1 THEN 'MEDIUM' WHEN lo = hi THEN 'HIGH' ELSE 'LOW' END AS confidence FROM near),
pool AS (SELECT suffix, count(*) AS contributors, min(y) AS lo, max(y) AS hi FROM a WHERE suffix IS NOT NULL GROUP BY suffix),
b AS (SELECT map_id, 'B' AS predictor, contributors, lo, hi, 'LOW' AS confidence FROM s JOIN pool USING (suffix) WHERE map_id NOT IN (SELECT map_id FROM dd)),
mean AS (SELECT avg(n) AS mx, avg(y) AS my FROM a), fit AS (SELECT count(*) AS n, sum((a.n - mx) * (y - my)) / sum((a.n - mx) * (a.n - mx)) AS slope, any_value(mx) AS mx, any_value(my) AS my FROM a, mean),
res AS (SELECT max(abs(y - my - slope * (a.n - mx))) AS residual FROM a, fit),
e AS (SELECT map_id, 'E' AS predictor, fit.n AS contributors, CAST(round(my + slope * (s.n - mx) - 5 * residual) AS BIGINT) AS lo, CAST(round(my + slope * (s.n - mx) + 5 * residual) AS BIGINT) AS hi, 'LOW' AS confidence FROM s, fit, res WHERE map_id NOT IN (SELECT map_id FROM dd) AND map_id NOT IN (SELECT map_id FROM b))
SELECT map_id, predictor, CAST(contributors AS BIGINT) AS contributors, lo, hi, confidence FROM dd UNION ALL SELECT * FROM b UNION ALL SELECT * FROM e""")
def predicted_windows(spark, d):
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    name = lambda n, plain, suffix: F.concat(F.lit("m"), n.cast("string"), F.when(plain, F.lit("")).otherwise(F.concat(F.lit("_"), suffix.cast("string"))))
    k, sk = F.col("c_custkey"), F.col("s_suppkey")
    series = c.select(name(k * 2, F.pmod(k, F.lit(3)) == 0, F.pmod(k, F.lit(5))).alias("map_id"))
    anchors = s.select(name(sk * 7, F.pmod(sk, F.lit(2)) == 0, F.pmod(sk, F.lit(4))).alias("map_id"), (F.lit(1_600_000_000_000) + F.col("s_nationkey").cast("long") * 1_000_000).alias("anchor_ms"))
    return P.predict(series, anchors)


_TUMBLE = "t AS (SELECT status, value, user_id % 3 AS worker, epoch_us(ts) // 600000000 AS w FROM (SELECT o.*, o.series AS user_id FROM obs o))"


@query(f"""WITH {OBSERVATIONS}, {_TUMBLE} SELECT worker, w * 600 AS start_s, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (status = '200') AS BIGINT) AS n200, CAST(count(*) FILTER (status = '404') AS BIGINT) AS n404, CAST(count(*) FILTER (status = '503') AS BIGINT) AS n503, count(*) / 600.0 AS rps,
list_sort(list(value))[CAST(least(floor(0.5 * count(*)) + 1, count(*)) AS BIGINT)] AS p50_s, list_sort(list(value))[CAST(least(floor(0.95 * count(*)) + 1, count(*)) AS BIGINT)] AS p95_s FROM t GROUP BY worker, w""")
def telemetry_windows(spark, d):
    obs = observations(spark, d).select("ts", "status", F.pmod("series", F.lit(3)).alias("worker"), F.col("value").alias("latency_s"))
    w = M.tumbling(obs.withColumn("ts", F.col("ts").cast("timestamp")), ["worker"], "ts", 600)
    return w.select("worker", F.unix_seconds("window_start").alias("start_s"), "n", "n200", "n404", "n503", "rps", "p50_s", "p95_s")


@query(f"WITH {OBSERVATIONS}, l AS (SELECT series, list_sort(list(value)) AS v FROM obs GROUP BY series) SELECT series, v[CAST(round_even(0.5 * (len(v) - 1), 0) AS BIGINT) + 1] AS p50, v[CAST(round_even(0.95 * (len(v) - 1), 0) AS BIGINT) + 1] AS p95 FROM l")
def latency_percentiles(spark, d):
    return M.latency_percentiles(observations(spark, d).select("series", F.col("value").alias("latency_s")), ["series"])


@query(f"WITH {OBSERVATIONS}, r AS (SELECT epoch, value, row_number() OVER (PARTITION BY epoch ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY epoch) AS n FROM obs) SELECT epoch, value FROM r WHERE i = least(CAST(floor(n * 0.95) AS BIGINT), n - 1)")
def exact_percentile(spark, d):
    return M.exact_percentile(observations(spark, d), ["epoch"], "value", 0.95)


@query(f"WITH {OBSERVATIONS} SELECT series, CAST(count(*) FILTER (status IN ('503', 'OTHER_429')) AS BIGINT) AS bad, CAST(count(*) AS BIGINT) AS probed, count(*) FILTER (status IN ('503', 'OTHER_429')) / count(*) AS bad_frac FROM obs GROUP BY series")
def bad_fraction(spark, d):
    x = observations(spark, d).groupBy("series", "status").agg(F.count(F.lit(1)).alias("n"))
    return M.bad_fraction(x, ["series"])


@query("SELECT l_returnflag, CAST(sum(greatest(1, round_even(l_quantity * 0.3 * 9.7, 0))) AS BIGINT) AS probed, CAST(sum(l_linenumber) AS BIGINT) AS bad, sum(l_linenumber) / sum(greatest(1, round_even(l_quantity * 0.3 * 9.7, 0))) AS bad_frac FROM lineitem GROUP BY l_returnflag")
def fleet_bad_fraction(spark, d):
    x = table(spark, d, "lineitem").select("l_returnflag", (F.col("l_quantity") * 0.3).alias("rps"), F.lit(9.7).alias("dur_s"), F.col("l_linenumber").alias("n503"), F.lit(0).alias("ntimeout"), F.lit(0).alias("nneterr"))
    return M.fleet_bad_fraction(x, ["l_returnflag"])


@query("SELECT l_suppkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC) AS r FROM lineitem) WHERE r <= 12")
def tail_history(spark, d):
    return M.tail(table(spark, d, "lineitem"), ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey"], 12).select("l_suppkey", "l_orderkey", "l_linenumber")


@query(f"WITH {OBSERVATIONS} SELECT event_id FROM obs WHERE 1706000000 - ts_ms / 1000.0 < 1500 AND status <> 'OTHER_429'")
def recent_ledger(spark, d):
    x = observations(spark, d).select("event_id", (F.col("ts_ms") / 1000.0).alias("finished_s"), F.when(F.col("status") == "OTHER_429", "test").alias("mode"))
    return M.recent(x, F.lit(1_706_000_000)).select("event_id")


_CYCLES = "w AS (SELECT c_nationkey AS k, c_custkey, (c_custkey * 7 % 100) / 1000.0 AS bad, (c_custkey * 3 % 50) / 1000.0 AS err, c_custkey % 4 AS samples, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS r FROM customer)"


def _cycles(spark, d):
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k"), "c_custkey", (F.pmod(k * 7, F.lit(100)) / 1000.0).alias("bad"), (F.pmod(k * 3, F.lit(50)) / 1000.0).alias("err"), F.pmod(k, F.lit(4)).alias("samples"))


def _last(step: str, start: str, columns: str) -> str:
    return f"WITH RECURSIVE {_CYCLES}, f AS (SELECT DISTINCT k, CAST(0 AS BIGINT) AS r, {start} FROM w UNION ALL SELECT f.k, w.r, {step} FROM f JOIN w ON w.k = f.k AND w.r = f.r + 1) SELECT k, {columns} FROM (SELECT *, max(r) OVER (PARTITION BY k) AS m FROM f) WHERE r = m"


@query(_last("CASE WHEN bad <= 0.005 AND err <= 0.01 THEN least(greatest(least(rate, 2000.0), 0.0) + 25.0, 2000.0) WHEN bad > 0.02 OR err > 0.03 THEN greatest(12.0, least(rate, 2000.0) * 0.5) ELSE least(rate, 2000.0) END", "CAST(100.0 AS DOUBLE) AS rate", "rate"))
def worker_rate(spark, d):
    return M.fold_worker(_cycles(spark, d), ["k"], "c_custkey")


@query(_last("least(greatest(CASE WHEN bad <= 0.015 AND err <= 0.02 THEN least(rate + 200.0, 8000.0) WHEN bad <= 0.03 AND err <= 0.04 THEN rate WHEN bad <= 0.08 AND err <= 0.08 THEN greatest(greatest(150.0, best * 0.5), rate * 0.9) ELSE greatest(greatest(150.0, best * 0.5), rate * 0.7) END, 150.0), 8000.0), CASE WHEN bad <= 0.03 AND err <= 0.04 THEN greatest(best, rate) ELSE best END", "CAST(600.0 AS DOUBLE) AS rate, CAST(0.0 AS DOUBLE) AS best", "rate, best"))
def grid_rate(spark, d):
    return M.fold_grid(_cycles(spark, d), ["k"], "c_custkey")


@query(_last("CASE WHEN samples = 0 THEN budget WHEN bad > 0.08 THEN greatest(150.0, budget * 0.6) WHEN bad > 0.03 THEN greatest(150.0, budget * 0.8) WHEN bad < 0.01 THEN least(16000.0, budget * 1.15) ELSE budget END", "CAST(1500.0 AS DOUBLE) AS budget", "budget"))
def global_budget(spark, d):
    return M.fold_budget(_cycles(spark, d), ["k"], "c_custkey")


@query(f"WITH {OBSERVATIONS}, b AS (SELECT series, count(*) AS n, count(*) FILTER (status = '503') / count(*) AS bad FROM obs GROUP BY series) SELECT series, CASE WHEN n * 40 >= 2000 THEN least(greatest(CASE WHEN bad < 0.003 THEN CAST(57500 AS DOUBLE) WHEN bad > 0.015 THEN CAST(35000 AS DOUBLE) ELSE CAST(50000 AS DOUBLE) END, 10000), 120000) ELSE CAST(50000 AS DOUBLE) END AS budget FROM b")
def governor_budget(spark, d):
    b = observations(spark, d).groupBy("series").agg(F.count(F.lit(1)).alias("n"), (F.count_if(F.col("status") == "503") / F.count(F.lit(1))).alias("bad"))
    return b.select("series", M.governor_step(F.lit(50_000.0), F.col("bad"), F.col("n") * 40).alias("budget"))


@query(f"""WITH RECURSIVE {OBSERVATIONS}, e AS (SELECT candidate % 40 AS k, status IN ('503', 'OTHER_429') AS bad, row_number() OVER (PARTITION BY candidate % 40 ORDER BY event_id) AS r FROM obs),
f AS (SELECT DISTINCT k, CAST(0 AS BIGINT) AS r, 0 AS streak, 0 AS hits FROM e UNION ALL
SELECT f.k, e.r, CASE WHEN bad THEN CASE WHEN streak + 1 >= 20 THEN 0 ELSE streak + 1 END ELSE greatest(streak - 1, 0) END, hits + CASE WHEN bad AND streak + 1 >= 20 THEN 1 ELSE 0 END FROM f JOIN e ON e.k = f.k AND e.r = f.r + 1)
SELECT k, hits FROM (SELECT *, max(r) OVER (PARTITION BY k) AS m FROM f) WHERE r = m""")
def bad_streaks(spark, d):
    x = observations(spark, d).select(F.pmod("candidate", F.lit(40)).alias("k"), is_bad(F.col("status")).alias("bad"), "event_id")
    return M.bad_streaks(x, ["k"], "event_id")


_ENTRIES = "en AS (SELECT CASE WHEN o_orderkey % 9 = 0 THEN format('batch-{:04d}', o_orderkey) ELSE format('e1-chunk-{:06d}', o_orderkey) END AS key, CASE o_orderkey % 4 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'RETRY' WHEN 2 THEN 'RUNNING' ELSE 'ABANDONED' END AS status, o_orderkey % 5 AS job_attempts, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(o_orderkey * 10 AS DOUBLE) END AS not_before, o_orderkey FROM orders)"


def _entries(spark, d):
    k = F.col("o_orderkey")
    status = F.element_at(F.array(*map(F.lit, ("PENDING", "RETRY", "RUNNING", "ABANDONED"))), (F.pmod(k, F.lit(4)) + 1).cast("int"))
    return table(spark, d, "orders").select(
        F.when(F.pmod(k, F.lit(9)) == 0, K.batch_id(k)).otherwise(K.chunk_key(F.lit(1), k)).alias("key"), status.alias("status"), F.pmod(k, F.lit(5)).alias("job_attempts"),
        F.when(F.pmod(k, F.lit(6)) != 0, (k * 10).cast("double")).alias("not_before"), k.alias("o_orderkey"),
    )


@query(f"WITH {_ENTRIES} SELECT key FROM en WHERE status IN ('PENDING', 'RETRY') AND job_attempts < 4 AND coalesce(not_before, 0) <= 90000")
def dispatchable_entries(spark, d):
    return Q.dispatchable(_entries(spark, d), F.lit(90_000.0)).select("key")


@query(f"WITH {_ENTRIES} SELECT key FROM en WHERE status IN ('PENDING', 'RETRY') AND job_attempts < 4 AND coalesce(not_before, 0) <= 90000 ORDER BY key LIKE 'batch-%', key LIMIT 30")
def dispatch_cycle(spark, d):
    return Q.dispatch(_entries(spark, d), F.lit(90_000.0), 70).select("key")


@query(f"WITH {_ENTRIES} SELECT status, CAST(count(*) AS BIGINT) AS n FROM en GROUP BY status")
def queue_histogram(spark, d):
    return Q.histogram(_entries(spark, d))


@query(f"""WITH {_ENTRIES}, r AS (SELECT *, 1000000 - o_orderkey * 13 % 9000 AS started FROM en WHERE status = 'RUNNING')
SELECT key FROM r WHERE CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 5 = 0 OR (1000000 - started) / 60.0 > 100 ELSE o_orderkey % 7 = 0 OR (1000000 - started) / 60.0 > 8 END""")
def stale_entries(spark, d):
    k = F.col("o_orderkey")
    at = T.iso((F.lit(1_000_000) - F.pmod(k * 13, F.lit(9000))) * 1000)
    e = _entries(spark, d).withColumn("dispatched_at", F.when(F.pmod(k, F.lit(7)) == 0, "never").otherwise(at))
    claims = e.where("o_orderkey % 3 = 0").select("key", k.alias("run_id"), at.alias("started_utc"))
    return Q.stale(e, claims, e.where("o_orderkey % 5 <> 0").select(k.alias("run_id")), F.lit(1_000_000)).select("key")


@query("WITH ep AS (SELECT n_nationkey + 1 AS epoch, unnest(range(0, CAST(n_nationkey % 7 * 20 AS BIGINT))) AS chunk FROM nation), q AS (SELECT epoch, chunk FROM ep WHERE chunk % 3 = 0) SELECT epoch, chunk, format('e{}-chunk-{:06d}', epoch, chunk) AS key FROM ep WHERE chunk % 3 <> 0 ORDER BY epoch, chunk LIMIT (SELECT 800 - count(*) FROM q)")
def frontier_chunks(spark, d):
    ep = table(spark, d, "nation").select((F.col("n_nationkey") + 1).alias("epoch"), (F.pmod("n_nationkey", F.lit(7)) * 20).cast("long").alias("chunks"))
    queued = ep.where("chunks > 0").select("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk")).where("chunk % 3 = 0")
    return Q.frontier(spark, ep, queued, 800)


@query(f"""WITH {OBSERVATIONS}, u AS (SELECT format('e1-chunk-{{:06d}}', series) AS key, CASE WHEN series % 4 = 0 THEN 3 ELSE NULL END AS lvl, event_id, status FROM obs WHERE status IN ('503', 'OTHER_429')),
n AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY event_id) - 1 AS n FROM u WHERE coalesce(lvl, 1) + 1 <= 3), p AS (SELECT *, n // 10 AS part, n % 10 AS place FROM n), l AS (SELECT key, max(part) AS last FROM p GROUP BY key),
f AS (SELECT key, coalesce(sum(last + 1) OVER (ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first FROM l)
SELECT format('batch-{{:04d}}', CAST(first + part + 5 AS BIGINT)) AS batch_id, CAST(coalesce(lvl, 1) + 1 AS INTEGER) AS retry_level, key AS parent_result, CAST(place AS INTEGER) AS place, key AS source_key, event_id AS source_ordinal, status AS prior_status FROM p JOIN f USING (key)""")
def retry_batches(spark, d):
    x = observations(spark, d).select(K.chunk_key(F.lit(1), F.col("series")).alias("key"), F.when(F.pmod("series", F.lit(4)) == 0, 3).alias("retry_level"), F.col("event_id").alias("pos"), "status")
    return Q.retry_batches(x, 5, 10)


@query(f"WITH {OBSERVATIONS}, w AS (SELECT series AS key, event_id AS pos, status FROM obs) SELECT key, pos, 'probe' AS what FROM w WHERE status IN ('503', 'OTHER_429') UNION ALL SELECT key, pos, 'carry' FROM w WHERE status NOT IN ('503', 'OTHER_429')")
def resumed_work(spark, d):
    x = observations(spark, d).select(F.col("series").alias("key"), F.col("event_id").alias("pos"), "status")
    left, carried = Q.resume(x.select("key", "pos"), x.where(~is_bad(F.col("status"))))
    return left.select("key", "pos", F.lit("probe").alias("what")).unionByName(carried.select("key", "pos", F.lit("carry").alias("what")))


@query("""WITH RECURSIVE e AS (SELECT user_id AS key, CASE event_type WHEN 'view' THEN 'dispatched' WHEN 'purchase' THEN CASE WHEN event_id % 13 = 0 THEN 'completed' ELSE 'dispatched' END WHEN 'click' THEN 'dispatched' WHEN 'error' THEN 'stale' ELSE 'partial' END AS kind, CAST(event_id AS DOUBLE) AS at_s, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events),
f AS (SELECT DISTINCT key, CAST(0 AS BIGINT) AS r, 'PENDING' AS status, 0 AS a, 0 AS q, CAST(0 AS DOUBLE) AS nb FROM e
UNION ALL SELECT f.key, e.r,
 CASE WHEN status IN ('COMPLETED', 'ABANDONED') THEN status WHEN kind = 'dispatched' THEN 'RUNNING' WHEN kind = 'completed' THEN 'COMPLETED' WHEN a + 1 < 4 THEN 'RETRY' WHEN q + 1 > 3 THEN 'ABANDONED' ELSE 'PENDING' END,
 CASE WHEN status IN ('COMPLETED', 'ABANDONED') OR kind IN ('dispatched', 'completed') THEN a ELSE a + 1 END,
 CASE WHEN status IN ('COMPLETED', 'ABANDONED') OR kind IN ('dispatched', 'completed') OR a + 1 < 4 THEN q ELSE q + 1 END,
 CASE WHEN status IN ('COMPLETED', 'ABANDONED') OR kind IN ('dispatched', 'completed') THEN nb WHEN a + 1 < 4 THEN at_s + 60 * CASE WHEN kind = 'stale' THEN 2 WHEN a + 2 = 2 THEN 15 ELSE 60 END WHEN q + 1 <= 3 THEN at_s + 7200 ELSE nb END
FROM f JOIN e ON e.key = f.key AND e.r = f.r + 1)
SELECT key, status, a AS job_attempts, q AS requeues, nb AS not_before FROM (SELECT *, max(r) OVER (PARTITION BY key) AS m FROM f) WHERE r = m""")
def queue_replay(spark, d):
    t = F.col("event_type")
    kind = F.when(t == "purchase", F.when(F.pmod("event_id", F.lit(13)) == 0, "completed").otherwise("dispatched")).when(t.isin("view", "click"), "dispatched").when(t == "error", "stale").otherwise("partial")
    e = table(spark, d, "events").select(F.col("user_id").alias("key"), F.col("event_id").alias("seq"), F.col("event_id").cast("double").alias("at"), kind.alias("kind"))
    return Q.replay(e)


@query("SELECT page_id, sha256(html) AS sha256, CAST(octet_length(encode(html)) AS BIGINT) AS bytes, lower(substr(html, 1, 512)) LIKE '%<html%' OR lower(substr(html, 1, 512)) LIKE '%<!doctype html%' OR lower(substr(html, 1, 512)) LIKE '%<script%' AS is_html, false AS zip_magic FROM pages")
def payload_checks(spark, d):
    h = F.col("html").cast("binary")
    return table(spark, d, "pages").select("page_id", F.sha2(h, 256).alias("sha256"), F.octet_length(h).cast("long").alias("bytes"), X.looks_like_html(h).alias("is_html"), X.has_zip_magic(h).alias("zip_magic"))


@query("SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS bytes, sha256(html) AS sha256, false AS verified FROM pages")
def verified_payloads(spark, d):
    x = table(spark, d, "pages").select("page_id", X.verify_zip_bytes(F.col("html").cast("binary")).alias("v"))
    return x.select("page_id", "v.bytes", "v.sha256", X.is_verified(F.col("v")).alias("verified"))


@query(f"WITH {ITEMS} SELECT seq, url, split_part(url, '/', -1) AS segment, left(split_part(url, '/', -1), length(split_part(url, '/', -1)) - 4) AS stem, CASE WHEN seq % 3 = 0 THEN 'plugins' ELSE 'maps' END AS family, seq % 40 AS number FROM (SELECT *, replace(replace(path_fmt, '{{map_id}}', map_id), '{{ts_ms}}', CAST(t0 AS VARCHAR)) AS url FROM items)".replace("{{", "{").replace("}}", "}"))
def rendered_urls(spark, d):
    x = items(spark, d).withColumn("url", K.render_url(F.col("path_fmt"), F.col("map_id"), F.col("t0")))
    return x.select("seq", "url", K.last_segment(F.col("url")).alias("segment"), K.path_stem(F.col("url")).alias("stem"), K.path_family(F.col("url")).alias("family"), K.series_number(F.col("map_id")).alias("number"))


@query("SELECT o_orderkey, format('e{}-chunk-{:06d}', o_orderkey % 9, o_orderkey) AS chunk, o_orderkey % 9 AS epoch, o_orderkey AS number, CASE WHEN o_orderkey % 2 = 0 THEN 'base' ELSE 'c1' END AS kind, o_orderkey AS package FROM orders")
def parsed_keys(spark, d):
    k = F.col("o_orderkey")
    x = table(spark, d, "orders").select("o_orderkey", K.chunk_key(F.pmod(k, F.lit(9)), k).alias("chunk"), F.when(F.pmod(k, F.lit(2)) == 0, K.package_id(k)).otherwise(K.package_id(k, "c1")).alias("pid"))
    c, p = K.parse_chunk_key(F.col("chunk")), K.parse_package_id(F.col("pid"))
    return x.select("o_orderkey", "chunk", c["epoch"].alias("epoch"), c["chunk"].alias("number"), p["kind"].alias("kind"), p["number"].alias("package"))


@query("SELECT event_id, strftime(make_timestamp_ms(ms), '%Y-%m-%dT%H:%M:%SZ') AS iso, CAST(ms // 1000 AS DOUBLE) AS parsed, CAST(0 AS DOUBLE) AS unreadable, ms // 3600000 AS hour_number, ms // 3600000 % 24 AS hour_of_day, strftime(make_timestamp_ms(ms), '%Y-%m-%d') AS day FROM (SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events)")
def instants(spark, d):
    x = table(spark, d, "events").select("event_id", T.millis(F.col("ts")).alias("ms")).withColumn("iso", T.iso(F.col("ms")))
    return x.select("event_id", "iso", T.parse_utc(F.col("iso")).alias("parsed"), T.parse_utc(F.concat(F.lit("x"), F.col("iso"))).alias("unreadable"), T.hour_number(F.col("ms")).alias("hour_number"), T.hour_of_day(F.col("ms")).alias("hour_of_day"), T.day(F.col("ms")).alias("day"))


_WORDS = ", ".join(f"CAST('0x' || substr(h, {1 + 8 * i}, 8) AS BIGINT)" for i in range(8))


@query(f"WITH h AS (SELECT c_custkey, sha256(c_name) AS h FROM customer), p AS (SELECT c_custkey, list_reduce([{_WORDS}], lambda a, x: (a * 28 + x) % 97, CAST(0 AS BIGINT)) AS owner FROM h) SELECT owner, CAST(count(*) AS BIGINT) AS n FROM p GROUP BY owner".replace("* 28", f"* {2**32 % 97}"))
def hash_owners(spark, d):
    return table(spark, d, "customer").groupBy(K.hash_owner(F.col("c_name"), 97).alias("owner")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, 0.9 + 0.2 * (event_id * 2654435761 % 1000) / 1000.0 AS jitter, least(2.0 * pow(2.0, event_id % 9), 60.0) AS backoff, least(greatest(value, 10.0), 50.0) AS clamped, event_id // 7 AS sevenths, (event_id + 6) // 7 AS ceiling FROM events")
def number_functions(spark, d):
    k = F.col("event_id")
    return table(spark, d, "events").select("event_id", N.jitter(k).alias("jitter"), N.backoff(F.pmod(k, F.lit(9))).alias("backoff"), N.clamp(F.col("value"), 10.0, 50.0).alias("clamped"), N.div(k, 7).alias("sevenths"), N.ceil_div(k, 7).alias("ceiling"))


@query("WITH p AS (SELECT c_custkey AS map_id, r_name AS anchor FROM customer, region) SELECT map_id, anchor, 1600000000000 + r_regionkey * 1000 AS ts_ms FROM p JOIN region ON r_name = anchor WHERE NOT (map_id % 10 = 0 AND r_regionkey = 2)")
def anchor_items(spark, d):
    ids = table(spark, d, "customer").select(F.col("c_custkey").alias("map_id"))
    anchors = table(spark, d, "region").select(F.col("r_name").alias("anchor"), (F.lit(1_600_000_000_000) + F.col("r_regionkey") * 1000).alias("ts_ms"), "r_regionkey")
    excluded = ids.where("map_id % 10 = 0").crossJoin(anchors.where("r_regionkey = 2").select("anchor"))
    return O.anchor_items(ids, anchors, excluded)


@query("SELECT coalesce(b.h, a.h) AS hash, coalesce(a.n, b.n) AS name FROM (SELECT md5(p_name) AS h, format('f{:06d}', p_partkey) AS n FROM part WHERE p_partkey % 3 <> 0) a FULL JOIN (SELECT md5(p_brand) AS h, format('f{:06d}', p_partkey) AS n FROM part WHERE p_partkey % 2 = 0) b ON a.n = b.n")
def manifest_upsert(spark, d):
    p = table(spark, d, "part").withColumn("name", F.format_string("f%06d", "p_partkey"))
    return updated_manifest(p.where("p_partkey % 3 <> 0").select(F.md5("p_name").alias("hash"), "name"), p.where("p_partkey % 2 = 0").select(F.md5("p_brand").alias("hash"), "name"))


@query("SELECT l_partkey AS pid FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT p_partkey FROM part WHERE p_size > 10 EXCEPT SELECT l_partkey FROM lineitem WHERE l_linestatus = 'F' AND l_quantity > 40")
def set_operations(spark, d):
    x = table(spark, d, "lineitem")
    returned = x.where("l_returnflag = 'R'").select(F.col("l_partkey").alias("pid"))
    return returned.intersect(table(spark, d, "part").where("p_size > 10").select("p_partkey")).subtract(x.where("l_linestatus = 'F' and l_quantity > 40").select("l_partkey"))

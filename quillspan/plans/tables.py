"""The driver's tables seen as the engine's: observations, intervals, items. Each has its SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import millis

DAY_MS = 86_400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """candidate, epoch, series, ts_ms, status, round, event_id of the events."""
    e = table(spark, sf_dir, "events")
    status = F.when(F.col("event_type") == "view", "404").when(F.col("event_type") == "purchase", "200").when(F.col("event_type") == "click", "FOUND_INVALID").when(F.col("event_type") == "error", "503").otherwise("OTHER_429")
    return e.select(
        (F.col("user_id") * 20 + F.pmod("event_id", F.lit(20))).alias("candidate"), (F.pmod("user_id", F.lit(7)) + 1).cast("int").alias("epoch"), F.col("user_id").alias("series"),
        millis(F.col("ts")).alias("ts_ms"), status.alias("status"), F.col("event_id").alias("round"), "event_id", "value", "ts",
    )


OBSERVATIONS = """
obs AS (
  SELECT user_id * 20 + event_id % 20 AS candidate, CAST(user_id % 7 + 1 AS INTEGER) AS epoch, user_id AS series, epoch_us(ts) // 1000 AS ts_ms,
    CASE event_type WHEN 'view' THEN '404' WHEN 'purchase' THEN '200' WHEN 'click' THEN 'FOUND_INVALID' WHEN 'error' THEN '503' ELSE 'OTHER_429' END AS status,
    event_id AS round, event_id, value, ts FROM events
),
ranked AS (
  SELECT *, CASE status WHEN '200' THEN 4 WHEN 'FOUND_INVALID' THEN 3 WHEN '404' THEN 2 WHEN '503' THEN 0 ELSE 1 END AS rnk,
    CASE status WHEN '200' THEN 'found_200' WHEN 'FOUND_INVALID' THEN 'found_invalid' WHEN '404' THEN 'confirmed_404' WHEN '503' THEN 'undetermined' ELSE 'other' END AS bucket FROM obs
),
canon AS (
  SELECT candidate, epoch, status, bucket, n AS observations FROM (
    SELECT *, row_number() OVER (PARTITION BY candidate ORDER BY rnk DESC, round) AS r, count(*) OVER (PARTITION BY candidate) AS n FROM ranked) WHERE r = 1
)"""


def order_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, lo, hi, label of the orders: days from the order's date on, by its price."""
    o = table(spark, sf_dir, "orders")
    lo = millis(F.col("o_orderdate"))
    return o.select(F.pmod("o_custkey", F.lit(100)).alias("k"), lo.alias("lo"), (lo + F.pmod(F.floor("o_totalprice").cast("long"), F.lit(9)) * DAY_MS).alias("hi"), F.col("o_orderpriority").alias("label"))


def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, lo, hi of the lines that were returned: one to three days from their shipping on."""
    x = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    lo = millis(F.col("l_shipdate"))
    return x.select(F.pmod("l_suppkey", F.lit(100)).alias("k"), lo.alias("lo"), (lo + (1 + F.pmod("l_orderkey", F.lit(3))) * DAY_MS).alias("hi"))


WINDOWS = """
win AS (SELECT o_custkey % 100 AS k, epoch_us(o_orderdate) // 1000 AS lo, epoch_us(o_orderdate) // 1000 + (CAST(floor(o_totalprice) AS BIGINT) % 9) * 86400000 AS hi, o_orderpriority AS label FROM orders),
ship AS (SELECT l_suppkey % 100 AS k, epoch_us(l_shipdate) // 1000 AS lo, epoch_us(l_shipdate) // 1000 + (1 + l_orderkey % 3) * 86400000 AS hi FROM lineitem WHERE l_returnflag = 'R')"""


def merged_sql(name: str, source: str, keys: str = "k", touch: int = 0) -> str:
    """CTEs that merge the intervals of a source by key."""
    return f"""
{name}_a AS (SELECT DISTINCT {keys}, lo, hi FROM {source} WHERE hi > lo),
{name}_b AS (SELECT *, max(hi) OVER (PARTITION BY {keys} ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {name}_a),
{name}_c AS (SELECT *, sum(CASE WHEN reach IS NULL OR lo > reach + {touch} THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS island FROM {name}_b),
{name} AS (SELECT {keys}, min(lo) AS lo, max(hi) AS hi FROM {name}_c GROUP BY {keys}, island)"""


def left_sql(name: str, windows: str, covered: str) -> str:
    """CTEs of what is left of windows (k, lo, hi, label) outside a merged covered set."""
    return f"""
{name}_w AS (SELECT DISTINCT k, lo, hi, label FROM {windows} WHERE hi > lo),
{name}_p AS (SELECT w.*, c.lo AS clo, c.hi AS chi FROM {name}_w w JOIN {covered} c ON w.k = c.k AND w.lo < c.hi AND c.lo < w.hi),
{name}_g AS (
  SELECT k, label, greatest(lo, coalesce(lag(chi) OVER (PARTITION BY k, lo, hi, label ORDER BY clo), lo)) AS nlo, least(clo, hi) AS nhi FROM {name}_p
  UNION ALL SELECT k, label, greatest(lo, max(chi)), hi FROM {name}_p GROUP BY k, lo, hi, label
  UNION ALL SELECT k, label, lo, hi FROM {name}_w w WHERE NOT EXISTS (SELECT 1 FROM {covered} c WHERE w.k = c.k AND w.lo < c.hi AND c.lo < w.hi)
),
{name} AS (SELECT k, nlo AS lo, nhi AS hi, label FROM {name}_g WHERE nhi > nlo)"""


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tier, priority, path_fmt, map_id, t0, t1, seq, n of the parts."""
    p = table(spark, sf_dir, "part")
    kind = F.when(F.pmod("p_partkey", F.lit(3)) == 0, "/a/plugins/{map_id}.{ts_ms}.zip").otherwise("/a/maps/{map_id}.{ts_ms}.zip")
    t0 = F.lit(1_600_000_000_000) + F.col("p_partkey") * 700_001
    return p.select(
        F.concat(F.lit("h"), F.substring("p_brand", -1, 1)).alias("tier"), F.pmod("p_partkey", F.lit(5)).cast("int").alias("own"), kind.alias("path_fmt"),
        F.concat(F.when(F.pmod("p_partkey", F.lit(2)) == 0, F.lit("m")).otherwise(F.lit("g")), F.pmod("p_partkey", F.lit(40)).cast("string")).alias("map_id"),
        t0.alias("t0"), (t0 + F.col("p_size") * 100).alias("t1"), F.col("p_partkey").alias("seq"), (F.col("p_size").cast("long") * 100).alias("n"),
    ).withColumn("priority", F.substring("tier", -1, 1).cast("int"))


ITEMS = """
items AS (
  SELECT 'h' || right(p_brand, 1) AS tier, CAST(right(p_brand, 1) AS INTEGER) AS priority,
    CASE WHEN p_partkey % 3 = 0 THEN '/a/plugins/{map_id}.{ts_ms}.zip' ELSE '/a/maps/{map_id}.{ts_ms}.zip' END AS path_fmt,
    CASE WHEN p_partkey % 2 = 0 THEN 'm' ELSE 'g' END || CAST(p_partkey % 40 AS VARCHAR) AS map_id,
    1600000000000 + p_partkey * 700001 AS t0, 1600000000000 + p_partkey * 700001 + p_size * 100 AS t1, p_partkey AS seq, CAST(p_size AS BIGINT) * 100 AS n FROM part
),
placed AS (SELECT *, CAST(coalesce(sum(n) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS ordinal0 FROM items)"""

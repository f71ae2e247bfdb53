"""Known answers and round trips of the operators."""

import io
import random
import zipfile

import duckdb
import pytest
from pyspark.sql import functions as F

from quillspan.functions import content as X
from quillspan.functions import keys as K
from quillspan.functions import numbers as N
from quillspan.functions import status as S
from quillspan.operators import accounting as A
from quillspan.operators import codec as C
from quillspan.operators import expand as E
from quillspan.operators import ordinals as O
from quillspan.operators import queue as Q
from quillspan.operators import telemetry as M
from quillspan.plans import records
from quillspan.streaming.queue import advance


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_merge_partials(spark):
    rows = [("a", 1, 5_000_000, [[2_000_000, 2_000_010]]), ("a", 2, 8_000_000, [[6_000_000, 6_000_005]]), ("b", 1, 8_000_000, None), ("b", 2, 0, [[7_900_000, 8_100_000]]), ("c", 1, 5, [[1, 2]]), ("c", 2, 5, [[3, 9]])]
    df = spark.createDataFrame(rows, "pid string, seq long, probed_through long, dirty_ranges array<array<long>>")
    got = {r.pid: (r.through, [tuple(x) for x in r.dirty]) for r in A.merge_partials(df).collect()}
    assert got == {"a": (8_000_000, [(6_000_000, 6_000_005)]), "b": (8_000_000, [(8_000_000, 8_100_000)]), "c": (5, [(1, 2), (5, 9)])}


def test_canonical_ties_and_tests(spark):
    rows = [(1, "503", 1, None), (1, "TIMEOUT", 0, None), (2, "404", 1, None), (2, "200", 2, "test"), (3, "OTHER_418", 1, "full"), (3, "503", 0, None), (4, None, 0, None)]
    df = spark.createDataFrame(rows, "c int, status string, round int, mode string")
    assert {r.c: (r.status, r.observations) for r in A.canonical(df, ["c"]).collect()} == {1: ("TIMEOUT", 2), 2: ("404", 1), 3: ("OTHER_418", 2)}


def test_statuses(spark):
    names = ["200", "404", "503", "TIMEOUT", "NETERR", "FOUND_INVALID", "OTHER", "OTHER_500", None]
    df = spark.createDataFrame([(n,) for n in names], "s string").select("s", S.bucket(F.col("s")).alias("b"), S.retryable(F.col("s")).alias("r"), S.rank(F.col("s")).alias("k"))
    got = {r.s: (r.b, r.r, r.k) for r in df.collect()}
    assert got["TIMEOUT"] == ("undetermined", True, 0) and got["OTHER_500"] == ("other", True, 1) and got["FOUND_INVALID"] == ("found_invalid", False, 3) and got[None] == (None, False, None)


def test_codec_round_trip(spark):
    rng = random.Random(2)
    rows = [(f"e1-chunk-{k:06d}", p, rng.choice(["404", "404", "404", "503", "200"])) for k in range(20) for p in range(rng.randrange(1, 40))]
    seen = spark.createDataFrame(rows, "key string, pos long, status string")
    enc = C.encode_statuses(seen)
    results = enc.select("key", F.lit("batch").alias("candidate_source"), F.lit(None).cast("long").alias("chunk_id"), F.col("n").alias("candidates_probed_unique"), "default_status", F.transform("exceptions", lambda e: F.array(e["pos"].cast("string"), e["status"])).alias("exceptions"))
    assert sorted(map(tuple, C.decode_statuses(results, 100).collect())) == sorted(rows)


def test_decode_edges(spark):
    rows = [("a", "epoch:1", 2, 3, "404", [["21", "200"], ["21", "503"]], None), ("b", None, None, 2, None, [], None), ("c", "spec", 0, 0, "404", None, None), ("d", "x", 5, 2, "404", [["1", "200"]], [1, 7])]
    df = spark.createDataFrame(rows, "key string, candidate_source string, chunk_id long, candidates_probed_unique long, default_status string, exceptions array<array<string>>, positions array<long>")
    got = sorted(map(tuple, C.decode_statuses(df, 10).collect()))
    assert got == [("a", 0, "404"), ("a", 1, "503"), ("a", 2, "404"), ("d", 1, "200"), ("d", 7, "404")]


def test_lineage_edges(spark):
    rows = [("batch-1", 0, "e1-chunk-000001", 7), ("batch-2", 0, "batch-1", 0), ("batch-3", 0, "batch-2", 0), ("batch-4", 0, "batch-9", 0), ("batch-5", 0, "batch-6", 0), ("batch-6", 0, "batch-5", 0), ("batch-7", 0, None, 0)]
    df = spark.createDataFrame(rows, "batch_id string, pos long, source_key string, source_ordinal long")
    got = {r.batch_id: (r.root_key, r.root_pos, r.depth) for r in A.lineage(df).collect()}
    assert got == {f"batch-{d}": ("e1-chunk-000001", 7, d) for d in (1, 2, 3)}


SPEC = "url_path_fmt string, tiers array<struct<tier_id:string,priority:int,path_fmt:string,ranges:array<struct<map_id:string,base:bigint,start_offset_ms:bigint,end_offset_ms:bigint>>>>"


def spec(spark):
    tiers = [(f"h{t}", t, "" if t == 1 else f"/p{t}/{{map_id}}", [(f"m{s}", 1_600_000_000_000, 3_600_000 * s, 3_600_000 * s + 3_000_000) for s in range(2)] + [("m9", 0, 5, 5)]) for t in (1, 2)]
    return spark.createDataFrame([("/d/{map_id}.{ts_ms}", tiers)], SPEC)


@pytest.mark.parametrize("target", [1_500_000, 1_700_000])
def test_plan_keeps_all_candidates(spark, target):
    items = O.with_offsets(O.tier_ranges(spec(spark)), F.col("t1") - F.col("t0"))
    parts = O.cut_packages(items, target)
    assert O.total(items, F.col("n")) == 12_000_000
    assert O.conservation(items, parts).isEmpty() and O.breaks(items.select("ordinal0", "n"), []).isEmpty()
    sizes = [r.candidates for r in O.packages(parts).orderBy("ordinal0").collect()]
    assert sizes[:-1] == [target] * (len(sizes) - 1) and sum(sizes) == 12_000_000
    assert {r.path_fmt for r in items.collect()} == {"/d/{map_id}.{ts_ms}", "/p2/{map_id}"}


def test_decode_known_answer(spark):
    items = spark.createDataFrame([("a", 1000, 100, 3, "t"), ("b", 5000, 103, 0, "t"), ("c", 5000, 103, 3, "t")], "map_id string, t0 long, ordinal0 long, n long, tier string")
    got = O.candidates(spark, items, 100, 106, 2).orderBy("ordinal").collect()
    assert [(r.ordinal, r.ts_ms) for r in got] == [(100, 1000), (101, 1001), (102, 1002), (103, 5000), (104, 5001), (105, 5002)]
    with pytest.raises(IndexError):
        O.chunk_bounds(100, 10, 10)
    assert O.chunk_bounds(95, 10, 9) == (90, 95)


def test_anchor_counts(spark):
    ids = spark.createDataFrame([("a",), ("b",)], "map_id string")
    anchors = spark.createDataFrame([("S1", 1), ("S2", 2)], "anchor string, ts_ms long")
    out = spark.createDataFrame([("a", "S1"), ("gone", "S1")], "map_id string, anchor string")
    assert O.anchor_count(ids, anchors, out) == 3 and O.anchor_count(ids, anchors, out, compat=True) == 2


def test_greedy_bins(spark):
    df = spark.createDataFrame([("p", i, 7_000_000) for i in range(6)] + [("q", 0, 1), ("q", 1, 30_000_000), ("q", 2, 5)], "g string, i int, n long")
    got = E.greedy_bins(df, ["g"], ["i"], "n", 18_000_000).collect()
    assert sorted((r.g, r.i, r.bin, r.offset) for r in got) == [("p", i, i // 2, 7_000_000 * (i % 2)) for i in range(6)] + [("q", 0, 0, 0), ("q", 1, 1, 0), ("q", 2, 2, 0)]


def test_cascade_widths(spark):
    plan = spark.createDataFrame([(i, "h1", n, f"/x/{f}/{{map_id}}") for i, (n, f) in enumerate([("m1", "maps"), ("m2", "maps"), ("g1", "maps"), ("p1", "plugins")])], "seq long, tier string, map_id string, path_fmt string")
    hit = spark.createDataFrame([("m1", 10**12, "/x/maps/m1.zip")], "map_id string, ts_ms long, url string")
    got = {(r.ring, r.map_id): r.t1 - r.t0 for r in E.cascade(hit, E.families(plan), E.all_series(plan)).collect()}
    assert got == {("c1", "m2"): 5_000, ("c1", "g1"): 180_000, ("c2", "m2"): 1_200_000, ("c2", "g1"): 1_200_000, ("c2", "p1"): 1_200_000}


def grid(spark, windows, cap=8000.0):
    df = spark.createDataFrame([("w", i, float(b), float(e)) for i, (b, e) in enumerate(windows)], "w string, i int, bad double, err double")
    return M.fold_grid(df, ["w"], "i", cap).first()


def test_rate_laws(spark):
    assert grid(spark, [(0, 0)] * 20).rate == 4600
    assert grid(spark, [(0, 0)] * 100).rate == 8000
    assert grid(spark, [(0.025, 0)]).rate == 600
    assert grid(spark, [(0.05, 0)]).rate == pytest.approx(540)
    assert grid(spark, [(0, 0)] * 20 + [(0.5, 0)] * 20).rate == 2200  # half the best clean rate
    df = spark.createDataFrame([("w", 0, 0.0, 0.0), ("w", 1, 0.0, 0.0), ("w", 2, 0.9, 0.0)], "w string, i int, bad double, err double")
    assert M.fold_worker(df, ["w"], "i").first().rate == 75
    assert M.fold_worker(df.where("i < 2"), ["w"], "i", cap=110.0).first().rate == 110


def test_percentiles_differ_on_purpose(spark):
    v = F.array(*[F.lit(float(x)) for x in (4, 1, 3, 2)])
    r = one(spark, N.nearest_rank(v, 50).alias("a"), N.floor_rank(v, 0.5, 0.3).alias("b"), N.nearest_rank(F.array().cast("array<double>"), 50).alias("c"), N.floor_rank(F.array().cast("array<double>"), 0.5, 0.3).alias("d"))
    assert (r.a, r.b, r.c, r.d) == (3.0, 3.0, 0.0, 0.3)  # 1.5 goes to the even 2


def test_keys(spark):
    r = one(spark, K.parse_chunk_key(F.lit("e12-chunk-000456")).alias("a"), K.parse_chunk_key(F.lit("e1-chunk-x")).alias("b"), K.parse_package_id(F.lit("c1-00003")).alias("c"), K.parse_package_id(F.lit("b00007")).alias("d"), K.parse_package_id(F.lit("zz")).alias("e"))
    assert (tuple(r.a), r.b, tuple(r.c), tuple(r.d), r.e) == ((12, 456), None, ("c1", 3), ("base", 7), None)
    import hashlib

    r = one(spark, K.hash_owner(F.lit("abc"), 97).alias("a"), K.hash_owner(F.lit(""), 2**31).alias("b"))
    assert r.a == int(hashlib.sha256(b"abc").hexdigest(), 16) % 97 and r.b == int(hashlib.sha256(b"").hexdigest(), 16) % 2**31


def archive(files):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        for n, c in files.items():
            z.writestr(n, c)
    return b.getvalue()


def test_archives(spark):
    good = archive({f"f{i}.txt": "x" * 100 for i in range(15)})
    bad = bytearray(archive({"a.txt": "hello world, hello world"}))
    bad[bad.index(b"hello") + 1] ^= 1
    rows = [(0, bytearray(good)), (1, bad), (2, bytearray(b"PK\x03\x04 not a zip")), (3, bytearray(b"<HTML>" + good)), (4, bytearray(b"")), (5, None), (6, bytearray(b"nothing"))]
    df = spark.createDataFrame(rows, "i int, c binary").select("i", X.verify_zip_bytes("c").alias("v"), X.looks_like_html(F.col("c")).alias("h"), X.has_zip_magic(F.col("c")).alias("m"))
    got = {r.i: r for r in df.withColumn("ok", X.is_verified(F.col("v"))).collect()}
    assert [i for i in got if got[i].ok] == [0]
    assert got[0].v.zip_entries == 15 and len(got[0].v.zip_names_sample) == 12
    assert got[1].v.zip_ok and not got[1].v.zip_crc_ok and got[2].v.zip_magic_ok and not got[2].v.zip_ok
    assert got[3].v.html_rejected and got[3].h and got[0].m and not got[6].m and got[4].v.bytes == 0
    assert [got[i].v.fault for i in (0, 1, 2, 3, 4, 6)] == [None, "member", "structure", "html", "magic", "magic"] and got[5].v is None


def test_ordinals_outside_the_universe_are_an_error(spark):
    df = spark.createDataFrame([(0,), (9,)], "ordinal long")
    assert O.in_universe(df, 10).count() == 2
    for total in (9, 0):
        try:
            O.in_universe(df, total).collect()
        except Exception as e:
            assert "outside the universe" in str(e)
        else:
            raise AssertionError


def test_last_json():
    assert X.last_json('a {"x": 1} b\n{\n  "y": {"z": 2}\n} end') == {"y": {"z": 2}}
    assert X.last_json("{ no") is None and X.last_json(None) is None


def test_queue_rules(spark):
    state = ("PENDING", 0, 0, 0.0)
    for i in range(4):
        state = advance(state, "partial", 0.0)
    assert state == ("PENDING", 4, 1, 7200.0)
    for _ in range(3):
        state = advance(state, "stale", 0.0)
    assert state[0] == "ABANDONED" and advance(state, "completed", 1.0) == state
    rng = random.Random(1)
    rows = [(f"k{k}", i, float(i), rng.choice(["dispatched", "partial", "stale", "partial", "completed" if k % 5 == 0 else "dispatched", "test" if k % 7 == 0 else "stale"])) for k in range(40) for i in range(rng.randrange(1, 14))]
    got = {r[0]: tuple(r)[1:] for r in Q.replay(spark.createDataFrame(rows, "key string, seq int, at double, kind string")).collect()}
    want = {}
    for key, _, at, kind in rows:
        want[key] = advance(want.get(key, ("PENDING", 0, 0, 0.0)), kind, at)
    assert got == want


def test_ownership_and_order(spark):
    e = spark.createDataFrame([("a", "RUNNING", "t", "s", False), ("b", "RETRY", "t", "s", False), ("c", "RUNNING", "t", "s", True)], "key string, status string, dispatch_token string, spec_sha256 string, has_result boolean")
    c = spark.createDataFrame([("a", "t", "s"), ("a", "u", "s"), ("a", "t", "z"), ("b", "t", "s"), ("c", "t", "s"), ("d", "t", "s")], "key string, token string, spec_sha256 string")
    assert sorted((r.key, str(r.reject)) for r in Q.ownership(c, e).collect()) == [("a", "None"), ("a", "spec differs"), ("a", "token differs"), ("b", "not running"), ("c", "has a result"), ("d", "no entry")]
    w = lambda *o: spark.createDataFrame([(x, i) for i, x in enumerate(o)], "ordinal long, seq long")
    assert [r.ordinal for r in Q.ordered_work(w(9), w(4, 2), w(1, 2, 3)).collect()] == [9, 4, 2, 1, 3]


def test_live_runs_by_age(spark):
    runs = spark.createDataFrame([(0, "queued", "1970-01-01T02:00:00Z"), (1, "queued", "1970-01-01T01:40:00Z"), (2, "queued", "1970-01-01T01:40:01Z"), (3, "queued", "1970-01-01T01:30:00Z"), (4, "queued", "1970-01-01T01:30:01Z"), (5, "in_progress", "1970-01-01T00:00:00Z"), (6, "completed", "1970-01-01T02:00:00Z"), (7, "queued", "unreadable"), (8, "queued", None)], "id int, status string, created_utc string")
    ids = lambda **kw: sorted(r.id for r in Q.live_runs(runs, F.lit(7200), **kw).collect())
    assert ids() == [0, 1, 2, 4, 5] and ids(zombie_min=20) == [0, 2, 5]


def test_live_runs_query_around_its_limit(spark, tmp_path):
    # rows at 20 and 30 minutes before the query's now, and a second to either side of them
    ages = [0, 1199, 1200, 1201, 1799, 1800, 1801]
    rows = [(k * 33 + 1, 0, 1_706_000_000 - a) for k, a in enumerate(ages)]
    spark.createDataFrame(rows, "event_id long, user_id long, at long").selectExpr("event_id", "user_id", "cast(timestamp_seconds(at) as timestamp_ntz) ts").write.parquet(f"{tmp_path}/events.parquet")
    duck = duckdb.connect()
    duck.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    got = sorted(r.event_id for r in records.live_runs(spark, str(tmp_path)).collect())
    assert got == sorted(x for (x,) in duck.execute(records.SQL["live_runs"]).fetchall()) == [1, 34]


def test_overlay_takes_hits_of_equal_rank_by_url(spark):
    known = spark.createDataFrame([("/p/0",)], "url string")
    hits = [(f"/p/{k}", 7) for k in range(9, -1, -1)] + [("/p/95", 3), ("/p/95", 9)]
    for parts in (1, 3, 10):
        rows = E.overlay(known, spark.createDataFrame(hits, "url string, seq long").repartition(parts)).collect()
        assert sorted(r.url for r in rows if r.expanded) == ["/p/1", "/p/2", "/p/3", "/p/95"]

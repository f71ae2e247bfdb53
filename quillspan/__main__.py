"""python -m quillspan: looks into universes and plans, and verifies payloads.

    stats SPEC [--compat]            tiers, total and number of chunks
    chunk SPEC N                     lines 'ordinal series instant tier' of a chunk
    chunk-info SPEC N                the bounds of a chunk
    candidate SPEC ORDINAL           the candidate at an ordinal
    plan SPEC OUT [--target N]       writes the packages of a spec as JSON lines
    validate SPEC [--target N]       holds a plan against its spec; exit 1 if they differ
    verify PATH                      a verdict on each file
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions.content import verify_zip_bytes
from .operators import ordinals as O
from .sources import files as S


def _plan(spark: SparkSession, path: str, target: int):
    ranges = O.tier_ranges(S.read_spec(spark, path))
    days, hours = spark.createDataFrame([], "day string, weight double"), spark.createDataFrame([], "hour long, density double")
    ordered = O.hour_major(ranges, days, hours).drop("seq").withColumnRenamed("rank", "seq")
    items = O.with_offsets(ordered, F.col("t1") - F.col("t0"))
    return items, O.cut_packages(items, target)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="quillspan", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="what", required=True)
    for name, more in {"stats": [], "chunk": ["number"], "chunk-info": ["number"], "candidate": ["ordinal"], "plan": ["out"], "validate": [], "verify": []}.items():
        c = sub.add_parser(name)
        c.add_argument("path")
        for m in more:
            c.add_argument(m, type=str if m == "out" else int)
        c.add_argument("--compat", action="store_true")
        c.add_argument("--target", type=int, default=18_000_000)
    a = p.parse_args(argv)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if a.what == "verify":
        for r in S.read_payloads(spark, a.path).select("path", verify_zip_bytes("content").alias("v")).toLocalIterator():
            print(json.dumps({"path": r.path, **r.v.asDict()}))
        return 0
    if a.what in ("plan", "validate"):
        items, parts = _plan(spark, a.path, a.target)
        if a.what == "plan":
            O.packages(parts).write.mode("overwrite").json(a.out)
            return 0
        bad = O.conservation(items, parts).collect() + O.breaks(items.select("ordinal0", "n"), []).collect()
        print(json.dumps({"ok": not bad, "differences": [r.asDict() for r in bad]}))
        return int(bool(bad))
    spec = S.read_spec(spark, a.path)
    items, size = O.universe(spec, a.compat).cache(), spec.first().chunk_size
    total = O.total(items, F.col("n"))
    if a.what == "stats":
        tiers = {r.tier: {"start_ordinal": r.start_ordinal, "count": r["count"]} for r in O.tier_table(items).collect()}
        print(json.dumps({"spec_sha256": S.sha256_file(spark, a.path), "total_candidates": total, "chunk_size": size, "num_chunks": -(-total // size), "tiers": tiers}, indent=2))
    elif a.what == "chunk-info":
        start, end = O.chunk_bounds(total, size, a.number)
        print(json.dumps({"chunk": a.number, "start_ordinal": start, "end_ordinal": end, "size": end - start, "universe": total}))
    else:
        start, end = O.chunk_bounds(total, size, a.number) if a.what == "chunk" else (a.ordinal, a.ordinal + 1)
        if not 0 <= start < end <= total:
            raise IndexError(f"ordinal {start} of {total} candidates")
        for r in O.candidates(spark, items, start, end, 1 << 20).orderBy("ordinal").toLocalIterator():
            print(f"{r.ordinal} {r.map_id} {r.ts_ms} {r.tier}" if a.what == "chunk" else json.dumps({"ordinal": r.ordinal, "map_id": r.map_id, "ts_ms": r.ts_ms, "tier_id": r.tier}))
    return 0


if __name__ == "__main__":
    sys.exit(main())

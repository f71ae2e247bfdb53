"""Documents on disk: reading, writing, manifests and snapshots."""

import json

import pytest
from pyspark.sql import functions as F

from quillspan.operators.accounting import claimable
from quillspan.sources import files as S


def test_results(spark, tmp_path):
    doc = {"mode": "full", "default_status": "404", "exceptions": [[3, "200"]], "candidates_probed_unique": 5, "statuses": {"404": 4, "200": 1}}
    (tmp_path / "e1-chunk-000001.result.json").write_text(json.dumps(doc, indent=1))
    (tmp_path / "e1-chunk-000002.result.json").write_text(json.dumps(doc | {"mode": "test"}))
    (tmp_path / "e1-chunk-000003.result.json").write_text("{ broken")
    (tmp_path / "e1-chunk-000004.result.json").write_text(json.dumps({k: v for k, v in doc.items() if k != "mode"}))
    (tmp_path / "other.json").write_text("{}")
    rows = {r.key: r for r in S.read_results(spark, str(tmp_path)).collect()}
    assert sorted(rows) == ["e1-chunk-000001", "e1-chunk-000004"]
    assert rows["e1-chunk-000001"].exceptions == [["3", "200"]] and rows["e1-chunk-000001"].statuses == {"404": 4, "200": 1}
    assert sorted(r.key for r in S.list_keys(spark, str(tmp_path), ".result.json").collect()) == [f"e1-chunk-00000{i}" for i in (1, 2, 3, 4)]


def test_other_documents(spark, tmp_path):
    (tmp_path / "queue.json").write_text(json.dumps({"schema": 3, "chunks": {"a": {"status": "PENDING", "size": 3}, "b": {"status": "RETRY", "not_before": 1.5}}}))
    assert {r.key: (r.status, r.size, r.not_before) for r in S.read_entries(spark, f"{tmp_path}/queue.json").collect()} == {"a": ("PENDING", 3, None), "b": ("RETRY", None, 1.5)}
    (tmp_path / "coverage.json").write_text(json.dumps({"done": ["b1"], "partial": {"b2": 7, "b3": {"through": 9, "dirty": [[1, 2]]}}}))
    done, partial = S.read_coverage(spark, f"{tmp_path}/coverage.json")
    assert [r.pid for r in done.collect()] == ["b1"]
    assert {r.pid: (r.through, r.dirty) for r in partial.collect()} == {"b2": (7, None), "b3": (9, [[1, 2]])}
    (tmp_path / "urls.json").write_text('{"urls": ["u", "v"]}')
    (tmp_path / "list.json").write_text('["w"]')
    assert sorted(r.url for p in ("urls", "list") for r in S.read_urls(spark, f"{tmp_path}/{p}.json").collect()) == ["u", "v", "w"]
    epochs = tmp_path / "epochs"
    epochs.mkdir()
    for n in (10, 2):
        (epochs / f"epoch_{n}.json").write_text(json.dumps({"spec_id": f"s{n}", "candidates_emitted": n}))
    assert [(r.epoch, r.candidates_emitted) for r in S.read_epochs(spark, str(epochs)).collect()] == [(2, 2), (10, 10)]
    (tmp_path / "maps.csv").write_text(S.schemas.MAPS_CSV.replace(" string", "").replace(" ", "") + "\n")
    assert S.read_maps_csv(spark, f"{tmp_path}/maps.csv").count() == 0
    assert S.load_json(spark, f"{tmp_path}/none.json", 5) == 5 and S.load_json(spark, f"{tmp_path}/urls.json") == {"urls": ["u", "v"]}
    assert len(S.sha256_file(spark, f"{tmp_path}/urls.json")) == 64


def test_manifest(spark, tmp_path):
    old = spark.createDataFrame([("1", "b"), ("2", "a")], "hash string, name string")
    new = S.updated_manifest(old, spark.createDataFrame([("9", "b"), ("3", "c d")], "hash string, name string"))
    S.write_manifest(new, f"{tmp_path}/m")
    assert sorted((r.name, r.hash) for r in S.read_manifest(spark, f"{tmp_path}/m").collect()) == [("a", "2"), ("b", "9"), ("c d", "3")]


def test_canonical_json():
    a, b = {"b": 1, "a": [{"_x": 1, "y": 2}], "_c": 3}, {"a": [{"y": 2}], "b": 1, "created_utc": "now"}
    assert S.canonical_json(a) == '{"a":[{"y":2}],"b":1}' and S.canonical_hash(a) == S.canonical_hash(b)


def test_snapshots(spark, tmp_path):
    s = S.Snapshots(spark, f"file://{tmp_path}/state")
    df = spark.range(3)
    assert s.version() == 0
    assert s.commit({"a": df, "b": df}) == 1
    assert s.commit({"a": spark.range(5), "b": None}) == 2
    assert s.read("a").count() == 5 and s.read("a", 1).count() == 3 and sorted(s.tables()) == ["a"]
    with pytest.raises(ValueError):
        s.commit({"a": df}, expected=1)
    assert s.read("a").count() == 5


def test_reports(spark):
    v = spark.createDataFrame([("u", True, True, False), ("v", True, False, False)], "url string, zip_ok boolean, zip_crc_ok boolean, html_rejected boolean")
    r = S.verification_report(v).first()
    assert r.verified_count == 1 and len(r.results) == 2
    assert S.status_report({"title": "T", "b": 1, "a": {"c": 2}}) == "# T\n\n- **a**\n  - c: 2\n- b: 1\n"


def test_chunk_dump(spark, tmp_path):
    c = spark.createDataFrame([(2, "m", 5, "t"), (1, "m", 4, "t")], "ordinal long, map_id string, ts_ms long, tier string")
    S.write_chunk_dump(c, f"{tmp_path}/d")
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/d").collect()) == ["1 m 4 t", "2 m 5 t"]
    p = spark.createDataFrame([("c2-00001",), ("b00002",), ("c1-00009",), ("b00001",)], "pid string")
    none = spark.createDataFrame([], "pid string, done boolean")
    assert [r.pid for r in claimable(p, none, none).collect()] == ["c1-00009", "c2-00001", "b00001", "b00002"]
    assert c.withColumn("x", F.lit(1)).count() == 2


def test_epoch_files(spark, tmp_path):
    import hashlib
    import json

    doc = {"epoch": 3, "tiers": [{"tier_id": "t", "ranges": []}]}
    sha = S.write_epoch_file(spark, f"file://{tmp_path}/epoch_3.json", doc)
    data = (tmp_path / "epoch_3.json").read_bytes()
    assert sha == hashlib.sha256(data).hexdigest() and json.loads(data) == doc and data.startswith(b'{\n "epoch"') and data.endswith(b"}\n")

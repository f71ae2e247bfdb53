"""The command line over a small spec with ranges and anchors."""

import json

import pytest

from quillspan.__main__ import main

SPEC = {
    "chunk_size": 4, "url_path_fmt": "/m/{map_id}.{ts_ms}.zip", "all_map_ids": ["a", "b"], "anchors_ms": {"S1": 50, "S2": 60},
    "tiers": [
        {"tier_id": "t1", "ranges": [{"map_id": "a", "base": 100, "start_offset_ms": -2, "end_offset_ms": 3}, {"map_id": "b", "base": 0, "start_offset_ms": 5, "end_offset_ms": 5}]},
        {"tier_id": "t2", "kind": "anchors", "anchors": ["S1", "S2"], "exclude": [{"map_id": "a", "anchors": ["S2"]}, {"map_id": "gone", "anchors": ["S1"]}]},
    ],
}


@pytest.fixture()
def spec(tmp_path):
    path = tmp_path / "spec.json"
    path.write_text(json.dumps(SPEC))
    return str(path)


def test_stats(spark, spec, capsys):
    main(["stats", spec])
    got = json.loads(capsys.readouterr().out)
    assert (got["total_candidates"], got["num_chunks"]) == (8, 2) and got["tiers"] == {"t1": {"start_ordinal": 0, "count": 5}, "t2": {"start_ordinal": 5, "count": 3}}
    main(["stats", spec, "--compat"])
    assert json.loads(capsys.readouterr().out)["total_candidates"] == 7


def test_candidates(spark, spec, capsys):
    main(["chunk", spec, "1"])
    assert capsys.readouterr().out.splitlines() == ["4 a 102 t1", "5 a 50 t2", "6 b 50 t2", "7 b 60 t2"]
    main(["candidate", spec, "0"])
    assert json.loads(capsys.readouterr().out) == {"ordinal": 0, "map_id": "a", "ts_ms": 98, "tier_id": "t1"}
    main(["chunk-info", spec, "1"])
    assert json.loads(capsys.readouterr().out)["size"] == 4
    with pytest.raises(IndexError):
        main(["candidate", spec, "8"])


def test_plan(spark, spec, tmp_path, capsys):
    assert main(["validate", spec, "--target", "2"]) == 0
    assert json.loads(capsys.readouterr().out)["ok"]
    main(["plan", spec, f"{tmp_path}/plan", "--target", "2"])
    assert sorted(r.candidates for r in spark.read.json(f"{tmp_path}/plan").collect()) == [1, 2, 2]

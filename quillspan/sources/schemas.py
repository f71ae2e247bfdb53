"""Schemas of the documents and tables. Nothing is inferred on read; ordinals and instants are longs."""

from __future__ import annotations

_RANGE = "struct<map_id:string,base:bigint,start_offset_ms:bigint,end_offset_ms:bigint,sub:string>"
_TIER = f"struct<tier_id:string,priority:int,path_fmt:string,kind:string,anchors:array<string>,exclude:array<struct<map_id:string,anchors:array<string>>>,ranges:array<{_RANGE}>>"
_ITEM = "struct<path_fmt:string,map_id:string,t0:bigint,t1:bigint,ordinal0:bigint>"
_CANDIDATE = "struct<map_id:string,ts_ms:bigint,source_key:string,source_ordinal:bigint,prior_status:string>"
_FOUND = "struct<map_id:string,ts_ms:bigint,url:string,get_status:int,bytes:bigint,sha256:string,zip_ok:boolean,zip_crc_ok:boolean,html_rejected:boolean,error:string>"
_RECORD = "struct<status:string,candidates:bigint,probed_unique:bigint,probed_through:bigint,dirty_ranges:array<array<bigint>>,statuses:map<string,bigint>,rate_rps:double>"

SPEC = f"spec_id string, chunk_size bigint, url_path_fmt string, all_map_ids array<string>, anchors_ms map<string,bigint>, candidates_emitted bigint, epoch int, kind string, evidence_basis string, tiers array<{_TIER}>"
RESULT = f"key string, chunk_id bigint, epoch int, attempt int, mode string, candidate_source string, outcome string, started_utc string, finished_utc string, candidates_scheduled bigint, candidates_probed_unique bigint, head_attempts_total bigint, statuses map<string,bigint>, default_status string, exceptions array<array<string>>, positions array<bigint>, found array<{_FOUND}>, rate struct<rps_mean:double,rps_final:double,local_cap:double,budget_rps:double,active_hint:int>, latency_ms struct<p50:double,p95:double>, windows array<array<double>>"
BATCH = f"batch_id string, retry_level int, parent_result string, count bigint, candidates array<{_CANDIDATE}>"
ENTRY = "key string, status string, kind string, epoch int, size bigint, job_attempts int, attempt_seq int, requeues int, retry_level int, parent_result string, batch_file string, spec_sha256 string, dispatch_token string, dispatched_at string, not_before double"
SHARD = f"worker string, heartbeat_utc string, current_pid string, probed_total bigint, rps_ema double, windows_tail array<array<double>>, packages map<string,{_RECORD}>, hits array<struct<map_id:string,ts_ms:bigint,url:string>>"
PLAN = f"packages array<struct<pid:string,tier:string,priority:int,ordinal0:bigint,candidates:bigint,items:array<{_ITEM}>>>"
LEDGER = "ordinal bigint, map_id string, ts_ms bigint, tier_id string, status string"
MAPS_CSV = "map_id string, game_id string, game_name string, timestamp_ms string, timestamp_utc string, url string, http_status string, content_length string, zip_entries string, sha256 string, first_verified_at string, source string"
MANIFEST = "hash string, name string"

import base64
import gzip
import hashlib
import random
from collections import defaultdict
from pathlib import Path

import pytest
from hypothesis import given
from hypothesis import strategies as st

from quillspan.llm.common import scratch_path
from quillspan.llm.warc import LoserTree, archive, captures, read_archives, records, write_archives

PAGES = "page_id long, url string, html string, payload string, digest int, offset long"


def brute(rows, least=0):
    groups = defaultdict(list)
    data = [(p, (h or "").encode()) for p, h in rows]
    for p, b in data:
        if len(b) >= least:
            groups[b].append(p)
    out = []
    for p, b in data:
        known = [x for x in groups[b] if x is not None]
        first = max(known) if known and len(groups[b]) > 1 else None
        refers = first if first is not None and first != p else None
        out.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    df = archive(pages)
    assert got(df) == brute([(r.page_id, r.html) for r in pages.collect()])
    rows = sorted(df.collect(), key=lambda r: (r.range, r.place))
    keys = [(r.url_key, r.timestamp, r.page_id) for r in rows]
    assert keys == sorted(keys)


@pytest.fixture(scope="module")
def odd_pages(spark):
    tricky = "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nxyz\r\n\r\n\r\n\r\n"
    rows = [
        (1, "http://www.A.example.com:80/x?y#z", "hi"), (2, "http://a.example.com/x?y", "hi"), (2, "http://a.example.com/x?y", "hi"), (3, None, None), (4, "u\r\nX: 1 % \n", ""),
        (None, "http://b.example", "hi"), (None, None, "alone"), (None, None, "alone"), (5, "http://b.example/", tricky), (6, "http://b.example/", tricky), (7, "http://b.example/", "\r\n\r\n"),
        (8, "http://b.example/", "\r\n\r\n" * 5 + "é" * 300_000), (9, "http://ü.example/", "\r\n\r"), (-3, "", "\n\r\n\r\n"),
    ]
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], PAGES)


def test_odd_rows(spark, odd_pages):
    want = [(r.page_id, r.html) for r in odd_pages.collect()]
    assert got(archive(odd_pages)) == brute(want)
    assert got(archive(odd_pages, least_bytes=3)) == brute(want, 3)
    assert archive(odd_pages.limit(0)).count() == 0


def test_round_trip_and_files(spark, odd_pages):
    path = scratch_path(spark, "warc-test")
    write_archives(captures(odd_pages.repartition(3)), path)
    rows = read_archives(spark, path).collect()
    assert sorted(str((r.page_id, r.url)) for r in rows) == sorted(str((r.page_id, r.url)) for r in odd_pages.collect())
    html = {r.page_id: r.html or "" for r in odd_pages.collect() if r.page_id is not None}
    for r in rows:
        if r.record_type == "response" and r.page_id is not None:
            assert bytes(r.payload).decode() == html[r.page_id]
    files = {p.name: gzip.decompress(p.read_bytes()) for p in Path(path.removeprefix("file://")).glob("part-*.gz")}
    for r in rows:  # the index leads to the record
        at = files[r.archive][r.offset :]
        assert at.startswith(b"WARC/1.1\r\n")
        head, rest = at.split(b"\r\n\r\n", 1)
        assert head.endswith(f"Content-Length: {r.length}".encode()) and rest[r.length :].startswith(b"\r\n\r\n")


def test_broken_archives_are_told():
    with pytest.raises(ValueError):
        list(records(iter([("a", b"nonsense")])))
    with pytest.raises(ValueError):
        list(records(iter([("a", b"WARC/1.1\r\nContent-Length: 9"), ("a", b"abc")])))


@given(st.lists(st.lists(st.integers(0, 50)), max_size=9))
def test_loser_tree(runs):
    runs = [sorted(r) for r in runs]
    assert list(LoserTree(runs)) == sorted(x for r in runs for x in r)
    random.shuffle(runs)


def test_payloads_that_end_in_line_breaks(spark):
    ends = ["\r\n", "\n\r\n", "\r\r\n", "\r\n\r\n\r\n", "\r", "\n", "\r\n\r", "\r\n\r\n\r", "\n\r"]
    for k in range(len(ends)):  # each of them in the middle and as the last of an archive
        turned = ends[k:] + ends[:k]
        stream = b"".join(b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(x) + 6, b"<html>" + x.encode()) for x in turned)
        pieces = stream.split(b"\r\n\r\n")
        if not pieces[-1]:
            pieces.pop()
        found = list(records(("a", x) for x in pieces))
        assert [block for *_, block in found] == [b"<html>" + x.encode() for x in turned]
        assert all(stream[at:].startswith(b"WARC/1.1\r\n") for _, at, *_ in found)
    rows = [(i, f"http://a.example/{i}", f"<html>{i}" + e) for i, e in enumerate(ends * 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    path = scratch_path(spark, "warc-test")
    write_archives(captures(pages), path)
    assert {r.page_id: bytes(r.payload).decode() for r in read_archives(spark, path).collect()} == {i: h for i, _, h in rows}
    assert got(archive(pages)) == brute([(i, h) for i, _, h in rows])

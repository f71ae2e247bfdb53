"""WARC archives and their index.

Captures are written as WARC/1.1 files through Spark's text writer, so to any store that Spark writes: the line
separator is the blank lines that end a record. Files are gzip-compressed and hence each read by one task, in
order, which frames the records by their Content-Length as they stream by.

Each archive gives a capture run, an index sorted by URL key and timestamp. The runs are merged by external
k-way merging: the key space is cut to ranges, and in each range a loser tree merges the runs' parts, which gives
capture histories in one global order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ceil_div, scratch_path, written

_END = "\r\n\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
#: Seconds since 1970 of the first capture where pages have no capture time; page n follows n seconds later.
FIRST_CAPTURE = 1_704_067_200
#: Index entries of a merge task.
ENTRIES_PER_TASK = 200_000
INDEX = "url_key string, timestamp string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, archive string, offset long, length long"


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a binary as 32 bare upper-case base-32 digits: each five hexadecimal digits are four of them."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def url_key(url: Column) -> Column:
    """The sort key of a URL: lower-cased, host labels reversed and joined by commas, then the path; null: empty."""
    u = F.lower(F.coalesce(url, F.lit("")))
    rest = F.regexp_replace(u, r"^[a-z][a-z0-9+.-]*://(www\d*\.)?", "")
    host = F.regexp_replace(F.regexp_extract(rest, r"^([^/?#]*)", 1), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?#]*(.*)$", 1), "#.*$", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(path == "", F.lit("/")).otherwise(path))


def captures(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, bytes, digest and refers_to, the page of the response that a revisit repeats (else null).

    Of equal payloads of at least least_bytes, the rows with the largest page_id are responses; groups without any
    page_id are all responses.
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("digest", base32_sha1(F.col("payload")))
    # only digests that stand there more than once are joined: a small table, and its hot keys are split
    keys = written(p.select("page_id", "digest", "bytes"), "digests")
    twice = keys.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("first")).where("n > 1").drop("n")
    joined = p.join(twice, "digest", "left")
    return joined.select("page_id", "url", "payload", "bytes", "digest", F.when((F.col("first") != F.col("page_id")) | F.col("page_id").isNull(), F.col("first")).alias("refers_to"))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _one_line(c: Column) -> Column:
    """Percent-encodes what would break a header line."""
    return F.replace(F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _record_id(page_id: Column) -> Column:
    h = F.md5(F.concat(F.lit("page "), page_id.cast("string")))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def write_archives(found: DataFrame, path: str, first_capture: int = FIRST_CAPTURE) -> None:
    """Writes a record for each row of `captures`, a file for each partition. Revisits have no payload."""
    revisit = F.col("refers_to").isNotNull()
    page, url = F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce(_one_line(F.col("url")), F.lit(""))
    date = F.date_format(F.timestamp_seconds(F.lit(first_capture) + F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(10**9))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    http = F.concat(F.lit(_HTTP), F.col("bytes").cast("string"), F.lit(_END))
    block = F.when(revisit, http.cast("binary")).otherwise(F.concat(http.cast("binary"), F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        F.when(revisit, F.lit("WARC-Type: revisit\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n")).otherwise(F.lit("WARC-Type: response\r\n")),
        _line("WARC-Record-ID", F.when(F.col("page_id").isNull(), F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))).otherwise(_record_id(F.col("page_id")))),
        F.when(revisit, F.concat(_line("WARC-Refers-To", _record_id(F.col("refers_to"))), _line("X-Refers-To-Page", F.col("refers_to").cast("string")))).otherwise(F.lit("")),
        _line("WARC-Target-URI", url),
        _line("WARC-Date", date),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("X-Payload-Length", F.col("bytes").cast("string")),
        _line("X-Page-ID", page),
        _line("X-Has-URI", F.col("url").isNotNull().cast("string")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(_END),
    )
    record = F.concat(head.cast("binary"), block).cast("string")  # the bytes as they are: a cast doesn't decode them
    found.select(record.alias("value")).write.option("lineSep", _END).option("compression", "gzip").text(path)


def records(parts: Iterator[tuple[str, bytes]]) -> Iterator[tuple[str, int, dict[str, str], bytes]]:
    """archive, offset, headers and block of each record, from the archives' pieces between blank lines, in order.

    Lengths count on the bytes as they were, with the blank lines put back. Where a block ends in a line break the
    reader cuts before the record's own end; what a piece holds beyond that end begins the next record.
    """
    end = _END.encode()
    archive, offset, pending, need, have = None, 0, [], -1, 0

    def start(piece: bytes) -> None:
        nonlocal pending, need, have
        length = re.search(rb"\r\nContent-Length: (\d+)$", piece) if piece.startswith(b"WARC/1.") else None
        if not length:
            raise ValueError(f"{archive}: no record at {offset}")
        pending, have = [piece], len(piece)
        need = have + len(end) + int(length[1])

    ended = False
    for name, piece in parts:
        if name != archive:
            if pending:
                raise ValueError(f"{archive}: the last record is cut off")
            archive, offset, ended = name, 0, False
        if ended:
            raise ValueError(f"{archive}: no record at {offset}")
        if not pending:
            start(piece)
        else:
            pending.append(piece)
            have += len(end) + len(piece)
        if have >= need:
            whole = end.join(pending)
            if have > need and whole[need : need + len(end)] != end:
                raise ValueError(f"{archive}: a record at {offset} is longer than it says")
            head = pending[0]
            yield archive, offset, dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:]), whole[len(head) + len(end) : need]
            offset += need + len(end)
            pending = []
            if have > need:
                rest = whole[need + len(end) :]
                if rest:
                    start(rest)
                else:
                    ended = True
    if pending:
        raise ValueError(f"{archive}: the last record is cut off")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """INDEX columns and payload (null for revisits) of every record, archive by archive in the order written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = ((n, v) for b in batches for n, v in zip(b[0].to_pylist(), b[1].to_pylist(), strict=True))
        rows, held = [], 0
        for archive, offset, h, block in records(parts):
            payload = block.split(_END.encode(), 1)[1] if h["WARC-Type"] == "response" else None
            page, refers = h["X-Page-ID"], h.get("X-Refers-To-Page")
            url = re.sub("%(25|0D|0A)", lambda m: chr(int(m[1], 16)), h["WARC-Target-URI"]) if h["X-Has-URI"] == "true" else None
            date = re.sub(r"\D", "", h["WARC-Date"])
            rows.append((date, int(page) if page else None, int(h["X-Payload-Length"]), h["WARC-Payload-Digest"].removeprefix("sha1:"), h["WARC-Type"], int(refers) if refers else None, url, archive, offset, len(block), payload))
            held += len(block)
            if len(rows) >= 1000 or held > 1 << 22:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)

    lines = spark.read.option("lineSep", _END).text(path).select(F.col("_metadata.file_name").alias("archive"), F.col("value").cast("binary").alias("value"))
    schema = "timestamp string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, archive string, offset long, length long, payload binary"
    return lines.mapInArrow(run, schema)


_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
_NAMES = ["timestamp", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "archive", "offset", "length", "payload"]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names=_NAMES)


class LoserTree:
    """Merges sorted runs: an inner node holds the loser of its match, and the winner of each round plays only on its own path."""

    def __init__(self, runs: list[Iterator]):
        self.runs = [iter(r) for r in runs]
        self.k = max(1, len(self.runs))
        self.heads = [next(r, None) for r in self.runs] or [None]
        self.losers = [-1] * self.k
        for i in range(self.k):
            self._play(i)

    def _play(self, i: int) -> None:
        """Takes run i up from its leaf; the first to come to an empty node waits there."""
        at, winner = (i + self.k) // 2, i
        while at:
            other = self.losers[at]
            if other < 0:
                self.losers[at] = winner
                return
            if self._less(other, winner):
                self.losers[at], winner = winner, other
            at //= 2
        self.losers[0] = winner

    def _less(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and x is not None
        return (x, a) < (y, b)

    def __iter__(self) -> Iterator:
        while (head := self.heads[self.losers[0]]) is not None:
            i = self.losers[0]
            yield head
            self.heads[i] = next(self.runs[i], None)
            at, winner = (i + self.k) // 2, i
            while at:
                if self._less(self.losers[at], winner):
                    self.losers[at], winner = winner, self.losers[at]
                at //= 2
            self.losers[0] = winner


def capture_runs(spark: SparkSession, path: str) -> DataFrame:
    """The index of the archives (INDEX), each archive's part sorted by URL key, timestamp and page_id: the capture runs."""
    index = read_archives(spark, path).drop("payload").withColumn("url_key", url_key(F.col("url")))
    names = [c.split()[0] for c in INDEX.split(", ")]
    return written(index.select(*names).sortWithinPartitions("archive", "url_key", "timestamp", "page_id"), "runs")


def merge_runs(runs: DataFrame, per_task: int = ENTRIES_PER_TASK) -> DataFrame:
    """INDEX, range and place: the runs merged by URL key, timestamp and page_id (null first). Rows are in global order by (range, place).

    A URL with very many captures is spread over several ranges, as ranges are cut by all three.
    """
    order = ["url_key", "timestamp", "page_id"]
    names = [c.split()[0] for c in INDEX.split(", ")]
    at = [names.index(c) for c in order]
    ranges = max(1, ceil_div(runs.count(), per_task))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[str, list[pa.RecordBatch]] = {}
        for batch in batches:  # the part of each run in this range, in its order
            number = batch["archive"].to_pylist()
            cuts = [0, *(i for i in range(1, len(number)) if number[i] != number[i - 1]), len(number)]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if e > s:
                    parts.setdefault(number[s], []).append(batch.slice(s, e - s))
        if not parts:
            return
        tables = [pa.Table.from_batches(p) for _, p in sorted(parts.items())]

        def keys(t: pa.Table, k: int) -> Iterator[tuple]:
            cols = [t.column(i).to_pylist() for i in at]
            for i, (u, d, p) in enumerate(zip(*cols, strict=True)):
                yield (u, d, p is not None, p or 0, k, i)

        start, base = [], 0
        for t in tables:
            start.append(base)
            base += t.num_rows
        merged = [start[k] + i for *_, k, i in LoserTree([keys(t, k) for k, t in enumerate(tables)])]
        whole = pa.concat_tables(tables).take(pa.array(merged, pa.int64()))
        place = pa.array(range(len(merged)), pa.int64())
        for b in whole.append_column("place", place).combine_chunks().to_batches(max_chunksize=10_000):
            yield b

    dealt = runs.repartitionByRange(ranges, *order).sortWithinPartitions("archive", *order)
    return dealt.mapInArrow(run, f"{INDEX}, place long").withColumn("range", F.spark_partition_id())


def archive(pages: DataFrame, path: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Writes the pages as WARC archives, reads them back and merges their index; one row per page, in global order by (range, place).

    Null html: an empty payload. Null url: no URL, key ')/'. Null page_id: written and read back as null; never the
    page a revisit refers to, and a revisit itself if an equal payload has a page_id. Rows that share the largest
    page_id of a group of equal payloads are all responses. Empty table: no rows. Extra columns are ignored.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(captures(pages, least_bytes), path)
    return merge_runs(capture_runs(spark, path))

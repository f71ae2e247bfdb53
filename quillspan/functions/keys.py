"""Formatting and parsing of chunk, package and batch keys, series ids and URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def chunk_key(epoch: Column, chunk: Column) -> Column:
    return F.format_string("e%d-chunk-%06d", epoch, chunk)


def package_id(number: Column, prefix: str | None = None) -> Column:
    """b00012, or c1-00012 with a prefix."""
    return F.format_string("b%05d", number) if prefix is None else F.format_string(f"{prefix}-%05d", number)


def batch_id(number: Column) -> Column:
    return F.format_string("batch-%04d", number)


def parse_chunk_key(key: Column) -> Column:
    """struct(epoch, chunk), or null where the key is of another form."""
    m = r"^e(\d+)-chunk-(\d+)$"
    e, c = F.regexp_extract(key, m, 1).try_cast("long"), F.regexp_extract(key, m, 2).try_cast("long")
    return F.when(e.isNotNull() & c.isNotNull(), F.struct(e.alias("epoch"), c.alias("chunk")))


def parse_package_id(pid: Column) -> Column:
    """struct(kind, number): base for plan packages, else the prefix; null where the id is of another form."""
    m = r"^(?:b|([^-]+)-)(\d+)$"
    kind = F.regexp_extract(pid, m, 1)
    n = F.regexp_extract(pid, m, 2).try_cast("long")
    return F.when(n.isNotNull(), F.struct(F.when(kind == "", "base").otherwise(kind).alias("kind"), n.alias("number")))


def claim_order(pid: Column) -> list[Column]:
    """Sort columns: the first expansion ring, the second, then the plan; by number in each."""
    p = parse_package_id(pid)
    return [F.when(p["kind"] == "c1", 0).when(p["kind"] == "c2", 1).otherwise(2), p["number"]]


def render_url(template: Column, series: Column, ts_ms: Column) -> Column:
    """Fills {map_id} and {ts_ms} in."""
    return F.replace(F.replace(template, F.lit("{map_id}"), series), F.lit("{ts_ms}"), ts_ms.cast("string"))


def last_segment(url: Column) -> Column:
    return F.substring_index(url, "/", -1)


def path_stem(path: Column) -> Column:
    """The last segment without its last extension."""
    return F.regexp_replace(F.substring_index(path, "/", -1), r"(?<=.)\.[^.]*$", "")


def series_number(series: Column) -> Column:
    """12 of m12 and of m12_3; null for ids of another form."""
    return F.nullif(F.regexp_extract(series, r"^[a-z]+(\d+)(?:_(\d+))?$", 1), F.lit("")).try_cast("long")


def series_suffix(series: Column) -> Column:
    """3 of m12_3, else null."""
    return F.nullif(F.regexp_extract(series, r"^[a-z]+(\d+)_(\d+)$", 2), F.lit("")).try_cast("long")


def hash_owner(key: Column, owners: int) -> Column:
    """The SHA-256 of the key, as a number, modulo `owners` (at most 2^31), in 8 steps of 32 bits without a UDF."""
    if not 0 < owners <= 1 << 31:
        raise ValueError("owners must be in 1..2^31")
    digest = F.sha2(key.cast("string"), 256)
    out = F.lit(0).cast("long")
    for i in range(8):
        part = F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long")
        out = F.pmod(F.pmod(out * F.lit((1 << 32) % owners), F.lit(owners).cast("long")) + part, F.lit(owners).cast("long"))
    return out


def is_ring(tier: Column, prefix: str = "h1") -> Column:
    return F.coalesce(tier.startswith(prefix), F.lit(False))


def path_family(path: Column) -> Column:
    """maps, plugins or null by the folder that the path goes through."""
    return F.when(path.contains("/maps/"), "maps").when(path.contains("/plugins/"), "plugins")

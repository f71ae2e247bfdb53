"""Checks of retrieved payloads: HTML in disguise, ZIP magic, and full verification of archives."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What an HTML page starts with, and the signatures of ZIP archives.
HTML_MARKS = ("<html", "<!doctype html", "<script")
ZIP_MAGIC = (b"PK\x03\x04", b"PK\x05\x06", b"PK\x07\x08")
NAMES_KEPT = 12

#: Why a payload is no sound archive; null for one that is.
FAULTS = ("html", "magic", "structure", "member")
_LISTING = T.StructType([T.StructField("entries", T.IntegerType()), T.StructField("names", T.ArrayType(T.StringType())), T.StructField("readable", T.BooleanType()), T.StructField("damaged", T.StringType())])


def looks_like_html(content: Column) -> Column:
    """A mark of HTML in the first 512 bytes, in either case."""
    head = F.lower(F.decode(F.substring(content.cast("binary"), 1, 512), "ISO-8859-1"))
    found = F.lit(False)
    for m in HTML_MARKS:
        found = found | head.contains(m)
    return found


def has_zip_magic(content: Column) -> Column:
    return F.substring(content.cast("binary"), 1, 4).isin(*[F.unhex(F.lit(m.hex())) for m in ZIP_MAGIC])


def _listing(data: bytes) -> dict:
    """What an archive holds: how many members, the first names, whether its directory can be read, and a damaged member's name."""
    found = {"entries": 0, "names": [], "readable": False, "damaged": None}
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as archive:
            members = archive.infolist()
            found |= {"entries": len(members), "names": [m.filename for m in members[:NAMES_KEPT]], "readable": True}
            for m in members:
                found["damaged"] = m.filename  # stays, if reading it to its end (where its CRC is compared) fails
                with archive.open(m) as content:
                    while content.read(1 << 20):
                        pass
            found["damaged"] = None
    except Exception:  # a payload is untrusted: whatever a reader trips over counts against it
        pass
    return found


@F.arrow_udf(_LISTING)
def _listed(payloads: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kind = pa.struct([("entries", pa.int32()), ("names", pa.list_(pa.string())), ("readable", pa.bool_()), ("damaged", pa.string())])
    for column in payloads:  # one payload is opened at a time
        yield pa.array((None if x is None else _listing(x.as_py()) for x in (v if v.is_valid else None for v in column)), kind)


def verify_zip_bytes(content: Column | str) -> Column:
    """A payload's verdict as a struct; null for null. Size, hash and marks are found in the JVM; only what may be an archive is opened.

    fault is one of FAULTS: HTML, no signature, an unreadable directory, a member whose content doesn't have its CRC.
    """
    c = (F.col(content) if isinstance(content, str) else content).cast("binary")
    magic, html = has_zip_magic(c), looks_like_html(c)
    x = _listed(F.when(magic & ~html, c))
    readable = F.coalesce(x["readable"], F.lit(False))
    fault = F.when(html, FAULTS[0]).when(~magic, FAULTS[1]).when(~readable, FAULTS[2]).when(x["damaged"].isNotNull(), FAULTS[3])
    verdict = F.struct(
        F.octet_length(c).cast("long").alias("bytes"), F.sha2(c, 256).alias("sha256"), magic.alias("zip_magic_ok"), html.alias("html_rejected"), readable.alias("zip_ok"),
        (readable & x["damaged"].isNull()).alias("zip_crc_ok"), F.coalesce(x["entries"], F.lit(0)).alias("zip_entries"), x["names"].alias("zip_names_sample"), fault.alias("fault"),
    )
    return F.when(c.isNotNull(), verdict)


def blob_text(content: Column) -> Column:
    """The text of a repository blob: base64 in lines."""
    return F.decode(F.unbase64(F.regexp_replace(content, r"\s", "")), "UTF-8")


def is_verified(verdict: Column) -> Column:
    """A found map counts only if it is a sound ZIP of sound members and no HTML."""
    return F.coalesce(verdict["zip_ok"] & verdict["zip_crc_ok"] & ~verdict["html_rejected"], F.lit(False))


def last_json(text: str | None):
    """The last JSON object in a log, or None: the latest brace from which a whole object can be read and that no other one holds."""
    if not text:
        return None
    decoder, at, found = json.JSONDecoder(), 0, None
    while (at := text.find("{", at)) >= 0:
        try:
            found, at = decoder.raw_decode(text, at)
        except ValueError:
            at += 1
    return found

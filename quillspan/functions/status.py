"""Probe outcomes: precedence, accounting buckets and what is tried again."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The precedence of outcomes. Anything else ranks as OTHER.
RANK = {"200": 4, "FOUND_INVALID": 3, "404": 2, "OTHER": 1, "503": 0, "TIMEOUT": 0, "NETERR": 0}
BUCKETS = ("found_200", "found_invalid", "confirmed_404", "undetermined", "other")
UNDETERMINED = ("503", "TIMEOUT", "NETERR")


def rank(status: Column) -> Column:
    """Precedence of an outcome; the strongest seen of a candidate is its canonical one. Null: null."""
    c = F.when(status.isNull(), F.lit(None).cast("int"))
    for s, r in RANK.items():
        c = c.when(status == s, F.lit(r))
    return c.otherwise(F.lit(RANK["OTHER"]))


def bucket(status: Column) -> Column:
    """The accounting bucket. Undetermined outcomes are never confirmed misses."""
    return (
        F.when(status.isNull(), F.lit(None).cast("string"))
        .when(status == "200", "found_200")
        .when(status == "FOUND_INVALID", "found_invalid")
        .when(status == "404", "confirmed_404")
        .when(status.isin(*UNDETERMINED), "undetermined")
        .otherwise("other")
    )


def retryable(status: Column) -> Column:
    """What a retry batch takes up: undetermined outcomes and all of OTHER."""
    return F.coalesce(status.isin(*UNDETERMINED, "OTHER") | status.startswith("OTHER_"), F.lit(False))


def classify(code: Column, error: Column) -> Column:
    """The outcome of a recorded response: its code, or the kind of its error ('timeout' or any other)."""
    return (
        F.when(error == "timeout", "TIMEOUT")
        .when(error.isNotNull(), "NETERR")
        .when(code.isin(200, 404, 503), code.cast("string"))
        .otherwise(F.concat(F.lit("OTHER_"), code.cast("string")))
    )


def is_bad(status: Column) -> Column:
    """Counts against the service when rates are set."""
    return F.coalesce(status.isin(*UNDETERMINED) | status.startswith("OTHER"), F.lit(False))

"""Text and number expressions, all JVM-side."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def ustrip(c: Column) -> Column:
    """Trim every Unicode white-space character at both ends (``trim`` only takes blanks)."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def blank(c: Column) -> Column:
    """True for null, empty and white-space-only strings."""
    return F.coalesce(ustrip(c) == "", F.lit(True))


def number_g(c: Column) -> Column:
    """Shortest form of a score: ``8.0`` prints as ``8``, ``7.5`` stays."""
    return F.regexp_replace(c.cast("string"), r"\.0$", "")


def sentences(c: Column) -> Column:
    """Split on white space after ``. ! ?`` or on a slash; blank parts are dropped."""
    parts = F.split(c, r"(?U)(?<=[.!?])\s+|\s*/\s*")
    return F.filter(F.transform(parts, ustrip), lambda s: s != "")


def clip(c: Column, limit: int = 180) -> Column:
    """At most ``limit`` code points, the last being an ellipsis where text was cut."""
    t = ustrip(c)
    cut = F.concat(F.regexp_replace(F.substring(t, 1, limit - 1), r"(?U)\s+$", ""), F.lit("…"))
    return F.when(F.length(t) <= limit, t).otherwise(cut)


def safe_div(num: Column, den: Column) -> Column:
    """Null on an empty denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def half_even(c: Column) -> Column:
    """Round half to even, as a bigint."""
    return F.rint(c).cast("bigint")


def stable_unit(text: Column, seed: str) -> Column:
    """First 8 bytes of SHA-256(``seed:text``) as a fraction of 2^64, in [0, 1)."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), text), 256), 1, 16), 16, 10)
    return h.cast("decimal(20,0)").cast("double") / F.lit(float(2**64))


def is_true(c: Column) -> Column:
    """Only a real true counts; null is false."""
    return c.eqNullSafe(F.lit(True))


def today() -> str:
    """The date in UTC as an ISO string; a constant for each call, so a build has one date."""
    return datetime.now(timezone.utc).date().isoformat()


def utc_now() -> str:
    """The time in UTC as an ISO string to the second."""
    return datetime.now(timezone.utc).isoformat(timespec="seconds")

"""Words as the operators of this package read them: runs of anything but ASCII white space, A-Z in lower case."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Spark SQL pattern of one word.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str | None) -> list[bytes]:
    """The words of a whole text as UTF-8. ``bytes.split`` cuts at exactly the six ASCII white space signs and
    ``bytes.lower`` changes A-Z only. A null text has no words."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_count(text: Column) -> Column:
    """Number of words, 0 for null, in Spark SQL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def doc_remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n. A null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n)).cast("int")

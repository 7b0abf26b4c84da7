"""Expressions on texts that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters. ``bytes.split()`` cuts at the same ones.
WORD = r"[^\x20\x09-\x0D]+"


def whole(text: Column) -> Column:
    """The text as string; NULL counts as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def id_remainder(key: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a NULL id counts as the empty text."""
    return F.crc32(whole(key)) % F.lit(modulus)


def scale_bits(rows: int, rows_per_part: int, least: int, most: int) -> int:
    """Power of two of the parts that leaves about ``rows_per_part`` rows in each."""
    return max(least, min(most, max(0, (rows // rows_per_part)).bit_length()))


def slices(batch, rows: int = 256):
    """A record batch in small parts, so that few of its texts are Python objects at once."""
    for first in range(0, batch.num_rows, rows):
        yield batch.slice(first, rows)

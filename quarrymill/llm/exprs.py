"""Column helpers shared by the operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

#: The white space that separates words and is stripped from lines.
SPACE = " \t\n\x0b\x0c\r"


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body reads it."""
    return F.transform(F.array(value), body)[0]


def crc_mod(doc_id: Column, m: int) -> Column:
    """crc32 of the decimal text of an id, modulo ``m``."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(m))


def only_ids(docs: DataFrame, wanted: DataFrame, key: str, slots: int = 1 << 20) -> DataFrame:
    """Rows of ``docs`` whose key may be in ``wanted``: a semi-join on key hashes folded into ``slots`` values, so the
    broadcast side has at most ``slots`` rows of one integer whatever the input. Keeps every wanted row and some others;
    an exact join follows. Saves shuffling texts that nothing asks for."""
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(slots)).cast("int")
    marks = wanted.select(slot(F.col(key)).alias("__slot")).distinct()
    return docs.join(F.broadcast(marks), slot(F.col(key)) == F.col("__slot"), "left_semi")

"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom import fixed as FX


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def md5_hex(e: Column) -> Column:
    """Lower-case hex md5 of a string expression."""
    return F.md5(e)


def surrogate_key(*cols: str | Column) -> Column:
    """md5 of the columns as text, NULL written as '', joined with '|'.

    Coalescing first matters: a bare ``concat_ws`` would skip NULLs and shift
    the remaining parts, so (NULL, 'a') and ('a', NULL) would collide.
    """
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]
    return md5_hex(F.concat_ws(FX.KEY_SEPARATOR, *parts))


def hash_pii(c: str | Column) -> Column:
    """Unsalted md5 of the value as text (lets analysts count distinct people)."""
    return md5_hex(_col(c).cast("string"))


# Stands before the bytes of a text that is no digest, so that those never are 16.
_TEXT_MARK = bytes(17)


def packed_text(c: str | Column) -> Column:
    """The text as bytes without loss: a digest of 32 lower-case hex digits as its 16 bytes, any other text behind a mark."""
    c = _col(c)
    digest = (F.octet_length(c) == 32) & (F.lower(F.hex(F.unhex(c))) == c)
    return F.when(digest, F.unhex(c)).otherwise(F.concat(F.lit(_TEXT_MARK), c.cast("binary")))


def unpacked_text(c: str | Column) -> Column:
    """The text that ``packed_text`` packed."""
    c = _col(c)
    return F.when(F.octet_length(c) == 16, F.lower(F.hex(c))).otherwise(F.substring(c, len(_TEXT_MARK) + 1, 2**31 - 1).cast("string"))

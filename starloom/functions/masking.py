"""PII masks for the analyst views."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom import fixed as FX


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def email_domain(c: str | Column) -> Column:
    """Second part on '@' ('' when there is no '@'); NULL stays NULL."""
    return F.split_part(_col(c), F.lit("@"), F.lit(2))


def mask_email(c: str | Column) -> Column:
    """First letter + '***@' + domain. NULL in, NULL out."""
    c = _col(c)
    return F.concat(F.left(c, F.lit(FX.EMAIL_KEEP)), F.lit(FX.EMAIL_MASK), email_domain(c))


def mask_phone(c: str | Column) -> Column:
    """Country and area code (first 7 characters) + '***-****'."""
    c = _col(c)
    return F.concat(F.left(c, F.lit(FX.PHONE_KEEP)), F.lit(FX.PHONE_MASK))

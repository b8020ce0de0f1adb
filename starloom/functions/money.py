"""Money: round once to cents, store as decimal(18,3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom import fixed as FX
from starloom.schemas import MONEY


def money(e: Column) -> Column:
    """``cast(round(e, 2) as decimal(18,3))``.

    ``e`` must keep its full scale (products of decimals do): casting to the
    money type before rounding would round twice (1.0049 -> 1.005 -> 1.01).
    Decimal rounding is half away from zero, as in the warehouse engines.
    """
    return F.round(e, FX.MONEY_PLACES).cast(MONEY)


def to_money(e: Column) -> Column:
    """Plain cast to the money type (the staging cast of a price column)."""
    return e.cast(MONEY)

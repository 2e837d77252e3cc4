"""Rounding and text of doubles that any engine reproduces.

``round`` of a double differs between engines on half ties. Going through
``DECIMAL(28,8)`` first and rounding half away from zero on the decimal gives
the same answer everywhere. Values that do not fit the decimal (wild input)
are rounded as doubles instead: no value makes a query fail.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PIN = "decimal(28,8)"
PLAIN = "decimal(38,18)"


def round_half_up(x: Column, scale: int) -> Column:
    return F.coalesce(F.round(x.try_cast(PIN), scale).cast("double"), F.round(x, scale))


def double_text(x: Column) -> Column:
    """All digits of a double, without exponent or closing zeros (``12.5``, ``12``, ``0.0001``).

    Beyond 20 digits before the point the engine's own text is used.
    """
    plain = F.regexp_replace(x.try_cast(PLAIN).cast("string"), r"\.?0+$", "")
    return F.coalesce(plain, x.cast("string"))

"""Duplicate removal on a static DataFrame (one micro-batch or a backfill).

Of the rows of a key one is chosen by its place in one sort. Every task keeps only its
own first row per key before the shuffle (a group limit below the exchange), so a record
repeated a million times is one row per task, and the shuffle on the key is the only one:
``keep="first"``/``"last"`` by the smallest/largest ``order_by`` values (all
other columns break ties, so the choice is deterministic), ``keep="any"``
whichever comes first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup(
    df: DataFrame,
    keys: list[str],
    keep: str = "any",
    order_by: list[str] | None = None,
) -> DataFrame:
    if keep not in ("any", "first", "last"):
        raise ValueError("keep must be 'any', 'first' or 'last'")
    others = [c for c in df.columns if c not in keys]
    order = [*(order_by or []), *(c for c in others if c not in (order_by or []))]
    if keep == "any" or not others:
        ranked = [F.col(k) for k in keys]
    else:
        ranked = [F.col(c).desc() if keep == "last" else F.col(c).asc() for c in order]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*ranked))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")

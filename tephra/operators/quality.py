"""Declarative data-quality checks compiled to one aggregate per table.

A check is ``(kind, columns, arg)``:

* ``("not_null", ["c"], None)``              rows where ``c`` is NULL
* ``("unique", ["a", "b"], None)``           rows beyond the first per key
* ``("accepted_values", ["c"], [v1, v2])``   non-NULL rows with another value
* ``("range", ["c"], (lo, hi))``             non-NULL rows outside ``[lo, hi]``

All checks of a table are evaluated in a single pass (``count_if`` and
one ``count_distinct``); the result has one row per check with the number
of failing rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Check = tuple[str, list[str], object]


def _failures(kind: str, cols: list[str], arg) -> Column:
    c = [F.col(x) for x in cols]
    if kind == "not_null":
        return F.count_if(c[0].isNull())
    if kind == "unique":
        complete = F.count_if(F.lit(True) if not c else _all_not_null(c))
        return complete - F.count_distinct(*c)
    if kind == "accepted_values":
        return F.count_if(c[0].isNotNull() & ~c[0].isin(*arg))
    if kind == "range":
        lo, hi = arg
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (c[0] < F.lit(lo))
        if hi is not None:
            bad = bad | (c[0] > F.lit(hi))
        return F.count_if(c[0].isNotNull() & bad)
    raise ValueError(f"unknown check {kind!r}")


def _all_not_null(cols: list[Column]) -> Column:
    cond = cols[0].isNotNull()
    for x in cols[1:]:
        cond = cond & x.isNotNull()
    return cond


def run_checks(df: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    aggs = [_failures(k, cols, arg).cast("long").alias(f"_c{i}") for i, (k, cols, arg) in enumerate(checks)]
    one_row = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(k).alias("check"),
                F.lit(",".join(cols)).alias("columns"),
                F.col(f"_c{i}").alias("failures"),
            )
            for i, (k, cols, _) in enumerate(checks)
        ]
    )
    return one_row.select(F.inline(rows))


# Checks on the marts and their staging ancestors (the original
# project ran an empty test suite).
MART_CHECKS: dict[str, list[Check]] = {
    "stg_fires": [
        ("not_null", ["event_time"], None),
        ("range", ["latitude"], (-90, 90)),
        ("range", ["longitude"], (-180, 180)),
        ("accepted_values", ["confidence"], ["l", "n", "h"]),
        ("range", ["fire_radioactive_power"], (0, None)),
    ],
    "stg_earthquakes": [
        ("not_null", ["event_time"], None),
        ("range", ["latitude"], (-90, 90)),
        ("range", ["longitude"], (-180, 180)),
        ("range", ["magnitude"], (-2, 10)),
    ],
    "fire_summary": [
        ("not_null", ["event_date"], None),
        ("unique", ["event_date", "satellite", "confidence"], None),
        ("accepted_values", ["fire_intensity_category"], ["severe", "moderate", "low"]),
        ("range", ["fire_count"], (1, None)),
    ],
    "earthquake_summary": [
        ("not_null", ["event_date"], None),
        ("unique", ["event_date", "hour"], None),
        ("range", ["hour"], (0, 23)),
        ("range", ["earthquake_count"], (1, None)),
    ],
    "combined_events": [
        ("not_null", ["event_type"], None),
        ("accepted_values", ["event_type"], ["fire", "earthquake"]),
        ("accepted_values", ["severity_level"], ["severe", "moderate"]),
        ("range", ["latitude"], (-90, 90)),
        ("range", ["longitude"], (-180, 180)),
    ],
}


def check_marts(marts: dict[str, DataFrame], checks: dict[str, list[Check]] | None = None) -> DataFrame:
    checks = checks or MART_CHECKS
    out = None
    for table, df in marts.items():
        if table not in checks:
            continue
        r = run_checks(df, table, checks[table])
        out = r if out is None else out.unionByName(r)
    return out

"""Property: the threshold engine agrees with a plain first-match rule."""

from __future__ import annotations

import operator

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tephra.functions import rules

OPS = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le}
TABLES = [
    (rules.FIRE_MAP_CATEGORY, rules.FIRE_MAP_CATEGORY_DEFAULT),
    (rules.QUAKE_MAP_CATEGORY, rules.QUAKE_MAP_CATEGORY_DEFAULT),
    (rules.QUAKE_MAP_COLOR, rules.QUAKE_MAP_COLOR_DEFAULT),
    (rules.FIRE_POWER_SEVERITY, rules.FIRE_POWER_SEVERITY_DEFAULT),
    (rules.QUAKE_DEPTH, rules.QUAKE_DEPTH_DEFAULT),
]
BOUNDARIES = sorted({float(t) for table, _ in TABLES for _, t, _ in table})


def expected(x, table, default):
    if x is None:
        return default
    for op, t, label in table:
        if OPS[op](x, t):
            return label
    return default


values = st.lists(
    st.one_of(
        st.none(),
        st.sampled_from(BOUNDARIES),
        st.floats(min_value=-100, max_value=800, allow_nan=False),
    ),
    min_size=1,
    max_size=60,
)


@settings(max_examples=8, deadline=None)
@given(values)
def test_classify_matches_first_match_rule(spark, xs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    cols = [rules.classify(F.col("x"), t, d).alias(f"c{k}") for k, (t, d) in enumerate(TABLES)]
    for r in df.select("i", "x", *cols).collect():
        for k, (t, d) in enumerate(TABLES):
            assert r[f"c{k}"] == expected(r.x, t, d)

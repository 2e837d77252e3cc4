"""Classification rules of the marts and serving views as threshold tables.

Each table is a list of ``(operator, threshold, label)`` checked in order;
the first match wins and ``default`` is used otherwise. A NULL measure
matches nothing and therefore falls to the default, as a SQL CASE does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, float, str]

# Thresholds and labels of the dashboards (must stay as written).
FIRE_INTENSITY_CATEGORY: list[Rule] = [(">=", 400, "severe"), (">=", 350, "moderate")]
FIRE_INTENSITY_CATEGORY_DEFAULT = "low"

FIRE_CLUSTER_SEVERITY: list[Rule] = [(">=", 400, "severe")]
QUAKE_SEVERITY: list[Rule] = [(">=", 6, "severe")]
EVENT_SEVERITY_DEFAULT = "moderate"

FIRE_MAP_CATEGORY: list[Rule] = [
    (">", 400, "Extreme Fire"),
    (">", 350, "Severe Fire"),
    (">", 320, "Moderate Fire"),
]
FIRE_MAP_CATEGORY_DEFAULT = "Low Fire"

QUAKE_MAP_CATEGORY: list[Rule] = [
    (">=", 7.0, "Major Earthquake"),
    (">=", 5.5, "Strong Earthquake"),
    (">=", 4.0, "Moderate Earthquake"),
    (">=", 2.5, "Light Earthquake"),
]
QUAKE_MAP_CATEGORY_DEFAULT = "Minor Earthquake"

FIRE_MAP_COLOR: list[Rule] = [
    (">", 400, "#8B0000"),
    (">", 350, "#FF0000"),
    (">", 320, "#FF6600"),
]
FIRE_MAP_COLOR_DEFAULT = "#FFA500"

QUAKE_MAP_COLOR: list[Rule] = [
    (">=", 6.0, "#4B0082"),
    (">=", 5.0, "#0000FF"),
    (">=", 4.0, "#1E90FF"),
    (">=", 3.0, "#87CEEB"),
]
QUAKE_MAP_COLOR_DEFAULT = "#ADD8E6"

CONFIDENCE_LEVEL = {"h": "High", "n": "Nominal", "l": "Low"}
CONFIDENCE_LEVEL_DEFAULT = "Unknown"

FIRE_POWER_SEVERITY: list[Rule] = [
    (">", 500, "Extreme"),
    (">", 200, "Severe"),
    (">", 50, "Moderate"),
]
FIRE_POWER_SEVERITY_DEFAULT = "Low"

QUAKE_ACTIVITY: list[Rule] = [
    (">=", 6.0, "Significant Activity"),
    (">=", 4.5, "Moderate Activity"),
    (">=", 3.0, "Light Activity"),
]
QUAKE_ACTIVITY_DEFAULT = "Minor Activity"

QUAKE_DEPTH: list[Rule] = [("<=", 70, "Shallow"), ("<=", 300, "Intermediate")]
QUAKE_DEPTH_DEFAULT = "Deep"

# Realtime counters and alert levels.
SEVERE_FIRE_ABOVE = 350
SIGNIFICANT_QUAKE_FROM = 5.0
ALERT_QUAKE_FROM = 6.0
ALERT_FIRE_ABOVE = 400
ALERT_COUNT_ABOVE = 100

# Fire bubble size: clamp((x - 300) / 2, 1, 100); quake bubble size: 2 ** x.
FIRE_BUBBLE_OFFSET = 300
FIRE_BUBBLE_DIVISOR = 2
FIRE_BUBBLE_MIN = 1
FIRE_BUBBLE_MAX = 100
QUAKE_BUBBLE_BASE = 2.0

_OPS = {
    ">": lambda c, t: c > t,
    ">=": lambda c, t: c >= t,
    "<": lambda c, t: c < t,
    "<=": lambda c, t: c <= t,
}


def classify(measure: Column, rules: list[Rule], default: str | None) -> Column:
    """First-match ``CASE`` over a threshold table."""
    expr = None
    for op, threshold, label in rules:
        cond = _OPS[op](measure, F.lit(threshold))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def lookup(key: Column, table: dict[str, str], default: str | None) -> Column:
    """Equality ``CASE`` over a small label map."""
    expr = None
    for value, label in table.items():
        cond = key == F.lit(value)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def by_event_type(event_type: Column, fire: Column, quake: Column) -> Column:
    """Two-branch CASE on the event type with no ELSE: unknown types give NULL."""
    return F.when(event_type == "fire", fire).when(event_type == "earthquake", quake)

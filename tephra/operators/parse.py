"""Raw payload parsers: fire CSV documents and GeoJSON earthquake collections.

Both take a DataFrame with a string column ``value`` (one message per
row) and work the same on a batch and on a streaming DataFrame. They use
built-ins only (``split``/``explode``/``from_csv``/``from_json``), so the
work stays inside whole-stage code generation and is spread over the
partitions of the input messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tephra import schemas
from tephra.functions.events import (
    acq_date,
    acq_timestamp,
    epoch_millis_to_seconds_ts,
    fire_event_id,
    grid_cell,
)

CORRUPT = "_corrupt_record"
# A header line starts with this; lines this short or shorter are noise.
FIRE_HEADER_PREFIX = "latitude"
FIRE_MIN_LINE_CHARS = 10


def fire_lines(payloads: DataFrame) -> DataFrame:
    """One row per data line of every CSV document (column ``line``).

    CRs and every double quote are stripped first (so a quoted field that
    holds a comma shifts the columns, as in the feed's own reader), the
    header and short noise lines are dropped.
    """
    # The characters the feed's reader strips.
    clean = F.trim(F.regexp_replace(F.col("value").cast("string"), '[\r"]', ""))
    return (
        payloads.where(F.col("value").isNotNull())
        .select(F.explode(F.split(clean, "\n")).alias("line"))
        .where(~F.col("line").startswith(FIRE_HEADER_PREFIX))
        .where(F.length("line") > FIRE_MIN_LINE_CHARS)
    )


def _with_corrupt(ddl: str) -> str:
    """A schema with the column that takes a record as it was, if it does not fit."""
    return f"{ddl.strip()}, {CORRUPT} STRING"


def parse_fire_lines(
    lines: DataFrame,
    cell_degrees: float = 0.22,
    rounding: str = "trunc",
    keep_corrupt: bool = False,
) -> DataFrame:
    """CSV lines -> rows of the stored ``fires`` table (PERMISSIVE parsing)."""
    parsed = F.from_csv(
        F.col("line"),
        _with_corrupt(schemas.FIRE_CSV),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    rows = lines.select(F.col("line"), parsed.alias("p")).select("line", "p.*")
    day = acq_date(F.col("acq_date"))
    out = (
        rows.withColumn("acq_date", day)
        .withColumn("event_timestamp", acq_timestamp(F.col("acq_date"), F.col("acq_time")))
        .withColumn("event_type", F.lit("fire"))
        .withColumn(
            "event_id",
            fire_event_id(
                F.col("satellite"),
                F.col("acq_date"),
                F.col("acq_time"),
                F.col("latitude"),
                F.col("longitude"),
            ),
        )
        .withColumn(
            "cluster_id",
            grid_cell(
                F.col("latitude"), F.col("longitude"), F.col("acq_date"), cell_degrees, rounding
            ),
        )
    )
    cols = list(schemas.FIRES_COLUMNS)
    if keep_corrupt:
        cols += ["line", CORRUPT]
    return out.select(*cols)


def parse_fires(
    payloads: DataFrame, cell_degrees: float = 0.22, rounding: str = "trunc"
) -> DataFrame:
    """Fire CSV messages -> ``fires`` rows, exactly as the feed's reader keeps them."""
    return parse_fire_lines(fire_lines(payloads), cell_degrees, rounding)


def _fire_reason(latest: Column | None) -> Column:
    """Why a parsed line is unusable (null: it is not)."""
    c = F.col
    reason = (
        F.when(c(CORRUPT).isNotNull(), F.lit("malformed_csv"))
        .when(c("latitude").isNull() | c("longitude").isNull(), F.lit("missing_coordinates"))
        .when(c("acq_date").isNull(), F.lit("bad_acq_date"))
        .when(c("event_timestamp").isNull(), F.lit("bad_acq_time"))
    )
    return reason if latest is None else reason.when(c("event_timestamp") > latest, F.lit("future_time"))


def fire_rejects(parsed_with_corrupt: DataFrame, latest: Column | None = None) -> DataFrame:
    """Dead letters of the fire path: lines that did not give a usable row.

    A line is rejected when the CSV reader flagged it, when it has no
    coordinates or no valid acquisition date/time, or when it is later than
    ``latest``, the last event time the ingest accepts.
    """
    return parsed_with_corrupt.select(
        F.lit("fires").alias("source"), F.col("line").alias("record"), _fire_reason(latest).alias("reason")
    ).where(F.col("reason").isNotNull())


# Columns that say what becomes of a record of a routed parse: its text, why it is a
# dead letter (null: it is none), and whether its row is stored.
RECORD, REASON, KEPT = "_record", "_reason", "_kept"


def routed_fires(payloads: DataFrame, latest: Column, cell_degrees: float = 0.22, rounding: str = "trunc") -> DataFrame:
    """Every line, parsed once: the stored columns and where the line goes."""
    full = parse_fire_lines(fire_lines(payloads), cell_degrees, rounding, keep_corrupt=True)
    kept = F.coalesce(F.col("event_timestamp") <= latest, F.lit(False))
    return full.select(
        *schemas.FIRES_COLUMNS, F.col("line").alias(RECORD), _fire_reason(latest).alias(REASON), kept.alias(KEPT)
    )


def split_fires(
    payloads: DataFrame, cell_degrees: float = 0.22, rounding: str = "trunc"
) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)`` from one parse; ``good`` only holds usable rows."""
    full = parse_fire_lines(fire_lines(payloads), cell_degrees, rounding, keep_corrupt=True)
    good = full.where(
        F.col(CORRUPT).isNull()
        & F.col("latitude").isNotNull()
        & F.col("longitude").isNotNull()
        & F.col("event_timestamp").isNotNull()
    ).select(*schemas.FIRES_COLUMNS)
    return good, fire_rejects(full)


def quake_features(payloads: DataFrame, narrow: bool = True) -> DataFrame:
    """GeoJSON collections -> one row per feature: ``value, doc_ok, record, f``.

    The collection is read with its features as text, then every feature on its own, so
    a field that does not parse is NULL in its feature and costs no other one. A document
    without features gives one row with a NULL ``record``. ``narrow`` declares only the
    properties the pipeline reads, so the JSON parser skips the other leaves.
    """
    collection = _with_corrupt(schemas.QUAKE_COLLECTION)
    feature = _with_corrupt(schemas.QUAKE_FEATURE_NARROW if narrow else schemas.QUAKE_FEATURE)
    permissive = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    docs = payloads.where(F.col("value").isNotNull()).select(F.col("value").cast("string").alias("value"))
    docs = docs.withColumn("d", F.from_json("value", collection, permissive))
    ok = F.col("d").isNotNull() & F.col(f"d.{CORRUPT}").isNull()
    rows = docs.select("value", ok.alias("doc_ok"), F.explode_outer("d.features").alias("record"))
    return rows.withColumn("f", F.from_json("record", feature, permissive))


def _feature_columns() -> list:
    coords = F.col("f.geometry.coordinates")
    return [
        F.col("f.properties.mag").alias("magnitude"),
        F.col("f.properties.place").alias("place"),
        F.col("f.properties.time").alias("time"),
        F.get(coords, 0).alias("longitude"),
        F.get(coords, 1).alias("latitude"),
        F.get(coords, 2).alias("depth"),
        F.col("f.id").alias("event_id"),
        F.lit("earthquake").alias("event_type"),
    ]


def parse_quakes(payloads: DataFrame, processed_at=None, narrow: bool = True) -> DataFrame:
    """GeoJSON messages -> rows of the stored ``earthquakes`` table.

    Features without a positive ``time`` are dropped; times are truncated
    to whole seconds; a short ``coordinates`` array gives NULLs, and so does
    a field that does not parse.
    """
    feats = quake_features(payloads, narrow).where(F.col("f").isNotNull())
    rows = feats.select(*_feature_columns())
    ts = epoch_millis_to_seconds_ts(F.col("time"))
    return (
        rows.where(F.col("time").isNotNull() & (F.col("time") > 0))
        .withColumn("event_timestamp", ts)
        .where(F.col("event_timestamp").isNotNull())
        .withColumn("event_date", F.to_date("event_timestamp"))
        .withColumn(
            "processed_at",
            processed_at if processed_at is not None else F.current_timestamp(),
        )
        .select(*schemas.QUAKES_COLUMNS)
    )


def _quake_reason(latest: Column | None) -> Column:
    """Why a feature is a dead letter (null: it is none)."""
    t = F.col("f.properties.time")
    coords = F.col("f.geometry.coordinates")
    event_time = epoch_millis_to_seconds_ts(t)
    reason = (
        F.when(~F.col("doc_ok") & F.col("record").isNull(), F.lit("malformed_json"))
        .when(F.col("record").isNull(), F.lit("no_features"))
        .when(t.isNull() | (t <= 0), F.lit("bad_time"))
        .when(event_time.isNull(), F.lit("time_out_of_range"))
    )
    if latest is not None:
        reason = reason.when(event_time > latest, F.lit("future_time"))
    return reason.when(
        F.get(coords, 0).isNull() | F.get(coords, 1).isNull(), F.lit("missing_coordinates")
    ).when(F.col(f"f.{CORRUPT}").isNotNull(), F.lit("bad_field"))


def routed_quakes(payloads: DataFrame, latest: Column) -> DataFrame:
    """Every feature (and every document without any), parsed once: the stored columns and where it goes."""
    feats = quake_features(payloads)
    rows = feats.select(
        *_feature_columns(), F.coalesce("record", "value").alias(RECORD), _quake_reason(latest).alias(REASON)
    )
    sound = F.when(F.col("time") > 0, F.col("time"))
    rows = rows.withColumn("event_timestamp", epoch_millis_to_seconds_ts(sound))
    rows = rows.withColumn("event_date", F.to_date("event_timestamp")).withColumn("processed_at", F.current_timestamp())
    kept = F.coalesce(F.col("event_timestamp") <= latest, F.lit(False))
    return rows.select(*schemas.QUAKES_COLUMNS, RECORD, REASON, kept.alias(KEPT))


def quake_rejects(payloads: DataFrame, latest: Column | None = None) -> DataFrame:
    """Dead letters of the quake path: unparseable documents, unusable features, and
    features that are kept but had a field that did not parse (``bad_field``).

    ``latest`` is the last event time the ingest accepts, where it has one.
    """
    return (
        quake_features(payloads, narrow=True)
        .select(F.lit("earthquakes").alias("source"), F.coalesce("record", "value").alias("record"),
                _quake_reason(latest).alias("reason"))
        .where(F.col("reason").isNotNull())
    )

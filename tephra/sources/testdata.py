"""Fire and earthquake feeds derived, with Spark, from the driver's ``events`` table.

The driver tables carry no hazard data, so the feeds are defined as
deterministic functions of ``events`` (the same definitions are written
in SQL for the oracle, see ``tephra.oracle``). Every row of ``events`` of
the fire types becomes one fire detection, every row of the quake types
one earthquake, so the work of every query grows with the input.

Raw payloads are built the way the upstream feeds ship them: a fire
message is one CSV document with a header and CRLF line ends, a quake
message one GeoJSON FeatureCollection. A document holds the events of
one hour, split into chunks of at most ``rows_per_doc`` events, so no
document (and no group while building it) grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tephra.functions.events import fire_event_id, grid_cell

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# The event types that stand for fires and for earthquakes.
FIRE_TYPES = ("error", "click", "signup")
QUAKE_TYPES = ("purchase", "view")

# Constant fields of the fire CSV lines.
FIRE_SCAN = "0.4"
FIRE_TRACK = "0.4"
FIRE_INSTRUMENT = "VIIRS"
FIRE_VERSION = "2.0NRT"
FIRE_BRIGHT_TI5 = "290.0"
FIRE_DAYNIGHT = "D"
FIRE_CSV_HEADER = (
    "latitude,longitude,bright_ti4,scan,track,acq_date,acq_time,satellite,"
    "instrument,confidence,version,bright_ti5,frp,daynight"
)
QUAKE_TIME_EXTRA_MILLIS = 7
ROWS_PER_DOC = 500
# The time stamp of the planted event of the far future.
FUTURE_DAY, FUTURE_MILLIS = "2099-01-01", 4070908800000
# Records that exercise the parsers' tests, by remainder of the event id: (divisor, remainder).
NO_LATITUDE = (97, 5)  # fires without a latitude
NO_COORDINATES = (79, 3)  # quakes without coordinates
NO_DEPTH = (83, 7)  # quakes with two coordinates
BAD_MAGNITUDE = (73, 11)  # quakes whose magnitude is not a number
ZERO_TIME, NO_TIME, NEGATIVE_TIME, HUGE_TIME = (89, 1), (89, 2), (89, 3), (89, 4)
NEGATIVE_MILLIS, HUGE_MILLIS = -5, 900000000000000000
# Messages (by document number) that first arrive in the second wave of a stream.
LATE_DOCS = (5, 2)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case_mod(x: Column, n: int, labels: list) -> Column:
    m = x % n
    expr = F.when(m == 0, F.lit(labels[0]))
    for i, label in enumerate(labels[1:], start=1):
        expr = expr.when(m == i, F.lit(label))
    return expr


def _scaled(x: Column, mult: int, mod: int, offset: int, div: int) -> Column:
    return ((x * mult) % mod - offset).cast("double") / div


def _is(x: Column, rule: tuple[int, int]) -> Column:
    return x % rule[0] == rule[1]


def fx_fires(events: DataFrame) -> DataFrame:
    """One fire detection per fire-typed event (latitudes in [-1, 1], some missing)."""
    e = events.where(F.col("event_type").isin(*FIRE_TYPES))
    eid, uid = F.col("event_id"), F.col("user_id")
    bright = (
        F.lit(2900) + (eid * 31) % 1500 + _case_mod(uid, 3, [0, -400, 700])
    ).cast("double") / 10
    return e.select(
        eid.alias("src_id"),
        F.when(~_is(eid, NO_LATITUDE), _scaled(eid, 7919, 201, 100, 100)).alias("latitude"),
        _scaled(eid, 104729, 201, 100, 100).alias("longitude"),
        bright.alias("bright_ti4"),
        _case_mod(uid, 3, ["N", "N20", "N21"]).alias("satellite"),
        _case_mod(eid, 4, ["h", "n", "l", "x"]).alias("confidence"),
        (F.col("value") * 2).alias("frp"),
        F.date_trunc("minute", F.col("ts").cast("timestamp")).alias("event_time"),
    )


def fx_quakes(events: DataFrame) -> DataFrame:
    """One earthquake per quake-typed event, anywhere on the globe.

    ``time`` is what the feed says, in part unusable; some features lack
    coordinates, a depth or a readable magnitude. ``event_time`` places the
    feature in its document.
    """
    e = events.where(F.col("event_type").isin(*QUAKE_TYPES))
    eid = F.col("event_id")
    second = F.date_trunc("second", F.col("ts").cast("timestamp"))
    placed = ~_is(eid, NO_COORDINATES)
    return e.select(
        eid.alias("src_id"),
        F.when(placed, _scaled(eid, 7919, 18001, 9000, 100)).alias("latitude"),
        F.when(placed, _scaled(eid, 104729, 36001, 18000, 100)).alias("longitude"),
        F.when(placed & ~_is(eid, NO_DEPTH), ((eid * 13) % 6500).cast("double") / 10).alias("depth"),
        F.when(~_is(eid, BAD_MAGNITUDE), (eid % 90).cast("double") / 10).alias("magnitude"),
        second.alias("event_time"),
        F.when(_is(eid, ZERO_TIME), F.lit(0))
        .when(_is(eid, NO_TIME), F.lit(None).cast("bigint"))
        .when(_is(eid, NEGATIVE_TIME), F.lit(NEGATIVE_MILLIS))
        .when(_is(eid, HUGE_TIME), F.lit(HUGE_MILLIS))
        .otherwise(F.unix_millis(second) + QUAKE_TIME_EXTRA_MILLIS)
        .alias("time"),
    )


def usable(quakes: DataFrame) -> DataFrame:
    """Fixture quakes with a time the ingest accepts."""
    eid = F.col("src_id")
    bad = _is(eid, ZERO_TIME) | _is(eid, NO_TIME) | _is(eid, NEGATIVE_TIME) | _is(eid, HUGE_TIME)
    return quakes.where(~bad)


def _acq_time_text(ts: Column) -> Column:
    """``HHmm`` written without leading zeros, as the feed sometimes does."""
    return (F.hour(ts) * 100 + F.minute(ts)).cast("string")


def fires_table(events: DataFrame, cell_degrees: float = 0.22, rounding: str = "trunc") -> DataFrame:
    """The stored ``fires`` table the ingest writes for these detections."""
    f = fx_fires(events)
    day = F.to_date(F.col("event_time"))
    acq_time = _acq_time_text(F.col("event_time"))
    return f.select(
        "latitude",
        "longitude",
        "bright_ti4",
        F.lit(float(FIRE_SCAN)).alias("scan"),
        F.lit(float(FIRE_TRACK)).alias("track"),
        day.alias("acq_date"),
        acq_time.alias("acq_time"),
        "satellite",
        F.lit(FIRE_INSTRUMENT).alias("instrument"),
        "confidence",
        F.lit(FIRE_VERSION).alias("version"),
        F.lit(float(FIRE_BRIGHT_TI5)).alias("bright_ti5"),
        "frp",
        F.lit(FIRE_DAYNIGHT).alias("daynight"),
        F.col("event_time").alias("event_timestamp"),
        F.lit("fire").alias("event_type"),
        fire_event_id(
            F.col("satellite"), day, acq_time, F.col("latitude"), F.col("longitude")
        ).alias("event_id"),
        grid_cell(F.col("latitude"), F.col("longitude"), day, cell_degrees, rounding).alias(
            "cluster_id"
        ),
    )


def quakes_table(events: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """The stored ``earthquakes`` table the ingest writes for these quakes."""
    q = usable(fx_quakes(events))
    return q.select(
        "magnitude",
        F.concat(F.lit("p"), F.col("src_id").cast("string")).alias("place"),
        "time",
        "longitude",
        "latitude",
        "depth",
        F.col("src_id").cast("string").alias("event_id"),
        F.lit("earthquake").alias("event_type"),
        F.col("event_time").alias("event_timestamp"),
        F.to_date(F.col("event_time")).alias("event_date"),
        (processed_at if processed_at is not None else F.current_timestamp()).alias(
            "processed_at"
        ),
    )


def _doc_key(ts: Column, src_id: Column, rows_per_doc: int) -> list[Column]:
    return [
        F.date_trunc("hour", ts).alias("doc_hour"),
        F.floor(src_id / F.lit(rows_per_doc)).alias("doc_chunk"),
    ]


def fire_payloads(
    events: DataFrame,
    rows_per_doc: int = ROWS_PER_DOC,
    resend: bool = False,
    junk: bool = False,
    future: bool = False,
) -> DataFrame:
    """Raw fire messages ``(doc_hour, doc_chunk, copy, value)``.

    Every document also holds a short noise line; every one is followed by an
    empty (NULL) message. ``resend`` ships every document a second time one hour later, as the
    upstream feed repeats overlapping windows (duplicates for dedup).
    ``junk`` appends one malformed line per document (for the rejects path),
    ``future`` one detection of the far future.
    """
    f = fx_fires(events)
    ts = F.col("event_time")
    q = F.lit('"')

    def csv(day: Column) -> Column:
        return F.concat_ws(
            ",",
            F.concat(q, F.coalesce(F.col("latitude").cast("string"), F.lit("")), q),
            F.col("longitude").cast("string"),
            F.col("bright_ti4").cast("string"),
            F.lit(FIRE_SCAN),
            F.lit(FIRE_TRACK),
            day,
            _acq_time_text(ts),
            F.col("satellite"),
            F.lit(FIRE_INSTRUMENT),
            F.col("confidence"),
            F.lit(FIRE_VERSION),
            F.lit(FIRE_BRIGHT_TI5),
            F.col("frp").cast("string"),
            F.lit(FIRE_DAYNIGHT),
        )

    docs = (
        f.select(*_doc_key(ts, F.col("src_id"), rows_per_doc), csv(F.to_date(ts).cast("string")).alias("line"))
        .groupBy("doc_hour", "doc_chunk")
        .agg(F.sort_array(F.collect_list("line")).alias("lines"))
    )
    docs = docs.withColumn("lines", F.array_append("lines", F.lit("noise,noi")))
    if junk:
        bad = F.concat(
            F.lit("badrow,"), F.col("doc_chunk").cast("string"), F.lit(",2,3,4,notadate,xx")
        )
        docs = docs.withColumn("lines", F.array_append("lines", bad))
    if future:
        first = F.regexp_replace(F.get("lines", F.lit(0)), r"[0-9]{4}-[0-9]{2}-[0-9]{2}", FUTURE_DAY)
        docs = docs.withColumn("lines", F.array_append("lines", first))
    value = F.concat(F.lit(FIRE_CSV_HEADER + "\r\n"), F.array_join("lines", "\r\n"))
    docs = docs.select("doc_hour", "doc_chunk", value.alias("value"))
    return _copies(docs, resend)


def _copies(docs: DataFrame, resend: bool, truncated: bool = False) -> DataFrame:
    """Copy 0 of every document; copy 1 one hour later when ``resend``; copy 2, cut after
    40 characters (malformed), when ``truncated``; copy 9, without a value.

    The copies come from one ``explode`` of the aggregated documents, so
    the document aggregation runs once (a union would run it twice).
    """
    kinds = [0] + ([1] if resend else []) + ([2] if truncated else []) + [9]
    copy = F.col("copy")
    return docs.select(
        "doc_hour", "doc_chunk", "value", F.explode(F.array(*map(F.lit, kinds))).alias("copy")
    ).select(
        F.when(copy == 1, F.col("doc_hour") + F.expr("INTERVAL 1 HOUR"))
        .otherwise(F.col("doc_hour"))
        .alias("doc_hour"),
        "doc_chunk",
        "copy",
        F.when(copy == 2, F.substring("value", 1, 40)).when(copy != 9, F.col("value")).alias("value"),
    )


def first_arrives_late() -> Column:
    """Documents whose first copy comes with the second wave."""
    return F.col("doc_chunk") % LATE_DOCS[0] == LATE_DOCS[1]


def quake_payloads(
    events: DataFrame,
    rows_per_doc: int = ROWS_PER_DOC,
    resend: bool = False,
    junk: bool = False,
    future: bool = False,
) -> DataFrame:
    """Raw GeoJSON messages ``(doc_hour, doc_chunk, copy, value)``.

    Times carry 7 extra milliseconds, which the parser must drop.
    ``junk`` adds one truncated (malformed) document per chunk, ``future`` one
    feature of the far future per document.
    """
    qk = fx_quakes(events)
    coordinates = F.when(F.col("depth").isNull(), F.array("longitude", "latitude")).otherwise(
        F.array("longitude", "latitude", "depth")
    )
    feature = F.to_json(
        F.struct(
            F.struct(
                F.coalesce(F.col("magnitude"), F.lit(-1.0)).alias("mag"),
                F.concat(F.lit("p"), F.col("src_id").cast("string")).alias("place"),
                "time",
            ).alias("properties"),
            F.struct(
                F.lit("Point").alias("type"),
                F.when(F.col("latitude").isNotNull(), coordinates).alias("coordinates"),
            ).alias("geometry"),
            F.col("src_id").cast("string").alias("id"),
        )
    )
    feature = F.when(
        F.col("magnitude").isNull(), F.regexp_replace(feature, '"mag":-1.0', '"mag":"strong"')
    ).otherwise(feature)
    docs = (
        qk.select(*_doc_key(F.col("event_time"), F.col("src_id"), rows_per_doc), feature.alias("f"))
        .groupBy("doc_hour", "doc_chunk")
        .agg(F.sort_array(F.collect_list("f")).alias("features"))
    )
    if future:
        planted = F.concat(
            F.lit(f'{{"properties":{{"mag":1.0,"time":{FUTURE_MILLIS}}},"geometry":{{"coordinates":[1,1,1]}},"id":"f'),
            F.col("doc_chunk").cast("string"),
            F.lit('"}'),
        )
        docs = docs.withColumn("features", F.array_append("features", planted))
    value = F.concat(
        F.lit('{"type":"FeatureCollection","features":['), F.array_join("features", ","), F.lit("]}")
    )
    docs = docs.select("doc_hour", "doc_chunk", value.alias("value"))
    return _copies(docs, resend, truncated=junk)

"""Synthetic trips, zones and campaigns, computed row by row from an id column."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom import schemas as S
from tallyloom.functions.scalar import cents, clip, uniform_int, weighted_choice
from tallyloom.functions.uniforms import Uniforms, normal_pair
from tallyloom.sources.files import write_parquet

# Fixed values of the trip model.
FIRST_SECOND = 1_704_067_200        # 2024-01-01T00:00:00Z
DAYS = 30
MORNING, EVENING = 8.5, 18.0        # the two humps of the day, in hours
HUMP_HOURS = 3.0                    # standard deviation around a hump
LAST_HOUR = 23.999
LOG_KM_MEAN, LOG_KM_DEVIATION = 0.7, 0.85
SLOWEST_KMH, KMH_RANGE = 8.0, 37.0
STOP_MEAN_S, STOP_DEVIATION_S = 120.0, 60.0
SHORTEST_S, LONGEST_S = 5.0, 28_800.0
BASE_FARE, FARE_PER_KM, FARE_PER_MINUTE = 3.0, 2.6, 0.45
DIRTY_SHARE, DIRTY_KM, DIRTY_FARE = 0.04, 0.0, -1.0


def trip_ids(spark: SparkSession, scale: str) -> DataFrame:
    """Ids 0..rows-1 of a size preset, one partition per output file."""
    rows, files = S.scale(scale)
    return spark.range(0, rows, 1, files)


def trips(ids: DataFrame, *, id_column: str = "id", skew: bool = False,
          hot_share: float = S.HOT_SHARE, seed: int = 0,
          columns: Sequence[str] | None = None) -> DataFrame:
    """One trip per row of ``ids``, in the ``TRIPS`` schema, or only the ``columns`` asked for.

    With ``skew`` a share of the trips starts in the hot zone. About 4% of the rows are dirty:
    distance 0 and fare -1, with tip and duration left as they were. Narrow: one pass over the
    ids, no shuffle. What is asked for decides which columns, and so which random streams, are
    computed at all; a column has the same values whatever else is asked for.
    """
    uniforms = Uniforms(id_column, seed)
    needed = _closure(columns or S.TRIPS.names)
    streams = sorted({k for name in needed for k in _streams(name, skew)})
    drawn = _computed_once(uniforms.prepared(ids).select(
        F.col(id_column).cast("bigint").alias("trip_id"),
        *[uniforms.stream(k).alias(f"u{k}") for k in streams]))
    model = _model(lambda k: F.col(f"u{k}"), skew, hot_share)
    shaped = drawn.select("trip_id", *[model[n].alias(n) for n in needed if n in STREAMS])
    if any(n in DERIVED for n in needed):
        shaped = _computed_once(shaped)
    for name in needed:
        if name not in STREAMS and name != "trip_id":
            shaped = shaped.withColumn(name, model[name])
    return shaped.select(*(columns or S.TRIPS.names))


# The random streams that a drawn column takes, and the columns that a derived one is made from.
STREAMS = {
    "vendor_id": (11,), "pickup_zone_id": (0,), "dropoff_zone_id": (12,),
    "pickup_ts": (2, 3, 4, 5, 6), "passenger_count": (13,), "payment_type": (14,),
    "km": (4, 5), "kmh": (7,), "stop_s": (8, 9), "tip_rate": (10,), "dirty": (15,)}
DERIVED = {
    "duration_s": ("km", "kmh", "stop_s"), "fare": ("km", "duration_s"),
    "dropoff_ts": ("pickup_ts", "duration_s"), "trip_distance_km": ("dirty", "km"),
    "fare_amount": ("dirty", "fare"), "tip_amount": ("fare", "tip_rate")}
HOT_STREAM = 1


def _streams(name: str, skew: bool) -> tuple[int, ...]:
    hot = (HOT_STREAM,) if skew and name == "pickup_zone_id" else ()
    return STREAMS.get(name, ()) + hot


def _closure(columns: Sequence[str]) -> list[str]:
    """The columns and all that they are made from, what is needed first coming first."""
    order: list[str] = []

    def add(name: str) -> None:
        for source in DERIVED.get(name, ()):
            add(source)
        if name not in order:
            order.append(name)

    for name in columns:
        if name not in S.TRIPS.names:
            raise ValueError(f"trips have no column {name!r}")
        add(name)
    return order


def _model(u: Callable[[int], Column], skew: bool, hot_share: float) -> dict[str, Column]:
    """Every column of the model, over streams of uniforms or over the columns it is made from."""
    zone = uniform_int(u(0), 1, S.N_ZONES)
    if skew:
        zone = F.when(u(HOT_STREAM) < hot_share, F.lit(S.HOT_ZONE)).otherwise(zone)
    by_hour, by_distance = normal_pair(u(4), u(5))
    extra, _ = normal_pair(u(8), u(9))
    hump = F.when(u(3) < 0.5, F.lit(MORNING)).otherwise(F.lit(EVENING))
    hour = clip(hump + by_hour * HUMP_HOURS, 0.0, LAST_HOUR)
    day = F.floor(u(2) * DAYS)
    minutes = F.col("duration_s") / 60.0
    return {
        "vendor_id": uniform_int(u(11), 1, 3, "smallint"),
        "pickup_zone_id": zone,
        "dropoff_zone_id": uniform_int(u(12), 1, S.N_ZONES),
        "pickup_ts": F.floor(day * 86_400 + hour * 3600 + u(6) * 60) + FIRST_SECOND,
        "passenger_count": uniform_int(u(13), 1, 6, "smallint"),
        "payment_type": weighted_choice(u(14), S.PAYMENT_WEIGHTS),
        "km": cents(F.exp(LOG_KM_MEAN + LOG_KM_DEVIATION * by_distance)),
        "kmh": SLOWEST_KMH + KMH_RANGE * u(7),
        "stop_s": STOP_MEAN_S + STOP_DEVIATION_S * extra,
        "tip_rate": weighted_choice(u(10), S.TIP_WEIGHTS),
        "dirty": u(15) < DIRTY_SHARE,
        "duration_s": F.floor(clip(F.col("km") / F.col("kmh") * 3600 + F.col("stop_s"),
                                   SHORTEST_S, LONGEST_S)),
        "fare": cents(BASE_FARE + FARE_PER_KM * F.col("km") + FARE_PER_MINUTE * minutes),
        "dropoff_ts": F.col("pickup_ts") + F.col("duration_s"),
        "trip_distance_km": F.when(F.col("dirty"), F.lit(DIRTY_KM)).otherwise(F.col("km")),
        "fare_amount": F.when(F.col("dirty"), F.lit(DIRTY_FARE)).otherwise(F.col("fare")),
        "tip_amount": cents(F.col("fare") * F.col("tip_rate")),
    }


def _computed_once(df: DataFrame) -> DataFrame:
    """The same rows, but the optimizer copies none of their expressions further up.

    inline() of a one-element array keeps a row as it is. Filters and projections are not
    merged across it, so costly columns are not computed again for each of their uses.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def zones(ids: DataFrame, *, id_column: str = "id", seed: int = 0) -> DataFrame:
    """One zone per row of ``ids``: a weighted borough and a zero-padded name."""
    uniforms = Uniforms(id_column, seed)
    pick = uniforms.stream(16)
    return uniforms.prepared(ids).select(
        F.col(id_column).cast("int").alias("zone_id"),
        weighted_choice(pick, S.BOROUGH_WEIGHTS).alias("borough"),
        F.format_string("Zone %03d", F.col(id_column).cast("int")).alias("zone_name"),
    )


def zone_ids(spark: SparkSession) -> DataFrame:
    """The ids 1..265."""
    return spark.range(1, S.N_ZONES + 1, 1, 1)


def campaigns(ids: DataFrame, *, id_column: str = "id", keys: int | Column = S.N_ZONES,
              first_key: int = 1) -> DataFrame:
    """One campaign per row of ``ids``, dealt out to the keys in turn."""
    row = F.col(id_column)
    return ids.select(
        (row % keys + first_key).cast("int").alias("zone_id"),
        (row % 97 + 1).cast("double").alias("campaign_budget"),
    )


def campaign_ids(spark: SparkSession, per_zone: int = 40) -> DataFrame:
    """Ids for ``per_zone`` campaigns in each of the 265 zones."""
    return spark.range(S.N_ZONES * per_zone)


def write_data_set(spark: SparkSession, scale: str, trips_path: str, zones_path: str, *,
                   skew: bool = False, hot_share: float = S.HOT_SHARE, seed: int = 0,
                   mode: str = "errorifexists") -> None:
    """Write trips (one file per id partition, exactly the preset's rows) and zones."""
    write_parquet(zones(zone_ids(spark), seed=seed), zones_path, mode=mode)
    write_parquet(trips(trip_ids(spark, scale), skew=skew, hot_share=hot_share, seed=seed),
                  trips_path, mode=mode)

"""Message envelope, payload shapes and silver column contracts.

A feed ties one payload schema to one list of silver columns. Batch and streaming jobs read the same
feed object, so the two can not drift apart.
"""

from __future__ import annotations

from dataclasses import dataclass

# How a silver column is taken from the parsed payload.
#   field        a (nested) field
#   epoch        a (nested) field in epoch seconds, as a timestamp
#   first        a field of the first element of an array; the array's name comes first in the path
#   first_epoch  as first, in epoch seconds, as a timestamp
KINDS = ("field", "epoch", "first", "first_epoch")


@dataclass(frozen=True)
class SilverColumn:
    name: str
    kind: str
    path: str

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"column {self.name}: unknown kind {self.kind!r}, expected one of {KINDS}")
        steps = self.path.split(".")
        if not all(steps):
            raise ValueError(f"column {self.name}: empty step in path {self.path!r}")
        if self.kind.startswith("first") and len(steps) < 2:
            raise ValueError(f"column {self.name}: kind {self.kind} needs an array and a field, got {self.path!r}")


@dataclass(frozen=True)
class Feed:
    """One message feed: its name, its payload schema (DDL) and its silver columns."""

    name: str
    payload: str
    columns: tuple[SilverColumn, ...]

    def __post_init__(self) -> None:
        names = ["timestamp", *(c.name for c in self.columns)]
        repeated = sorted({n for n in names if names.count(n) > 1})
        if repeated:
            raise ValueError(f"feed {self.name}: repeated column names {repeated}")

    @classmethod
    def of(cls, name: str, payload: str, columns: list[tuple[str, str, str]]) -> Feed:
        return cls(name, payload, tuple(SilverColumn(*column) for column in columns))


# ---------------------------------------------------------------------------------------------
# Schemas and column contracts that the results have to equal.
# ---------------------------------------------------------------------------------------------

ENVELOPE = "topic STRING, timestamp TIMESTAMP, json_str STRING"

# Payload shape A
CONDITIONS_PAYLOAD = """
    coord STRUCT<lon: DOUBLE, lat: DOUBLE>,
    weather ARRAY<STRUCT<id: INT, main: STRING, description: STRING, icon: STRING>>,
    base STRING,
    main STRUCT<temp: DOUBLE, feels_like: DOUBLE, temp_min: DOUBLE, temp_max: DOUBLE,
                pressure: INT, humidity: INT, sea_level: INT, grnd_level: INT>,
    visibility INT,
    wind STRUCT<speed: DOUBLE, deg: INT, gust: DOUBLE>,
    rain STRUCT<`1h`: DOUBLE>,
    clouds STRUCT<`all`: INT>,
    dt BIGINT,
    sys STRUCT<country: STRING, sunrise: BIGINT, sunset: BIGINT>,
    timezone INT,
    id INT,
    name STRING,
    cod INT
"""

CONDITIONS_COLUMNS = [
    ("event_time", "epoch", "dt"),
    ("lat", "field", "coord.lat"),
    ("lon", "field", "coord.lon"),
    ("condition_id", "first", "weather.id"),
    ("condition_main", "first", "weather.main"),
    ("condition_description", "first", "weather.description"),
    ("condition_icon", "first", "weather.icon"),
    ("base", "field", "base"),
    ("temp", "field", "main.temp"),
    ("feels_like", "field", "main.feels_like"),
    ("temp_min", "field", "main.temp_min"),
    ("temp_max", "field", "main.temp_max"),
    ("pressure", "field", "main.pressure"),
    ("humidity", "field", "main.humidity"),
    ("sea_level_pressure", "field", "main.sea_level"),
    ("ground_level_pressure", "field", "main.grnd_level"),
    ("visibility", "field", "visibility"),
    ("wind_speed", "field", "wind.speed"),
    ("wind_deg", "field", "wind.deg"),
    ("wind_gust", "field", "wind.gust"),
    ("rain_1h", "field", "rain.1h"),
    ("cloudiness", "field", "clouds.all"),
    ("country", "field", "sys.country"),
    ("sunrise", "epoch", "sys.sunrise"),
    ("sunset", "epoch", "sys.sunset"),
    ("timezone_offset_sec", "field", "timezone"),
    ("city_id", "field", "id"),
    ("city_name", "field", "name"),
    ("response_code", "field", "cod"),
]

# Payload shape B
AIR_QUALITY_PAYLOAD = """
    coord STRUCT<lon: DOUBLE, lat: DOUBLE>,
    list ARRAY<STRUCT<
        dt: BIGINT,
        main: STRUCT<aqi: INT>,
        components: STRUCT<co: DOUBLE, no: DOUBLE, no2: DOUBLE, o3: DOUBLE,
                           so2: DOUBLE, pm2_5: DOUBLE, pm10: DOUBLE, nh3: DOUBLE>>>
"""

AIR_QUALITY_COLUMNS = [
    ("event_time", "first_epoch", "list.dt"),
    ("lat", "field", "coord.lat"),
    ("lon", "field", "coord.lon"),
    ("aqi", "first", "list.main.aqi"),
    ("co", "first", "list.components.co"),
    ("no", "first", "list.components.no"),
    ("no2", "first", "list.components.no2"),
    ("o3", "first", "list.components.o3"),
    ("so2", "first", "list.components.so2"),
    ("pm2_5", "first", "list.components.pm2_5"),
    ("pm10", "first", "list.components.pm10"),
    ("nh3", "first", "list.components.nh3"),
]

# Health: stages in the order the data flows, and the two age limits in seconds.
STAGES = ("producers", "kafka", "bronze", "silver")
POLL_INTERVAL_SECONDS = 900
ACTIVITY_WINDOW_SECONDS = 2 * POLL_INTERVAL_SECONDS
FRESHNESS_SECONDS = 1800
TRIGGER_INTERVAL = "5 minutes"

# ---------------------------------------------------------------------------------------------

CONDITIONS = Feed.of("conditions", CONDITIONS_PAYLOAD, CONDITIONS_COLUMNS)
AIR_QUALITY = Feed.of("air_quality", AIR_QUALITY_PAYLOAD, AIR_QUALITY_COLUMNS)

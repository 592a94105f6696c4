"""SQL over the original columns of ``events``. It never looks at the generated JSON."""

from __future__ import annotations

CUTOFF = "2024-01-16T00:00:00Z"
CUTOFF_SQL = "TIMESTAMP '2024-01-16 00:00:00'"

# Shape A
CONDITIONS = {
    "timestamp": "ts",
    "event_time": "date_trunc('second', ts)",
    "lat": "value",
    "lon": "-value",
    "condition_id": "CAST(200 + user_id % 10 AS INTEGER)",
    "condition_main": "event_type",
    "condition_description": "event_type || ' reading'",
    "condition_icon": "'01d'",
    "base": "'stations'",
    "temp": "value + 273.15e0",
    "feels_like": "value + 270e0",
    "temp_min": "value",
    "temp_max": "value * 2e0",
    "pressure": "CAST(1000 + user_id % 50 AS INTEGER)",
    "humidity": "CAST(event_id % 101 AS INTEGER)",
    "sea_level_pressure": "CAST(1000 + user_id % 50 AS INTEGER)",
    "ground_level_pressure": "CAST(990 + user_id % 50 AS INTEGER)",
    "visibility": "CAST(10000 AS INTEGER)",
    "wind_speed": "value / 10e0",
    "wind_deg": "CAST(event_id % 360 AS INTEGER)",
    "wind_gust": "value / 5e0",
    "rain_1h": "CASE WHEN event_type = 'error' THEN value END",
    "cloudiness": "CAST(user_id % 101 AS INTEGER)",
    "country": "'XX'",
    "sunrise": "date_trunc('second', ts) - INTERVAL 1 HOUR",
    "sunset": "date_trunc('second', ts) + INTERVAL 10 HOUR",
    "timezone_offset_sec": "CAST(3600 AS INTEGER)",
    "city_id": "CAST(user_id AS INTEGER)",
    "city_name": "'site-' || CAST(user_id AS VARCHAR)",
    "response_code": "CAST(200 AS INTEGER)",
}

# Shape B
AIR_QUALITY = {
    "timestamp": "ts",
    "event_time": "date_trunc('second', ts)",
    "lat": "value",
    "lon": "-value",
    "aqi": "CAST(user_id % 5 + 1 AS INTEGER)",
    "co": "value * 1e0",
    "no": "value * 2e0",
    "no2": "value * 3e0",
    "o3": "value * 4e0",
    "so2": "value * 5e0",
    "pm2_5": "value * 6e0",
    "pm10": "value * 7e0",
    "nh3": "value * 8e0",
}

ENVELOPE = {"topic": "event_type", "timestamp": "ts", "json_str": "props"}


def columns(shape: dict[str, str], names: list[str] | None = None, null_if: str | None = None) -> str:
    """Select list. With ``null_if`` all but the ingestion time are NULL where that condition holds."""
    parts = []
    for name in names or shape:
        expression = shape[name]
        if null_if and name != "timestamp":
            expression = f"CASE WHEN {null_if} THEN NULL ELSE {expression} END"
        parts.append(f'{expression} AS "{name}"')
    return ", ".join(parts)


def select(shape: dict[str, str], names: list[str] | None = None, where: str = "TRUE") -> str:
    return f"SELECT {columns(shape, names)} FROM events WHERE {where}"


def one_per(shape: dict[str, str], keys: list[str], names: list[str] | None = None, where: str = "TRUE") -> str:
    """One row per key, the first by all other columns in their order."""
    key_list = ", ".join(f'"{k}"' for k in keys)
    order = ", ".join(f'"{n}" NULLS FIRST' for n in shape if n not in keys)
    chosen = ", ".join(f'"{n}"' for n in names or shape)
    return (
        f"WITH rows AS ({select(shape, where=where)}), "
        f"ranked AS (SELECT *, row_number() OVER (PARTITION BY {key_list} ORDER BY {order}) AS rank_in_key FROM rows) "
        f"SELECT {chosen} FROM ranked WHERE rank_in_key = 1"
    )

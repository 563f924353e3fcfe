"""Column types of the inputs and results. Station ids are text: they have leading zeros."""

# Files read by header name: only the columns that are not text need a type.
POINT_TYPES = {"code": "int", "latitude": "double", "longitude": "double"}
PRICE_TYPES = {"price_eur_mwh": "double"}
CONSUMPTION_COLUMNS = [
    "TimeUTC",
    "TimeDK",
    "MunicipalityCode",
    "Municipality",
    "RegionName",
    "ConsumptionkWh",
]
CONSUMPTION_TYPES = {"MunicipalityCode": "int", "ConsumptionkWh": "double"}
SUNLIGHT_TYPES = {"latitude": "double", "longitude": "double", "sunshine_minutes": "double"}
WIND_TYPES = {"latitude": "double", "longitude": "double", "value": "double"}
PROFILE_TYPES = {
    "latitude": "double",
    "longitude": "double",
    "parameter_count": "int",
    "measures_sunshine": "boolean",
    "measures_radiation": "boolean",
    "sunshine_observations": "bigint",
    "radiation_observations": "bigint",
    "total_wind_observations": "bigint",
    "max_wind_speed_recorded_ms": "double",
    "min_wind_speed_recorded_ms": "double",
    "precipitation_observations": "bigint",
    "min_precipitation_mm": "double",
    "max_precipitation_mm": "double",
    "avg_precipitation_mm": "double",
    "total_precipitation_sample_mm": "double",
}

# Landed pages. A value is read as text, so that an unreadable one can be told from a missing one.
_GEOMETRY = "geometry: struct<coordinates: array<double>>"
OBSERVATION_PAGE = (
    f"features array<struct<{_GEOMETRY}, "
    "properties: struct<stationId: string, parameterId: string, `from`: string, value: string>>>, "
    "parameter string, offset bigint"
)
DETAIL_PAGE = (
    f"features array<struct<{_GEOMETRY}, properties: struct<stationId: string, name: string, "
    "country: string, status: string, validFrom: string, validTo: string>>>, offset bigint"
)
CONSUMPTION_RECORD = ", ".join(f"{c}: {CONSUMPTION_TYPES.get(c, 'string')}" for c in CONSUMPTION_COLUMNS)

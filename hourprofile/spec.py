"""Column specifications.

Every operator addresses fields by name; the names and their roles live here.
Two specs exist: the traffic-counter layout the library is built for, and the
layout of the test views derived from the driver tables (``plans.testviews``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

HOURS = tuple(range(24))


@dataclass(frozen=True)
class ObsSpec:
    """Wide observation table: one row per station x direction x lane x day."""

    key: tuple[str, ...]            # parts of the composite station id, in order
    categoricals: tuple[str, ...]   # encoded fields, in one-hot block order
    volumes: tuple[str, ...]        # 24 hour columns, hour 0 first
    date: str = "date"
    columns: tuple[str, ...] = ()   # full record layout (message and CSV schema)

    def __post_init__(self):
        if len(self.volumes) != 24:
            raise ValueError("an observation spec needs exactly 24 volume columns")

    def schema(self) -> T.StructType:
        """All-string schema of the raw record, as read from CSV or messages."""
        names = self.columns or (self.date, *self.key, *self.categoricals, *self.volumes)
        seen: list[str] = []
        for n in names:
            if n not in seen:
                seen.append(n)
        return T.StructType([T.StructField(n, T.StringType(), True) for n in seen])


@dataclass(frozen=True)
class StationSpec:
    """Station dimension: key parts plus the typed attributes the profile keeps.

    ``attributes`` maps output name -> (source column, Spark SQL type).
    """

    key: tuple[str, ...]
    latitude: str
    longitude: str
    attributes: dict = field(default_factory=dict)


# Output layout of the hourly profile (`traffic` table): fixed values.
PROFILE_KEYS = ("id", "location", "latitude", "longitude_w", "lanes", "type", "highway")
AVG_COLUMNS = tuple(f"avgvolume{h:02d}" for h in HOURS)
PROFILE_COLUMNS = PROFILE_KEYS + AVG_COLUMNS + ("longitude",)

# Output layout of the live result (`realtimetraffic` table), key `sid`: fixed values.
RESULT_SCHEMA = T.StructType([
    T.StructField("sid", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("direction", T.StringType()),
    T.StructField("lanes", T.IntegerType()),
    T.StructField("roadtype", T.StringType()),
    T.StructField("highway", T.StringType()),
    T.StructField("current", T.IntegerType()),
    T.StructField("historical", T.DoubleType()),
    T.StructField("predicted", T.DoubleType()),
    T.StructField("level", T.StringType()),
])
RESULT_COLUMNS = tuple(f.name for f in RESULT_SCHEMA.fields)


# ---------------------------------------------------------------------------
# Traffic-counter layout. The 38 record columns in record order,
# as the producer and the scorer define them.
_TRAFFIC_VOLUMES = tuple(
    f"traffic_volume_counted_after_{h:02d}00_to_{h + 1:02d}00" for h in HOURS
)
TRAFFIC_RECORD = (
    "date",
    "day_of_data",
    "day_of_week",
    "direction_of_travel",
    "direction_of_travel_name",
    "fips_state_code",
    "functional_classification",
    "functional_classification_name",
    "lane_of_travel",
    "month_of_data",
    "record_type",
    "restrictions",
    "station_id",
    *_TRAFFIC_VOLUMES,
    "year_of_data",
)

TRAFFIC_OBS = ObsSpec(
    key=("fips_state_code", "station_id", "direction_of_travel_name"),
    categoricals=(
        "day_of_data",
        "day_of_week",
        "direction_of_travel",
        "direction_of_travel_name",
        "fips_state_code",
        "functional_classification",
        "functional_classification_name",
        "lane_of_travel",
        "month_of_data",
        "record_type",
    ),
    volumes=_TRAFFIC_VOLUMES,
    columns=TRAFFIC_RECORD,
)

TRAFFIC_STATION = StationSpec(
    key=("fips_state_code", "station_id", "direction_of_travel_name"),
    latitude="latitude",
    longitude="longitude",
    attributes={
        "location": ("station_location", "string"),
        "latitude": ("latitude", "double"),
        "longitude_w": ("longitude", "double"),
        "lanes": ("lane_of_travel", "int"),
        "type": ("functional_classification_name", "string"),
        "highway": ("national_highway_system", "string"),
    },
)

# Result-row sources inside a traffic record (direction and road type come from
# the message, the rest from the profile).
TRAFFIC_RESULT_FIELDS = {"direction": "direction_of_travel_name",
                         "roadtype": "functional_classification_name"}


# ---------------------------------------------------------------------------
# Layout of the views built from the driver tables (see plans.testviews).
TEST_VOLUMES = tuple(f"v{h:02d}" for h in HOURS)
TEST_RECORD = (
    "date",
    "day_of_data",
    "day_of_week",
    "direction",
    "state",
    "segment",
    "month_of_data",
    "station_id",
    *TEST_VOLUMES,
)
TEST_OBS = ObsSpec(
    key=("state", "station_id", "direction"),
    categoricals=("day_of_data", "day_of_week", "direction", "state", "segment", "month_of_data"),
    volumes=TEST_VOLUMES,
    columns=TEST_RECORD,
)
TEST_STATION = StationSpec(
    key=("state", "station_id", "direction"),
    latitude="latitude",
    longitude="longitude",
    attributes={
        "location": ("location", "string"),
        "latitude": ("latitude", "double"),
        "longitude_w": ("longitude", "double"),
        "lanes": ("lane_of_travel", "int"),
        "type": ("type", "string"),
        "highway": ("highway", "string"),
    },
)
TEST_RESULT_FIELDS = {"direction": "direction", "roadtype": "segment"}

"""Table schemas of the landed data."""

from pyspark.sql import types as T

# The request feed's columns, in feed order.
REQUEST_TEXT_COLUMNS = [
    "unique_key",
    "created_date",
    "closed_date",
    "resolution_action_updated_date",
    "agency",
    "agency_name",
    "complaint_type",
    "descriptor",
    "location_type",
    "incident_zip",
    "incident_address",
    "street_name",
    "cross_street_1",
    "cross_street_2",
    "intersection_street_1",
    "intersection_street_2",
    "address_type",
    "city",
    "landmark",
    "facility_type",
    "status",
    "due_date",
    "resolution_description",
    "borough",
    "x_coordinate_state_plane",
    "y_coordinate_state_plane",
    "open_data_channel_type",
    "park_facility_name",
    "park_borough",
    "vehicle_type",
    "taxi_company_borough",
    "taxi_pick_up_location",
    "bridge_highway_name",
    "bridge_highway_direction",
    "road_ramp",
    "bridge_highway_segment",
]

# Census estimate codes and what they count.
DEMOGRAPHIC_MEASURES = {
    "b19013_001e": "median_household_income",
    "b01003_001e": "total_population",
    "b17001_002e": "population_below_poverty",
    "b03002_003e": "pop_white_non_hispanic",
    "b03002_012e": "pop_hispanic",
    "b03002_004e": "pop_black",
}

RAW_REQUESTS = T.StructType(
    [T.StructField(name, T.StringType()) for name in REQUEST_TEXT_COLUMNS]
    + [
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("tract_geoid", T.StringType()),
        T.StructField("ingestion_timestamp", T.TimestampNTZType()),
    ]
)

RAW_DEMOGRAPHICS = T.StructType(
    [T.StructField("geo_id", T.StringType())]
    + [T.StructField(code, T.DoubleType()) for code in DEMOGRAPHIC_MEASURES]
    + [T.StructField(name, T.StringType()) for name in ("state", "county", "tract", "county_fips")]
    + [T.StructField("vintage_year", T.IntegerType())]
)

# One ring is a closed list of points; a boundary holds all rings of all its parts.
RINGS = T.ArrayType(
    T.ArrayType(
        T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
    )
)

BOUNDARIES = T.StructType(
    [
        T.StructField("tract_geoid", T.StringType()),
        T.StructField("ord", T.IntegerType()),
        T.StructField("rings", RINGS),
    ]
)

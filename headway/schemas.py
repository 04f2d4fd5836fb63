"""Record schemas. Message schemas keep timestamps as text; table schemas are zone-free."""

from pyspark.sql import types as T

TYPES = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "short": T.ShortType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "array<int>": T.ArrayType(T.IntegerType()),
    "array<double>": T.ArrayType(T.DoubleType()),
    "array<string>": T.ArrayType(T.StringType()),
}


def schema(columns: str) -> T.StructType:
    """Schema of comma-separated ``name type`` pairs; unlike DDL text it needs no session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


TICKET_MESSAGE = schema(
    "ticket_id string, timestamp string, stop_id string, route string, passenger_type string, "
    "fare double, bus_id int, trip_id string, peak_hour int, hospital int, school int"
)
SENSOR_MESSAGE = schema(
    "measurement_id string, timestamp string, stop_id string, route string, status int, "
    "activation_type int, bus_id int, trip_id string, peak_hour int, hospital int, school int"
)
PREDICTION_MESSAGE = schema(
    "prediction_id long, timestamp string, stop_id string, route string, "
    "predicted_passengers_in int, predicted_passengers_out int, shape_id string, trip_id string, "
    "stop_sequence string, bus_id int, weekend int, peak_hour int, hospital int, school int, "
    "traffic string"
)
TRAFFIC_MESSAGE = schema(
    "measurement_id string, timestamp string, stop_id string, route string, bus_id int, "
    "trip_id string, traffic_level string, normal int, traffic int, shape_id string"
)
GPS_MESSAGE = schema(
    "measurement_id string, timestamp string, stop_id string, route string, bus_id int, "
    "trip_id string, shape_id string, sequence int, latitude double, longitude double"
)
WEATHER_MESSAGE = schema(
    "measurement_id string, timestamp string, latitude double, longitude double, "
    "weather_code array<int>, precipitation_probability array<double>, "
    "temperature array<double>, hour array<string>"
)
MODEL_MESSAGE = schema("model_key string, accuracy double, timestamp long")
# Reply of a travel-time service: rows[0].elements[0].duration.value and .duration_in_traffic.value
_ELEMENT = T.StructType(
    [
        T.StructField("duration", schema("value int")),
        T.StructField("duration_in_traffic", schema("value int")),
    ]
)
_ROW = T.StructType([T.StructField("elements", T.ArrayType(_ELEMENT))])
TRAVEL_TIME_REPLY = T.StructType([T.StructField("rows", T.ArrayType(_ROW))])

TICKETS = schema(
    "ticket_id string, timestamp timestamp_ntz, stop_id string, route string, "
    "passenger_type string, fare double, bus_id int, trip_id string, peak_hour int, "
    "hospital int, school int"
)
SENSORS = schema(
    "measurement_id string, timestamp timestamp_ntz, stop_id string, route string, status int, "
    "activation_type int, bus_id int, trip_id string, peak_hour int, hospital int, school int"
)
TRAFFIC = schema(
    "measurement_id string, timestamp timestamp_ntz, stop_id string, route string, bus_id int, "
    "trip_id string, traffic_level string, normal int, traffic int, shape_id string"
)
GPS = schema(
    "measurement_id string, timestamp timestamp_ntz, stop_id string, route string, bus_id int, "
    "trip_id string, shape_id string, sequence int, latitude double, longitude double"
)
WEATHER = schema(
    "measurement_id long, timestamp timestamp_ntz, latitude double, longitude double, "
    "weather_code int, precipitation_probability double, temperature double, hour timestamp_ntz"
)
TRIPS = schema(
    "route_id int, service_id string, trip_id string, trip_headsign string, "
    "direction_id boolean, shape_id string, wheelchair_accessible short"
)
ROUTES = schema(
    "route_id short, agency_id short, route_short_name string, route_long_name string, "
    "route_type short, route_color string, route_text_color string"
)
SHAPES = schema(
    "shape_id string, shape_pt_lat double, shape_pt_lon double, shape_pt_sequence short"
)
STOP_TIMES = schema(
    "trip_id string, arrival_time string, departure_time string, stop_id short, "
    "stop_sequence short"
)
STOPS = schema(
    "stop_id short, stop_code string, stop_name string, stop_desc string, stop_lat double, "
    "stop_lon double, zone_id string, wheelchair_boarding short"
)
BUS = schema("bus_id short, total_capacity int, seats short")
CITY_EVENTS = schema(
    "event_id int, event_name string, day_event date, start_time string, end_time string, "
    "location_event string, latitude double, longitude double"
)
FEATURES = schema(
    "trip_id_x string, timestamp_x timestamp_ntz, peak_hour short, sine_time double, "
    "temperature double, precipitation_probability double, weather_code short, "
    "traffic_level string, event_dummy short, congestion_rate double, school short, "
    "hospital short, weekend short"
)
PREDICTION_LOG = schema(
    "route_short_name string, timestamp string, peak_hour boolean, sine_time double, "
    "temperature double, precipitation_probability double, weather_code int, traffic_level int, "
    "event_dummy boolean, school boolean, hospital boolean, weekend boolean, prediction double, "
    "created_at timestamp"
)

# Dimension files: name -> (schema, separator).
DIMENSION_FILES = {
    "trips": (TRIPS, ","),
    "routes": (ROUTES, ","),
    "shapes": (SHAPES, ","),
    "stops": (STOPS, ","),
    "stop_times": (STOP_TIMES, ","),
    "bus": (BUS, ","),
    "events": (CITY_EVENTS, ";"),
}

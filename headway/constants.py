"""Names, limits and lookup entries that results depend on."""

# Traffic levels in rising order; the code of a level is its position.
TRAFFIC_LEVELS = ["no traffic/low", "medium", "heavy", "severe/standstill"]
# Delay in percent: up to 10 is low, up to 30 medium, below 100 heavy, otherwise severe.
LOW_DELAY_MAX = 10
MEDIUM_DELAY_MAX = 30
SEVERE_DELAY_MIN = 100
TRAFFIC_ALERT_LEVEL = 0.8

# Ticket price by passenger type.
FARES = {"adult": 2.50, "student": 1.25, "senior": 1.00}

# Door sensor: status of a working sensor, activation type of a person leaving.
SENSOR_ACTIVE = 1
SENSOR_ALIGHTING = 2

# Congestion rate divides by this number of places on every bus.
PLACES_PER_BUS = 400
CONGESTED_HOUR_MEAN = 1.0
DEFAULT_CONGESTION = 0.3

# Map colours (red, green, blue) and the congestion rate each starts at.
RED, YELLOW, GREEN = [255, 0, 0], [255, 255, 0], [0, 255, 0]
RED_FROM = 0.7
YELLOW_FROM = 0.4

# Forecast status and the mean congestion it starts at.
HIGH_FROM = 0.8
MODERATE_FROM = 0.3

# Geometry.
KM_PER_DEGREE = 111.32
BUS_SPEED_KMH = 30

# Weather refresh: first possible moment and smallest gap.
SAMPLING_START = "2025-01-01 00:00:00"
SAMPLING_GAP_SECONDS = 6 * 60 * 60

RECENT_MESSAGES = 100
MAX_OFFSETS_PER_TRIGGER = 10_000
POLL_RECORDS = 100
READ_PARTITIONS = 10

# Topic -> (archive collection, unique field).
TOPICS = {
    "sensors.topic": ("sensors", "measurement_id"),
    "ticketing.topic": ("tickets", "ticket_id"),
    "bus.passenger.predictions": ("passengers", "prediction_id"),
    "gps.topic": ("gps", "measurement_id"),
    "traffic.topic": ("traffic", "measurement_id"),
    "weather.topic": ("weather", "measurement_id"),
}
MODEL_TOPIC = "model.train.topic"

# Columns of the feature table, in order.
FEATURE_COLUMNS = [
    "trip_id_x",
    "timestamp_x",
    "peak_hour",
    "sine_time",
    "temperature",
    "precipitation_probability",
    "weather_code",
    "traffic_level",
    "event_dummy",
    "congestion_rate",
    "school",
    "hospital",
    "weekend",
]
FEATURE_KEY = ["trip_id_x", "timestamp_x"]
# Model inputs, in the order the model expects them.
MODEL_INPUTS = [
    "peak_hour",
    "sine_time",
    "temperature",
    "precipitation_probability",
    "weather_code",
    "traffic_level",
    "event_dummy",
    "school",
    "hospital",
    "weekend",
]
MODEL_FLAGS = ["peak_hour", "event_dummy", "school", "hospital", "weekend"]
MODEL_LABEL = "congestion_rate"

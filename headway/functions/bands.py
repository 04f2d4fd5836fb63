"""Bands and lookups."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway import constants as K


def delay_percent(normal: Column, traffic: Column) -> Column:
    """Delay against the normal travel time; NULL where that time is zero."""
    return F.try_divide((traffic - normal).cast("double"), normal.cast("double")) * 100


def traffic_level(delay: Column) -> Column:
    """Level name of a delay in percent; NULL for no delay value."""
    low, medium, heavy, severe = K.TRAFFIC_LEVELS
    return (
        F.when(delay <= K.LOW_DELAY_MAX, low)
        .when(delay <= K.MEDIUM_DELAY_MAX, medium)
        .when(delay < K.SEVERE_DELAY_MIN, heavy)
        .when(delay.isNotNull(), severe)
    )


def traffic_code(level: Column) -> Column:
    """Level name to 0..3; NULL for an unknown name."""
    codes = {name: code for code, name in enumerate(K.TRAFFIC_LEVELS)}
    return lookup(level, codes)


def lookup(key: Column, table: dict) -> Column:
    """Value of a literal table; NULL where the key is missing."""
    value = None
    for name, entry in table.items():
        value = (value if value is not None else F).when(key == name, F.lit(entry))
    return value


def congestion_color(rate: Column) -> Column:
    """[red, green, blue]; an unknown rate is green."""
    return (
        F.when(rate >= K.RED_FROM, _rgb(K.RED))
        .when(rate >= K.YELLOW_FROM, _rgb(K.YELLOW))
        .otherwise(_rgb(K.GREEN))
    )


def _rgb(parts: list[int]) -> Column:
    return F.array(*[F.lit(part) for part in parts])


def fare(passenger_type: Column) -> Column:
    """Price of a ticket."""
    return lookup(passenger_type, K.FARES)


def congestion_status(mean_rate: Column) -> Column:
    """Status of a mean forecast."""
    return (
        F.when(mean_rate >= K.HIGH_FROM, "High")
        .when(mean_rate >= K.MODERATE_FROM, "Moderate")
        .when(mean_rate.isNotNull(), "Low")
    )


def precipitation_fraction(percent: Column) -> Column:
    """Percent to fraction. Training data holds percent; see ``plans.model.forecast_grid``."""
    return percent / 100

"""Bus occupancy (Q1, Q2: A1-A4, J1, J2, F3)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.constants import SENSOR_ACTIVE

STOP_KEY = ["trip_id", "bus_id", "route", "stop_id", "timestamp"]


def boarding_counts(tickets: DataFrame) -> DataFrame:
    """A1: tickets per trip, bus, route, stop and time."""
    return tickets.groupBy(*STOP_KEY).agg(F.count("*").alias("passengers_on"))


def alighting_counts(sensors: DataFrame) -> DataFrame:
    """Readings of active sensors, by the same key."""
    active = sensors.filter(F.col("status") == SENSOR_ACTIVE)
    return active.groupBy(*STOP_KEY).agg(F.count("*").alias("passengers_off"))


def stop_balance(tickets: DataFrame, sensors: DataFrame) -> DataFrame:
    """Boardings with the alightings of the same key.

    The left join of the two counts is one aggregation over both tables: each row counts for one
    side, keys without a ticket go, and a key with a NULL part has no alightings, because NULLs do
    not join. That needs one shuffle of combined counts, and no sort.
    """
    active = sensors.filter(F.col("status") == SENSOR_ACTIVE)
    on = tickets.select(*STOP_KEY, F.lit(1).alias("on"), F.lit(0).alias("off"))
    off = active.dropna(subset=STOP_KEY).select(
        *STOP_KEY, F.lit(0).alias("on"), F.lit(1).alias("off")
    )
    return add_balances(on.union(off))


def add_balances(counts: DataFrame) -> DataFrame:
    """Sum up partial (on, off) counts by key; also used on stored partial counts."""
    return (
        counts.groupBy(*STOP_KEY)
        .agg(F.sum("on").alias("passengers_on"), F.sum("off").alias("passengers_off"))
        .filter("passengers_on > 0")
    )


def occupancy_of(balances: DataFrame) -> DataFrame:
    """A3: passengers per bus and trip; the sum is cut off at zero, not its parts."""
    aboard = F.sum(F.col("passengers_on") - F.col("passengers_off"))
    return balances.groupBy("bus_id", "trip_id").agg(
        F.max("timestamp").alias("latest_timestamp"),
        F.greatest(aboard, F.lit(0)).alias("total_occupancy"),
    )


def current_occupancy(tickets: DataFrame, sensors: DataFrame) -> DataFrame:
    """Q1: passengers aboard every bus and trip that sold a ticket."""
    return occupancy_of(stop_balance(tickets, sensors))


def bus_occupancy(occupancy: DataFrame, bus: DataFrame, skip_empty_capacity: bool = False):
    """Q2: occupancy in percent of the bus; unknown buses are dropped.

    A bus of zero capacity fails the query, unless ``skip_empty_capacity`` turns it into NULL.
    """
    share = F.try_divide if skip_empty_capacity else lambda a, b: a / b
    return occupancy.join(bus.select("bus_id", "total_capacity"), "bus_id").select(
        "bus_id",
        "trip_id",
        "latest_timestamp",
        "total_occupancy",
        "total_capacity",
        (share(F.col("total_occupancy").cast("double"), F.col("total_capacity")) * 100).alias(
            "occupancy_percentage"
        ),
    )

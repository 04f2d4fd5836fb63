"""Passenger counts to tickets and sensor readings (Q10: F9, D1, C8-C10)."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway import constants as K
from headway.functions.texts import composite_id, iso_text
from headway.operators.expand import repeat_rows
from headway.operators.keyed import first_per_key

_CARRIED = ["bus_id", "trip_id", "peak_hour", "hospital", "school"]


def first_predictions(predictions: DataFrame, order: Sequence[str]) -> DataFrame:
    """The first message of every prediction id; messages without one are dropped."""
    known = predictions.filter(F.col("prediction_id").isNotNull())
    return first_per_key(known, ["prediction_id"], order)


def _numbered(predictions: DataFrame, count: str, name: str) -> DataFrame:
    """A row per passenger with an id. All of the id but the position is put together
    once per prediction; neither part can be missing, so a passenger only costs the joining of two."""
    prefix = composite_id("stop_id", "route", iso_text(F.col("timestamp")), "prediction_id")
    dashed = predictions.withColumn("_prefix", F.concat(prefix, F.lit("-")))
    copies = repeat_rows(dashed, F.col(count), "position")
    return copies.withColumn(name, F.concat("_prefix", F.col("position").cast("string")))


def _in_turn(values: Sequence) -> Column:
    """The value whose turn it is at a position: a place in a constant array."""
    return F.array(*[F.lit(value) for value in values])[F.pmod(F.col("position"), F.lit(len(values)))]


def tickets_of(predictions: DataFrame) -> DataFrame:
    """One ticket per boarding passenger.

    Passenger types take turns. Ids hold the prediction id and the position in it, so they are
    unique and come out the same when a task runs again.
    """
    boarding = _numbered(predictions, "predicted_passengers_in", "ticket_id")
    return boarding.select(
        "ticket_id",
        "timestamp",
        "stop_id",
        "route",
        _in_turn(list(K.FARES)).alias("passenger_type"),
        _in_turn(list(K.FARES.values())).alias("fare"),
        *_CARRIED,
    )


def sensors_of(predictions: DataFrame) -> DataFrame:
    """One active reading per alighting passenger."""
    return _numbered(predictions, "predicted_passengers_out", "measurement_id").select(
        "measurement_id",
        "timestamp",
        "stop_id",
        "route",
        F.lit(K.SENSOR_ACTIVE).alias("status"),
        F.lit(K.SENSOR_ALIGHTING).alias("activation_type"),
        *_CARRIED,
    )


def expand_counts(predictions: DataFrame, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Q10: (tickets, sensors) of the first message of every prediction."""
    firsts = first_predictions(predictions, order)
    return tickets_of(firsts), sensors_of(firsts)

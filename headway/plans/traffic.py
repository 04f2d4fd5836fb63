"""Traffic measurements (Q12: C5, C16, D2)."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.bands import delay_percent, traffic_level
from headway.functions.texts import composite_id, iso_text
from headway.operators.expand import with_parsed
from headway.operators.keyed import first_per_key
from headway.schemas import TRAVEL_TIME_REPLY

_CARRIED = ["timestamp", "stop_id", "route", "bus_id", "trip_id"]


def read_replies(measurements: DataFrame, reply: str = "reply") -> DataFrame:
    """Normal and actual seconds out of the JSON reply of a travel-time service.

    Replies without either value are left out.
    """
    element = F.try_element_at(
        F.try_element_at(F.col("_reply.rows"), F.lit(1))["elements"], F.lit(1)
    )
    return (
        with_parsed(measurements, "_reply", F.from_json(reply, TRAVEL_TIME_REPLY))
        .withColumn("normal", element["duration"]["value"])
        .withColumn("traffic", element["duration_in_traffic"]["value"])
        .drop("_reply", reply)
        .dropna(subset=["normal", "traffic"])
    )


def classify_traffic(measurements: DataFrame) -> DataFrame:
    """Q12: level of every measurement; a normal time of zero gives no level and is left out."""
    delay = delay_percent(F.col("normal"), F.col("traffic"))
    return measurements.withColumn("traffic_level", traffic_level(delay)).filter(
        F.col("traffic_level").isNotNull()
    )


def stated_traffic(predictions: DataFrame, order: Sequence[str]) -> DataFrame:
    """Traffic rows without a service: the first message of every shape, the missing shape
    included, with the level the message states and no travel times."""
    firsts = first_per_key(predictions, ["shape_id"], order)
    return firsts.select(
        composite_id("stop_id", "route", iso_text(F.col("timestamp")), "prediction_id").alias("measurement_id"),
        *_CARRIED,
        F.col("traffic").alias("traffic_level"),
        F.lit(None).cast("int").alias("normal"),
        F.lit(None).cast("int").alias("traffic"),
        "shape_id",
    )

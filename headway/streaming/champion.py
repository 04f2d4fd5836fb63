"""Champion decisions on a stream of model messages."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.operators.champion import mark_champions
from headway.schemas import MODEL_MESSAGE, schema
from headway.sinks.tables import (
    BATCH,
    newest_version,
    read_parts,
    read_version,
    write_part,
    write_version,
)
from headway.sources.messages import split_messages
from headway.streaming.running import start

DECISIONS = schema(
    "partition int, offset long, model_key string, accuracy double, timestamp long, "
    f"promoted boolean, {BATCH} int"
)
BEST = schema("accuracy double")


def decide_champions(
    messages: DataFrame,
    table: str,
    best: str,
    rejects: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Promote a model that scores below the champion before it; record every decision.

    Without a champion the first model wins. No start value is stored for a missing champion, so a
    failure between two writes cannot lock out later models. ``best`` holds the best score after
    each batch, so a batch reads one row and no earlier decision. Undecodable messages are kept.
    """

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        runs, undecodable = split_messages(batch, MODEL_MESSAGE, keep=["partition", "offset"])
        last = newest_version(spark, best, batch_id)
        before = spark.createDataFrame([], BEST) if last is None else read_version(spark, best, batch_id)
        champion = before.filter(F.col("accuracy").isNotNull()).select(
            F.lit(-1).alias("partition"),
            F.lit(-1).cast("long").alias("offset"),
            F.lit(None).cast("string").alias("model_key"),
            "accuracy",
            F.lit(None).cast("long").alias("timestamp"),
        )
        field = champion.unionByName(runs).withColumn("model", F.lit("congestion"))
        decided = mark_champions(
            field,
            "model",
            "accuracy",
            ["partition", "offset"],
            F.col("partition"),
            F.col("offset"),
        )
        write_part(decided.filter("offset >= 0").drop("model"), table, batch_id)
        promoted = decided.filter("promoted or offset < 0")
        write_version(promoted.agg(F.min("accuracy").alias("accuracy")), best, batch_id)
        write_part(undecodable, rejects, batch_id)

    return start(messages, each_batch, checkpoint, every)


def current_champion(spark: SparkSession, table: str) -> DataFrame:
    """The champion as one row: the promoted model with the best score."""
    promoted = read_parts(spark, table, DECISIONS).filter("promoted")
    return promoted.agg(
        F.min_by("model_key", "accuracy").alias("model_key"), F.min("accuracy").alias("accuracy")
    ).filter(F.col("model_key").isNotNull())

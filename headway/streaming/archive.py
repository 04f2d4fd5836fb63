"""Document archive of all topics."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from headway.operators.merge import documents, latest_fields, message_fields
from headway.schemas import schema
from headway.sinks.logs import add_to_log, fold_log, fold_now, read_log
from headway.sources.messages import ARRIVAL, route_topics
from headway.streaming.running import start

ORDER = list(ARRIVAL)
FIELDS = StructType(
    [
        *schema("key string, field string, value string").fields,
        StructField("position", schema("sent_at timestamp, partition int, offset long")),
        *schema("collection string").fields,
    ]
)


def archive(
    messages: DataFrame,
    table: str,
    checkpoint: str,
    every: str | None = None,
    fold_every: int = 100,
) -> StreamingQuery:
    """Write the last value of every document field that a batch touches. Every ``fold_every``
    batches the parts before become a base."""

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        fields = message_fields(
            route_topics(batch), F.col("unique_field"), ORDER, keep=["collection"]
        )
        add_to_log(_latest(fields), table, batch_id, "collection")
        if fold_now(batch_id, fold_every):
            fold_archive(batch.sparkSession, table, batch_id - 1)

    return start(messages, each_batch, checkpoint, every)


def read_archive(
    spark: SparkSession, table: str, collection: str, key: str, names: Sequence[str]
) -> DataFrame:
    """Documents of a collection; only its folders are read."""
    fields = read_log(spark, table, FIELDS).filter(F.col("collection") == collection)
    return documents(latest_fields(fields), key, names)


def fold_archive(spark: SparkSession, table: str, upto: int) -> None:
    """Fold what the stream has written up to a finished batch."""
    fold_log(spark, table, FIELDS, _latest, upto, "collection")


def _latest(fields: DataFrame) -> DataFrame:
    return latest_fields(fields, ["collection"])

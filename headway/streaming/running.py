"""Starting and watching streaming queries."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def start(
    stream: DataFrame,
    each_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Start a query: every interval, or over what is there now and then stop."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def run_until_any_ends(spark: SparkSession) -> None:
    """Wait for the first query to end, whichever it is, then stop the others."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in spark.streams.active:
            query.stop()

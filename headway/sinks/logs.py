"""Logs: tables that streams add to batch by batch and that readers reduce.

A log has a part per batch. Folding reduces the parts up to a batch to a base, from which readers go
on, so that reading does not slow down with the age of the stream. Parts up to the base can then be
removed whenever storage calls for it.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from headway.schemas import TYPES
from headway.sinks.tables import (
    BATCH,
    VERSION,
    newest_version,
    read_parts,
    write_part,
    write_version,
)


def add_to_log(df: DataFrame, path: str, batch_id: int, *by: str) -> None:
    write_part(df, f"{path}/parts", batch_id, *by)


def read_log(
    spark: SparkSession, path: str, schema: StructType, before: int | None = None
) -> DataFrame:
    """Rows of the newest base and of the parts after it; with ``before``, of earlier batches only.
    Nothing else is opened, however old the log is."""
    base = newest_version(spark, f"{path}/base", before)
    parts = read_parts(spark, f"{path}/parts", _with(schema, BATCH), base, before)
    rows = parts.select(*schema.names)
    if base is None:
        return rows
    folded = spark.read.schema(schema).parquet(f"{path}/base/{VERSION}={base}")
    return folded.select(*schema.names).union(rows)


def read_batch(spark: SparkSession, path: str, schema: StructType, batch_id: int) -> DataFrame:
    """Rows of the part of one batch."""
    part = read_parts(spark, f"{path}/parts", _with(schema, BATCH), batch_id - 1, batch_id + 1)
    return part.select(*schema.names)


def fold_log(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fold: Callable[[DataFrame], DataFrame],
    upto: int,
    *by: str,
) -> None:
    """Make the rows up to a finished batch the new base. ``fold`` must be associative: reducing
    its result with later rows has to give what reducing all rows gives."""
    if newest_version(spark, f"{path}/base", upto + 1) == upto:
        return  # folded before, in an earlier try of the same batch
    rows = read_log(spark, path, schema, before=upto + 1)
    write_version(fold(rows).select(*schema.names), f"{path}/base", upto, *by)


def fold_now(batch_id: int, every: int) -> bool:
    """Whether a stream folds after this batch; it then folds the batches before it."""
    return batch_id > 0 and batch_id % every == 0


def _with(schema: StructType, partition: str) -> StructType:
    return StructType([*schema.fields, StructField(partition, TYPES["int"])])

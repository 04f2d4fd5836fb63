"""Table writes that can be repeated (K1, K4-K6, K8, K9).

Tables are folders of Parquet parts. A write that may be repeated, because a micro-batch or a task
was, names its part after the batch and overwrites that part, so a repeat changes nothing.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from headway.constants import FEATURE_KEY
from headway.operators.filters import within_range_of
from headway.operators.keyed import new_rows
from headway.operators.merge import insert_if_absent
from headway.schemas import PREDICTION_LOG

BATCH = "batch_id"
VERSION = "version"


def write_part(df: DataFrame, path: str, batch_id: int, *by: str) -> None:
    """K1: the part of one batch, within it a folder per value of ``by``. Repeating a batch
    replaces its part."""
    _dealt(df, by).write.mode("overwrite").partitionBy(*by).parquet(f"{path}/{BATCH}={batch_id}")


def _dealt(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of a folder together, so that not every task writes a file to every folder. Adaptive
    execution joins small folders to one task and deals a large one out to several."""
    return df.hint("rebalance", *by) if by else df


def numbered_folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the ``name=number`` folders below a path, in order; one listing of names."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    names = [status.getPath().getName() for status in system.listStatus(root)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{name}="))


def is_committed(spark: SparkSession, path: str) -> bool:
    """Whether a write of a folder has ended: its marker is written last."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def read_parts(
    spark: SparkSession,
    path: str,
    schema: StructType,
    after: int | None = None,
    before: int | None = None,
) -> DataFrame:
    """The parts of batches after and before the given ones, opened by name; an empty table while
    there are none. A part that is still being written is left out."""
    paths = [
        f"{path}/{BATCH}={n}"
        for n in numbered_folders(spark, path, BATCH)
        if (after is None or n > after) and (before is None or n < before)
    ]
    paths = [p for p in paths if is_committed(spark, p)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*paths)


def write_version(df: DataFrame, path: str, version: int, *by: str) -> None:
    """K4, K5: a whole new version next to the old ones. Its files appear when the write commits,
    so a failed write leaves the old version the newest."""
    _dealt(df, by).write.mode("overwrite").partitionBy(*by).parquet(f"{path}/{VERSION}={version}")


def newest_version(spark: SparkSession, path: str, before: int | None = None) -> int | None:
    """Number of the newest version whose write has ended, of those before ``before`` if given."""
    for n in reversed(numbered_folders(spark, path, VERSION)):
        if (before is None or n < before) and is_committed(spark, f"{path}/{VERSION}={n}"):
            return n
    return None


def read_version(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The newest finished version of a replaced table; no file of another version is opened."""
    return spark.read.parquet(f"{path}/{VERSION}={newest_version(spark, path, before)}")


def append_new_features(features: DataFrame, existing: DataFrame) -> DataFrame:
    """K6: the feature rows whose (trip, timestamp) the table does not hold yet. The key carries
    its time, so only rows of the table within the time span of the new ones are read."""
    within = within_range_of(existing, features, FEATURE_KEY[1])
    return new_rows(features, within, FEATURE_KEY)


def prediction_log(predictions: DataFrame) -> DataFrame:
    """K8: predictions with the types of the log and the time of writing."""
    typed = [
        F.col(f.name).cast(f.dataType).alias(f.name)
        for f in PREDICTION_LOG.fields
        if f.name != "created_at"
    ]
    return predictions.select(*typed, F.current_timestamp().alias("created_at"))


def to_messages(df: DataFrame, topic: str, columns: Sequence[str] | None = None) -> DataFrame:
    """K9: rows as JSON messages for a topic."""
    return df.select(F.lit(topic).alias("topic"), F.to_json(F.struct(*(columns or "*"))).alias("value"))


def send_messages(messages: DataFrame, servers: str) -> None:
    """K9: messages to a broker (the connector must be on the class path)."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def append_to_database(df: DataFrame, url: str, table: str, **properties: str) -> None:
    """K1: append to a database table, in as many connections as there are partitions."""
    df.write.format("jdbc").mode("append").options(url=url, dbtable=table, **properties).save()


def missing_rows(df: DataFrame, existing: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """K1, K2: the rows to append so that every key is in the table once, whatever its time.

    Only the key column of the table is read, and a repeated batch finds what an earlier try has
    already committed.
    """
    return insert_if_absent(df, existing, key, order)

"""An index of all keys ever seen, which a batch opens only where its own keys may be.

Keys lie in folders by the hash of the key, per batch and, after folding, in a base. Beside them, each
part has a Bloom filter: for every bucket some 64-bit words, in one of which a key sets a few bits. A
batch reads the filters, which are much smaller than the keys, and then only the buckets of those parts
that may hold one of its keys. No key is ever forgotten, and a filter that has filled up only means
that more buckets are opened.
"""

import tempfile
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators.keyed import first_per_key
from headway.schemas import schema
from headway.sinks.logs import add_to_log, fold_log
from headway.sinks.tables import BATCH, VERSION, is_committed, newest_version, numbered_folders

BUCKETS = 256
WORDS = 4096
BITS_PER_KEY = 5
KEYS = schema("key string, bucket int")
FILTERS = schema("bucket int, word int, bits long")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder that the driver and all executors share; on the machine itself for a local session."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{spark.sql('SELECT uuid()').first()[0]}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="headway-")


def _places(keys: DataFrame, key: str, buckets: int, words: int) -> DataFrame:
    """(key, bucket, word, bits): where a key is stored and what it sets in the filter there."""
    text = F.col(key).cast("string")
    second = F.xxhash64(F.lit("filter"), text)

    def bit(n: int) -> Column:
        place = F.shiftrightunsigned(second, 30 + 6 * n).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), place)

    return keys.select(
        text.alias("key"),
        F.pmod(F.xxhash64(text), F.lit(buckets)).cast("int").alias("bucket"),
        F.pmod(second, F.lit(words)).cast("int").alias("word"),
        reduce(Column.bitwiseOR, [bit(n) for n in range(BITS_PER_KEY)]).alias("bits"),
    )


def add_keys(
    keys: DataFrame, key: str, path: str, batch_id: int, buckets: int = BUCKETS, words: int = WORDS
) -> None:
    """Add the keys of a batch; repeating a batch replaces its part. The filter is written first, so
    that keys are never without one."""
    placed = _places(keys, key, buckets, words)
    filters = placed.groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
    add_to_log(filters, f"{path}/filters", batch_id)
    add_to_log(placed.select("key", "bucket").repartition("bucket"), f"{path}/keys", batch_id, "bucket")


def _sources(spark: SparkSession, path: str, before: int) -> list[str]:
    """The newest base and the parts after it, of earlier batches, by their names."""
    base = newest_version(spark, f"{path}/keys/base", before)
    names = [] if base is None else [f"base/{VERSION}={base}"]
    for n in numbered_folders(spark, f"{path}/keys/parts", BATCH):
        if (base is None or n > base) and n < before:
            names.append(f"parts/{BATCH}={n}")
    return [n for n in names if is_committed(spark, f"{path}/keys/{n}")]


def known_keys(
    keys: DataFrame, key: str, path: str, before: int, buckets: int = BUCKETS, words: int = WORDS
) -> DataFrame:
    """Those of the keys, as column ``key``, that a batch before the given one has added."""
    spark = keys.sparkSession
    sources = _sources(spark, path, before)
    if not sources:
        return spark.createDataFrame([], KEYS).select("key")
    filters = reduce(
        DataFrame.unionByName,
        [
            spark.read.schema(FILTERS).parquet(f"{path}/filters/{s}").withColumn("source", F.lit(s))
            for s in sources
        ],
    )
    asked = _places(keys, key, buckets, words).withColumnRenamed("bits", "asked")
    may_be = asked.join(filters, ["bucket", "word"]).filter(
        F.col("bits").bitwiseAND(F.col("asked")) == F.col("asked")
    )
    # At most a row per part and bucket, whatever the number of keys.
    hits = may_be.select("source", "bucket").distinct().collect()
    if not hits:
        return spark.createDataFrame([], KEYS).select("key")
    folders = [f"{path}/keys/{h.source}/bucket={h.bucket}" for h in hits]
    held = spark.read.schema(schema("key string")).parquet(*sorted(folders))
    return held.join(asked.select("key"), "key", "left_semi").distinct()


def first_ever(
    rows: DataFrame,
    key: str,
    order: list[str],
    path: str,
    batch_id: int,
    buckets: int = BUCKETS,
    words: int = WORDS,
) -> DataFrame:
    """The first row of every key that no earlier batch had; rows without the key are left out.

    The caller stores them and then adds their keys under the same batch. A batch that is repeated
    finds the same rows, as it does not look at its own keys.
    """
    firsts = first_per_key(rows.filter(F.col(key).isNotNull()), [key], order)
    known = known_keys(rows.select(key).filter(F.col(key).isNotNull()).distinct(), key, path, batch_id, buckets, words)
    named = known.select(F.col("key").alias("_known"))
    return firsts.join(named, F.col(key).cast("string") == F.col("_known"), "left_anti")


def fold_keys(spark: SparkSession, path: str, upto: int) -> None:
    """Make the parts up to a finished batch a new base; the filters first, as for a part."""
    fold_log(
        spark,
        f"{path}/filters",
        FILTERS,
        lambda df: df.groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits")),
        upto,
    )
    fold_log(spark, f"{path}/keys", KEYS, lambda df: df.repartition("bucket"), upto, "bucket")

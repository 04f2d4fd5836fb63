"""Helpers of the text operators: Spark functions over whole texts, and tables in the shared folder."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
import weakref
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.functions import arrow_udf

import headway

ARROW = {
    "boolean": pa.bool_(),
    "int": pa.int32(),
    "long": pa.int64(),
    "double": pa.float64(),
    "string": pa.string(),
    "array<int>": pa.list_(pa.int32()),
    "array<long>": pa.list_(pa.int64()),
    "array<string>": pa.list_(pa.string()),
}

ROWS = 500

_folders: dict[str, str] = {}
_shipped: set[str] = set()
_kept: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: `spark.checkpoint.dir`, or an own one in a local session."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _folders:
        _folders[app] = tempfile.mkdtemp(prefix="headway-")
    return _folders[app]


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for a session: the tasks' functions come from its modules.

    Spark serves the archive from the driver, so nothing need be installed on the executors. A package that is itself
    read from an archive was sent with the job.
    """
    context, root = spark.sparkContext, Path(headway.__file__).parent
    if context.applicationId in _shipped or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="headway-")) / "headway.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(root.rglob("*.py")):
            file.write(source, f"headway/{source.relative_to(root)}")
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """`df.mapInArrow`, with this package on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def keep(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder and read again: lineage ends here, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    _kept[kept] = path
    return kept


def discard(kept: DataFrame) -> None:
    """Removes what `keep` wrote for this very table, once nothing reads it any more."""
    path = kept.sparkSession._jvm.org.apache.hadoop.fs.Path(_kept.pop(kept))
    path.getFileSystem(kept.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a query go when it ends, not when the driver happens to collect its garbage.

    For jobs in steps that keep() what they need: a shuffle that is used once more would be made again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, old) if old is not None else spark.conf.unset(name)


def over_texts(start: Callable[[], Callable[[list], list]], **fields: str) -> Callable[[Column], Column]:
    """A Spark function from a text column to a struct of `fields` (name to type).

    `start()` runs once per task and gives a function from a list of texts (UTF-8 bytes, None for null) to one list per
    field. It counts as non-deterministic, so that Spark neither repeats nor reorders it.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        _used.clear()
        work = start()
        release_unused()
        for texts in batches:
            # A few texts at a time, so that neither texts nor results of a whole batch are held twice.
            for at in range(0, len(texts), ROWS):
                columns = work(texts.slice(at, ROWS).cast(pa.binary()).to_pylist())
                arrays = [pa.array(c, ARROW[k]) for c, k in zip(columns, fields.values(), strict=True)]
                yield pa.StructArray.from_arrays(arrays, list(fields))
            del texts
            give_back()

    ship(SparkSession.active())
    kind = "struct<" + ", ".join(f"{name}: {k}" for name, k in fields.items()) + ">"
    return arrow_udf(run, kind).asNondeterministic()


_held: dict[str, object] = {}
_used: set[str] = set()


def once(key: str, make: Callable):
    """`make()` of a key, kept in the worker process from task to task until a function without it runs there.

    Workers outlive queries, so what earlier operators have built must not pile up in them.
    """
    _used.add(key)
    if key not in _held:
        release_unused()
        _held[key] = make()
    return _held[key]


def release_unused() -> None:
    """Drops what functions before this one have kept."""
    for key in _held.keys() - _used:
        del _held[key]
    give_back()


def give_back() -> None:
    """Returns freed memory to the system, as workers share an executor's memory with others and live long."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


class Memo(dict):
    """Results of `of` by word, for words of up to 64 letters.

    Words come in two generations of at most `limit`: when the younger is full it becomes the older one, whose words are
    forgotten unless they have been asked for since. So frequent words stay, and memory is bounded.
    """

    def __init__(self, of: Callable, limit: int = 120_000):
        super().__init__()
        self.of, self.limit, self.older = of, limit, {}

    def __missing__(self, word):
        value = self.older[word] if word in self.older else self.of(word)
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[word] = value
        return value

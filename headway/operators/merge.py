"""Keyed merges (K2, K3)."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.operators.expand import with_parsed
from headway.operators.keyed import first_per_key


def insert_if_absent(
    incoming: DataFrame,
    existing: DataFrame,
    key: str,
    order: Sequence[str],
) -> DataFrame:
    """K2: rows to append. The first message of a key wins; known and NULL keys are left out. Of
    the table only the key column is read, but all of it: a key may come again at any time."""
    firsts = first_per_key(incoming.filter(F.col(key).isNotNull()), [key], order)
    return firsts.join(existing.select(key), key, "left_anti").select(*incoming.columns)


def json_fields(value: str) -> Column:
    """Fields of a JSON object as a map of JSON texts; of a name that is repeated the last counts."""
    read = F.from_json(value, "map<string,string>")
    entries = F.map_entries(read)
    names = F.array_distinct(F.map_keys(read))
    last = F.transform(
        names, lambda n: F.element_at(F.filter(entries, lambda e: e["key"] == n), -1)["value"]
    )
    repeated = F.size(names) < F.size(entries)
    return F.when(repeated, F.map_from_arrays(names, last)).otherwise(read)


def message_fields(
    messages: DataFrame, unique: Column, order: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """K3, first half: (key, field, value, position) for every field a JSON message carries.

    ``unique`` is the name of the field that identifies a document. An explicit null is a value; a
    field that a message does not carry yields no row. Messages without the unique field, or that
    are not JSON objects, are dropped. Values are JSON text.
    """
    parsed = with_parsed(messages, "_fields", json_fields("value"))
    return (
        parsed.select(
            *keep, "_fields", unique.alias("_unique"), F.struct(*order).alias("position")
        )
        .filter(F.map_contains_key(F.col("_fields"), F.col("_unique")))
        .select(
            *keep,
            F.col("_fields")[F.col("_unique")].alias("key"),
            "position",
            F.explode("_fields").alias("field", "value"),
        )
        .select(*keep, "key", "field", "value", "position")
    )


def latest_fields(fields: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """K3: the last value of every (key, field). Feeding results back in with newer rows is fine:
    the reduction is associative, and map tasks combine before the shuffle."""
    return fields.groupBy(*keep, "key", "field").agg(
        F.max_by("value", "position").alias("value"), F.max("position").alias("position")
    )


def documents(fields: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """Latest fields as one row per key with the named fields as columns."""
    named = [
        F.max(F.when(F.col("field") == name, F.col("value"))).alias(name)
        for name in names
        if name != key
    ]
    return fields.groupBy(F.col("key").alias(key)).agg(*named)


def upsert_latest(
    messages: DataFrame, key: str, order: Sequence[str], names: Sequence[str]
) -> DataFrame:
    """Q14: JSON messages to one row per key; later fields overwrite, absent fields stay.

    The same as the steps above, in one aggregation, for fields that are known beforehand: a
    message counts for a field only if it carries it.
    """
    fields, position = F.col("_fields"), F.struct(*order)
    parsed = with_parsed(messages, "_fields", json_fields("value"))
    latest = [
        F.max_by(fields[name], F.when(F.map_contains_key(fields, name), position)).alias(name)
        for name in names
        if name != key
    ]
    return (
        parsed.filter(F.map_contains_key(fields, key))
        .groupBy(fields[key].alias(key))
        .agg(*latest)
    )

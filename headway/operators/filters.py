"""Row and column filters."""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL = "All"
_AROUND_NAMES = " \t\r\n\"'"


def filter_choices(df: DataFrame, **choices: str | None) -> DataFrame:
    """keep rows equal to every choice; ``All`` or None does not filter."""
    for name, value in choices.items():
        if value is not None and value != ALL:
            df = df.filter(F.col(name) == value)
    return df


def has_text(names: Sequence[str]) -> Column:
    """every named field is there and not empty."""
    return reduce(and_, [F.col(n).isNotNull() & (F.col(n) != "") for n in names])


def split_required(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with all required fields, the other rows)."""
    complete = F.coalesce(has_text(names), F.lit(False))
    return df.filter(complete), df.filter(~complete)


def complete_columns(df: DataFrame) -> list[str]:
    """names of the columns without a single NULL or NaN; one aggregation over the table."""
    flags = df.agg(*[F.max(_missing(df, n).cast("int")).alias(n) for n in df.columns]).first()
    return [n for n in df.columns if not flags[n]]


def missing_counts(df: DataFrame) -> DataFrame:
    """NULL or NaN values per column, as one row."""
    return df.agg(*[F.count_if(_missing(df, n)).alias(n) for n in df.columns])


def _missing(df: DataFrame, name: str) -> Column:
    missing = F.col(name).isNull()
    return missing | F.isnan(name) if dict(df.dtypes)[name] in ("double", "float") else missing


def clean_names(df: DataFrame) -> DataFrame:
    """column names without surrounding blanks and quotes."""
    return df.toDF(*[name.strip(_AROUND_NAMES) for name in df.columns])


def any_row(df: DataFrame, condition: Column) -> DataFrame:
    """At most one row, present when the condition holds somewhere."""
    return df.filter(condition).limit(1).select(F.lit(True).alias("found"))


def within_range_of(df: DataFrame, other: DataFrame, name: str) -> DataFrame:
    """Rows whose value lies in the range of values of another table (or is missing).

    The ends of the range are subqueries that run before the scan, so that a table stored by the
    column opens the folders within the range only. A semi-join would prune only where Spark deems
    it worthwhile.
    """
    low = other.agg(F.min(name)).scalar()
    high = other.agg(F.max(name)).scalar()
    return df.filter(((F.col(name) >= low) & (F.col(name) <= high)) | F.col(name).isNull())

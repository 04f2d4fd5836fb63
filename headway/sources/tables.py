"""Table and file reads."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from headway import constants as K
from headway.schemas import DIMENSION_FILES

_TRUE = ["1", "t", "true", "y", "yes", "on"]
_FALSE = ["0", "f", "false", "n", "no", "off"]


def database_options(
    url: str, table: str, column: str, lower, upper, partitions: int = K.READ_PARTITIONS
) -> dict[str, str]:
    """Read a table in ranges of a column, one task per range."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_database_table(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower,
    upper,
    partitions: int = K.READ_PARTITIONS,
    **properties: str,
) -> DataFrame:
    """S5. Rows without a value in the range column come with the first range."""
    options = database_options(url, table, column, lower, upper, partitions) | properties
    return spark.read.format("jdbc").options(**options).load()


def read_positional_csv(
    spark: SparkSession, path: str, schema: StructType, separator: str = ","
) -> DataFrame:
    """CSV whose header line is skipped, not matched: columns go by position.

    Malformed rows fail the read. Booleans accept 1/0 as well as words.
    """
    as_text = StructType(
        [
            StructField(f.name, StringType() if f.dataType == BooleanType() else f.dataType)
            for f in schema.fields
        ]
    )
    rows = spark.read.schema(as_text).csv(
        path, header=True, sep=separator, quote='"', escape='"', mode="FAILFAST"
    )
    for field in schema.fields:
        if field.dataType == BooleanType():
            rows = rows.withColumn(field.name, _boolean(field.name))
    return rows


def _boolean(name: str) -> Column:
    text = F.lower(name)
    unreadable = F.raise_error(F.concat(F.lit(f"no boolean in {name}: "), text)).cast("boolean")
    return (
        F.when(text.isNull(), None)
        .when(text.isin(_TRUE), True)
        .when(text.isin(_FALSE), False)
        .otherwise(unreadable)
    )


def read_dimension(spark: SparkSession, name: str, path: str) -> DataFrame:
    """One of the dimension files by its table name."""
    schema, separator = DIMENSION_FILES[name]
    return read_positional_csv(spark, path, schema, separator)


def read_days(spark: SparkSession, path: str, first: str, last: str) -> DataFrame:
    """Rows of a fact table stored by ``day``; other days' files are not opened."""
    return spark.read.parquet(path).filter(F.col("day").between(F.lit(first), F.lit(last)))

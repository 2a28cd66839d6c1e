"""Small column operators: partition dates, renames, copies, drops, conforming, filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

# Which timestamp gives the partition date of each layer.
PARTITION_COLUMN = "partitionDate"
RAW_DATE_SOURCE = "lastUpdated"
CLEAN_DATE_SOURCE = "dateCreated"


def with_date(df: DataFrame, name: str, source: str) -> DataFrame:
    return df.withColumn(name, F.col(source).cast("date"))


def with_raw_partition(df: DataFrame) -> DataFrame:
    return with_date(df, PARTITION_COLUMN, RAW_DATE_SOURCE)


def with_clean_partition(df: DataFrame) -> DataFrame:
    return with_date(df, PARTITION_COLUMN, CLEAN_DATE_SOURCE)


def with_login_date(df: DataFrame) -> DataFrame:
    return with_date(df, "lastLoginDate", "lastLoginTimeStamp")


def copy_column(df: DataFrame, source: str = "address", target: str = "address1") -> DataFrame:
    return df.withColumn(target, F.col(source))


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop the named columns, by default the bulky ones; unknown names are ignored."""
    return df.drop(*(names or ("address", "extension")))


def only_patients(users: DataFrame) -> DataFrame:
    """Users that are patients; a null user type is not one."""
    return users.where(F.col("userType") == "PATIENT")


def with_value(df: DataFrame, column: str = "address") -> DataFrame:
    return df.where(F.col(column).isNotNull())


def _wrapped() -> StructType:
    return StructType([StructField("value", StringType())])


# The declared type of a patient's addresses.
ADDRESS_TYPE = ArrayType(
    StructType(
        [
            StructField("city", _wrapped()),
            StructField("country", _wrapped()),
            StructField("line", ArrayType(_wrapped())),
            StructField("postalCode", _wrapped()),
            StructField("state", _wrapped()),
            StructField("text", _wrapped()),
            StructField("useCode", _wrapped()),
        ]
    )
)


def conform(column: Column, actual: DataType, declared: DataType) -> Column:
    """Bring a nested value to a declared type, whatever fields it has so far.

    Fields follow the declared order; missing ones are null, undeclared ones are left
    out, leaves are cast. Null structs and arrays stay null.
    """
    if isinstance(declared, ArrayType) and isinstance(actual, ArrayType):
        return F.transform(
            column, lambda item: conform(item, actual.elementType, declared.elementType)
        )
    if isinstance(declared, StructType) and isinstance(actual, StructType):
        present = set(actual.names)
        fields = [
            (
                conform(column.getField(f.name), actual[f.name].dataType, f.dataType)
                if f.name in present
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in declared.fields
        ]
        return F.when(column.isNotNull(), F.struct(*fields))
    return column if actual == declared else column.cast(declared)


def conform_address(df: DataFrame, source: str = "address", target: str = "address") -> DataFrame:
    actual = df.schema[source].dataType
    return df.withColumn(target, conform(F.col(source), actual, ADDRESS_TYPE))


def latest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the greatest ``order`` of every key; rows without a key all stay.

    Of rows with equal ``order`` the greatest by a hash of the whole row is taken. The greatest
    row is found partly before the shuffle, so that a hot key needs no window.
    """
    row = F.struct(*(F.col(c) for c in df.columns))
    keyed = df.where(F.col(key).isNotNull())
    rank = F.struct(F.col(order), F.xxhash64(*df.columns))
    best = keyed.groupBy(F.col(key).alias("_key")).agg(F.max_by(row, rank).alias("_row"))
    return best.select("_row.*").union(df.where(F.col(key).isNull()))

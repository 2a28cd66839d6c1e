"""Contents of the relational marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierfold.operators.columns import with_login_date

# New names that keep the two sides of the join apart.
PRIMARY_NAMES = {"partitionDate": "updatedDate"}
SECONDARY_NAMES = {
    "mongoId": "userMongoId",
    "dateCreated": "userDateCreated",
    "lastUpdated": "userLastUpdated",
    "gender": "userGender",
    "partitionDate": "userPartitionDate",
}
ACTIVITY_KEYS = ("enabled", "lastLoginDate", "userGender", "userPartitionDate")


def rename_primary(clean: DataFrame) -> DataFrame:
    return clean.withColumnsRenamed(PRIMARY_NAMES)


def rename_secondary(clean: DataFrame) -> DataFrame:
    return clean.withColumnsRenamed(SECONDARY_NAMES)


def join_renamed(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """One row per matching pair, all columns of both renamed sides.

    No hint: Spark broadcasts a side only when its size is known to be under the
    threshold, and otherwise sorts and merges, where AQE splits a hot patient id over
    several tasks. Rows with a null key are filtered out before the shuffle.
    """
    return primary.join(secondary, primary["mongoId"] == secondary["patientId"], "inner")


def patient_user_join(patients: DataFrame, users: DataFrame) -> DataFrame:
    return join_renamed(rename_primary(patients), rename_secondary(users))


def activity_counts(secondary: DataFrame) -> DataFrame:
    """Users per enabled flag, login date, gender and partition date, from renamed users.

    Counted before and after the shuffle, so a hot group is one row per task.
    """
    return with_login_date(secondary).groupBy(*ACTIVITY_KEYS).count()


def user_activity_agg(users: DataFrame) -> DataFrame:
    return activity_counts(rename_secondary(users))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))

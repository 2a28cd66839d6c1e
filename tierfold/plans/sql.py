"""SQL over views and over paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def sql_over_view(df: DataFrame, query: str, view: str) -> DataFrame:
    """Run ``query`` with ``df`` visible under the name ``view``."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(query)


def sql_over_path(
    spark: SparkSession, path: str, columns: str = "*", table_format: str = "parquet"
) -> DataFrame:
    """Select columns directly from files, without registering a table."""
    return spark.sql(f"SELECT {columns} FROM {table_format}.`{path}`")

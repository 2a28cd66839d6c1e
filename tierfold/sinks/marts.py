"""Full-overwrite targets for mart tables."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from tierfold.config import LakeConfig
from tierfold.staging import delete_tree, recover_tree, replace_tree


class Mart(Protocol):
    def overwrite(self, df: DataFrame, table: str) -> int:
        """Replace ``table`` by the rows of ``df`` and return how many there are."""


class RowsMissing(RuntimeError):
    """The table does not hold as many rows as were sent."""


@dataclass(frozen=True)
class JdbcMart:
    """Tables of a relational database.

    The writer opens one connection per task, at most ``connections`` at a time. Each task
    is one transaction; a task repeated after its executor was lost just past the commit
    would leave its rows twice, so the table is counted afterwards (in the database) and
    the overwrite, which drops and recreates the table, is repeated on a difference. Rows are
    counted as they are written. ``properties`` of the user win over the defaults here.
    """

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    connections: int = 16
    batch_size: int = 10_000
    attempts: int = 2

    def overwrite(self, df: DataFrame, table: str) -> int:
        nested = [
            f.name for f in df.schema if isinstance(f.dataType, ArrayType | MapType | StructType)
        ]
        if nested:
            raise TypeError(f"{table}: nested columns cannot go to a database: {nested}")
        for _ in range(self.attempts):
            observed = Observation()
            counted = df.observe(observed, F.count(F.lit(1)).alias("rows"))
            counted.write.mode("overwrite").jdbc(
                self.url, table, properties=self.writer_options()
            )
            rows = observed.get["rows"]
            stored = self._stored_rows(df.sparkSession, table)
            if stored == rows:
                return rows
        raise RowsMissing(f"{table}: {rows} rows sent, {stored} stored")

    def writer_options(self) -> dict[str, str]:
        return {
            "numPartitions": str(self.connections),
            "batchsize": str(self.batch_size),
            **self.properties,
        }

    def _stored_rows(self, spark: SparkSession, table: str) -> int:
        counted = f"(SELECT COUNT(*) AS n FROM {table}) counted"
        return int(spark.read.jdbc(self.url, counted, properties=self.properties).first()[0])


@dataclass(frozen=True)
class FileMart:
    """Mart tables as folders of files, for engines that read them in place.

    A table is written beside its place and then takes it, the former one being kept until
    that is done. A failed write leaves the table as it was; what an interrupted change of
    place had moved away is brought back by the next one, or by ``recover``.
    """

    root: str
    table_format: str = "parquet"

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def overwrite(self, df: DataFrame, table: str) -> int:
        return self._replaced(df, table, even_if_empty=True)

    def overwrite_if_any(self, df: DataFrame, table: str) -> int:
        """Same, but no rows leave the table as it is; the rows are written once."""
        return self._replaced(df, table, even_if_empty=False)

    def recover(self, spark: SparkSession, table: str) -> bool:
        """Bring the table back if a change of place was interrupted; whether it was missing."""
        return recover_tree(spark, self.path(table))

    def _replaced(self, df: DataFrame, table: str, even_if_empty: bool) -> int:
        # the underscore keeps readers of the whole folder away from it
        spark, new = df.sparkSession, f"{self.root.rstrip('/')}/_new.{table}.{uuid.uuid4().hex}"
        observed = Observation()
        counted = df.observe(observed, F.count(F.lit(1)).alias("rows"))
        try:
            counted.write.format(self.table_format).save(new)
            rows = observed.get["rows"]
            if rows or even_if_empty:
                replace_tree(spark, new, self.path(table))
        finally:
            delete_tree(spark, new)
        return rows


def mart_from_config(config: LakeConfig) -> Mart:
    if config.jdbc_url is not None:
        return JdbcMart(config.jdbc_url, config.jdbc_properties, config.jdbc_connections)
    if config.mart_root is not None:
        return FileMart(config.mart_root)
    raise ValueError("neither a JDBC url nor a mart folder is configured")

"""Where the layers live and how they are stored."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession

CONF_PREFIX = "spark.tierfold."


@dataclass(frozen=True)
class LakeConfig:
    """Locations and formats of one lake.

    ``root`` and ``source_root`` take any Hadoop URI. ``source_format`` is ``json`` or
    ``parquet`` for document files under ``source_root/<collection>``, or a connector
    such as ``mongodb`` whose settings go into ``source_options``. ``write_partitions`` is
    the number of hash partitions in front of a write partitioned by date.
    """

    root: str
    table_format: str = "parquet"
    # The layer prefixes and the default retention in hours.
    raw_prefix: str = "raw."
    clean_prefix: str = "clean."
    retention_hours: float = 1.0
    retention_root: str | None = None
    write_partitions: int | None = None
    source_root: str | None = None
    source_format: str = "json"
    source_options: dict[str, str] = field(default_factory=dict)
    jdbc_url: str | None = None
    jdbc_properties: dict[str, str] = field(default_factory=dict)
    jdbc_connections: int = 16
    mart_root: str | None = None

    def raw_path(self, collection: str) -> str:
        return f"{self.root.rstrip('/')}/{self.raw_prefix}{collection}"

    def clean_path(self, collection: str) -> str:
        return f"{self.root.rstrip('/')}/{self.clean_prefix}{collection}"

    def quarantine_path(self, collection: str) -> str:
        """Where documents that could not be read go, with their text."""
        return f"{self.root.rstrip('/')}/quarantine.{collection}"

    @classmethod
    def from_session(cls, spark: SparkSession) -> LakeConfig:
        """Read ``spark.tierfold.*``, as given to spark-submit or a properties file.

        ``source.option.<name>`` and ``jdbc.property.<name>`` are passed through to the
        source reader and the JDBC writer.
        """
        conf = {
            key[len(CONF_PREFIX):]: value
            for key, value in spark.sparkContext.getConf().getAll()
            if key.startswith(CONF_PREFIX)
        }
        if "root" not in conf:
            raise ValueError(f"{CONF_PREFIX}root is not set")

        def below(prefix: str) -> dict[str, str]:
            return {k[len(prefix):]: v for k, v in conf.items() if k.startswith(prefix)}

        return cls(
            root=conf["root"],
            table_format=conf.get("tableFormat", cls.table_format),
            raw_prefix=conf.get("rawPrefix", cls.raw_prefix),
            clean_prefix=conf.get("cleanPrefix", cls.clean_prefix),
            retention_hours=float(conf.get("retentionHours", cls.retention_hours)),
            write_partitions=int(conf["writePartitions"]) if "writePartitions" in conf else None,
            retention_root=conf.get("retentionRoot"),
            source_root=conf.get("source.root"),
            source_format=conf.get("source.format", cls.source_format),
            source_options=below("source.option."),
            jdbc_url=conf.get("jdbc.url"),
            jdbc_properties=below("jdbc.property."),
            jdbc_connections=int(conf.get("jdbc.connections", cls.jdbc_connections)),
            mart_root=conf.get("mart.root"),
        )

"""Relational table sink (JDBC).

No database is reachable here, so only the option builder is exercised by tests. Options are
validated before any expensive work (the reference failed at the sink after the whole job, on
missing credentials). Writes go out in parallel (``numPartitions`` connections, each batching
``batchsize`` rows); ``truncate`` keeps the table definition on overwrite instead of dropping it.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.fixed import SILVER_TABLE_NAMES
from tripspark.schema import SILVER_SINK_TYPES, SPLIT_COL, is_numeric


class SinkConfigError(ValueError):
    pass


@dataclass(frozen=True)
class JdbcSink:
    url: str
    table: str
    user: str
    password: str
    driver: str = "org.postgresql.Driver"
    batchsize: int = 10000
    num_partitions: int = 16
    truncate: bool = True

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": self.table,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "batchsize": str(self.batchsize),
            "numPartitions": str(self.num_partitions),
            "truncate": "true" if self.truncate else "false",
        }


def jdbc_sink(
    url: str | None,
    table: str | None,
    user: str | None,
    password: str | None,
    driver: str = "org.postgresql.Driver",
    batchsize: int = 10000,
    num_partitions: int = 16,
    truncate: bool = True,
) -> JdbcSink:
    missing = [n for n, v in (("url", url), ("table", table), ("user", user), ("password", password)) if not v]
    if missing:
        raise SinkConfigError(f"JDBC sink is missing {missing}")
    if not str(url).startswith("jdbc:"):
        raise SinkConfigError(f"JDBC url must start with 'jdbc:': {url!r}")
    if batchsize <= 0 or num_partitions <= 0:
        raise SinkConfigError("batchsize and num_partitions must be positive")
    return JdbcSink(str(url), str(table), str(user), str(password), driver, batchsize, num_partitions, truncate)


def jdbc_sink_from_env(table: str, prefix: str = "TRIPSPARK_DB_") -> JdbcSink:
    """Read URL/USER/PASSWORD from the environment (e.g. TRIPSPARK_DB_URL)."""
    env = os.environ
    return jdbc_sink(env.get(prefix + "URL"), table, env.get(prefix + "USER"), env.get(prefix + "PASSWORD"))


def relational_view(df: DataFrame, types: dict | None = None) -> DataFrame:
    """Cast columns to the relational declaration of the table (smallint codes, decimal(6,2)
    distance, decimal(10,2) money and duration). A value that does not fit raises (ANSI cast) instead of
    being silently nulled, so a bad batch never reaches the table."""
    declared = types or SILVER_SINK_TYPES
    have = {f.name: f.dataType for f in df.schema.fields}

    def applies(c: str) -> bool:  # numeric -> numeric only; e.g. a text payment_type stays text
        return c in declared and is_numeric(have[c]) and is_numeric(declared[c])

    return df.select(*[F.col(c).cast(declared[c]).alias(c) if applies(c) else F.col(c) for c in df.columns])


def sink_frame(df: DataFrame, declared_types: bool = False, table_names: bool = False) -> DataFrame:
    """The frame a relational sink gets: Spark's own types unless ``declared_types``, which rounds to the declared
    scales; our names unless ``table_names`` asks for those of the table. The split bucket stays out."""
    out = df.drop(SPLIT_COL)
    out = relational_view(out) if declared_types else out
    return out.withColumnsRenamed(SILVER_TABLE_NAMES) if table_names else out


def write_jdbc(df: DataFrame, sink: JdbcSink, mode: str = "overwrite", declared_types: bool = False, table_names: bool = False) -> None:
    out = sink_frame(df, declared_types, table_names)
    out.write.format("jdbc").options(**sink.options()).mode(mode).save()


def read_jdbc(spark: SparkSession, sink: JdbcSink, partition_column: str, lower: int, upper: int) -> DataFrame:
    """S6 over JDBC: a partitioned read (numPartitions parallel range queries)."""
    return (
        spark.read.format("jdbc")
        .options(**{k: v for k, v in sink.options().items() if k not in ("batchsize", "truncate")})
        .option("partitionColumn", partition_column)
        .option("lowerBound", str(lower))
        .option("upperBound", str(upper))
        .load()
    )

"""Other readers: LIBSVM files and JDBC tables (option builders only)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """LIBSVM text as ``(label double, features vector)``.  Giving
    ``num_features`` skips the extra pass that finds the vector size."""
    reader = spark.read.format("libsvm")
    if num_features is not None:
        reader = reader.option("numFeatures", str(num_features))
    return reader.load(path)


@dataclass(frozen=True)
class JdbcOptions:
    """Reader options for a JDBC table.

    ``partition_column`` with bounds and ``num_partitions`` makes Spark issue
    that many range queries in parallel instead of one query through one
    task; ``fetch_size`` sets rows per round trip.
    """

    url: str
    table: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    partition_column: str | None = None
    lower_bound: int | None = None
    upper_bound: int | None = None
    num_partitions: int | None = None
    fetch_size: int | None = None
    extra: dict[str, str] = field(default_factory=dict)

    def to_options(self) -> dict[str, str]:
        opts = {"url": self.url, "dbtable": self.table}
        for key, value in (
            ("user", self.user),
            ("password", self.password),
            ("driver", self.driver),
            ("fetchsize", self.fetch_size),
        ):
            if value is not None:
                opts[key] = str(value)
        if self.partition_column is not None:
            if None in (self.lower_bound, self.upper_bound, self.num_partitions):
                raise ValueError("a partition column needs lower_bound, upper_bound and num_partitions")
            opts.update(
                partitionColumn=self.partition_column,
                lowerBound=str(self.lower_bound),
                upperBound=str(self.upper_bound),
                numPartitions=str(self.num_partitions),
            )
        opts.update(self.extra)
        return opts


def read_jdbc(spark: SparkSession, options: JdbcOptions) -> DataFrame:
    return spark.read.format("jdbc").options(**options.to_options()).load()

"""Database tables (S2, S3) through Spark's JDBC source.

No database runs here: these build reader/writer options, and the tests check
the options, not a connection.  Credentials come from the caller, never from
code.  A partitioned read splits the table on a numeric column into
``num_partitions`` range queries so no single task reads the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def quoted_table(schema: str, table: str) -> str:
    """``"schema"."table"`` with case preserved, as the original queries it."""
    def q(x: str) -> str:
        return '"' + x.replace('"', '""') + '"'
    return f"{q(schema)}.{q(table)}"


def reader_options(url: str, schema: str, table: str, user: str | None = None, password: str | None = None,
                   partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
                   num_partitions: int | None = None, fetch_size: int = 10_000,
                   driver: str | None = None) -> dict[str, str]:
    opts = {"url": url, "dbtable": quoted_table(schema, table), "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    if partition_column:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("a partitioned read needs lower, upper and num_partitions")
        opts.update({"partitionColumn": partition_column, "lowerBound": str(lower),
                     "upperBound": str(upper), "numPartitions": str(num_partitions)})
    return opts


def load_table(spark: SparkSession, **kw) -> DataFrame:
    """``SELECT *`` of ``"schema"."table"`` as a (partitioned) DataFrame."""
    return spark.read.format("jdbc").options(**reader_options(**kw)).load()


_MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}


def writer_options(url: str, schema: str, table: str, if_exists: str = "replace", batch_size: int = 1000,
                   user: str | None = None, password: str | None = None,
                   driver: str | None = None) -> tuple[str, dict[str, str]]:
    """S3: save mode for the policy and the JDBC batch size (chunk size)."""
    if if_exists not in _MODES:
        raise ValueError(f"if_exists must be one of {sorted(_MODES)}")
    opts = {"url": url, "dbtable": quoted_table(schema, table), "batchsize": str(batch_size)}
    if if_exists == "replace":
        opts["truncate"] = "false"
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    return _MODES[if_exists], opts


def load_csv_to_table(spark: SparkSession, csv_path: str, schema=None, num_partitions: int | None = None,
                      **kw) -> None:
    """S3: CSV -> database table; each partition writes its rows in batches
    (the policy applies once to the whole table, as the first chunk's does)."""
    from .files import read_csv
    df = read_csv(spark, csv_path, schema)
    if num_partitions:
        df = df.repartition(num_partitions)
    mode, opts = writer_options(**kw)
    df.write.format("jdbc").mode(mode).options(**opts).save()

"""File sources and sinks.

Reads take an explicit schema when one is known (type inference is a second
pass over the data); writes go through the DataFrame writer so Spark writes
one file per partition in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


# Quotes are doubled inside quoted cells, as spreadsheets, pandas and most
# databases write them; blanks around a value belong to it.
_DIALECT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
# what an empty quoted cell reads as, until it becomes an empty text
_EMPTY_CELL = "\u0000empty\u0000"
BAD_ROW = "_bad_row"


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, header: bool = True,
             multi_line: bool = True, bad_rows: str = "fail", **options) -> DataFrame:
    """CSV with a header; ``schema`` given -> no inference pass.

    Quoted cells may hold commas, doubled quotes and line breaks.  An empty
    cell is NULL, an empty quoted one an empty text.  A file with line breaks
    in cells cannot be split, so one task reads it (where rows end in CR LF,
    line breaks in cells come back as LF); ``multi_line=False`` splits
    files known to have none.  A row that does not fit the schema raises;
    ``bad_rows="keep"`` gives its text in a column ``_bad_row`` instead and
    NULL in the cells that do not fit.
    """
    if bad_rows not in ("fail", "keep"):
        raise ValueError("bad_rows must be 'fail' or 'keep'")
    r = spark.read.option("header", header).option("multiLine", multi_line).option("emptyValue", _EMPTY_CELL)
    for k, v in _DIALECT.items():
        r = r.option(k, v)
    if schema is not None:
        schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        if bad_rows == "keep":
            schema = StructType([*schema.fields, StructField(BAD_ROW, StringType())])
            r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_ROW)
        else:
            r = r.option("mode", "FAILFAST")
        r = r.schema(schema).option("enforceSchema", not header or bad_rows == "keep")
    else:
        r = r.option("inferSchema", True)
    for k, v in options.items():
        r = r.option(k, v)
    df = r.csv(path)
    empty = options.get("emptyValue", _EMPTY_CELL)
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)} if empty == _EMPTY_CELL else set()
    cell = {c: F.col("`" + c.replace("`", "``") + "`") for c in df.columns}
    return df.select(*[F.when(cell[c] == _EMPTY_CELL, F.lit("")).otherwise(cell[c]).alias(c) if c in texts else cell[c] for c in df.columns])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, **options) -> None:
    """Staging copy, per-stage dump, final feature table."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)


def write_scored_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Scored rows as CSV with a header, in the dialect of ``read_csv``:
    NULL as an empty cell, an empty text as an empty quoted one."""
    w = df.write.mode(mode).option("header", True).option("emptyValue", '""')
    for k, v in _DIALECT.items():
        w = w.option(k, v)
    w.csv(path)


def stage_dump(df: DataFrame, root: str, stage: str, enabled: bool = False, overwrite: bool = False) -> DataFrame:
    """Optional per-stage Parquet dump; off by default so plans stay fused.
    When on, the stage is written once and read back (cutting the lineage); a
    dump that is there already raises unless ``overwrite``."""
    if not enabled:
        return df
    path = f"{root.rstrip('/')}/{stage}"
    df.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


_POLICY = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}


def load_csv_to_catalog(spark: SparkSession, csv_path: str, table_name: str, if_exists: str = "replace",
                        schema: StructType | str | None = None, path: str | None = None) -> None:
    """S3 without a database: CSV -> catalog table with the same if-exists
    policy (``replace`` / ``append`` / ``fail``); partitions write in parallel
    where the original wrote 1000-row chunks.  ``path`` makes it an external
    table in a chosen (shared) folder."""
    if if_exists not in _POLICY:
        raise ValueError(f"if_exists must be one of {sorted(_POLICY)}")
    w = read_csv(spark, csv_path, schema).write.mode(_POLICY[if_exists]).format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(table_name)

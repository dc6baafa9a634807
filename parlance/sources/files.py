"""CSV and JSON in the dialect the conversation tables are exchanged in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Doubled quotes escape a quote, records may span lines, blanks are kept as they are.
_DIALECT = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_parquet(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Read a table, in as many splits as its files offer or dealt out over ``partitions``.

    A row group is the smallest unit of a scan, so one small file keeps all other cores idle.
    """
    df = spark.read.parquet(path)
    return df if partitions is None else df.repartition(partitions)


def read_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """Read with an explicit schema, so the files are scanned once.

    Files are split. With ``multi_line`` a cell may hold line breaks, and one file is then one
    task: write many files (see ``write_csv``) rather than a single large one.
    """
    return spark.read.schema(schema).options(**_DIALECT, multiLine=str(multi_line).lower()).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write one file per partition with a header and no index; '' and NULL both become empty."""
    df.write.mode(mode).options(**_DIALECT, emptyValue="").csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a report back in its own schema."""
    return spark.read.schema(schema).json(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a (small, nested) report as JSON lines, keeping fields that are NULL."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)

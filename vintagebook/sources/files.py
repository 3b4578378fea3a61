"""Landing CSV scans, bronze ingestion and path-addressed table reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Landing CSV options (header, quoted multi-line fields, lenient rows).
CSV_OPTIONS: dict[str, str] = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "mode": "PERMISSIVE",
}


def string_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def scan_csv_strings(spark: SparkSession, path: str, columns: Sequence[str],
                     options: dict[str, str] | None = None) -> DataFrame:
    """CSV scan with an explicit all-STRING schema (no inference pass over the data).

    Multi-line CSV cannot be split inside a file, so parallelism comes from
    the number of landing files; one file per day/partition is the norm.
    """
    opts = {**CSV_OPTIONS, **(options or {})}
    return spark.read.schema(string_schema(columns)).options(**opts).csv(path)


def ingest_bronze(df: DataFrame, columns: Sequence[str], datproc=None) -> DataFrame:
    """Project the listed columns (as text) and stamp the processing time."""
    stamp = F.current_timestamp() if datproc is None else F.lit(datproc).cast("timestamp")
    return df.select(*[F.col(c).cast("string").alias(c) for c in columns], stamp.alias("datproc"))


def write_csv(df: DataFrame, path: str) -> None:
    """Landing-style CSV (header, quoted) for round-trip tests."""
    df.write.mode("overwrite").options(header="true", quote='"', escape='"').csv(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Path-addressed table scan (parquet by default, delta when its jar is present)."""
    return spark.read.format(fmt).load(path)


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Idempotent database creation (``CREATE SCHEMA IF NOT EXISTS ... LOCATION``)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{loc}")

"""File sources and sinks: CSV and JSON, typed, inferred or all text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    sep: str = ",",
    glob: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """CSV with a header line.

    ``schema=None`` infers the types (one extra pass over the files), ``"string"``
    leaves every column text, anything else is taken as the schema.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if schema is None:
        reader = reader.option("inferSchema", True)
    elif schema != "string":
        reader = reader.schema(schema)
    return reader.csv(path)


def infer_schema(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False) -> StructType:
    """The inferred schema alone, to be handed to a stream over the same folder."""
    return read_csv(spark, path, glob=glob, recursive=recursive).schema


def load_all(
    spark: SparkSession, files: Mapping[str, str], prefix: str = "", schema: StructType | str | None = "string"
) -> dict[str, DataFrame]:
    """Read each file and register it as a temporary view named prefix + name."""
    frames = {}
    for name, path in files.items():
        frames[name] = read_csv(spark, path, schema)
        frames[name].createOrReplaceTempView(prefix + name)
    return frames


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file per partition, each with a header."""
    df.write.mode("error").option("header", True).csv(path)

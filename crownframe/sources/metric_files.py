"""Metric tables to and from CSV; list columns travel as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_metrics(df: DataFrame, path: str) -> None:
    out = df.select(*[
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
        for f in df.schema.fields])
    out.write.mode("errorifexists").option("header", True).csv(path)


def read_metrics(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table as it was written; `schema` names the list columns' element types."""
    flat = T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.ArrayType) else f.dataType)
        for f in schema.fields])
    rows = spark.read.schema(flat).option("header", True).csv(path)
    return rows.select(*[
        F.from_json(f.name, f.dataType).alias(f.name) if isinstance(f.dataType, T.ArrayType)
        else F.col(f.name) for f in schema.fields])

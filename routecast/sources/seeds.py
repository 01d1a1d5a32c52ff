"""CSV seeds into the RAW layer (S1) and typed raw readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from routecast.sources.schemas import RAW_SCHEMAS


def load_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a header CSV with an explicit schema; malformed rows fail the job."""
    return (
        spark.read.option("header", True)
        .option("mode", "FAILFAST")
        .option("inferSchema", False)
        .schema(schema)
        .csv(path)
    )


def read_raw(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Read one named raw relation, CSV with its declared schema or parquet."""
    schema = RAW_SCHEMAS[name]
    if fmt == "csv":
        return load_seed(spark, path, schema)
    df = spark.read.format(fmt).load(path)
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])

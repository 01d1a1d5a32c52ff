"""Layer writers.

Staging and intermediate relations are lazy DataFrames (views). Marts are
materialised: a full rebuild written as parquet, facts in one directory per
month and sorted by ``date_key`` inside each file, so a date range opens only
its months and skips row groups inside them.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Parquet codec of the written tables.
CODEC = "zstd"
#: A directory of a partitioned table with more files than this is compacted, to files of about so many bytes.
MOST_FILES, FILE_BYTES = 16, 32 << 20


def schema_name(custom: str | None, default: str) -> str:
    """A configured layer (schema) name is used verbatim; without one
    the default schema is used."""
    return custom.strip() if custom and custom.strip() else default


def layer_path(root: str, layer: str | None, name: str, default_layer: str = "default") -> str:
    """Location of ``name`` in a layer under ``root`` (the shared folder)."""
    return f"{root.rstrip('/')}/{schema_name(layer, default_layer)}/{name}"


def write_table(
    df: DataFrame,
    path: str,
    sort_by: tuple[str, ...] | None = None,
    partition_by: tuple[str, ...] | None = None,
) -> None:
    """Overwrite a table (S4), a full rebuild.

    ``partition_by`` writes one directory per value. Rows stay in the tasks
    that made them and are not shuffled for it; directories that get many small
    files are compacted (:func:`compact`). ``sort_by`` sorts rows inside each
    output file, so parquet row groups cover narrow key ranges."""
    out = df.sortWithinPartitions(*(partition_by or ()), *sort_by) if sort_by else df
    w = out.write.mode("overwrite").option("compression", CODEC)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    if partition_by and len(partition_by) == 1:
        compact(df.sparkSession, path, df.schema, partition_by[0], sort_by)


def write_months(df: DataFrame, path: str, sort_by: tuple[str, ...] | None = None, whole: bool = False, number: str | None = None) -> None:
    """S4, incremental: replaces the directories of the months in ``df``; other months' files stay.

    ``whole`` replaces the table. Rows lie and are compacted as in
    :func:`write_table`. ``number`` names a column with a number for each row,
    unique in this write: it is given by the tasks that write the files."""
    out = df.withColumn(number, F.monotonically_increasing_id()) if number else df
    dealt = out.sortWithinPartitions("month_key", *sort_by) if sort_by else out
    mode = "static" if whole else "dynamic"
    dealt.write.mode("overwrite").option("compression", CODEC).option("partitionOverwriteMode", mode).partitionBy("month_key").parquet(path)
    compact(df.sparkSession, path, out.schema, "month_key", sort_by)


def compact(spark: SparkSession, path: str, schema: StructType, column: str, sort_by: tuple[str, ...] | None = None) -> None:
    """Rewrites the directories of a table partitioned by ``column`` that hold many small files, in one job.

    A directory's files are read together and written as a few: rows meet
    through the files, which take a fraction of the bytes of a shuffle of the
    rows. What is read is cut into pieces of about ``FILE_BYTES``, so a hot
    value is spread over tasks. Other directories stay as they are."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    pieces = {}
    for d in fs.listStatus(at):
        if d.getPath().getName().startswith(f"{column}="):
            sizes = [f.getLen() for f in fs.listStatus(d.getPath()) if f.getPath().getName().startswith("part-")]
            # At least two: branches of a union that are a single partition each are all run by one task.
            n = max(2, math.ceil(sum(sizes) / FILE_BYTES))
            if len(sizes) > max(MOST_FILES, 2 * n):
                pieces[d.getPath().toString()] = n
    if not pieces:
        return
    read = spark.read.schema(schema).option("basePath", path)
    whole = reduce(DataFrame.unionAll, [read.parquet(d).coalesce(n) for d, n in sorted(pieces.items())])
    out = whole.sortWithinPartitions(column, *sort_by) if sort_by else whole
    out.write.mode("overwrite").option("compression", CODEC).option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """A catalog table in ``buckets`` buckets by ``key``, one sorted file each, replaced as a whole.

    The rows are dealt by the key first, as joins deal them, so that a bucket
    is one file and not one for each task."""
    dealt = df.repartition(buckets, key).sortWithinPartitions(key)
    dealt.write.mode("overwrite").format("parquet").option("compression", CODEC).bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Marks a folder of this application's own for removal when the driver ends."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A written table; with its ``schema`` also one without rows, which has no files if it is partitioned."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def register_views(tables: dict[str, DataFrame]) -> None:
    """Expose relations to SQL users (S3)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def to_client(df: DataFrame, max_rows: int):
    """Hand a *small* result to a client as pandas. Refuses results above
    ``max_rows`` instead of pulling an unbounded result through the driver."""
    head = df.limit(max_rows + 1).toPandas()
    if len(head) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; aggregate before delivering it")
    return head

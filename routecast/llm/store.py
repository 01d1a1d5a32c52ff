"""Written intermediate tables in the shared folder of the session.

Expensive results that are read more than once (tokenised pieces, numbered
rows) are written as Parquet under ``spark.checkpoint.dir``: a lost executor
then costs a read, not a second computation, and every executor sees the
files. Column pruning on the re-read is why this is a table rather than
``checkpoint()``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from routecast.session import scratch_dir
from routecast.sources.sinks import remove_at_exit


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path that no other run uses, in the shared folder; removed when the driver ends."""
    path = f"{scratch_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    remove_at_exit(spark, path)
    return path


#: Rows of an Arrow batch that goes to Python. Spark's default of 10,000 whole
#: texts is some hundred MB on both sides of the pipe.
ARROW_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to ``ARROW_ROWS`` rows; a lower setting stays.

    Plans take the setting when they run, so it has to outlast the call."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if not 0 < now <= ARROW_ROWS:
        spark.conf.set(name, ARROW_ROWS)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read again (lineage ends here)."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Cut lineage by writing a table to the cluster's shared checkpoint folder.

Used where a frame feeds several branches of a plan that must agree row by row
or would each recompute it. The table is written as Parquet (column pruning
and pushdown on re-read) under ``spark.checkpoint.dir``, which survives
executor loss; never a machine-local folder on a cluster. ``release`` removes
the tables of a session once their readers are done."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path

_written: dict[str, list[str]] = {}
_tables: dict[str, str] = {}   # path -> name of a bucketed table

# Columns of a numbered table: the task that wrote a row, and the row's number.
SLICE, ROW = "__slice", "__row"


def scratch_table(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, known to ``release``."""
    path = scratch_path(spark, f"quarry/{label}-{uuid.uuid4().hex}")
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_table(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def planned_bytes(df: DataFrame) -> int:
    """The size that the planner goes by: of a written table its files' size (cut
    to the columns taken), of anything else an estimate that may be far too large."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes."""
    value = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(value))


def numbered(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once with its rows numbered, each task's rows in one bucket
    of their own slice number. Values that were found for single rows come back to
    such a table by (slice, row): only they are shuffled, the table is read where it lies."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_table(spark, label)
    name = "quarry_" + path.rsplit("-", 1)[1]
    rows = df.withColumns({SLICE: F.spark_partition_id(), ROW: F.monotonically_increasing_id()})
    rows = rows.withColumn(SLICE, F.col(SLICE).alias(SLICE, metadata={"buckets": buckets}))
    rows.write.format("parquet").option("path", path).bucketBy(buckets, SLICE).saveAsTable(name)
    _tables[path] = name
    return spark.table(name)


def buckets_of(df: DataFrame) -> int | None:
    """The number of buckets if ``df`` has the columns of a numbered table."""
    if SLICE not in df.columns or ROW not in df.columns:
        return None
    return df.schema[SLICE].metadata.get("buckets")


def written(spark: SparkSession) -> list[str]:
    """The paths that this session wrote and has not released."""
    return list(_written.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Delete the tables at ``paths`` (default: all that this session wrote);
    returns their number. Call it when the frames that read them have been consumed."""
    own = _written.setdefault(spark.sparkContext.applicationId, [])
    paths = [p for p in own if paths is None or p in paths]
    own[:] = [p for p in own if p not in paths]
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        if p in _tables:
            spark.sql(f"DROP TABLE IF EXISTS `{_tables.pop(p)}`")
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)

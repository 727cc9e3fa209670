"""Scans and sinks (CSV / Parquet), versioned rewrite."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the incident CSV format (must match the source files).
CSV_SEPARATOR = ";"
CSV_QUOTE = '"'
CSV_TIMESTAMP_FORMAT = "MM/dd/yyyy hh:mm:ss a"

# The raw incident schema, in file order.
INCIDENT_SCHEMA = T.StructType([
    T.StructField("ID", T.IntegerType()),
    T.StructField("Case Number", T.StringType()),
    T.StructField("Date", T.TimestampType()),
    T.StructField("Block", T.StringType()),
    T.StructField("IUCR", T.StringType()),
    T.StructField("Primary Type", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("Location Description", T.StringType()),
    T.StructField("Arrest", T.BooleanType()),
    T.StructField("Domestic", T.BooleanType()),
    T.StructField("Beat", T.IntegerType()),
    T.StructField("District", T.IntegerType()),
    T.StructField("Ward", T.IntegerType()),
    T.StructField("Community Area", T.IntegerType()),
    T.StructField("FBI Code", T.StringType()),
    T.StructField("X Coordinate", T.IntegerType()),
    T.StructField("Y Coordinate", T.IntegerType()),
    T.StructField("Year", T.IntegerType()),
    T.StructField("Updated On", T.TimestampType()),
    T.StructField("Latitude", T.DoubleType()),
    T.StructField("Longitude", T.DoubleType()),
    T.StructField("Location", T.StringType()),
])


def scan_csv(spark: SparkSession, path: str, schema: T.StructType = INCIDENT_SCHEMA,
             sep: str = CSV_SEPARATOR, timestamp_format: str = CSV_TIMESTAMP_FORMAT,
             header: bool = True) -> DataFrame:
    """Typed CSV scan: explicit schema (no inference pass), header, quote ``"``.

    Splittable, so a multi-GB file is read by many tasks in parallel."""
    return (
        spark.read.option("header", header)
        .option("sep", sep)
        .option("quote", CSV_QUOTE)
        .option("timestampFormat", timestamp_format)
        .option("timestampNTZFormat", timestamp_format)
        .option("mode", "PERMISSIVE")
        .schema(schema)
        .csv(path)
    )


CORRUPT = "_corrupt_record"


def scan_csv_checked(spark: SparkSession, path: str, target: str, schema: T.StructType = INCIDENT_SCHEMA,
                     sep: str = CSV_SEPARATOR, timestamp_format: str = CSV_TIMESTAMP_FORMAT,
                     header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(clean, rejected): the rows that fit the schema, and the lines that do not (a
    value of another type, too few or too many fields) as (file, line).

    The file is parsed once, into a Parquet table at ``target`` that keeps each bad line
    as it stood; both parts are read from that table. Nothing turns into NULL unseen."""
    with_bad = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = (spark.read.option("header", header).option("sep", sep).option("quote", CSV_QUOTE)
              .option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).schema(with_bad))
    parsed = reader.csv(path).select("*", F.col("_metadata.file_name").alias("_file"))
    parsed.withColumn("_bad", F.col(CORRUPT).isNotNull()).write.mode("overwrite").partitionBy("_bad").parquet(target)
    table = spark.read.schema(T.StructType([*with_bad.fields, T.StructField("_file", T.StringType()),
                                            T.StructField("_bad", T.BooleanType())])).parquet(target)
    clean = table.where(~F.col("_bad")).select(*[F.col(f"`{f.name}`") for f in schema.fields])
    return clean, table.where("_bad").select(F.col("_file").alias("file"), F.col(CORRUPT).alias("line"))


def scan_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan; projecting ``columns`` here keeps ReadSchema narrow even
    before Catalyst prunes."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def sink_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                 mode: str = "overwrite") -> str:
    """Write a Parquet dataset (one file per task, no coalesce)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def sink_csv(df: DataFrame, path: str, single_file: bool = True, sep: str = ",") -> str:
    """Write a (small) query result as CSV with header.

    ``single_file`` coalesces to one task; only use it on aggregated
    results, where the shuffle below keeps the upstream stage parallel."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
    return path


class VersionedTable:
    """A Parquet table that is rewritten in place, version by version.

    Version n lies in ``v<n>`` under the root. A writer first claims its number with
    the file ``_claims/<n>``, writes, and last makes the empty file ``_versions/<n>``,
    with which the version counts. Neither file is ever replaced, so a rewrite that
    dies leaves the table as it was and costs a number, and no writer touches the files of
    another. A rewrite is refused if another one was committed meanwhile. A reader pins
    the version it opened; older ones stay until ``expire``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _files(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path
        return path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _numbers(self, folder: str) -> list[int]:
        fs, path = self._files()
        marks = path(f"{self.root}/{folder}")
        if not fs.exists(marks):
            return []
        return sorted(int(f.getPath().getName()) for f in fs.listStatus(marks))

    def versions(self) -> list[int]:
        """The committed versions, oldest first."""
        return self._numbers("_versions")

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or a given one. The frame keeps reading it whatever is written later."""
        known = self.versions()
        if not known or (version is not None and version not in known):
            raise ValueError(f"no version {version or ''} of {self.root}")
        return self.spark.read.parquet(f"{self.root}/v{known[-1] if version is None else version}")

    def commit(self, df: DataFrame, base: int | None = None) -> int:
        """Write ``df`` as a new version; it may be computed from any earlier one. With
        ``base``, only if that is still the newest version when ``df`` has been written."""
        version = max(self._numbers("_claims"), default=0) + 1
        fs, path = self._files()
        fs.create(path(f"{self.root}/_claims/{version}"), False).close()
        df.write.parquet(f"{self.root}/v{version}")
        if base is not None and self.versions()[-1:] != [base]:
            fs.delete(path(f"{self.root}/v{version}"), True)
            raise RuntimeError(f"version {base} of {self.root} was rewritten meanwhile")
        fs.create(path(f"{self.root}/_versions/{version}"), False).close()
        return version

    def rewrite(self, transform) -> int:
        """Commit ``transform`` of the newest version."""
        base = self.versions()[-1:]
        return self.commit(transform(self.read(*base)), *base)

    def expire(self, keep: int = 1) -> list[int]:
        """Remove all but the newest ``keep`` versions, marks first; their numbers."""
        fs, path = self._files()
        old = self.versions()[:-keep] if keep else self.versions()
        for version in old:
            fs.delete(path(f"{self.root}/_versions/{version}"), False)
            fs.delete(path(f"{self.root}/v{version}"), True)
        return old

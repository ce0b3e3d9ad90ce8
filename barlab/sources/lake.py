"""Hive-partitioned bar lake: write, scan, inventory.

Layout ``<root>/symbol=<s>/resolution=<r>/dt=<d>/part-*.parquet``.  Writes
repartition on the partition columns, so each day directory holds one file
written by one task, and a rerun replaces only the days it writes
(``partitionOverwriteMode=dynamic``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlab.functions import scalar
from barlab.schemas import TS_ALIASES

PARTITIONS = ["symbol", "resolution", "dt"]


def write_lake(df: DataFrame, path: str, partitions: Sequence[str] = PARTITIONS,
               mode: str = "overwrite") -> str:
    """Partitioned Parquet sink, one file per day directory."""
    parts = [p for p in partitions if p in df.columns]
    (df.repartition(*parts).write.mode(mode)
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(*parts).parquet(path))
    return path


def write_lake_clustered(df: DataFrame, path: str, records_per_file: int = 5_000_000) -> str:
    """The same lake for many symbols: folders by resolution and day only, rows
    sorted by symbol inside, files of at most ``records_per_file`` rows.  A day
    of ten thousand symbols is a few large files whose row groups carry symbol
    ranges, instead of ten thousand tiny files."""
    (df.repartitionByRange("resolution", "dt", "symbol").sortWithinPartitions("resolution", "dt", "symbol", "ts")
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", records_per_file)
       .partitionBy("resolution", "dt").parquet(path))
    return path


def scan(spark: SparkSession, path: str, merge_schema: bool = False,
         with_filename: bool = False, schema: T.StructType | None = None) -> DataFrame:
    """Partition-discovering scan; ``merge_schema`` unions file schemas by name
    (S4-S7) and opens every footer for it; a ``schema`` given instead opens none,
    and columns a file lacks are NULL.  ``filename`` comes from the hidden
    ``_metadata`` column."""
    r = spark.read.option("basePath", path)
    if schema is not None:
        r = r.schema(schema)
    if merge_schema:
        r = r.option("mergeSchema", "true")
    df = r.parquet(path)
    if with_filename:
        df = df.withColumn("filename", F.col("_metadata.file_path"))
    return df


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of frames whose columns differ, matched by name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def filename_parts(df: DataFrame, col: str = "filename") -> DataFrame:
    """``symbol`` and ``dt`` recovered from the file path."""
    return (df.withColumn("path_symbol", scalar.path_symbol(F.col(col)))
              .withColumn("path_dt", scalar.path_dt(F.col(col))))


def filter_by_filename_date(df: DataFrame, day: str, col: str = "filename") -> DataFrame:
    """Rows of files whose name carries ``day``."""
    return df.filter((scalar.path_date(F.col(col)) == F.lit(day)) | F.col(col).like(f"%{day}.parquet"))


def inventory(df: DataFrame, group: Sequence[str] = ("symbol",)) -> DataFrame:
    """Files, rows and first/last day per group."""
    return df.groupBy(*group).agg(
        F.count_distinct(F.col("_metadata.file_path")).alias("n_files"),
        F.count(F.lit(1)).alias("n_rows"),
        F.min("dt").alias("min_dt"), F.max("dt").alias("max_dt"))


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application that answers counts, minima and maxima of
    Parquet scans from file footers; the caller's session stays as it is."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", "UTC")
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def row_count(spark: SparkSession, path: str) -> DataFrame:
    """``n_rows`` of a lake, from its footers."""
    return footer_session(spark).read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"))


def footer_inventory(spark: SparkSession, path: str, group: Sequence[str] = ("symbol",)) -> DataFrame:
    """Files, rows and first/last day per group without reading a column (S13):
    rows per day folder come from the footers, files from the listing, days from
    the folders' names."""
    own = footer_session(spark)
    rows = own.read.parquet(path)
    # by all partition columns, which is what the scan can answer
    rows = rows.groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("n")).groupBy(*group).agg(
        F.sum("n").alias("n_rows"), F.min("dt").alias("min_dt"), F.max("dt").alias("max_dt"))
    files = (own.read.format("binaryFile").option("basePath", path).option("pathGlobFilter", "*.parquet").load(path)
             .groupBy(*group).agg(F.count("path").alias("n_files")))
    return rows.join(files, list(group)).select(*group, "n_files", "n_rows", "min_dt", "max_dt")


#: Every time alias and the bar columns, with the partition columns.
DRIFT_SCHEMA = T.StructType([
    *[T.StructField(c, T.TimestampType()) for c in TS_ALIASES],
    *[T.StructField(c, T.DoubleType()) for c in ("open", "high", "low", "close", "volume")],
    T.StructField("symbol", T.StringType()), T.StructField("resolution", T.StringType()), T.StructField("dt", T.DateType())])


def register_bar_view(spark: SparkSession, path: str, name: str = "bars_1h", resolution: str | None = None) -> str:
    """Canonical SQL view over the lake (S18, S19): ts coalesced from the time
    aliases; symbol and dt are the partition columns, so filters on them prune
    folders; ``resolution`` picks one of several.  Ordering is left to the
    consumer."""
    df = scan(spark, path, schema=DRIFT_SCHEMA)
    if resolution is not None:
        df = df.filter(F.col("resolution") == resolution)
    df = df.select(F.coalesce(*TS_ALIASES).alias("ts"), "open", "high", "low", "close", "volume", "symbol", "dt")
    df.createOrReplaceTempView(name)
    return name

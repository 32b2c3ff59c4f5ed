"""Outputs: partitioned tables and nested documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_partitioned(frame: DataFrame, path: str, by: str) -> None:
    """Parquet by partition; running it again replaces only the partitions written."""
    frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def nested_map(frame: DataFrame, by: list[str], key: str, value: Column, name: str = "values") -> DataFrame:
    """One row per group with a map of its keys, in order of the keys."""
    return frame.groupBy(*by).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(key), value.alias("v"))))).alias(name))


def sparse_json(frame: DataFrame, name: str = "document") -> DataFrame:
    """Rows as JSON without null, empty text, empty list or empty map fields; 0 and false stay."""
    kept = [F.nullif(F.col(c), F.lit("")).alias(c) if t == "string" else F.when(F.size(c) > 0, F.col(c)).alias(c) if t.startswith(("array", "map")) else F.col(c) for c, t in frame.dtypes]
    return frame.select(F.to_json(F.struct(*kept)).alias(name))


def write_document(frame: DataFrame, path: str) -> None:
    """The one column of a small result as a text file of its own name, a line a row, with a line feed at the end.

    Spark writes a folder; its only part is renamed to `path` in one step, so readers see the old file or the new one.
    """
    spark = frame.sparkSession
    staged = f"{path}.staged"
    frame.coalesce(1).write.mode("overwrite").text(staged)
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, folder = hadoop.Path(path), hadoop.Path(staged)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    part = next(s.getPath() for s in system.listStatus(folder) if s.getPath().getName().startswith("part-"))
    system.delete(target, False)
    system.rename(part, target)
    system.delete(folder, True)


def write_with_health(frame: DataFrame, path: str, by: str, source: str) -> DataFrame:
    """Writes rows by partition (see write_partitioned) and returns the by column, source, n, ok: what was written, for the health report."""
    write_partitioned(frame, path, by)
    written = frame.sparkSession.read.parquet(path)
    return written.groupBy(by, source).agg(F.count("*").alias("n")).withColumn("ok", F.col("n") > 0)

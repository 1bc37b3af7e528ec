"""Text file sources and sinks of the training-data chain.

Export files (S4), recursive export scans (S5), labelled dumps (S6),
dataset landing (S7), statistics files (S8) and their parsing (S9). Writes
go to the shared folder named by ``spark.checkpoint.dir`` unless a path is
given, and every write lands in a new folder (the line writes a new
timestamped file per export).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fabline.functions import codes as C
from fabline.session import scratch_path


def new_folder(spark: SparkSession, kind: str) -> str:
    return scratch_path(spark, f"{kind}/{uuid.uuid4().hex}")


# --- S4 ---------------------------------------------------------------------
def delimited_line(*cols: str | Column) -> Column:
    """Each value followed by ``;`` (``a;b;c;``)."""
    return F.concat(F.concat_ws(";", *cols), F.lit(";"))


def write_lines(df: DataFrame, path: str, line: str = "line",
                partition_by: list[str] | None = None) -> str:
    """Write one text line per row (optionally one folder per partition value)."""
    w = df.select(*(partition_by or []), line).write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.text(path)
    return path


# --- S5 ---------------------------------------------------------------------
def export_scan(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """All text files below ``path`` as one input: ``line, file_path`` (plus
    partition columns when the folder has ``k=v`` levels and not recursive)."""
    r = spark.read
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    df = r.text(path)
    return df.select(F.col("value").alias("line"), "*",
                     F.col("_metadata.file_path").alias("file_path")).drop("value")


# --- S6 ---------------------------------------------------------------------
def labelled_dump(lines: DataFrame, line: str = "line") -> DataFrame:
    """Dump CSV ``'table','id','c','v1',...``: strip quotes, drop table and
    id, map the class digit to its label (others stay as text), keep the
    vector text ``datapoints``."""
    parts = F.split(F.regexp_replace(F.col(line), "'", ""), ",")
    digit = F.try_element_at(parts, F.lit(3))
    label = (F.when(digit == "0", C.GOOD).when(digit == "1", C.DEFECT1)
             .when(digit == "2", C.DEFECT2).otherwise(digit))
    return lines.select(
        F.try_element_at(parts, F.lit(2)).alias("id"), label.alias("label"),
        F.array_join(F.slice(parts, 4, F.size(parts) - 3), ",").alias("datapoints"))


# --- S7 ---------------------------------------------------------------------
def dataset_land(spark: SparkSession, src: str, dst: str) -> DataFrame:
    """Copy a collected dataset file unchanged into the export folder."""
    spark.read.text(src).write.mode("errorifexists").text(dst)
    return spark.read.text(dst).select(F.col("value").alias("line"))


# --- S8 ---------------------------------------------------------------------
def stats_line(day: str = "day") -> Column:
    """``day<TAB>good=a, defect1=b, defect2=c``."""
    return F.format_string("%s\tgood=%d, defect1=%d, defect2=%d",
                           F.col(day), F.col(C.GOOD), F.col(C.DEFECT1), F.col(C.DEFECT2))


# --- S9 ---------------------------------------------------------------------
def stats_parse(lines: DataFrame, line: str = "line") -> DataFrame:
    """Statistics lines back to counters, summed over days. Counters that
    are not integers are skipped (counted in ``n_bad_counters``)."""
    def grab(name: str) -> Column:
        return F.regexp_extract(F.col(line), rf"{name}=([^,\s]*)", 1).try_cast("int")

    parsed = lines.select(*[grab(c).alias(c) for c in C.CLASSES])
    bad = sum(F.when(F.col(c).isNull(), 1).otherwise(0) for c in C.CLASSES)
    return parsed.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in C.CLASSES],
                      F.coalesce(F.sum(bad), F.lit(0)).cast("bigint").alias("n_bad_counters"))

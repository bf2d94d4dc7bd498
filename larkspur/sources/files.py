"""File sources and report sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path on it: the driver's view of any store that Spark reads."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> bool:
    """Deletes a folder with all its files, on whatever store it lies."""
    disk, where = file_system(spark, path)
    return disk.delete(where, True)


def state(spark: SparkSession, path: str) -> tuple:
    """Names, lengths and times of a folder's files: changes when they do."""
    disk, where = file_system(spark, path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in disk.listStatus(where)))


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, date_columns: tuple[str, ...] = (), sep: str = ","
) -> DataFrame:
    """Headered text with a stated schema; date columns are parsed, bad ones are null."""
    raw = T.StructType([T.StructField(f.name, T.StringType() if f.name in date_columns else f.dataType) for f in schema])
    df = spark.read.csv(path, header=True, schema=raw, sep=sep)
    for name in date_columns:
        df = df.withColumn(name, F.try_to_timestamp(name).cast("date"))
    return df


def write_report(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").csv(path, header=True, sep=sep)


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """Headerless code list, all strings so that leading zeros stay.

    The lines above the list carry no three-digit level code, which is how they
    are told apart; nothing depends on where a split of the file begins.
    """
    names = ("level", "statefips", "countyfips", "drop1", "drop2", "drop3", "county")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.csv(path, schema=schema).where(F.col("level").rlike(r"^\d{3}$")).drop("drop1", "drop2", "drop3")


def region_codes(codes: DataFrame) -> DataFrame:
    """County rows with their state name and the joined id."""
    county = codes.where(F.col("level") == "050").select("statefips", "countyfips", "county")
    state = codes.where(F.col("level") == "040").select("statefips", F.col("county").alias("state"))
    return county.join(state, "statefips").select(
        F.concat("statefips", "countyfips").alias("geo_id"), "state", "county"
    )


def read_instances(spark: SparkSession, path: str) -> DataFrame:
    """Instance files: first line ``n capacity``, then one ``value weight`` per line.

    One row per item with its place in the file; the path names the instance. Line
    numbers come from the size
    of the file splits: a task numbers the lines of one split only, and the
    offsets of the splits are summed in a small table, so a huge file is never
    held by one task.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("instance"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line_id"),
        F.trim("value").alias("line"),
    )
    lines = lines.where(F.col("line") != "")
    splits = lines.groupBy("instance", "split").agg(
        F.count("*").alias("n"), F.min_by("line", "line_id").alias("first_line")
    )
    by_split = Window.partitionBy("instance").orderBy("split")
    splits = splits.select(
        "instance",
        "split",
        (F.sum("n").over(by_split) - F.col("n")).alias("offset"),
        F.element_at(F.split(F.first("first_line").over(by_split), r"\s+"), 2).cast("long").alias("capacity"),
    )
    in_split = Window.partitionBy("instance", "split").orderBy("line_id")
    parts = F.split("line", r"\s+")
    return (
        lines.withColumn("nr", F.row_number().over(in_split))
        .join(splits, ["instance", "split"])
        .withColumn("item", F.col("offset") + F.col("nr") - 2)
        .where(F.col("item") >= 0)
        .select(
            "instance",
            "item",
            F.element_at(parts, 1).cast("long").alias("value"),
            F.element_at(parts, 2).cast("long").alias("weight"),
            "capacity",
        )
    )

"""Reading and writing tables: Parquet, CSV and JSON directories."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.functions.sizing import as_bytes, scanned_bytes
from tallyloom.session import split_bytes

SPLIT, OPEN_COST = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"


def read_parquet(spark: SparkSession, *paths: str, schema: StructType | str | None = None,
                 columns: list[str] | None = None) -> DataFrame:
    """One table over any number of Parquet files or directories.

    With a declared schema no footer is opened to infer one.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(*paths)
    return df if columns is None else df.select(*columns)


def row_count(spark: SparkSession, *paths: str) -> int:
    """Rows of a Parquet table, answered from the footers; no column is decoded."""
    return spark.read.parquet(*paths).count()


def scan_partitions(df: DataFrame) -> int:
    """Number of tasks the scan would start with; plans the query but runs nothing.

    Planned anew, so that the session's present settings count.
    """
    return df.select("*").rdd.getNumPartitions()


def with_row_number_in_file(df: DataFrame, name: str = "row_in_file") -> DataFrame:
    """Add each row's position in its Parquet file.

    Call it directly on a Parquet read. The number is a property of the stored row, so it is
    the same when a task is run again, and it tells apart rows that are copies of each other.
    """
    return df.withColumn(name, F.col("_metadata.row_index"))


def with_file_name(df: DataFrame, name: str = "file") -> DataFrame:
    """Add the name of the file each row is stored in, a natural part column for rollups.

    Call it directly on a file read.
    """
    return df.withColumn(name, F.col("_metadata.file_name"))


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """Even round-robin split, for the output of a scan with fewer splits than cores."""
    return df.repartition(partitions)


@contextmanager
def planned_splits(df: DataFrame, waves: int = 3) -> Iterator[dict]:
    """Within the block, scans start with about ``waves`` tasks a core, or one per file if those
    are fewer than the files.

    The split size follows from the bytes and the number of the files below ``df`` and from the
    cores, before anything is read. Queries planned in the block use it: build the plan of ``df``
    anywhere, run its actions inside. Gives a record of what was planned; the session's own
    setting comes back at the end.
    """
    spark = df.sparkSession
    plan = {"source_bytes": scanned_bytes(df), "source_files": len(df.inputFiles()),
            "cores": spark.sparkContext.defaultParallelism}
    cost = as_bytes(spark.conf.get(OPEN_COST))
    plan["split_bytes"] = split_bytes(plan["source_bytes"], plan["cores"], waves, smallest=cost,
                                      files=plan["source_files"], open_cost=cost)
    before = spark.conf.get(SPLIT)
    spark.conf.set(SPLIT, str(plan["split_bytes"]))
    try:
        yield plan
    finally:
        spark.conf.set(SPLIT, before)


def spread_small(df: DataFrame) -> DataFrame:
    """Spread a scan over the cores when it has fewer splits than there are cores.

    A larger source is left as it is scanned, so no shuffle is added where it would cost.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return spread(df, cores) if scan_partitions(df) < cores else df


def write_parquet(df: DataFrame, path: str, *, mode: str = "errorifexists",
                  partition_by: list[str] | None = None) -> None:
    """Snappy Parquet, one file per task.

    With ``partition_by`` and ``mode="overwrite"`` only the partitions present in ``df`` are
    replaced, so writing the same slice twice leaves one copy of it.
    """
    writer = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """CSV directory with a header line in every file and doubled quotes inside values."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header, read with a declared schema; a malformed line is an error.

    An empty field is null and a quoted empty field is an empty string.
    """
    # a null marker that occurs in no file, so that quoted empty fields are not taken for null
    return (spark.read.schema(schema).option("header", True).option("escape", '"')
            .option("nullValue", "\0").option("mode", "FAILFAST").csv(path))


def write_json(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """One JSON object per line; null fields are written, so every line has every field."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines, read with a declared schema; a malformed line is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A folder of this machine is made only for a local session, where it is the same for all; on a
    cluster without the setting this is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not re.match(r"local(\[[^,\]]*(,[^\]]*)?\])?$", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tallyloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has been written to yet."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store a small intermediate table in the shared folder and go on from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()

"""Paths on whatever file system the session can reach."""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def first_existing(spark: SparkSession, candidates: list[str]) -> str | None:
    return next((path for path in candidates if exists(spark, path)), None)


def entries(spark: SparkSession, folder: str) -> list[str]:
    """Names of a few entries of a folder, one call to the JVM each; none where it is missing."""
    fs, hadoop_path = _file_system(spark, folder)
    if not fs.exists(hadoop_path):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(hadoop_path)]
    return [name for name in names if not name.startswith((".", "_"))]


def input_files(frame: DataFrame) -> list[str]:
    """Paths of a frame's files, however many, fetched as one string."""
    joined = frame.sparkSession._jvm.org.apache.hadoop.util.StringUtils.join(
        "\n", frame._jdf.inputFiles())
    return [unquote(path) for path in joined.split("\n") if path]


def reads_files(frame: DataFrame) -> bool:
    """Whether a frame reads any file; one without has no rows and, to Spark, no known size."""
    return len(frame._jdf.inputFiles()) > 0


def touch(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.create(hadoop_path, True).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all; one of that name is replaced."""
    fs, target = _file_system(spark, path)
    folder, name = path.rsplit("/", 1)
    _, hidden = _file_system(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = fs.create(hidden, True)
    out.write(text.encode())
    out.close()
    fs.delete(target, False)
    if not fs.rename(hidden, target):
        raise OSError(f"{path} could not be written")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    fs, hadoop_path = _file_system(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def folder_size(spark: SparkSession, folder: str, ending: str = ".parquet") -> tuple[int, int]:
    """Number and bytes of the files with an ending that lie in a folder itself, from one listing."""
    fs, hadoop_path = _file_system(spark, folder)
    if not fs.exists(hadoop_path):
        return 0, 0
    sizes = [status.getLen() for status in fs.listStatus(hadoop_path)
             if status.getPath().getName().endswith(ending)]
    return len(sizes), sum(sizes)


def remove(spark: SparkSession, path: str, recursive: bool = False) -> None:
    """Delete a file, or a folder with all it holds, if it is there."""
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, recursive)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the session's shared checkpoint folder.

    Where none is set, a local session gets its own; a cluster must name a folder that
    all its executors can reach.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="changetide-")
        context.setCheckpointDir(root)
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a stored table: computed once, and not again if an executor is lost."""
    path = scratch_dir(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def data_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Name, size in KB and bytes of the parquet files below the paths; no file is opened."""
    schema = "path STRING, modified TIMESTAMP, bytes LONG"
    if not paths:
        return spark.createDataFrame([], schema).select(
            "path", F.col("path").alias("file_name"), "modified", "bytes",
            F.col("bytes").alias("kb"))
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
        .load(paths)
        .select(
            "path",
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            F.col("modificationTime").alias("modified"),
            F.col("length").alias("bytes"),
            F.floor(F.col("length") / 1024).alias("kb"),
        )
    )

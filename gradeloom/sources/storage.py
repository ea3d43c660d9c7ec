"""File operations of the storage Spark writes to, by the file system's own calls on the driver; no data passes through it."""

from __future__ import annotations

import shutil
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _at(spark: SparkSession, path: str):
    """The path and its file system."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_tree(spark: SparkSession, path: str) -> None:
    """Delete a folder with all in it; nothing happens if it is not there."""
    where, fs = _at(spark, path)
    fs.delete(where, True)


def _names(spark: SparkSession, path: str, folders: bool) -> list[str]:
    where, fs = _at(spark, path)
    if not fs.exists(where):
        return []
    found = [status.getPath().getName() for status in fs.listStatus(where) if status.isDirectory() == folders]
    return sorted(name for name in found if not name.startswith(("_", ".")))


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, in order."""
    return _names(spark, path, True)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files in a folder, in order."""
    return _names(spark, path, False)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder; 0 when it is not there."""
    where, fs = _at(spark, path)
    return fs.getContentSummary(where).getLength() if fs.exists(where) else 0


def join_files(spark: SparkSession, parts: list[str], target: str) -> None:
    """Join files into one, in order; the parts may be gone afterwards.

    HDFS moves block lists, by its own ``concat``. In a local (or mounted) folder tasks copy the parts side by side, each to its place
    in the file, which gets its name when it is whole. Storage that has no such call, as most object stores, raises an error.
    """
    where, fs = _at(spark, target)
    if fs.exists(where):
        raise FileExistsError(target)
    if not parts:
        fs.create(where).close()
        return
    jvm = spark.sparkContext._jvm
    paths = [jvm.org.apache.hadoop.fs.Path(p) for p in parts]
    ends = list(accumulate(fs.getFileStatus(path).getLen() for path in paths))
    fs.mkdirs(where.getParent())
    if isinstance_of(jvm, fs, "org.apache.hadoop.fs.LocalFileSystem"):
        # ``concat`` of local files starts the target anew, so what it held would be lost, and copies on the driver
        fs = fs.getRawFileSystem()
        joined = where.suffix(".joining")
        fs.create(joined, True).close()
        names = [fs.pathToFile(path).getPath() for path in paths]
        places = list(zip(names, [0, *ends[:-1]]))
        table = spark.createDataFrame(places, "name string, at bigint").repartition(len(places))
        copied = table.mapInArrow(_copy_into(fs.pathToFile(joined).getPath()), "n bigint").agg(F.sum("n")).first()[0]
    else:
        joined = paths[0]
        if paths[1:]:
            array = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(paths) - 1)
            for k, path in enumerate(paths[1:]):
                array[k] = path
            fs.concat(joined, array)
        copied = ends[-1]
    if not copied == fs.getFileStatus(joined).getLen() == ends[-1]:
        raise OSError(f"{target}: the joined file has not the length of its {len(parts)} parts")
    if not fs.rename(joined, where):
        raise OSError(f"can't rename {joined} to {target}")


def _copy_into(target: str):
    """Per file name and place, copy the file's bytes to that place of the target."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                with open(r["name"], "rb") as source, open(target, "r+b") as out:
                    out.seek(r["at"])
                    shutil.copyfileobj(source, out, 1 << 20)
                    n = out.tell() - r["at"]
                yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    return run


def isinstance_of(jvm, value, name: str) -> bool:
    return jvm.java.lang.Class.forName(name).isInstance(value)

"""Tagged text files as a table."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphatlas.operators.incremental import changed
from glyphatlas.session import shuffle_width

# The folder of texts without one, as Spark's writers name it.
NO_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def lay_texts(texts: DataFrame, root: str) -> None:
    """Every (path, text), with no path twice, as a file `folder=<escaped folder of the path>/*.txt` below `root`, which ends with a line break.

    Where `root` lies in a file system that tasks reach by themselves, they make the files: Hadoop's local file system starts a program
    twice a file, to set the permissions of the file and of its checksums. Elsewhere Spark's writer makes them.
    """
    spark = texts.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    foldered = texts.select(F.regexp_extract("path", "^(.*)/", 1).alias("folder"), "path", "text")
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() != "file":
        laid = foldered.repartitionByRange(shuffle_width(spark), "path").drop("path")
        laid.write.option("maxRecordsPerFile", 1).partitionBy("folder").text(root)
        return
    top = place.toUri().getPath()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: set[str] = set()
        for batch in batches:
            for folder, name, text in zip(*(batch.column(i).to_pylist() for i in range(2)), batch.column(2), strict=True):
                where = f"{top}/folder={quote(folder, safe='') if folder else NO_FOLDER}"
                if where not in made:
                    os.makedirs(where, exist_ok=True)
                    made.add(where)
                # readers leave names with a leading dot out, and a task that runs again makes the same files
                begun = f"{where}/.{uuid.uuid4().hex}"
                with open(begun, "xb") as f:
                    f.write(text.as_py())
                    f.write(b"\n")
                os.replace(begun, f"{where}/{name}.txt")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    name = F.coalesce(F.md5("path"), F.lit("none"))
    foldered.select("folder", name.alias("name"), F.col("text").cast("binary").alias("text")).mapInArrow(write, "n long").agg(F.sum("n")).collect()
    os.makedirs(top, exist_ok=True)  # without texts there is nothing to find, but a place to look


def _files(spark: SparkSession, paths, glob: str, recursive: bool = True) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    return reader.option("recursiveFileLookup", str(recursive).lower()).load(paths)


def _relative(root: str):
    return F.regexp_replace("path", r"^.*?" + _quoted(root.rstrip("/")) + "/", "")


def _quoted(text: str) -> str:
    return "\\Q" + text + "\\E"


def _version():
    return F.col("modificationTime").cast("double").alias("mtime"), F.col("length").alias("size")


def discover(spark: SparkSession, root: str, glob: str = "*.seq") -> DataFrame:
    """(path, mtime, size) of every file below `root`; contents are not read."""
    return _files(spark, root, glob).select(_relative(root).alias("path"), *_version())


def _read(files: DataFrame, root: str) -> DataFrame:
    """(path, mtime, size, text, valid) of binary file rows; `valid` is false where the bytes are not UTF-8."""
    ok = F.is_valid_utf8(F.col("content").cast("string"))
    return files.select(_relative(root).alias("path"), *_version(), F.col("content").cast("string").alias("text"), ok.alias("valid"))


def scan_tagged(spark: SparkSession, root: str, glob: str = "*.seq", only: DataFrame | None = None) -> DataFrame:
    """(path, mtime, size, text, valid) of the files below `root`, or of those in `only` (path, and mtime if known).

    Files are matched by their listed path, never by a pattern, and one that has vanished since is left out. With
    `mtime`, files older than all wanted ones are not opened. Files that are not valid belong in
    quarantine and are tried again on the next run.
    """
    files = _files(spark, root, glob)
    if only is None:
        return _read(files, root)
    if "mtime" in only.columns:
        first = only.agg(F.min("mtime")).first()[0]
        files = files.where("false" if first is None else F.col("modificationTime") >= F.timestamp_seconds(F.lit(first - 1.0)))
    return _read(files, root).join(only.select("path"), "path", "left_semi")


def stream_tagged(spark: SparkSession, root: str, glob: str = "*.seq", max_files: int = 10_000) -> DataFrame:
    """The same rows as a stream of the files that arrive below `root`."""
    schema = spark.read.format("binaryFile").load(root).schema
    reader = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true")
    return _read(reader.option("pathGlobFilter", glob).option("maxFilesPerTrigger", max_files).load(root), root)


def scan_changed(spark: SparkSession, root: str, cache: DataFrame, glob: str = "*.seq") -> DataFrame:
    """Contents of the files that are new or changed against the cached (path, mtime, size)."""
    return scan_tagged(spark, root, glob, changed(discover(spark, root, glob), cache))

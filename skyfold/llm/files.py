"""Files that tasks write to a shared folder themselves, for formats that Spark has no writer for.

Paths are URIs or absolute paths of any file system that pyarrow reaches. A task writes under a temporary name and
moves the finished file to its final name; a task that runs again finds its file there and leaves it alone. Nothing is
deleted before something else stands in its place. A folder counts as written when its manifest table is: files that it
does not list are ignored, and files that it lists must be there, whole.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def file_sum(data: bytes) -> int:
    """A 64-bit number of a file's content, the beginning of its SHA-256."""
    return int.from_bytes(hashlib.sha256(data).digest()[:8], "little", signed=True)


def write_file(folder: str, name: str, chunks: list[bytes]) -> tuple[int, int]:
    """Writes the chunks as one file and returns its size and :func:`file_sum`.

    An equal file is left as it is. A different one is replaced by the move itself.
    """
    store, root = filesystem(folder)
    whole = b"".join(chunks)
    mark = file_sum(whole)
    final = f"{root}/{name}"
    if store.get_file_info(final).type == fs.FileType.File:
        with store.open_input_stream(final, compression=None) as there:
            if file_sum(there.read()) == mark:
                return len(whole), mark
    store.create_dir(f"{root}/_temporary", recursive=True)
    temporary = f"{root}/_temporary/{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(temporary, compression=None) as out:
        out.write(whole)
    store.move(temporary, final)
    return len(whole), mark


def _files(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    store, root = filesystem(folder)
    store.create_dir(root, recursive=True)
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder)
    return found.select(F.substring_index("path", "/", -1).alias("name"), "content")


def read_listed(
    spark: SparkSession, folder: str, suffix: str, manifest: DataFrame, read: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """Rows that ``read`` makes of ``(name, content)`` of the files in ``manifest(name, file_sum)``.

    ``read`` gives each row the ``name`` and ``file_sum`` of its file. A listed file that is missing, or differs from what
    was written, raises; files that are not listed are left out; a folder that nothing was written to has no rows.
    """
    want = manifest.select("name", F.col("file_sum").alias("_sum"))
    fail = lambda what: F.raise_error(F.concat(F.lit(f"{what} file: "), F.col("name"))).cast("string")
    found = _files(spark, folder, suffix).mapInArrow(read, schema).join(want, "name")
    checked = found.withColumn("name", F.when(F.col("file_sum") != F.col("_sum"), fail("damaged")).otherwise(F.col("name"))).where("name IS NOT NULL")
    # Without rows unless a file is missing, and then it fails.
    there = want.select("name").join(_files(spark, folder, suffix).select("name", F.lit(True).alias("_there")), "name", "left")
    missing = there.where(F.when(F.col("_there").isNull(), fail("missing")).isNotNull()).drop("_there")
    return checked.drop("_sum").unionByName(missing, allowMissingColumns=True).drop("file_sum")

"""File trees as tables: folders are listed by tasks, files are opened by tasks, whatever their names and sizes.

A listing goes on from a table of folders not yet listed. A task lists its folders and those it meets, until it has met ``AT_ONCE`` entries; the folders left over are the next
table's rows. Only their number reaches the driver. Every file is a row: hidden names and files without bytes as well.

Tasks use Arrow's file systems (local, HDFS, S3, GCS, Azure). For a root in any other scheme Spark's own file source takes the tree, with its limits: it lists on the driver, leaves out
hidden names and empty files and holds a file as one value.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muniment.session import stage

#: Entries a task lists before it hands back the folders that are left.
AT_ONCE = 10_000
#: Bytes of files that one task should open.
TASK_BYTES = 128 << 20

_FOUND = "folder BOOLEAN, path STRING, length BIGINT, modified BIGINT"


def opened(path: str):
    """(file system, name in it) of a path as a listing gives it: unescaped, so names may hold ``%`` and other URI characters."""
    from urllib.parse import quote

    from pyarrow import fs

    root, inner = re.match(r"^([A-Za-z][\w+.-]*:(?://[^/]*)?)?(.*)$", path, re.DOTALL).groups()
    return fs.FileSystem.from_uri((root or "file:") + quote(inner))


def open_file(path: str):
    filesystem, name = opened(path)
    return filesystem.open_input_stream(name)


def open_random(path: str):
    """A file that is read by position."""
    filesystem, name = opened(path)
    return filesystem.open_input_file(name)


def entries(folder: str) -> Iterable[tuple[bool, str, int | None, int | None]]:
    """(is a folder, path, bytes, milliseconds of its last change) of what a folder holds."""
    from pyarrow import fs

    filesystem, name = opened(folder)
    for info in filesystem.get_file_info(fs.FileSelector(name)):
        inside = info.type == fs.FileType.Directory
        yield inside, f"{folder.rstrip('/')}/{info.base_name}", None if inside else info.size, None if inside else (info.mtime_ns or 0) // 1_000_000


def _list_some(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    schema = pa.schema([("folder", pa.bool_()), ("path", pa.string()), ("length", pa.int64()), ("modified", pa.int64())])
    met = 0
    for batch in batches:
        given = batch.column(0).to_pylist()
        todo, rows = deque((f, True) for f in given), []
        while todo:
            folder, must = todo.popleft()
            if not must and met >= AT_ONCE:
                rows.append((True, folder, None, None))
            else:
                for found in entries(folder):
                    met += 1
                    if found[0]:
                        todo.append((found[1], False))
                    else:
                        rows.append(found)
            if len(rows) >= 1000 or not todo:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [()] * 4, schema)], schema=schema)
                rows = []


def qualified(spark: SparkSession, root: str) -> str:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def reads(root: str) -> bool:
    """Whether tasks can open files below ``root`` themselves."""
    try:
        opened(root)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
        return False
    return True


def list_tree(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, modificationTime) of every file below ``root``."""
    whole = qualified(spark, root)
    if not reads(whole):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
        return files.select("path", "length", "modificationTime")
    tasks = 3 * spark.sparkContext.defaultParallelism
    frontier, n, listed = spark.createDataFrame([(whole,)], "path STRING"), 1, None
    while n:
        found = stage(frontier.repartition(min(n, tasks)).mapInArrow(_list_some, _FOUND), "tree")
        files = found.where("NOT folder").select("path", "length", F.timestamp_millis("modified").alias("modificationTime"))
        listed = files if listed is None else listed.unionByName(files)
        frontier = found.where("folder").select("path")
        n = frontier.count()
    return listed


def map_files(listed: DataFrame, fn: Callable[[str, int], tuple], added: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of listed files, and for each those of ``added``, which ``fn`` gives for its path and length. Files are spread over tasks by their bytes."""
    spark = listed.sparkSession
    files, total = listed.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    tasks = max(1, min(files, max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))))
    fields = spark.createDataFrame([], added).schema.fields
    schema = listed.select(*keep).schema
    for f in fields:
        schema = schema.add(f)
    kinds = [_arrow(f) for f in fields]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            rows, first, held = [], 0, 0
            paths, lengths = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, (path, length) in enumerate(zip(paths, lengths)):
                rows.append(fn(path, length))
                held += length
                if held >= 4 << 20 or i + 1 == len(paths):
                    some = batch.slice(first, len(rows)).columns[2:]
                    yield pa.RecordBatch.from_arrays([*some, *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))], names=schema.names)
                    rows, first, held = [], i + 1, 0

    return listed.select(F.col("path").alias("_path"), F.col("length").alias("_length"), *keep).repartition(tasks).mapInArrow(run, schema)


def _arrow(field) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(field.dataType)

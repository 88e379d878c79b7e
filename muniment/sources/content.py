"""Content files and their index."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from muniment.functions import containers, ids, mime
from muniment.functions import values as V
from muniment.session import stage
from muniment.sources import tree

CHUNK_BYTES = 8 * 1024 * 1024

ID_OF_NAME = {"akubra": ids.internal_id_akubra, "legacy": ids.internal_id_legacy}


def scan_content(spark: SparkSession, root: str, id_of_name: str | Column) -> DataFrame:
    """(internal_id, path, length) of every file below ``root``; file bodies are not opened.

    ``id_of_name`` is a profile name or a column expression over ``name``. A name that is not a valid one
    gives a null id (see ``bad_names``).
    """
    files = tree.list_tree(spark, root).select("path", "length", ids.file_name(F.col("path")).alias("name"))
    internal = ID_OF_NAME[id_of_name](F.col("name")) if isinstance(id_of_name, str) else id_of_name
    return files.select(internal.alias("internal_id"), "path", "length")


def bad_names(index: DataFrame) -> DataFrame:
    return index.where(F.col("internal_id").isNull()).select(
        "path", F.concat(F.lit("file name gives no content id: "), ids.file_name(F.col("path"))).alias("message")
    )


def digest_content(spark: SparkSession, root: str, algorithms: list[str], chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(path, length, head, inside, one hex column per algorithm): each file read once in chunks by a task, whatever its size, its bytes never moved on.

    ``inside`` is the media type that a container's directory tells; it is null where only Spark's own file source can open the tree.
    """
    if not tree.reads(tree.qualified(spark, root)):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
        digests = [V.INDEX_DIGESTS[a](F.col("content")).alias(a) for a in algorithms]
        return files.select("path", "length", F.substring(F.col("content"), 1, mime.MAGIC_BYTES).alias("head"), F.lit(None).cast("string").alias("inside"), *digests)

    def digest(path: str, length: int) -> tuple:
        hashes, head = [hashlib.new(a) for a in algorithms], b""
        with tree.open_file(path) as stream:
            while chunk := stream.read(chunk_bytes):
                if len(head) < mime.MAGIC_BYTES:
                    head += bytes(chunk[: mime.MAGIC_BYTES - len(head)])
                for h in hashes:
                    h.update(chunk)
        inside = None
        if head.startswith((containers.ZIP, containers.COMPOUND)):
            with tree.open_random(path) as file:
                inside = containers.media_type(file, length, head)
        return (head, inside, *[h.hexdigest() for h in hashes])

    added = ", ".join(["head BINARY", "inside STRING", *[f"{a} STRING" for a in algorithms]])
    return tree.map_files(tree.list_tree(spark, root), digest, added, ["path", "length"])


def content_index(
    spark: SparkSession, root: str, id_of_name: str | Column, algorithms: list[str], index_dir: str | None = None
) -> DataFrame:
    """Index of a content directory with digests; written to ``index_dir`` once and reused from there."""
    if index_dir:
        marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(index_dir, "_SUCCESS")
        if marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker):
            stored = spark.read.parquet(index_dir)
            if {"inside", *algorithms} <= set(stored.columns):
                return stored
    name = ids.file_name(F.col("path"))
    internal = ID_OF_NAME[id_of_name](name) if isinstance(id_of_name, str) else id_of_name
    digests = digest_content(spark, root, algorithms)
    if not isinstance(id_of_name, str):
        digests = digests.withColumn("name", name)
    index = digests.withColumn("internal_id", internal).drop("name")
    return stage(index, "content-index", index_dir)


def _text_of(body: bytes) -> str:
    """A document's text by its byte order mark or declaration; one that can't be decoded is empty, so it fails to parse."""
    import codecs
    import re

    marks = ((codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF16_BE, "utf-16"), (codecs.BOM_UTF16_LE, "utf-16"))
    said = re.match(rb"""\s*<\?xml[^>]*?\sencoding\s*=\s*["']([A-Za-z0-9._-]+)["']""", body[:400])
    name = next((n for m, n in marks if body.startswith(m)), said[1].decode() if said else "utf-8")
    try:
        text = body.decode(name)
    except (LookupError, UnicodeDecodeError):
        return ""
    return re.sub(r"""^(\s*<\?xml[^>]*?)\sencoding\s*=\s*["'][^"']*["']""", r"\1", text) if said else text


def read_texts(df: DataFrame, path: str, out: str) -> DataFrame:
    """``df`` with the text of the file each row names; rows without a path get null.

    For the few small documents (element sets, relationships) kept as managed files: only their paths
    travel, and each is opened by the task that parses it.
    """
    schema = df.withColumn(out, F.lit(None).cast("string")).schema
    place = df.columns.index(path)

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            texts = []
            for p in batch.column(place).to_pylist():
                if p is None:
                    texts.append(None)
                    continue
                with tree.open_file(p) as stream:
                    texts.append(_text_of(stream.read()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    # A list of paths is tiny next to the files it names: spread it by number, or it ends up in one task.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks).mapInArrow(run, schema)

"""Record files, id lists, mapping tables and ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muniment.functions import ids
from muniment.operators.shred import record_pid
from muniment.sources import tree

VISIBLE = r"^[^\.].*$"


# Encodings that can be read, under the names records may declare.
ENCODINGS = {
    "UTF-8": "UTF-8", "UTF8": "UTF-8", "US-ASCII": "US-ASCII", "ASCII": "US-ASCII", "ISO-8859-1": "ISO-8859-1", "ISO8859-1": "ISO-8859-1",
    "LATIN1": "ISO-8859-1", "UTF-16": "UTF-16", "UTF-16BE": "UTF-16BE", "UTF-16LE": "UTF-16LE", "UTF-32": "UTF-32",
}
_DECLARED = r"""^\s*<\?xml[^>]*?\sencoding\s*=\s*["']([A-Za-z0-9._-]+)["']"""
_ENCODING_PART = r"""^(\s*<\?xml[^>]*?)\sencoding\s*=\s*["'][^"']*["']"""


#: A larger record is not read into one value: it is a reject, and the job goes on.
RECORD_BYTES = 1 << 30


def read_files(spark: SparkSession, root: str, name_regex: str = VISIBLE, limit: int = RECORD_BYTES) -> DataFrame:
    """(path, length, content) of files whose name passes the filter; the content of one larger than ``limit`` is null."""
    named = ids.file_name(F.col("path")).rlike(name_regex)
    if not tree.reads(tree.qualified(spark, root)):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).where(named)
        small = files.where(F.col("length") <= limit).select("path", "length", "content")
        return small.unionByName(files.where(F.col("length") > limit).select("path", "length", F.lit(None).cast("binary").alias("content")))

    def body(path: str, length: int) -> tuple:
        if length > limit:
            return (None,)
        with tree.open_file(path) as stream:
            return (stream.read(),)

    return tree.map_files(tree.list_tree(spark, root).where(named), body, "content BINARY", ["path", "length"])


def decoded(files: DataFrame, content: str = "content") -> DataFrame:
    """``files`` with the text ``xml`` of their bytes, or a ``text_problem``.

    The encoding is told by a byte order mark, else by the declaration, else it is UTF-8. A text in an encoding that is not
    known, or with bytes that don't fit it, is null and has a problem. One projection per step, so each is worked out once.
    """
    known = F.create_map(*[F.lit(x) for pair in ENCODINGS.items() for x in pair])
    mark, said, name = F.col("_mark"), F.col("_said"), F.col("_name")
    marked = (
        F.when(mark.startswith("EFBBBF"), "UTF-8").when(mark.startswith("FEFF") | mark.startswith("003C"), "UTF-16BE")
        .when(mark.startswith("FFFE") | mark.startswith("3C00"), "UTF-16LE").when(said == "", "UTF-8")
    )
    text = F.when(name == "UTF-8", F.when(F.is_valid_utf8(F.col(content).cast("string")), F.col(content).cast("string")))
    for other in sorted(set(ENCODINGS.values()) - {"UTF-8"}):
        text = text.when(name == other, F.decode(content, other))
    # A text in UTF-8 stays as it is; any other is no longer in the encoding that it declares.
    bare = F.when(name == "UTF-8", F.col("_text")).otherwise(F.regexp_replace("_text", _ENCODING_PART, "$1"))
    return (
        files.withColumn("_mark", F.hex(F.substring(content, 1, 3)))
        .withColumn("_said", F.upper(F.regexp_extract(F.decode(F.substring(content, 1, 400), "ISO-8859-1"), _DECLARED, 1)))
        .withColumn("_name", F.coalesce(marked, F.try_element_at(known, said)))
        .withColumn("_text", text)
        .withColumn("xml", F.regexp_replace(bare, "^\ufeff", ""))
        .withColumn("text_problem", F.when(name.isNull(), F.concat(F.lit("encoding not known here: "), said)).when(
            F.col("_text").isNull() & F.col(content).isNotNull(), F.concat(F.lit("bytes that are not "), name)))
        .drop("_mark", "_said", "_name", "_text")
    )


def scan_records(spark: SparkSession, root: str, name_regex: str = VISIBLE, limit: int = RECORD_BYTES) -> DataFrame:
    """(path, xml, length, text_problem, sha256, sha512): one row per file below ``root`` whose name passes the filter.

    The filter looks at names of files only, never at folders. Digests are those of the file's bytes. A file without bytes has an empty text; one
    larger than ``limit`` has none and a problem.
    """
    files = decoded(read_files(spark, root, name_regex, limit))
    large = F.when(F.col("length") > limit, F.concat(F.lit("record too large to be read as one value: "), F.col("length").cast("string"), F.lit(" bytes")))
    return files.select(
        "path", "xml", "length", F.coalesce(large, "text_problem").alias("text_problem"), F.sha2("content", 256).alias("sha256"), F.sha2("content", 512).alias("sha512")
    )


def scan_record_ids(raw: DataFrame) -> DataFrame:
    """(path, pid) of raw records by one pattern match; records without an id have a null pid."""
    return raw.select("path", record_pid(F.col("xml")).alias("pid"))


def read_pid_list(spark: SparkSession, path: str) -> DataFrame:
    """One id per line, lines as they are, duplicates collapsed."""
    return spark.read.text(path).select(F.col("value").alias("pid")).distinct()


def read_mapping(spark: SparkSession, path: str, separator: str = "=") -> DataFrame:
    """(source, target) pairs of a properties file.

    Comment and blank lines are left out. The first separator not escaped by a backslash splits a line;
    escapes are then dropped.
    """
    line = F.trim("value")
    sep = {"=": "=", ":": ":"}[separator]
    pattern = rf"^((?:[^\\{sep}]|\\.)*?)\s*{sep}\s*(.*)$"

    def plain(c):
        return F.regexp_replace(F.trim(c), r"\\(.)", "$1")

    return (
        spark.read.text(path)
        .select(line.alias("line"))
        .where(~F.col("line").startswith("#") & ~F.col("line").startswith("!") & F.col("line").rlike(pattern))
        .select(
            plain(F.regexp_extract("line", pattern, 1)).alias("source"),
            plain(F.regexp_extract("line", pattern, 2)).alias("target"),
        )
    )


def read_ledger(spark: SparkSession, path: str | None) -> DataFrame | None:
    """The ledger of earlier runs, or None when there is none yet."""
    if not path:
        return None
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return None
    return spark.read.schema("pid STRING, position BIGINT, status STRING").parquet(path)

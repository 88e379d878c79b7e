"""Round trips through files: the given tables written by Spark, then read by the sources; and the sinks read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muniment import model as M
from muniment.functions import containers, ids, mime
from muniment.model import RunOptions
from muniment.operators import shred, triples
from muniment.plans import render as R
from muniment.plans.tables import table
from muniment.session import fresh_path, spread_rows, stage
from muniment.sources import content, records, sinks, tree

T1 = "2020-01-01T00:00:00.000Z"
_PART_ENTRY = {
    "ECONOMY": "word/document.xml", "PROMO": "xl/workbook.xml", "STANDARD": "ppt/presentation.xml", "MEDIUM": "META-INF/MANIFEST.MF",
}


def _supplier_pid():
    return F.concat(F.lit("supplier:"), F.col("s_suppkey").cast("string"))


#: Folders that files are dealt into, and files that one task writes.
FOLDERS, FILES_AT_ONCE = 256, 2000


def _one_file_per_id(rows: DataFrame, name: str) -> str:
    """``rows(id, value)`` as a directory tree with one text file per id, a line for each of its rows."""
    lines = F.sort_array(F.collect_list(F.coalesce("value", F.lit(""))))
    files = rows.groupBy("id").agg(F.concat(F.array_join(lines, "\n"), F.lit("\n")).alias("value"))
    folder = F.pmod(F.xxhash64("id"), F.lit(FOLDERS)).cast("string")
    return write_files(files.select(F.concat(folder, F.lit("/id="), F.coalesce(F.col("id").cast("string"), F.lit("null"))).alias("file"), "value"), name)


def scan_records(spark: SparkSession, d: str) -> DataFrame:
    xml = R.record(
        _supplier_pid(), [(M.STATE_PROPERTY, F.lit("Active"))],
        [R.datastream("NAME", "X", "A", [R.version("NAME.0", T1, R.inline(F.concat(F.lit("<n>"), R.escape(F.col("s_name")), F.lit("</n>"))))])],
    )
    root = _one_file_per_id(table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), xml.alias("value")), "record-files")
    parsed = shred.parse_records(records.scan_records(spark, root))
    return shred.shred_versions(parsed).select("pid", "ds_id", "version_id", "inline_xml")


def write_files(rows: DataFrame, name: str) -> str:
    """``rows(file, value)`` as a tree with one file per row, its value a text or bytes, written by tasks; a file that is written again is the same.

    Making a file takes a turn to the file system, so small rows are dealt to tasks by their number.
    """
    root = fresh_path(rows.sparkSession, name)
    kept = stage(rows.select("file", "value"), name + "-rows")

    def run(batches):
        from pyarrow import fs

        made = set()
        for batch in batches:
            filesystem, base = tree.opened(root)
            for file, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                path = f"{base}/{file}"
                folder = path.rpartition("/")[0]
                if folder not in made:
                    if filesystem.get_file_info(folder).type != fs.FileType.Directory:
                        filesystem.create_dir(folder, recursive=True)
                    made.add(folder)
                with filesystem.open_output_stream(path) as out:
                    out.write(value if isinstance(value, bytes) else (value or "").encode())
            yield batch

    spread_rows(kept, FILES_AT_ONCE).mapInArrow(run, kept.schema).count()
    return root


def scan_content(spark: SparkSession, d: str) -> DataFrame:
    """A content file for every part and supplier, in plain and hidden folders, hashed in place; every tenth part's file is empty."""
    parts = table(spark, d, "part").select(
        F.concat_ws("/", F.col("p_brand"), F.when(F.col("p_partkey") % 3 == 0, "_deep"), F.concat(F.lit("part%3A"), F.col("p_partkey").cast("string"))).alias("file"),
        F.when(F.col("p_partkey") % 10 == 0, "").otherwise(F.col("p_name")).alias("value"))
    suppliers = table(spark, d, "supplier").select(F.concat(F.lit(".suppliers/_s"), F.col("s_suppkey").cast("string")).alias("file"), F.col("s_name").alias("value"))
    root = write_files(parts.unionByName(suppliers), "content-files")
    found = content.digest_content(spark, root, ["md5", "sha256"], chunk_bytes=15)
    listed = content.scan_content(spark, root, ids.file_name(F.col("path"))).select("path", "internal_id")
    return found.join(listed, "path").select("internal_id", "length", F.decode("head", "UTF-8").alias("head"), "md5", "sha256")


def container_types(spark: SparkSession, d: str) -> DataFrame:
    """Every part's name inside a container of its type (documents, sheets, slides, books, archives): the type is told by the container's directory."""
    entry = F.create_map(*[F.lit(x) for pair in _PART_ENTRY.items() for x in pair])
    rows = table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("file"), F.coalesce(F.try_element_at(entry, "p_type"), F.lit("notes.txt")).alias("entry"), "p_name")

    def zipped(batches):
        import io
        import zipfile

        import pyarrow as pa

        for batch in batches:
            made = []
            for entry, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                held = io.BytesIO()
                with zipfile.ZipFile(held, "w") as archive:
                    archive.writestr("[Content_Types].xml", "<Types/>")
                    archive.writestr(entry, text or "")
                made.append(held.getvalue())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["file", "value"])

    root = write_files(rows.mapInArrow(zipped, "file STRING, value BINARY"), "containers")
    found = content.digest_content(spark, root, [])
    name = ids.file_name(F.col("path"))
    return found.select(name.cast("bigint").alias("p_partkey"), mime.detect_mime(F.lit(None).cast("string"), F.col("head"), name, F.col("inside")).alias("mime"))


def scan_all_names(spark: SparkSession, d: str) -> DataFrame:
    """Files in plain folders, and in folders whose names begin with ``_`` or ``.``, all read back; every seventh is empty."""
    key = F.col("s_suppkey")
    folder = F.when(key % 3 == 0, "plain").when(key % 3 == 1, "_under/plain").otherwise(".dot/_under")
    value = F.when(key % 7 == 0, "").otherwise(F.concat_ws(":", key.cast("string"), "s_name"))
    root = write_files(table(spark, d, "supplier").select(F.concat(folder, F.lit("/_"), key.cast("string")).alias("file"), value.alias("value")), "hidden-files")
    found = records.scan_records(spark, root)
    return found.select(F.regexp_extract("path", rf"{root.rsplit('/')[-1]}/(.*)/[^/]*$", 1).alias("folder"), ids.file_name(F.col("path")).alias("name"), "xml", "length")


def encoded_records(spark: SparkSession, d: str) -> DataFrame:
    """Documents as records in the encoding of their language: with a byte order mark, Latin-1, UTF-16 and plain UTF-8."""
    label = F.regexp_replace("text", "[^A-Za-z\u00c0-\u00ff ]", "")
    xml = R.record(F.concat(F.lit("doc:"), F.col("doc_id").cast("string")), [(M.STATE_PROPERTY, F.lit("Active"))], [
        R.datastream("D", "M", "A", [R.version("D.0", T1, R.base64(F.encode(F.lit("x"), "UTF-8")), label=label)])
    ])
    body = F.regexp_replace(xml, r"^\s*<\?xml[^>]*\?>", "")
    said = lambda name: F.concat(F.lit(f'<?xml version="1.0" encoding="{name}"?>'), body)
    content = (
        F.when(F.col("lang") == "en", F.concat(F.unhex(F.lit("EFBBBF")), F.encode(body, "UTF-8"))).when(F.col("lang") == "de", F.encode(said("ISO-8859-1"), "ISO-8859-1"))
        .when(F.col("lang") == "fr", F.encode(said("UTF-16"), "UTF-16")).otherwise(F.encode(body, "UTF-8"))
    )
    raw = table(spark, d, "documents").select("lang", F.concat(F.lit("store/"), F.col("doc_id").cast("string")).alias("path"), content.alias("content"))
    raw = records.decoded(raw).select("path", "lang", "xml", F.length("content").cast("bigint").alias("length"), "text_problem")
    return shred.shred_versions(shred.parse_records(raw), keep=["lang"]).select("pid", "lang", "label")


def pid_list_source(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "pid-list")
    lines = table(spark, d, "customer").select(F.concat(F.lit("customer:"), F.col("c_custkey").cast("string")).alias("value"))
    lines.unionByName(lines).write.text(path)
    return records.read_pid_list(spark, path)


def mapping_source(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "mapping")
    parts = table(spark, d, "part")
    line = F.concat(F.lit("part\\="), F.col("p_partkey").cast("string"), F.lit(" = "), F.col("p_name"))
    notes = parts.select(F.concat(F.lit("# "), F.col("p_brand"), F.lit("=x")).alias("value"))
    parts.select(line.alias("value")).unionByName(notes).write.text(path)
    return records.read_mapping(spark, path)


def written_resources(spark: SparkSession, d: str) -> DataFrame:
    """Resource versions through the partitioned sink: layout directory, bucket and version metadata."""
    path = fresh_path(spark, "resources")
    rows = table(spark, d, "orders").select(
        F.concat(F.lit("info:fedora/order:"), F.col("o_orderkey").cast("string")).alias("object_id"), F.col("o_custkey").alias("version")
    )
    sinks.write_resources(rows, path, RunOptions(user="u", user_uri="urn:u"), bucket_characters=1)
    stored = spark.read.parquet(path)
    return stored.select("object_id", "version", "object_dir", F.col("bucket").cast("string").alias("bucket"), "version_user", "version_address")


def written_ntriples(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "ntriples")
    rows = table(spark, d, "supplier").select(
        ids.object_resource(_supplier_pid()).alias("s"), "s_name", F.col("s_nationkey").cast("string").alias("nation")
    )

    def line(p: str, o: str):
        parts = {"s": F.col("s"), "p": F.lit(p), "o": F.col(o), "o_kind": F.lit("literal"), "o_datatype": F.lit(M.XSD_STRING), "o_lang": F.lit(None).cast("string")}
        return triples.ntriples_line(parts.__getitem__)

    sinks.write_ntriples(rows.select(F.concat(line("urn:name", "s_name"), F.lit("\n"), line("urn:nation", "nation"), F.lit("\n")).alias("nt")), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


QUERIES = {
    f.__name__: f for f in (scan_records, scan_all_names, encoded_records, scan_content, container_types, pid_list_source, mapping_source, written_resources, written_ntriples)
}

_S = "'<info:fedora/supplier:' || s_suppkey || '> '"

ORACLE = {
    "scan_records": """
SELECT 'supplier:' || s_suppkey AS pid, 'NAME' AS ds_id, 'NAME.0' AS version_id, chr(10) || '<n>' || s_name || '</n>' || chr(10) AS inline_xml
FROM supplier""",
    "scan_all_names": """
SELECT folder, '_' || s_suppkey AS name, xml, CAST(strlen(xml) AS BIGINT) AS length FROM (
  SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'plain' WHEN 1 THEN '_under/plain' ELSE '.dot/_under' END AS folder,
         CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE s_suppkey || ':' || s_name END AS xml FROM supplier)""",
    "encoded_records": """
SELECT 'doc:' || doc_id AS pid, lang, regexp_replace(text, '[^A-Za-z\u00c0-\u00ff ]', '', 'g') AS label FROM documents""",
    "scan_content": """
WITH c AS (SELECT 'part%3A' || p_partkey AS id, CASE WHEN p_partkey % 10 = 0 THEN '' ELSE p_name END AS body FROM part
  UNION ALL SELECT '_s' || s_suppkey, s_name FROM supplier)
SELECT id AS internal_id, CAST(strlen(body) AS BIGINT) AS length, substr(body, 1, 64) AS head, md5(body) AS md5, sha256(body) AS sha256 FROM c""",
    "container_types": "SELECT p_partkey, CASE p_type "
    + " ".join(f"WHEN '{kind}' THEN '{containers.IN_ZIP[entry]}'" for kind, entry in _PART_ENTRY.items())
    + " ELSE 'application/zip' END AS mime FROM part",
    "pid_list_source": "SELECT DISTINCT 'customer:' || c_custkey AS pid FROM customer",
    "mapping_source": "SELECT 'part=' || p_partkey AS source, p_name AS target FROM part",
    "written_resources": """
SELECT object_id, version, h[1:3] || '/' || h[4:6] || '/' || h[7:9] || '/' || h AS object_dir, h[1:1] AS bucket, 'u' AS version_user, 'urn:u' AS version_address
FROM (SELECT 'info:fedora/order:' || o_orderkey AS object_id, o_custkey AS version, sha256('info:fedora/order:' || o_orderkey) AS h FROM orders)""",
    "written_ntriples": f"""
SELECT {_S} || '<urn:name> "' || s_name || '" .' AS line FROM supplier
UNION ALL SELECT {_S} || '<urn:nation> "' || s_nationkey || '" .' FROM supplier""",
}

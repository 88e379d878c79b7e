"""Whole migration runs over records rendered from the given documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muniment import model as M
from muniment.model import RunOptions
from muniment.operators import select
from muniment.plans import migrate
from muniment.plans import render as R
from muniment.plans.source_queries import write_files
from muniment.plans.tables import documents, table
from muniment.session import fresh_path, spread_rows, stage
from muniment.sources import sinks

RUN_TS = "2024-06-01T00:00:00.000Z"
T1, T2, T3 = "2020-01-01T00:00:00.000Z", "2020-02-01T00:00:00.000Z", "2020-03-01T00:00:00.000Z"
FEDORA_MODEL = "info:fedora/fedora-system:def/model#"


def document_records(spark: SparkSession, d: str) -> DataFrame:
    """One record per document.

    Text in one or (for documents of good quality) two versions, an element set, a relationship datastream
    that renames the text, a link for French documents; toxic documents are deleted; documents of one source
    state a wrong digest.
    """
    labels = table(spark, d, "labels")
    rows = spread_rows(documents(spark, d)).join(labels, "doc_id", "left")
    pid = F.concat(F.lit("doc:"), F.col("doc_id").cast("string"))
    text = F.encode("text", "UTF-8")
    second = F.encode(F.concat(F.col("text"), F.lit(" (2)")), "UTF-8")
    digest = F.when(F.col("source") == "src3", F.lit("0" * 32)).otherwise(F.upper(F.md5(text)))
    v0 = R.version("TEXT.0", T1, R.base64(text), mime="text/plain", digest=("MD5", digest))
    v1 = F.when(F.col("quality") == 1, R.version("TEXT.1", T2, R.base64(second), label="second", mime="text/plain")).otherwise("")
    link = F.when(
        F.col("lang") == "fr",
        R.datastream("LINK", "E", "A", [R.version("LINK.0", T1, R.location("URL", F.concat(F.lit("http://local.fedora.server/"), pid)), mime="text/html")]),
    ).otherwise("")
    rels = R.rdf([(F.concat(F.lit(M.ID_ROOT), pid, F.lit("/TEXT")), [
        R.edge("downloadFilename", FEDORA_MODEL, value=F.concat(F.col("source"), F.lit(".txt"))),
    ])])
    dc = R.dc([("title", F.col("source")), ("language", F.col("lang"))])
    xml = R.record(
        pid,
        [
            (M.STATE_PROPERTY, F.when(F.col("toxic") == 1, "Deleted").otherwise("Active")),
            (FEDORA_MODEL + "createdDate", T1),
            ("info:fedora/fedora-system:def/view#lastModifiedDate", T3),
        ],
        [
            R.datastream("DC", "X", "A", [R.version("DC.0", T1, R.inline(dc), label="Dublin Core", mime="text/xml")]),
            R.datastream("TEXT", "M", "A", [v0, v1]), link,
            R.datastream("RELS-INT", "X", "A", [R.version("RELS-INT.0", T3, R.inline(rels), mime="application/rdf+xml")]),
        ],
    )
    return rows.select(F.concat(F.lit("store/"), pid).alias("path"), xml.alias("xml"), F.length(xml).cast("bigint").alias("length"))


def _run(spark: SparkSession, d: str, raw: DataFrame | None = None, **options) -> dict[str, DataFrame]:
    opts = RunOptions(source_profile="exported", run_ts=RUN_TS, continue_on_error=True, digest_algorithm="sha256", **options)
    return migrate.migrate(spark, opts, raw=document_records(spark, d) if raw is None else raw)


def _stored_records(spark: SparkSession, d: str) -> DataFrame:
    """The records of several runs, rendered and written once, as they would lie in a store: each run scans them for ids and then for their texts."""
    return stage(document_records(spark, d), "records")


def _shown(resources: DataFrame) -> DataFrame:
    binary = F.col("kind") == "binary"
    return resources.select(
        "object_id", "resource_id", "version", "version_date", "kind", "logical_path", "header_only", "deleted",
        F.col("headers.filename").alias("filename"), F.col("headers.external_url").alias("external_url"),
        F.when(binary, F.col("bytes")).alias("bytes"), F.when(binary, F.col("digest")).alias("digest"),
    )


def migrated_resources(spark: SparkSession, d: str) -> DataFrame:
    return _shown(_run(spark, d)["resources"])


def migrated_heads(spark: SparkSession, d: str) -> DataFrame:
    """Only the last state of every resource, in one version per object."""
    return _shown(_run(spark, d, head_only=True)["resources"])


def migrated_atomic(spark: SparkSession, d: str) -> DataFrame:
    """Every datastream as a plain target object of its own."""
    return _shown(_run(spark, d, migration_type=M.PLAIN_OCFL, resource_type=M.ATOMIC)["resources"])


def migrated_rejects(spark: SparkSession, d: str) -> DataFrame:
    return _run(spark, d)["rejects"]


def migrated_versions(spark: SparkSession, d: str) -> DataFrame:
    return _run(spark, d)["versions"]


def migrated_ledger(spark: SparkSession, d: str) -> DataFrame:
    return _run(spark, d)["ledger"].select("pid", "status")


def migrated_limit(spark: SparkSession, d: str) -> DataFrame:
    """A run over the first 50 objects: those done, and those rejected."""
    return _done_and_failed(_run(spark, d, limit=50))


def migrated_resume(spark: SparkSession, d: str) -> DataFrame:
    """A run from a resume point half way through the objects."""
    placed = select.with_positions(document_records(spark, d).select("path"), ["path"])
    half = placed.count() // 2
    before = placed.where(F.col("position") == half - 1).first().path.removeprefix("store/")
    return _done_and_failed(_run(spark, d, resume=True, resume_position=half, resume_last_id=before))


def migrated_resume_twice(spark: SparkSession, d: str) -> DataFrame:
    """Three runs into one target, each from where the one before stopped: the ledger's positions are those of the whole scan."""
    raw = _stored_records(spark, d)
    n = raw.count()
    target = fresh_path(spark, "target")
    ledger, last = f"{target}/ledger", (0, select.FIRST_RUN)
    for k, upto in enumerate((n // 3, 2 * n // 3, n)):
        tables = _run(spark, d, raw, target_dir=target, ledger_dir=ledger, limit=upto, resume=k > 0, resume_position=last[0], resume_last_id=last[1])
        sinks.write_outputs(tables, RunOptions(target_dir=target, ledger_dir=ledger), run_id=f"{k:03d}")
        if upto < n:
            placed = select.with_positions(raw.select("path"), ["path"]).where(F.col("position") == upto - 1).first()
            last = (upto, placed.path.removeprefix("store/"))
    parts = [spark.read.parquet(f"{ledger}/run={k:03d}").withColumn("run", F.lit(f"{k:03d}")) for k in range(3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("pid", "position", "run")


def _done_and_failed(tables: dict[str, DataFrame]) -> DataFrame:
    return tables["ledger"].select("pid", "status").unionByName(tables["rejects"].select("pid", F.lit("failed").alias("status")).distinct())


def rerun_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Two runs into one target, under ids that look like numbers: the second fails every object that the first has stored, and stores nothing."""
    raw, target = _stored_records(spark, d), fresh_path(spark, "target")
    for name in ("007", "1e3"):
        tables = _run(spark, d, raw, target_dir=target)
        sinks.write_outputs(tables, RunOptions(target_dir=target, ledger_dir=f"{target}/ledger"), run_id=name)
    stored = sinks.published(spark, f"{target}/data/ocfl-root", "resources").groupBy("object_id").agg(F.countDistinct("run").alias("runs"))
    stored = stored.select(F.regexp_replace("object_id", "^info:fedora/", "").alias("pid"), "runs")
    return tables["rejects"].select("pid", "stage").join(stored, "pid", "left").select("pid", "stage", F.coalesce("runs", F.lit(0)).alias("runs"))


def resume_without_ledger(spark: SparkSession, d: str) -> DataFrame:
    """A run is published but dies before its ledger: the next one, told to resume, takes only what the target does not hold."""
    raw, target = _stored_records(spark, d), fresh_path(spark, "target")
    first = _run(spark, d, raw, target_dir=target, limit=40)
    sinks.write_outputs(first, RunOptions(target_dir=target, ledger_dir=f"{target}/lost"))
    again = _run(spark, d, raw, target_dir=target, ledger_dir=f"{target}/ledger", resume=True)
    return _done_and_failed(again)


def migrated_manifest(spark: SparkSession, d: str) -> DataFrame:
    return _run(spark, d)["manifest"].where(~F.col("content_path").endswith(".nt")).select("object_id", "digest", "version", "content_path", "n_writes")


def migrated_fixity(spark: SparkSession, d: str) -> DataFrame:
    return _run(spark, d)["fixity"]


def migrated_state(spark: SparkSession, d: str) -> DataFrame:
    """Version states of a whole run, as intervals, without its statement files."""
    return _run(spark, d)["version_state"].where(~F.col("path").endswith(".nt"))


def migrated_report(spark: SparkSession, d: str) -> DataFrame:
    return _run(spark, d)["report"].select("objects", "resources", "resource_versions", "failures")


def written_inventories(spark: SparkSession, d: str) -> DataFrame:
    """Inventory documents of a stored run, read back from the target: head, number of versions, and the manifest's content."""
    target = fresh_path(spark, "target")
    sinks.write_outputs(_run(spark, d, target_dir=target), RunOptions(target_dir=target), run_id="007")
    stored = sinks.published(spark, f"{target}/data/ocfl-root", "inventories")
    document = F.from_json("value", "id STRING, head STRING, manifest MAP<STRING, ARRAY<STRING>>, versions MAP<STRING, STRUCT<created: STRING>>").alias("i")
    rows = stored.select(document, "run").select(F.col("i.id").alias("object_id"), F.col("i.head").alias("head"), F.size("i.versions").alias("n_versions"), F.explode("i.manifest").alias("digest", "paths"), "run")
    return rows.select("object_id", "head", "n_versions", "digest", F.explode("paths").alias("content_path"), "run").where(~F.col("content_path").endswith(".nt"))


def written_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Rejects and report of a stored run, read back from the target."""
    target = fresh_path(spark, "target")
    sinks.write_outputs(_run(spark, d, target_dir=target), RunOptions(target_dir=target), run_id="1e3")
    root = f"{target}/data/ocfl-root"
    report = sinks.published(spark, root, "report").select("objects", "failures", F.col("run").alias("report_run"))
    return sinks.published(spark, root, "rejects").select("pid", "stage", "run").crossJoin(F.broadcast(report.limit(1)))


def migrated_records(spark: SparkSession, d: str) -> DataFrame:
    """Whole-record mode: the source record itself is stored beside the content, with its own digest, and deleted at once."""
    raw = document_records(spark, d).select(F.regexp_replace("path", "^store/", M.ID_ROOT).alias("object_id"), F.sha2("xml", 256).alias("of_record"))
    writes = _run(spark, d, foxml_file=True)["resources"].where("kind = 'foxml'").join(raw, "object_id")
    return writes.select("object_id", "resource_id", "version_date", "deleted", (F.col("digest") == F.col("of_record")).alias("whole"))


def _profiled(spark: SparkSession, d: str, profile: str) -> DataFrame:
    """A run over files of a source profile: a record for every supplier, and its name as managed content; every third one's content is missing."""
    key = F.col("s_suppkey").cast("string")
    pid, name = F.concat(F.lit("supplier:"), key), F.col("s_name")
    xml = R.record(pid, [(M.STATE_PROPERTY, F.lit("Active")), (FEDORA_MODEL + "createdDate", F.lit(T1)), ("info:fedora/fedora-system:def/view#lastModifiedDate", F.lit(T1))], [
        R.datastream("NAME", "M", "A", [R.version("NAME.0", T1, R.location("INTERNAL_ID", F.concat(pid, F.lit("+NAME+NAME.0"))), mime="text/plain", digest=("MD5", F.md5(name)))])])
    folder = F.concat(F.lit("d"), (F.col("s_suppkey") % 5).cast("string"), F.lit("/"))
    encoded = lambda *parts: F.concat(F.lit("info%3Afedora%2Fsupplier%3A"), key, *map(F.lit, parts))
    legacy = lambda *parts: F.concat(F.lit("supplier_"), key, *map(F.lit, parts))
    names = (encoded(), encoded("%2FNAME%2FNAME.0")) if profile == "akubra" else (legacy(), legacy("+NAME+NAME.0"))
    rows = spread_rows(table(spark, d, "supplier"))
    objects = write_files(rows.select(F.concat(folder, names[0]).alias("file"), xml.alias("value")), "profile-objects")
    streams = write_files(rows.where("s_suppkey % 3 != 0").select(F.concat(folder, names[1]).alias("file"), name.alias("value")), "profile-streams")
    opts = RunOptions(source_profile=profile, objects_dir=objects, datastreams_dir=streams, run_ts=RUN_TS, continue_on_error=True, digest_algorithm="sha256")
    tables = migrate.migrate(spark, opts)
    stored = tables["resources"].where("kind = 'binary'").select("object_id", "resource_id", "bytes", "digest", F.lit("stored").alias("status"))
    failed = tables["rejects"].select(F.concat(F.lit(M.ID_ROOT), "pid").alias("object_id"), F.lit(None).cast("string").alias("resource_id"), F.lit(None).cast("bigint").alias("bytes"),
                                      F.lit(None).cast("string").alias("digest"), F.col("stage").alias("status"))
    return stored.unionByName(failed)


def migrated_akubra(spark: SparkSession, d: str) -> DataFrame:
    return _profiled(spark, d, "akubra")


def migrated_legacy(spark: SparkSession, d: str) -> DataFrame:
    return _profiled(spark, d, "legacy")


QUERIES = {
    f.__name__: f
    for f in (
        migrated_resources, migrated_heads, migrated_atomic, migrated_rejects, migrated_versions, migrated_ledger, migrated_limit, migrated_resume,
        migrated_resume_twice, rerun_conflicts, resume_without_ledger, migrated_manifest, migrated_fixity, migrated_state, migrated_report, written_inventories, written_rejects,
        migrated_records, migrated_akubra, migrated_legacy,
    )
}

_DOCS = f"""
WITH docs AS (
  SELECT 'info:fedora/doc:' || d.doc_id AS obj, d.doc_id, lang, source, text, coalesce(toxic = 1, false) AS gone, coalesce(quality = 1, false) AS two,
    chr(10) || '<oai_dc:dc xmlns:oai_dc="http://www.openarchives.org/OAI/2.0/oai_dc/" xmlns:dc="{M.DC_NS}">' || chr(10) ||
      '<dc:title>' || source || '</dc:title>' || chr(10) || '<dc:language>' || lang || '</dc:language>' || chr(10) || '</oai_dc:dc>' || chr(10) AS dc,
    chr(10) || '<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#">' || chr(10) || '<rdf:Description rdf:about="info:fedora/doc:' ||
      d.doc_id || '/TEXT">' || chr(10) || '<downloadFilename xmlns="{FEDORA_MODEL}">' || source || '.txt</downloadFilename>' || chr(10) ||
      '</rdf:Description>' || chr(10) || '</rdf:RDF>' || chr(10) AS rels
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE source <> 'src3'),
content AS (
  SELECT obj, gone, '{T1}' AS vd, 'DC' AS ds, false AS header_only, 'Dublin Core' AS filename, CAST(NULL AS VARCHAR) AS url, dc AS body FROM docs
  UNION ALL SELECT obj, gone, '{T1}', 'TEXT', false, 'TEXT', NULL, text FROM docs
  UNION ALL SELECT obj, gone, '{T2}', 'TEXT', false, 'second', NULL, text || ' (2)' FROM docs WHERE two
  UNION ALL SELECT obj, gone, '{T1}', 'LINK', false, 'LINK', 'http://fedora.info/doc:' || doc_id, NULL FROM docs WHERE lang = 'fr'
  UNION ALL SELECT obj, gone, '{T3}', 'RELS-INT', false, 'RELS-INT', NULL, rels FROM docs),
renamed AS (SELECT obj, gone, '{T3}' AS vd, 'TEXT' AS ds, true AS header_only, source || '.txt' AS filename, CAST(NULL AS VARCHAR) AS url,
    CASE WHEN two THEN text || ' (2)' ELSE text END AS body FROM docs)"""


def _live(binaries: str, filename: str = "filename") -> str:
    return f"""
binaries AS ({binaries}),
live AS (
  SELECT obj, gone, obj || '/' || ds AS resource_id, vd, 'binary' AS kind, ds AS logical_path, header_only, {filename} AS filename, url, body FROM binaries
  UNION ALL SELECT obj, gone, obj || '/' || ds || '/fcr:metadata', vd, 'description', ds || '~fcr-desc.nt', false, NULL, NULL, NULL FROM content
  UNION ALL SELECT obj, gone, obj || '/TEXT/fcr:metadata', '{T3}', 'description', 'TEXT~fcr-desc.nt', false, NULL, NULL, NULL FROM docs
  UNION ALL SELECT obj, gone, obj, '{T1}', 'container', 'fcr-container.nt', false, NULL, NULL, NULL FROM docs),
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY resource_id ORDER BY vd DESC) AS r FROM live) WHERE r = 1)"""


_FACTS = "CAST(octet_length(encode(body)) AS BIGINT) AS bytes, sha256(body) AS digest"
_COLS = "resource_id, kind, logical_path"
_TOMB = f"SELECT obj, {_COLS}, '{RUN_TS}' AS vd, 1 AS late, false AS header_only, true AS deleted, filename, url, CAST(NULL AS BIGINT) AS bytes, CAST(NULL AS VARCHAR) AS digest FROM last WHERE gone"
_BOTH = f"SELECT obj, {_COLS}, vd, 0 AS late, header_only, false AS deleted, filename, url, {_FACTS} FROM live UNION ALL {_TOMB}"


def _numbered(target: str, rows: str) -> str:
    return f"""
SELECT {target} AS object_id, resource_id, CAST(dense_rank() OVER (PARTITION BY {target} ORDER BY late, vd) AS INTEGER) AS version,
  vd AS version_date, kind, logical_path, header_only, deleted, filename, url AS external_url, bytes, digest FROM ({rows})"""


_STATUS = "SELECT 'doc:' || doc_id AS pid, CASE WHEN source = 'src3' THEN 'failed' ELSE 'done' END AS status"

_ATOMIC_LIVE = _live("SELECT obj, gone, vd, ds, header_only, filename, url, coalesce(body, url) AS body FROM content",
                     f"CASE WHEN ds = 'TEXT' AND vd = '{T3}' THEN NULL ELSE filename END")

_RUN = f"{_DOCS}, {_live('SELECT * FROM content UNION ALL SELECT * FROM renamed')}, r AS ({_numbered('obj', _BOTH)})"
_MANIFEST = f"""{_RUN}, manifest AS (
  SELECT object_id, digest, min(version) AS version, arg_min(logical_path, (version, logical_path)) AS logical_path, count(*) AS n_writes
  FROM r WHERE kind = 'binary' AND NOT header_only AND NOT deleted AND digest IS NOT NULL GROUP BY object_id, digest)"""

ORACLE = {
    "migrated_resources": f"{_DOCS}, {_live('SELECT * FROM content UNION ALL SELECT * FROM renamed')} {_numbered('obj', _BOTH)}",
    "migrated_heads": f"""{_DOCS}, {_live('SELECT * FROM content UNION ALL SELECT * FROM renamed')}
SELECT obj AS object_id, resource_id, CAST(1 AS INTEGER) AS version, '{T1}' AS version_date, kind, logical_path, false AS header_only, gone AS deleted,
  filename, url AS external_url, CASE WHEN NOT gone THEN CAST(octet_length(encode(body)) AS BIGINT) END AS bytes,
  CASE WHEN NOT gone THEN sha256(body) END AS digest FROM last""",
    "migrated_atomic": f"{_DOCS}, {_ATOMIC_LIVE} "
    + _numbered("CASE WHEN kind = 'container' THEN obj ELSE replace(resource_id, '/fcr:metadata', '') END", _BOTH),
    "migrated_rejects": f"""
SELECT 'doc:' || doc_id AS pid, 'store/doc:' || doc_id AS path, 'content digest' AS stage,
  'content of doc:' || doc_id || '/TEXT has digest ' || md5(text) || ', the record says {'0' * 32}' AS message
FROM documents WHERE source = 'src3'""",
    "migrated_versions": f"""{_DOCS}, {_live('SELECT * FROM content UNION ALL SELECT * FROM renamed')}
SELECT object_id, version, min(version_date) AS created, '{M.VERSION_MESSAGE}' AS message, '{M.DEFAULT_USER}' AS user_name, '{M.DEFAULT_USER_URI}' AS user_address
FROM ({_numbered('obj', _BOTH)}) GROUP BY object_id, version""",
    "migrated_ledger": "SELECT 'doc:' || doc_id AS pid, 'done' AS status FROM documents WHERE source <> 'src3'",
    "migrated_limit": f"{_STATUS} FROM (SELECT * FROM documents ORDER BY 'store/doc:' || doc_id LIMIT 50)",
    "migrated_resume": f"""{_STATUS} FROM (SELECT *, row_number() OVER (ORDER BY 'store/doc:' || doc_id) AS r, count(*) OVER () AS n FROM documents) WHERE r > n // 2""",
    "rerun_conflicts": """
SELECT 'doc:' || doc_id AS pid, CASE WHEN source = 'src3' THEN 'content digest' ELSE 'conflict' END AS stage,
  CAST(CASE WHEN source = 'src3' THEN 0 ELSE 1 END AS BIGINT) AS runs FROM documents""",
    "migrated_resume_twice": """
SELECT 'doc:' || doc_id AS pid, position, CASE WHEN position < n // 3 THEN '000' WHEN position < 2 * n // 3 THEN '001' ELSE '002' END AS run FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY 'store/doc:' || doc_id) - 1 AS BIGINT) AS position, count(*) OVER () AS n FROM documents) WHERE source <> 'src3'""",
    "migrated_records": f"""
SELECT 'info:fedora/doc:' || doc_id AS object_id, 'info:fedora/doc:' || doc_id || '/FOXML' AS resource_id, CASE WHEN gone THEN '{RUN_TS}' ELSE '{T1}' END AS version_date, gone AS deleted,
  CASE WHEN NOT gone THEN true END AS whole FROM documents, (VALUES (false), (true)) AS v(gone) WHERE source <> 'src3'""",
    "resume_without_ledger": f"""{_STATUS} FROM (SELECT *, row_number() OVER (ORDER BY 'store/doc:' || doc_id) AS r FROM documents) WHERE r > 40 OR source = 'src3'""",
    "migrated_manifest": f"""{_MANIFEST} SELECT object_id, digest, version, 'v' || version || '/content/' || logical_path AS content_path, n_writes FROM manifest""",
    "migrated_fixity": f"{_DOCS} SELECT obj AS object_id, 'md5' AS algorithm, md5(text) AS digest, 'TEXT' AS path FROM docs",
    "migrated_state": f"""{_RUN}
SELECT object_id, logical_path AS path, digest, version AS from_version, to_version FROM (
  SELECT *, lead(version) OVER (PARTITION BY object_id, logical_path ORDER BY version) AS to_version
  FROM (SELECT * FROM r WHERE NOT header_only AND (deleted OR digest IS NOT NULL) AND kind = 'binary')) WHERE NOT deleted""",
    "migrated_report": f"""{_RUN}
SELECT (SELECT count(DISTINCT object_id) FROM r) AS objects, (SELECT count(DISTINCT resource_id) FROM r) AS resources,
  (SELECT count(*) FROM r WHERE NOT deleted) AS resource_versions, (SELECT count(*) FROM documents WHERE source = 'src3') AS failures""",
    "written_inventories": f"""{_MANIFEST}
SELECT m.object_id, 'v' || h.head AS head, h.head AS n_versions, m.digest, 'v' || m.version || '/content/' || m.logical_path AS content_path, '007' AS run
FROM manifest m JOIN (SELECT object_id, CAST(max(version) AS INTEGER) AS head FROM r GROUP BY object_id) h ON h.object_id = m.object_id""",
    "written_rejects": """
SELECT 'doc:' || doc_id AS pid, 'content digest' AS stage, '1e3' AS run, (SELECT count(*) FROM documents WHERE source <> 'src3') AS objects,
  (SELECT count(*) FROM documents WHERE source = 'src3') AS failures, '1e3' AS report_run FROM documents WHERE source = 'src3'""",
} | {
    name: """
SELECT 'info:fedora/supplier:' || s_suppkey AS object_id, CASE WHEN s_suppkey % 3 != 0 THEN 'info:fedora/supplier:' || s_suppkey || '/NAME' END AS resource_id,
  CASE WHEN s_suppkey % 3 != 0 THEN CAST(strlen(s_name) AS BIGINT) END AS bytes, CASE WHEN s_suppkey % 3 != 0 THEN sha256(s_name) END AS digest,
  CASE WHEN s_suppkey % 3 != 0 THEN 'stored' ELSE 'content' END AS status FROM supplier"""
    for name in ("migrated_akubra", "migrated_legacy")
}

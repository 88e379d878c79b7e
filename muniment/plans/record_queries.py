"""Queries over records rendered from the given tables: shredding, classification, documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muniment import model as M
from muniment.functions import ids, mime
from muniment.functions import values as V
from muniment.operators import audit, history, rejects, shred, spread, triples, validate
from muniment.plans import render as R
from muniment.plans.tables import documents, events, orders, table
from muniment.session import spread_rows, stage

#: Compact rows that one task renders and parses: a row of a hundred bytes becomes a record of two thousand.
AT_ONCE = 50_000


def _word():
    return (
        F.when(F.col("o_orderstatus") == "F", "Deleted").when(F.col("o_orderstatus") == "P", "Inactive").otherwise("Active")
    )


def order_records(spark: SparkSession, d: str) -> DataFrame:
    """One record per order: five properties, an inline, a managed and an external datastream."""
    rows = spread_rows(orders(spark, d), AT_ONCE)
    key = F.col("o_orderkey").cast("string")
    pid = F.concat(F.lit("order:"), key)
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    later = V.iso_instant(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"))
    note = F.concat(F.lit('<note  b="2" a="1">\n  '), R.escape(F.col("o_orderpriority")), F.lit("\n</note>"))
    xml = R.record(
        pid,
        [
            (M.STATE_PROPERTY, _word()),
            ("info:fedora/fedora-system:def/model#label", F.concat(F.lit('<"Order"> & '), key)),
            ("info:fedora/fedora-system:def/model#ownerId", F.lit("")),
            ("info:fedora/fedora-system:def/model#createdDate", F.col("created")),
            ("info:fedora/fedora-system:def/view#lastModifiedDate", later),
        ],
        [
            R.datastream("NOTE", "X", "A", [
                R.version("NOTE.0", F.col("created"), R.inline(note), label=F.lit(" a note "), mime="text/xml"),
                R.version("NOTE.1", later, R.inline(F.lit("<note/>")), mime="text/xml", size="7"),
            ]),
            R.datastream("PRICE", "M", F.col("o_orderstatus"), [
                R.version("PRICE.0", F.col("created"), R.location("INTERNAL_ID", F.concat(pid, F.lit("+PRICE+PRICE.0"))),
                          label="price", mime="text/plain", size=F.length(price).cast("string"),
                          digest=("MD5", F.md5(price))),
            ], versionable="false"),
            R.datastream("LINK", "E", "A", [
                R.version("LINK.0", later, R.location("URL", F.concat(F.lit(" http://local.fedora.server/get/"), key)),
                          alt_ids="alt", format_uri="format:uri"),
            ]),
        ],
    )
    return rows.select(F.concat(F.lit("store/"), key).alias("path"), "o_orderkey", "o_orderstatus", xml.alias("xml"))


def _order_parsed(spark, d) -> DataFrame:
    return shred.parse_records(order_records(spark, d).select("path", "xml"))


def shred_objects(spark: SparkSession, d: str) -> DataFrame:
    return shred.shred_objects(stage(_order_parsed(spark, d).select("pid", "fedora_uri", "path", "problem"), "parsed"))


def shred_properties(spark: SparkSession, d: str) -> DataFrame:
    return shred.shred_properties(_order_parsed(spark, d))


def shred_datastreams(spark: SparkSession, d: str) -> DataFrame:
    return shred.shred_datastreams(_order_parsed(spark, d))


def shred_versions(spark: SparkSession, d: str) -> DataFrame:
    return shred.shred_versions(_order_parsed(spark, d), "repo.example.org:8080").select(
        "pid", "ds_id", "control_group", "state", "version_id", "label", "created", "mime_type", "alt_ids", "format_uri",
        "size", "digest_type", "digest_value", "content_kind", "content_ref", "inline_xml", "doc_pos",
        V.iso_instant(F.col("created_ts")).alias("created_again"),
    )


def record_ids(spark: SparkSession, d: str) -> DataFrame:
    """The cheap id extraction that selects records before they are parsed."""
    return order_records(spark, d).select("path", shred.record_pid(F.col("xml")).alias("pid"))


def unreadable_records(spark: SparkSession, d: str) -> DataFrame:
    """Records of pending orders are cut in half, those of open orders lose their id."""
    raw = order_records(spark, d)
    xml = (
        F.when(F.col("o_orderstatus") == "P", F.substring(F.col("xml"), F.lit(1), (F.length("xml") / 2).cast("int")))
        .when(F.col("o_orderstatus") == "O", F.regexp_replace("xml", ' PID="[^"]*"', ""))
        .otherwise(F.col("xml"))
    )
    parsed = shred.parse_records(raw.select("path", xml.alias("xml")))
    return shred.unreadable(stage(parsed.select("pid", "path", "problem"), "parsed"))


def structure_report(spark: SparkSession, d: str) -> DataFrame:
    """An unknown element, stray text and an unknown attribute, by order status."""
    raw = order_records(spark, d)
    close = F.lit("</foxml:digitalObject>")
    xml = (
        F.when(F.col("o_orderstatus") == "P", F.replace("xml", close, F.concat(F.lit("<foxml:extra/>"), close)))
        .when(F.col("o_orderstatus") == "O", F.replace("xml", close, F.concat(F.lit("stray"), close)))
        .otherwise(F.replace("xml", F.lit('ID="LINK"'), F.lit('ID="LINK" ODD="1"')))
    )
    parsed = shred.parse_records(raw.select("path", xml.alias("xml")))
    return shred.structure_report(stage(parsed.drop("datastreams", "properties"), "parsed"))


def misplaced_elements(spark: SparkSession, d: str) -> DataFrame:
    """Known elements where they may not stand, and a comment in a version, by order key; the other records are sound."""
    raw = order_records(spark, d)
    form, behind = F.col("o_orderkey") % 8, lambda tag, more: F.regexp_replace("xml", f'(<foxml:{tag}="LINK[^>]*>)', f"$1{more}")
    close = F.lit("</foxml:digitalObject>")
    xml = (
        F.when(form == 0, behind("datastream ID", '<foxml:contentDigest TYPE="MD5" DIGEST="x"/>'))
        .when(form == 1, behind("datastreamVersion ID", '<foxml:datastream ID="IN"/>'))
        .when(form == 2, F.replace("xml", close, F.concat(F.lit('<foxml:datastreamVersion ID="X.0"/>'), close)))
        .when(form == 3, behind("datastream ID", '<foxml:datastream ID="IN"/>'))
        .when(form == 4, F.regexp_replace("xml", "(?s)<foxml:objectProperties>.*</foxml:objectProperties>", ""))
        .when(form == 5, behind("datastreamVersion ID", "<!-- c -->"))
        .when(form == 6, F.replace("xml", F.lit("<note/>"), F.lit("<note><!-- c --><foxml:datastream/></note>")))
        .otherwise(F.col("xml"))
    )
    return shred.structure_report(shred.parse_records(raw.select("path", xml.alias("xml")))).select("pid", "structure_problem")


def version_problems(spark: SparkSession, d: str) -> DataFrame:
    raw = order_records(spark, d)
    xml = (
        F.when(F.col("o_orderstatus") == "P", F.replace("xml", F.lit('xml" SIZE="7"'), F.lit('xml" SIZE="seven"')))
        .when(F.col("o_orderstatus") == "O", F.replace("xml", F.lit(" http://local"), F.lit("gopher://local")))
        .otherwise(F.regexp_replace("xml", '(ID="PRICE.0"[^>]*CREATED=")[^"]*"', '$1soon"'))
    )
    parsed = shred.parse_records(raw.select("path", xml.alias("xml")))
    return shred.version_problems(shred.shred_versions(parsed))


def base64_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    rows = spread_rows(documents(spark, d))
    text = F.encode(F.col("text"), "UTF-8")
    xml = R.record(
        F.concat(F.lit("doc:"), F.col("doc_id").cast("string")), [],
        [R.datastream("TEXT", "M", "A", [R.version("TEXT.0", "2020-01-01T00:00:00.000Z", R.base64(text))])],
    )
    parsed = shred.parse_records(rows.select("doc_id", F.lit("").alias("path"), xml.alias("xml")))
    versions = shred.shred_versions(parsed, keep=["doc_id"])
    content = V.decode_base64(F.col("base64"))
    return versions.select("doc_id", "content_kind", F.length(content).cast("bigint").alias("n_bytes"), F.md5(content).alias("md5"))


def inline_bodies(spark: SparkSession, d: str) -> DataFrame:
    """Every turn as its own record: the inline text comes back exactly as it was written."""
    rows = spread_rows(table(spark, d, "conversations"))
    body = F.concat(F.lit('<turn role="'), F.col("role"), F.lit('">'), R.escape(F.col("text")), F.lit("<!-- end --></turn>"))
    xml = R.record(
        F.concat(F.lit("turn:"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")), [],
        [R.datastream("TURN", "X", "A", [R.version("TURN.0", "2020-01-01T00:00:00.000Z", R.inline(body))])],
    )
    parsed = shred.parse_records(rows.select("conv_id", "turn", F.lit("").alias("path"), xml.alias("xml")))
    return shred.shred_versions(parsed, keep=["conv_id", "turn"]).select(
        "conv_id", "turn", F.md5("inline_xml").alias("md5"), F.length("inline_xml").alias("n_chars")
    )


def _document_dc() -> F.Column:
    return R.dc([
        ("title", F.substring_index("text", "\n", 1)), ("description", F.col("text")),
        ("language", F.col("lang")), ("source", F.col("source")),
    ])


def extract_dc(spark: SparkSession, d: str) -> DataFrame:
    docs = spread_rows(documents(spark, d)).select("doc_id", _document_dc().alias("inline_xml"))
    return triples.extract_dc(docs).select(
        "doc_id", "element", "pos", F.md5("value").alias("value_md5"), F.length("value").alias("n_chars"), "parse_error"
    )


def dc_triples(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d).select("doc_id", R.dc([("language", F.col("lang")), ("source", F.col("source"))]).alias("inline_xml"))
    subject = F.concat(F.lit("info:fedora/doc:"), F.col("doc_id").cast("string"))
    return triples.dc_triples(triples.extract_dc(docs), ["doc_id"], subject)


REL = "info:fedora/fedora-system:def/relations-external#"


def _member_rdf() -> F.Column:
    nation = F.concat(F.lit("info:fedora/nation:"), F.col("c_nationkey").cast("string"))
    return R.rdf([(F.concat(F.lit("info:fedora/customer:"), F.col("c_custkey").cast("string")), [
        R.edge("isMemberOf", REL, resource=nation), R.edge("segment", "urn:rel#", value=F.col("c_mktsegment")),
    ])])


def rdf_triples(spark: SparkSession, d: str) -> DataFrame:
    rows = spread_rows(table(spark, d, "customer"), AT_ONCE).select("c_custkey", _member_rdf().alias("inline_xml"))
    return triples.extract_rdf(rows)


def rels_ext_asof(spark: SparkSession, d: str) -> DataFrame:
    """Sign-ups replace the relationships of their user; each event sees those in force."""
    rows = events(spark, d).select("user_id", "event_id", "ts", "event_type", "k")
    subject = F.concat(F.lit("info:fedora/user:"), F.col("user_id").cast("string"))
    signups = rows.where(F.col("event_type") == "signup").select(
        F.col("event_id").alias("rels_id"),
        R.rdf([(subject, [
            R.edge("isMemberOf", REL, resource=F.concat(F.lit("info:fedora/group:"), F.col("k").cast("string"))),
            R.edge("rank", "urn:rel#", value=F.col("k").cast("string")),
        ])]).alias("inline_xml"),
    )
    stated = triples.extract_rdf(signups).select("rels_id", "s", "p", "o")
    carried = history.asof_state(
        rows.drop("k"), ["user_id"], ["ts", "event_id"],
        {"rels_id": F.when(F.col("event_type") == "signup", F.col("event_id"))}, spread.by_day("ts"),
    )
    return carried.select("event_id", "rels_id").where(F.col("rels_id").isNotNull()).join(stated, "rels_id").select("event_id", "s", "p", "o")


def split_rels_int(spark: SparkSession, d: str) -> DataFrame:
    part = F.concat(F.lit("info:fedora/part:"), F.col("p_partkey").cast("string"))
    doc = R.rdf([
        (F.concat(part, F.lit("/FRONT")), [R.edge("downloadFilename", "info:fedora/fedora-system:def/model#", value=F.col("p_name"))]),
        (F.concat(part, F.lit("/BACK")), [R.edge("brand", "urn:rel#", value=F.col("p_brand")), R.edge("kind", "urn:rel#", value=F.col("p_type"))]),
    ])
    rows = spread_rows(table(spark, d, "part"), AT_ONCE).select("p_partkey", doc.alias("inline_xml"))
    return triples.split_rels_int(triples.extract_rdf(rows)).select("p_partkey", "resource_id", "p", "o")


def download_names(spark: SparkSession, d: str) -> DataFrame:
    part = F.concat(F.lit("info:fedora/part:"), F.col("p_partkey").cast("string"), F.lit("/FRONT"))
    space = "info:fedora/fedora-system:def/model#"
    doc = R.rdf([(part, [
        R.edge("downloadFilename", space, value=F.col("p_name")), R.edge("downloadFilename", space, value=F.col("p_brand")),
        R.edge("other", "urn:rel#", value=F.col("p_type")),
    ])])
    rows = spread_rows(table(spark, d, "part"), AT_ONCE).select("p_partkey", doc.alias("inline_xml"))
    return triples.download_names(triples.extract_rdf(rows), ["p_partkey"])


def validate_inline(spark: SparkSession, d: str) -> DataFrame:
    """Turns as inline documents whose stated digest is right for users and wrong for everyone else."""
    rows = spread_rows(table(spark, d, "conversations"))
    safe = F.replace(F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    body = F.concat(
        F.lit('\n<turn role="'), F.col("role"), F.lit('" conv="'), F.col("conv_id").cast("string"), F.lit('">'), safe,
        F.lit("\n  <end></end>\n</turn>"),
    )
    normal = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?><turn conv="'), F.col("conv_id").cast("string"), F.lit('" role="'),
        F.col("role"), F.lit('">'), F.regexp_replace(safe, r"[\x00-\x20]*\n[\x00-\x20]*", ""), F.lit("<end/></turn>"),
    )
    versions = rows.select(
        "conv_id", "turn", body.alias("inline_xml"),
        F.when(F.col("role") == "system", "DISABLED").otherwise("MD5").alias("digest_type"),
        F.when(F.col("role") == "assistant", F.lit("0" * 32)).otherwise(F.upper(F.md5(F.encode(normal, "UTF-8")))).alias("digest_value"),
    )
    return validate.validate_inline(versions).select("conv_id", "turn", "inline_status", "inline_actual")


def validate_content(spark: SparkSession, d: str) -> DataFrame:
    """Documents checked against a digest of an algorithm chosen by language; toxic ones state a wrong value."""
    labels = table(spark, d, "labels").select("doc_id", "toxic")
    docs = documents(spark, d).select("doc_id", "lang", "source", F.encode("text", "UTF-8").alias("content"))
    kind = (
        F.when(F.col("lang") == "en", "MD5").when(F.col("lang") == "fr", "SHA-1").when(F.col("lang") == "de", "SHA-256")
        .otherwise("DISABLED")
    )
    facts = docs.select(
        "doc_id",
        F.when(F.col("source") == "src0", "E").otherwise("M").alias("control_group"),
        F.lit("internal").alias("content_kind"),
        kind.alias("digest_type"),
        V.digest_by_name(kind, F.col("content")).alias("actual_digest"),
        F.col("source"),
    ).join(labels, "doc_id", "left")
    stated = (
        F.when(F.col("source") == "src1", F.lit(""))
        .when(F.col("toxic") == 1, F.lit("ffff"))
        .otherwise(F.coalesce(F.upper("actual_digest"), F.lit("none")))
    )
    return facts.withColumn("digest_value", stated).select(
        "doc_id", "digest_type", "actual_digest", validate.content_status().alias("status")
    )


def verify_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Listed documents against a store that lost the poor ones, changed the toxic ones and has strangers."""
    docs = documents(spark, d).select(F.concat(F.lit("docs/"), F.col("doc_id").cast("string")).alias("path"), "doc_id", F.md5("text").alias("digest"))
    labels = table(spark, d, "labels")
    kept = docs.join(labels, "doc_id", "left").where(F.coalesce(F.col("quality"), F.lit(1)) == 1)
    stored = kept.select("path", F.when(F.col("toxic") == 1, F.reverse("digest")).otherwise(F.upper("digest")).alias("digest"))
    strange = table(spark, d, "benchmark").select(
        F.concat(F.lit("bench/"), F.col("item_id").cast("string")).alias("path"), F.md5("text").alias("digest")
    )
    return validate.verify_manifest(docs.select("path", "digest"), stored.unionByName(strange), ["path"])


def partition_rejects(spark: SparkSession, d: str) -> DataFrame:
    failed = table(spark, d, "labels").where(F.col("quality") == 0).select(F.col("doc_id").alias("pid"))
    return rejects.partition_rejects(documents(spark, d).select(F.col("doc_id").alias("pid"), "lang", "n_chars"), failed, True)


def audit_events(spark: SparkSession, d: str) -> DataFrame:
    """Each event as an audit trail of two records."""
    def rec(name, action, component, why):
        return F.concat(
            F.lit('<audit:record ID="'), F.lit(name), F.lit('"><audit:process type="Fedora API-M"/><audit:action>'), action,
            F.lit("</audit:action><audit:componentID>"), component, F.lit("</audit:componentID><audit:responsibility>u"),
            F.col("user_id").cast("string"), F.lit("</audit:responsibility><audit:date>"), F.col("created"),
            F.lit("</audit:date><audit:justification>"), why, F.lit("</audit:justification></audit:record>\n"),
        )

    action = (
        F.when(F.col("event_type") == "purchase", "addDatastream").when(F.col("event_type") == "click", "modifyDatastreamByValue")
        .when(F.col("event_type") == "error", "purgeDatastream").otherwise("setDatastreamVersionable")
    )
    trail = F.concat(
        F.lit('<audit:auditTrail xmlns:audit="info:fedora/fedora-system:def/audit#">\n'),
        rec("R1", action, F.col("event_type"), F.lit("")),
        rec("R2", F.lit("modifyObject"), F.lit(""), F.when(F.col("k") < 50, "checksum validation").otherwise("other")),
        F.lit("</audit:auditTrail>"),
    )
    rows = spread_rows(events(spark, d)).select("event_id", trail.alias("inline_xml"))
    return audit.audit_events(rows, ["event_id"]).select(
        "event_id", "pos", "record_id", "process_type", "action", F.coalesce("component_id", F.lit("")).alias("component_id"),
        "responsibility", "date", F.coalesce("justification", F.lit("")).alias("justification"), "event_type",
    )


def internal_ids(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    root = F.when(F.col("c_nationkey") < 5, "info%3Aother%2F").otherwise("info%3Afedora%2F")
    rows = table(spark, d, "customer").select(
        "c_custkey",
        F.concat(root, F.lit("demo%3A"), key, F.lit("%2FDS1%2FDS1.0")).alias("encoded"),
        F.concat(F.lit("demo_"), key, F.lit("+DS_1+DS_1.0")).alias("legacy"),
    )
    return rows.select(
        "c_custkey", ids.internal_id_akubra(F.col("encoded")).alias("akubra_id"), ids.internal_id_legacy(F.col("legacy")).alias("legacy_id")
    )


def host_rewrite(spark: SparkSession, d: str) -> DataFrame:
    placed = F.regexp_replace("url", "^(https?)://[^/]*", "$1://local.fedora.server")
    return table(spark, d, "pages").select("page_id", V.rewrite_local_host(placed, "repo.example.org:8080").alias("url"))


def self_urls(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("page_id").cast("string")
    url = (
        F.when(F.col("url").contains("/en/"), F.concat(F.lit("http://localhost:8080/fedora/get/page:"), key, F.lit("/DS/1")))
        .when(F.col("url").contains("/fr/"), F.concat(F.lit("http://localhost:8080/fedora/objects/page:"), key, F.lit("/datastreams/DS/content")))
        .when(F.col("url").contains("/de/"), F.concat(F.lit("http://localhost:8080/fedora/search/"), key))
        .otherwise(F.col("url"))
    )
    rows = table(spark, d, "pages").select("page_id", url.alias("url"))
    mapped = V.map_self_url(
        F.col("url"), "localhost:8080", "http://new.example.org/rest", lambda pid, ds: F.concat(F.lit("/"), pid, F.lit("/"), ds)
    )
    return rows.select("page_id", mapped.alias("mapped"), mapped.isNull().alias("unhandled"))


def detect_mime(spark: SparkSession, d: str) -> DataFrame:
    """Pages with and without a declared type, some stored as other formats."""
    head = F.when(F.col("url").startswith("https"), F.encode("html", "UTF-8")).otherwise(
        F.encode(F.concat(F.lit("%PDF-1.4 "), F.col("html")), "UTF-8")
    )
    declared = F.when(F.col("url").contains("/fr/"), "text/x-own").when(F.col("url").contains("/de/"), "")
    name = F.when(F.col("url").contains("html"), F.concat(F.lit("page"), F.col("page_id").cast("string"), F.lit(".html"))).otherwise(F.lit("PAGE"))
    return table(spark, d, "pages").select("page_id", mime.detect_mime(declared, F.substring(head, 1, mime.MAGIC_BYTES), name).alias("mime"))


QUERIES = {
    f.__name__: f
    for f in (
        shred_objects, shred_properties, shred_datastreams, shred_versions, record_ids, unreadable_records, structure_report, misplaced_elements,
        version_problems, base64_roundtrip, inline_bodies, extract_dc, dc_triples, rdf_triples, rels_ext_asof, split_rels_int,
        download_names, validate_inline, validate_content, verify_manifest, partition_rejects, audit_events, internal_ids,
        host_rewrite, self_urls, detect_mime,
    )
}

_C = "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%fZ')"
_L = "strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S.%fZ')"
_PID = "'order:' || o_orderkey"
_WORD = "CASE o_orderstatus WHEN 'F' THEN 'Deleted' WHEN 'P' THEN 'Inactive' ELSE 'Active' END"
_PRICE = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"
_EVC = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"
_EVK = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"
_XS = M.XSD_STRING
_MODEL = "info:fedora/fedora-system:def/model#"


def _ds(pos: int, ds: str, group: str, state: str, versionable: str) -> str:
    return f"""SELECT {_PID} AS pid, '{ds}' AS ds_id, '{group}' AS control_group, CAST(NULL AS VARCHAR) AS fedora_uri,
    {state} AS state, {versionable} AS versionable, CAST({pos} AS INTEGER) AS doc_pos FROM orders"""


def _ver(**v: str) -> str:
    names = ("ds_id", "control_group", "state", "version_id", "label", "created", "mime_type", "alt_ids", "format_uri", "size",
             "digest_type", "digest_value", "content_kind", "content_ref", "inline_xml", "doc_pos")
    casts = {"size": "BIGINT", "doc_pos": "BIGINT"}
    cols = ", ".join(f"CAST({v.get(n, 'NULL')} AS {casts.get(n, 'VARCHAR')}) AS {n}" for n in names)
    return f"SELECT {_PID} AS pid, {cols}, {v['created']} AS created_again FROM orders"


_ROOM = shred.VERSION_ROOM
_TURN_SAFE = "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_TURN_ESC = (
    "replace(replace(replace(replace(" + _TURN_SAFE + ", '\"', '&quot;'), chr(10), '&#10;'), chr(13), '&#13;'), chr(9), '&#9;')"
)
_TURN_NORMAL = (
    "'<?xml version=\"1.0\" encoding=\"UTF-8\"?><turn conv=\"' || conv_id || '\" role=\"' || role || '\">' || "
    "regexp_replace(" + _TURN_SAFE + ", '[\\x00-\\x20]*\\n[\\x00-\\x20]*', '', 'g') || '<end/></turn>'"
)
_ACTION = """CASE event_type WHEN 'purchase' THEN 'addDatastream' WHEN 'click' THEN 'modifyDatastreamByValue'
  WHEN 'error' THEN 'purgeDatastream' ELSE 'setDatastreamVersionable' END"""

ORACLE = {
    "shred_objects": f"SELECT {_PID} AS pid, CAST(NULL AS VARCHAR) AS fedora_uri, 'store/' || o_orderkey AS path FROM orders",
    "shred_properties": " UNION ALL ".join(
        f"SELECT {_PID} AS pid, CAST({i} AS INTEGER) AS pos, '{name}' AS name, {value} AS value FROM orders"
        for i, (name, value) in enumerate([
            (M.STATE_PROPERTY, _WORD), (_MODEL + "label", "'<\"Order\"> & ' || o_orderkey"), (_MODEL + "ownerId", "''"),
            (_MODEL + "createdDate", _C), ("info:fedora/fedora-system:def/view#lastModifiedDate", _L),
        ])
    ),
    "shred_datastreams": " UNION ALL ".join([
        _ds(0, "NOTE", "X", "'A'", "true"), _ds(1, "PRICE", "M", "o_orderstatus", "false"), _ds(2, "LINK", "E", "'A'", "true"),
    ]),
    "shred_versions": " UNION ALL ".join([
        _ver(ds_id="'NOTE'", control_group="'X'", state="'A'", version_id="'NOTE.0'", label="' a note '", created=_C,
             mime_type="'text/xml'", size="-1", content_kind="'inline'", doc_pos="0",
             inline_xml="chr(10) || '<note  b=\"2\" a=\"1\">' || chr(10) || '  ' || o_orderpriority || chr(10) || '</note>' || chr(10)"),
        _ver(ds_id="'NOTE'", control_group="'X'", state="'A'", version_id="'NOTE.1'", created=_L, mime_type="'text/xml'", size="7",
             content_kind="'inline'", doc_pos="1", inline_xml="chr(10) || '<note/>' || chr(10)"),
        _ver(ds_id="'PRICE'", control_group="'M'", state="o_orderstatus", version_id="'PRICE.0'", label="'price'", created=_C,
             mime_type="'text/plain'", size=f"length({_PRICE})", digest_type="'MD5'", digest_value=f"md5({_PRICE})",
             content_kind="'internal'", content_ref=f"{_PID} || '+PRICE+PRICE.0'", doc_pos=str(_ROOM)),
        _ver(ds_id="'LINK'", control_group="'E'", state="'A'", version_id="'LINK.0'", created=_L, alt_ids="'alt'",
             format_uri="'format:uri'", size="-1", content_kind="'url'",
             content_ref="'http://repo.example.org:8080/get/' || o_orderkey", doc_pos=str(2 * _ROOM)),
    ]),
    "record_ids": f"SELECT 'store/' || o_orderkey AS path, {_PID} AS pid FROM orders",
    "unreadable_records": f"""
SELECT CASE o_orderstatus WHEN 'P' THEN {_PID} END AS pid, 'store/' || o_orderkey AS path, 'unreadable' AS stage,
       CASE o_orderstatus WHEN 'P' THEN 'malformed record' ELSE 'record without PID' END AS message
FROM orders WHERE o_orderstatus IN ('P', 'O')""",
    "structure_report": f"""
SELECT {_PID} AS pid, 'store/' || o_orderkey AS path,
       CASE o_orderstatus WHEN 'P' THEN 'element not known here: extra' WHEN 'O' THEN 'text outside of elements' END AS structure_problem,
       CASE o_orderstatus WHEN 'P' THEN '' WHEN 'O' THEN '' ELSE 'ODD' END AS unexpected_attributes FROM orders""",
    "misplaced_elements": f"""
SELECT {_PID} AS pid, CASE o_orderkey % 8 WHEN 0 THEN 'element out of place: contentDigest in datastream' WHEN 1 THEN 'element out of place: datastream in datastreamVersion'
  WHEN 2 THEN 'element out of place: datastreamVersion in digitalObject' WHEN 3 THEN 'element out of place: datastream in datastream'
  WHEN 4 THEN 'element in the place of the properties: datastream' ELSE 'comment or instruction in the record' END AS structure_problem
FROM orders WHERE o_orderkey % 8 < 6""",
    "version_problems": f"""
SELECT {_PID} AS pid, CASE o_orderstatus WHEN 'P' THEN 'NOTE' WHEN 'O' THEN 'LINK' ELSE 'PRICE' END AS ds_id,
       CASE o_orderstatus WHEN 'P' THEN 'NOTE.1' WHEN 'O' THEN 'LINK.0' ELSE 'PRICE.0' END AS version_id,
       CASE o_orderstatus WHEN 'P' THEN 'invalid SIZE in NOTE.1' WHEN 'O' THEN 'malformed URL gopher://fedora.info/get/' || o_orderkey
         ELSE 'invalid CREATED in PRICE.0' END AS message FROM orders""",
    "base64_roundtrip": """
SELECT doc_id, 'base64' AS content_kind, CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes, md5(text) AS md5 FROM documents""",
    "inline_bodies": f"""
SELECT conv_id, turn, md5(body) AS md5, CAST(length(body) AS INTEGER) AS n_chars FROM (
  SELECT conv_id, turn, chr(10) || '<turn role="' || role || '">' || {_TURN_ESC} || '<!-- end --></turn>' || chr(10) AS body
  FROM conversations)""",
    "extract_dc": " UNION ALL ".join(
        f"SELECT doc_id, '{M.DC_NS}{name}' AS element, CAST({i} AS INTEGER) AS pos, md5({v}) AS value_md5, "
        f"CAST(length({v}) AS INTEGER) AS n_chars, CAST(NULL AS VARCHAR) AS parse_error FROM documents"
        for i, (name, v) in enumerate([
            ("title", "split_part(text, chr(10), 1)"), ("description", "text"), ("language", "lang"), ("source", "source"),
        ])
    ),
    "dc_triples": " UNION ALL ".join(
        f"SELECT doc_id, 'info:fedora/doc:' || doc_id AS s, '{M.DC_NS}{name}' AS p, {v} AS o, 'literal' AS o_kind, "
        f"'{_XS}' AS o_datatype, CAST(NULL AS VARCHAR) AS o_lang FROM documents"
        for name, v in [("language", "lang"), ("source", "source")]
    ),
    "rdf_triples": f"""
SELECT c_custkey, 'info:fedora/customer:' || c_custkey AS s, '{REL}isMemberOf' AS p, 'info:fedora/nation:' || c_nationkey AS o,
       'uri' AS o_kind, CAST(NULL AS VARCHAR) AS o_datatype, CAST(NULL AS VARCHAR) AS o_lang, CAST(NULL AS VARCHAR) AS parse_error
FROM customer UNION ALL
SELECT c_custkey, 'info:fedora/customer:' || c_custkey, 'urn:rel#segment', c_mktsegment, 'literal', '{_XS}', NULL, NULL FROM customer""",
    "rels_ext_asof": f"""
WITH c AS (SELECT user_id, event_id, last_value(CASE WHEN event_type = 'signup' THEN {_EVK} END IGNORE NULLS) OVER (
  PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k FROM events)
SELECT event_id, 'info:fedora/user:' || user_id AS s, '{REL}isMemberOf' AS p, 'info:fedora/group:' || k AS o FROM c WHERE k IS NOT NULL
UNION ALL
SELECT event_id, 'info:fedora/user:' || user_id, 'urn:rel#rank', CAST(k AS VARCHAR) FROM c WHERE k IS NOT NULL""",
    "split_rels_int": " UNION ALL ".join(
        f"SELECT p_partkey, 'info:fedora/part:' || p_partkey || '/{ds}/fcr:metadata' AS resource_id, '{p}' AS p, {o} AS o FROM part"
        for ds, p, o in [("FRONT", M.DOWNLOAD_NAME, "p_name"), ("BACK", "urn:rel#brand", "p_brand"), ("BACK", "urn:rel#kind", "p_type")]
    ),
    "download_names": """
SELECT p_partkey, 'info:fedora/part:' || p_partkey || '/FRONT' AS subject, least(p_name, p_brand) AS download_name FROM part""",
    "validate_inline": f"""
SELECT conv_id, turn,
       CASE role WHEN 'system' THEN 'skipped' WHEN 'assistant' THEN 'mismatch' ELSE 'ok' END AS inline_status,
       CASE WHEN role <> 'system' THEN md5({_TURN_NORMAL}) END AS inline_actual FROM conversations""",
    "validate_content": """
WITH f AS (
  SELECT d.doc_id, source, toxic,
    CASE lang WHEN 'en' THEN 'MD5' WHEN 'fr' THEN 'SHA-1' WHEN 'de' THEN 'SHA-256' ELSE 'DISABLED' END AS digest_type,
    CASE lang WHEN 'en' THEN md5(text) WHEN 'fr' THEN sha1(text) WHEN 'de' THEN sha256(text) END AS actual_digest
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT doc_id, digest_type, actual_digest,
  CASE WHEN source = 'src0' THEN 'skipped' WHEN source = 'src1' THEN 'missing' WHEN digest_type = 'DISABLED' THEN 'unknown_algorithm'
       WHEN toxic = 1 THEN 'mismatch' ELSE 'ok' END AS status FROM f""",
    "verify_manifest": """
WITH s AS (
  SELECT 'docs/' || d.doc_id AS path, CASE WHEN toxic = 1 THEN reverse(md5(text)) ELSE upper(md5(text)) END AS actual
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE coalesce(quality, 1) = 1
  UNION ALL SELECT 'bench/' || item_id, md5(text) FROM benchmark),
m AS (SELECT 'docs/' || doc_id AS path, md5(text) AS expected FROM documents)
SELECT coalesce(m.path, s.path) AS path, expected, actual,
  CASE WHEN actual IS NULL THEN 'missing' WHEN expected IS NULL THEN 'extra' WHEN lower(expected) = lower(actual) THEN 'ok' ELSE 'mismatch' END AS status
FROM m FULL JOIN s ON m.path = s.path""",
    "partition_rejects": "SELECT doc_id AS pid, lang, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)",
    "audit_events": f"""
SELECT event_id, CAST(0 AS INTEGER) AS pos, 'R1' AS record_id, 'Fedora API-M' AS process_type, {_ACTION} AS action,
  event_type AS component_id, 'u' || user_id AS responsibility, {_EVC} AS date, '' AS justification,
  CASE event_type WHEN 'purchase' THEN 'premis:ing' WHEN 'click' THEN 'audit:contentModification/metadataModification'
    WHEN 'error' THEN 'audit:contentRemoval' END AS event_type FROM events
UNION ALL
SELECT event_id, 1, 'R2', 'Fedora API-M', 'modifyObject', '', 'u' || user_id, {_EVC},
  CASE WHEN {_EVK} < 50 THEN 'checksum validation' ELSE 'other' END,
  CASE WHEN {_EVK} < 50 THEN 'premis:validation' ELSE 'audit:resourceModification' END FROM events""",
    "internal_ids": """
SELECT c_custkey, CASE WHEN c_nationkey >= 5 THEN 'demo:' || c_custkey || '+DS1+DS1.0' END AS akubra_id,
       'demo:' || c_custkey || '+DS_1+DS_1.0' AS legacy_id FROM customer""",
    "host_rewrite": """
SELECT page_id, regexp_replace(url, '^(https?)://[^/]*', '\\1://repo.example.org:8080') AS url FROM pages""",
    "self_urls": """
SELECT page_id,
  CASE WHEN contains(url, '/en/') THEN 'http://new.example.org/rest/page:' || page_id || '/DS/1'
       WHEN contains(url, '/fr/') THEN 'http://new.example.org/rest/page:' || page_id || '/DS'
       WHEN contains(url, '/de/') THEN NULL ELSE url END AS mapped,
  NOT contains(url, '/en/') AND NOT contains(url, '/fr/') AND contains(url, '/de/') AS unhandled FROM pages""",
    "detect_mime": """
SELECT page_id, CASE WHEN contains(url, '/fr/') THEN 'text/x-own' WHEN NOT starts_with(url, 'https') THEN 'application/pdf'
  ELSE 'text/html' END AS mime FROM pages""",
}

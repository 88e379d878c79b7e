"""One migration run: records in, tables of target resources out.

Four stages are written once to the shared folder and read back, because several later steps start from
each: the parsed records, the datastream versions with their content facts, the relationship and element
statements, and the resource writes. Windows partition by source object, which one record file bounds.
Content bytes and record texts are never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from muniment import model as M
from muniment.functions import ids, mime
from muniment.functions import values as V
from muniment.model import RunOptions
from muniment.operators import filenames, headers, history, inventory, lifecycle, rejects, report, resolve, select, shred, spread, triples, validate
from muniment.operators.rejects import as_rejects
from muniment.session import stage
from muniment.sources import content as content_source
from muniment.sources import records as record_source
from muniment.sources import sinks


@dataclass(frozen=True)
class Facts:
    """What the records say, before anything is derived from it."""

    parsed: DataFrame
    objects: DataFrame
    versions: DataFrame
    rels: DataFrame | None
    dc: DataFrame | None


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def scan_positions(spark: SparkSession, opts: RunOptions, found: DataFrame) -> DataFrame:
    """(path, pid, position) of every record of the scan that has an id, in path order: written once, so that whatever a run selects keeps its absolute position."""
    return stage(select.with_positions(found.where(F.col("pid").isNotNull()).select("path", "pid"), ["path"]), "scan-positions")


def finished(spark: SparkSession, opts: RunOptions, existing: DataFrame | None) -> DataFrame | None:
    """What is done already, as a ledger: entries of the ledger, and objects of published runs that died before theirs was written."""
    ledger = record_source.read_ledger(spark, opts.ledger_dir)
    if existing is None:
        return ledger
    stored = existing.where(F.col("object_id").startswith(opts.id_prefix)).select(
        F.substring("object_id", len(opts.id_prefix) + 1, 2**31 - 1).alias("pid"), F.lit(None).cast("bigint").alias("position"), F.lit("done").alias("status"))
    return stored if ledger is None else ledger.select("pid", "position", "status").unionByName(stored)


def select_records(spark: SparkSession, opts: RunOptions, raw: DataFrame | None, existing: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Raw records of the run, and the positions of the whole scan where a selection or a ledger needs them.

    A selection works on ids and paths; records without an id stay in, to be rejected.
    """
    if raw is None:
        raw = record_source.scan_records(spark, opts.exported_dir or opts.objects_dir, opts.name_regex)
    whole = opts.limit < 0 and not opts.pid_file and not opts.resume
    whole = whole and opts.resume_position == 0 and opts.resume_last_id.lower() == select.FIRST_RUN
    if whole and not opts.target_dir:
        return raw, None
    found = stage(record_source.scan_record_ids(raw), "record-ids")
    placed = scan_positions(spark, opts, found)
    if whole:
        return raw, placed
    chosen = select.select_objects(
        placed.select("path", "pid"), "pid", ["path"], opts.limit,
        record_source.read_pid_list(spark, opts.pid_file) if opts.pid_file else None,
        opts.resume_position, opts.resume_last_id, opts.resume, finished(spark, opts, existing),
    )
    taken = chosen.select("path").union(found.where(F.col("pid").isNull()).select("path"))
    return raw.join(taken, "path", "left_semi"), placed


def _bits(opts: RunOptions) -> int:
    return int(opts.digest_algorithm.removeprefix("sha"))


def _version_facts(opts: RunOptions, parsed: DataFrame) -> DataFrame:
    """Versions with digest, size and leading bytes of the content that sits in the record itself."""
    rows = shred.shred_versions(parsed, opts.local_host, keep=["path"])
    decoded = V.decode_base64(F.col("base64"))
    external = V.is_external(F.col("control_group"))
    body = (
        F.when(F.col("content_kind") == "inline", F.encode("inline_xml", "UTF-8"))
        .when(F.col("content_kind") == "base64", decoded)
    )
    if opts.plain:
        body = F.when(external & (F.col("content_kind") == "url"), F.encode("content_ref", "UTF-8")).otherwise(body)
    return (
        rows.withColumn("_body", body)
        .withColumn("own_bytes", F.length("_body").cast("bigint"))
        .withColumn("own_head", F.substring("_body", 1, mime.MAGIC_BYTES))
        .withColumn("own_digest", F.sha2("_body", _bits(opts)))
        .withColumn("own_actual", F.when(F.col("content_kind") == "base64", V.digest_by_name(F.col("digest_type"), F.col("_body"))))
        .drop("_body")
    )


def read_facts(spark: SparkSession, opts: RunOptions, raw: DataFrame, index: DataFrame | None = None) -> Facts:
    own = F.col(f"sha{_bits(opts)}") if f"sha{_bits(opts)}" in raw.columns else F.sha2(F.encode("xml", "UTF-8"), _bits(opts))
    raw = raw.select(
        "path", "xml", "length", *[c for c in raw.columns if c == "text_problem"], *([own.alias("record_digest")] if opts.foxml_file else [])
    )
    parsed = stage(shred.parse_records(raw), "parsed")
    whole = _version_facts(opts, parsed)
    facts = validate.validate_inline(whole).drop("inline_xml", "base64")
    scanned = index is None and opts.source_profile != "exported" and bool(opts.datastreams_dir)
    algorithms = sorted({opts.digest_algorithm} | (_needed_algorithms(parsed, opts) if scanned or index is not None else set()))
    if scanned:
        index = content_source.content_index(spark, opts.datastreams_dir, opts.source_profile, algorithms, opts.index_dir)
    facts = _with_content(opts, facts, index, algorithms)
    versions = stage(facts, "versions")
    created, modified = headers.property_dates(F.col("properties"))
    objects = shred.readable(parsed).select(
        "path", "pid", "fedora_uri", "properties", "length",
        lifecycle.object_state(F.col("properties")).alias("object_state"),
        created.alias("created_text"), modified.alias("modified_text"),
        *(["record_digest"] if opts.foxml_file else []),
    )
    rels = dc = None
    if not opts.foxml_file:
        documents = _documents(whole, versions)
        rels = stage(triples.extract_rdf(documents.where(F.col("ds_id").isin(M.RELS_EXT, M.RELS_INT)), "text"), "rels")
        if not opts.disable_dc:
            dc = stage(triples.extract_dc(documents.where(F.col("ds_id") == M.DC_DS), "text"), "dc")
    return Facts(parsed, objects, versions, rels, dc)


def _needed_algorithms(parsed: DataFrame, opts: RunOptions) -> set[str]:
    """Digest columns the index must carry: at most one per known algorithm, whatever the records say."""
    if opts.disable_checksum_validation:
        return set()
    kinds = parsed.select(F.explode("stored_digest_types").alias("type")).where(V.known_algorithm(F.col("type"))).select(F.upper("type").alias("kind")).distinct()
    return {V.INDEX_COLUMNS[row["kind"]] for row in kinds.collect()}


def _with_content(opts: RunOptions, facts: DataFrame, index: DataFrame | None, algorithms: list[str]) -> DataFrame:
    internal = F.col("content_kind") == "internal"
    if index is None:
        resolved = facts.withColumn("resolution", F.when(internal, "unresolved"))
        for name, kind in (("content_path", "string"), ("length", "bigint"), ("head", "binary"), ("inside", "string")):
            resolved = resolved.withColumn(name, F.lit(None).cast(kind))
        stored_digest = stored_actual = F.lit(None).cast("string")
    else:
        wanted = facts.withColumn("internal_id", F.when(internal, F.col("content_ref")))
        inside = F.col("inside") if "inside" in index.columns else F.lit(None).cast("string")
        slim = index.select("internal_id", "path", "length", "head", inside.alias("inside"), *algorithms)
        rest = wanted.where(~internal).drop("internal_id")
        # Only internal references travel to the index; all other versions keep their place.
        joined = resolve.resolve_content(
            wanted.where(internal).withColumnRenamed("path", "_record"), slim).withColumnRenamed("path", "content_path").withColumnRenamed("_record", "path").drop("internal_id", "n_files")
        resolved = joined.unionByName(rest, allowMissingColumns=True)
        stored_digest = F.col(opts.digest_algorithm)
        stored_actual = validate.indexed_digest(columns=algorithms)
    out = (
        resolved.withColumn("actual_digest", F.when(internal, stored_actual).otherwise(F.col("own_actual")))
        .withColumn("target_digest", F.when(internal, stored_digest).otherwise(F.col("own_digest")))
        .withColumn("bytes", F.when(internal, F.col("length")).otherwise(F.col("own_bytes")))
        .withColumn("declared_mime", F.col("mime_type"))
        .withColumn("mime_type", mime.detect_mime(F.col("mime_type"), F.coalesce("own_head", "head"), F.col("ds_id"), F.col("inside")))
        .withColumn("content_status", validate.content_status(not opts.disable_checksum_validation))
    )
    return out.drop("length", "head", "inside", "own_bytes", "own_head", "own_digest", "own_actual", *(algorithms if index is not None else []))


def _documents(whole: DataFrame, versions: DataFrame) -> DataFrame:
    """Texts of the element-set and relationship datastreams, wherever they are kept."""
    keys = ["path", "pid", "ds_id", "created", "doc_pos"]
    named = F.col("ds_id").isin(M.DC_DS, M.RELS_EXT, M.RELS_INT)
    own = whole.where(named & (F.col("content_kind") != "internal")).select(
        *keys, F.coalesce("inline_xml", V.decode_base64(F.col("base64")).cast("string")).alias("text")
    )
    stored = versions.where(named & (F.col("content_kind") == "internal")).select(*keys, "content_path")
    return own.unionByName(content_source.read_texts(stored, "content_path", "text").drop("content_path"))


# --- Rejects -------------------------------------------------------------------------------------


def find_warnings(facts: Facts) -> DataFrame:
    """What a run reports without failing: odd attributes, and content that could not be checked."""
    odd = facts.parsed.where(F.size("unexpected_attributes") > 0)
    unchecked = facts.versions.where(F.col("content_status").isin("missing", "unknown_algorithm", "unread"))
    return _union([
        as_rejects(odd, "attributes", F.concat(F.lit("unexpected attributes: "), F.array_join("unexpected_attributes", ","))),
        as_rejects(unchecked, "content digest", F.concat(F.col("content_status"), F.lit(": "), F.col("pid"), F.lit("/"), F.col("ds_id"))),
    ])


def find_rejects(opts: RunOptions, facts: Facts, renames: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Everything that makes an object fail, one row per reason, keyed by the path of its record."""
    objects, versions = facts.objects, facts.versions
    text = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    found = [shred.unreadable(facts.parsed).transform(as_rejects, "unreadable")]
    readable = shred.readable(facts.parsed)
    found.append(as_rejects(readable.where(F.col("structure_problem").isNotNull()), "structure", F.col("structure_problem")))
    found.append(as_rejects(shred.inline_count_problems(readable), "structure"))
    found.append(as_rejects(shred.version_problems(versions), "version"))
    found.append(as_rejects(objects.where(F.col("object_state").isNull()), "state", text("no state property in ", F.col("pid"))))
    for name in ("created_text", "modified_text"):
        bad = F.col(name).isNotNull() & V.parse_instant(F.col(name)).isNull()
        found.append(as_rejects(objects.where(bad), "property", text("invalid date ", F.col(name))))
    # A second record with the same id would meet the first one's target: the first in path order stays.
    first = objects.groupBy("pid").agg(F.min("path").alias("_first"))
    doubles = objects.select("pid", "path").join(first, "pid").where(F.col("path") != F.col("_first"))
    found.append(as_rejects(doubles, "conflict", text("a second record for ", F.lit(opts.id_prefix), F.col("pid"))))
    if existing is not None:
        there = objects.withColumn("object_id", ids.object_resource(F.col("pid"), opts.id_prefix))
        found.append(as_rejects(resolve.conflicts(there, existing, "object_id"), "conflict", text("the target already holds ", F.col("object_id"))))
    place = text(F.col("pid"), "/", F.col("ds_id"))
    found.append(as_rejects(
        versions.where(F.col("inline_status") == "mismatch"), "inline digest",
        text("inline text of ", place, " has ", F.coalesce("digest_type", F.lit("")), " ", F.coalesce("inline_actual", F.lit("none")), ", the record says ", F.coalesce("digest_value", F.lit(""))),
    ))
    found.append(as_rejects(versions.where(F.col("inline_status") == "unsupported"), "inline form", text("inline text of ", place, " has no normal form here, so its digest can't be checked")))
    found.append(as_rejects(
        versions.where(F.col("content_status") == "mismatch"), "content digest",
        text("content of ", place, " has digest ", F.col("actual_digest"), ", the record says ", F.col("digest_value")),
    ))
    lost = F.col("resolution").isin("unresolved", "ambiguous")
    found.append(as_rejects(versions.where(lost), "content", text(F.col("resolution"), " internal id ", F.col("content_ref"))))
    for table in (facts.rels, facts.dc):
        if table is not None:
            failed = table.where(F.col("parse_error").isNotNull())
            found.append(as_rejects(failed, "document", text(F.col("parse_error"), " in ", F.col("pid"), "/", F.col("ds_id"))))
    found.append(as_rejects(_date_disagreements(versions), "version", text("no creation date for ", F.col("ds_id"), " at ", F.col("created"))))
    if not opts.plain and facts.rels is not None:
        foreign = _stated_names(facts).where(~_is_own(F.col("subject"), opts))
        found.append(as_rejects(foreign, "missing_resource", text("name for a resource of another object: ", F.col("subject"))))
    if not opts.plain:
        missing = renames.where(F.col("missing")).select("path", "pid", "ds_id")
        found.append(as_rejects(missing, "missing_resource", text("name for a datastream that does not exist yet: ", F.col("ds_id"))))
    return _union(found).distinct()


def _date_disagreements(versions: DataFrame) -> DataFrame:
    """Versions that come first as text although another version of their datastream is older as an instant."""
    w = Window.partitionBy("path", "ds_id")
    first = F.min_by("created", F.struct("created_ts", "doc_pos")).over(w)
    return versions.select("path", "pid", "ds_id", "created", first.alias("_first")).where(F.col("created") < F.col("_first"))


# --- Derivation ------------------------------------------------------------------------------------


def find_renames(opts: RunOptions, facts: Facts) -> DataFrame:
    """Filename history of every binary (see ``filenames``), keyed by record path."""
    versions = facts.versions
    content = versions.select("path", "pid", F.col("created").alias("version"), F.col("doc_pos").alias("pos"), "ds_id", "label", "mime_type")
    rels = content.where(F.col("ds_id") == M.RELS_INT).select("path", "version", "pos")
    if facts.rels is None:
        names = content.limit(0).select("path", "version", "pos", "ds_id", F.lit("").alias("download_name"))
        rels = rels.limit(0)
    else:
        names = _own_subjects(_stated_names(facts), "subject", opts).select(
            "path", F.col("created").alias("version"), F.col("doc_pos").alias("pos"), F.col("subject_ds").alias("ds_id"), "download_name"
        )
    made = filenames.filename_history(content.drop("pid"), rels, names, "path", opts.add_extensions)
    return made.join(facts.objects.select("path", "pid"), "path")


def _stated_names(facts: Facts) -> DataFrame:
    """File names that relationship documents state, whatever they are about."""
    return triples.download_names(
        facts.rels.where((F.col("ds_id") == M.RELS_INT) & F.col("parse_error").isNull()), ["path", "pid", "created", "doc_pos"]
    )


def _is_own(subject: Column, opts: RunOptions) -> Column:
    """Whether a subject is the object itself or one of its resources."""
    own = F.concat(F.lit(opts.id_prefix), F.col("pid"))
    return (subject == own) | subject.startswith(F.concat(own, F.lit("/")))


def _own_subjects(df: DataFrame, subject: str, opts: RunOptions) -> DataFrame:
    """Rows whose subject is a datastream of their own object, with its id as ``subject_ds``."""
    root = F.concat(F.lit(opts.id_prefix), F.col("pid"), F.lit("/"))
    return df.where(F.col(subject).startswith(root)).withColumn(
        "subject_ds", F.substring(F.col(subject), F.length(root) + 1, F.length(F.col(subject)))
    )


def _contents(versions: DataFrame) -> DataFrame:
    """One content write per datastream and version, with its datastream's creation date."""
    by_time = Window.partitionBy("path", "ds_id").orderBy("created_ts", "doc_pos")
    last = Window.partitionBy("path", "ds_id", "created").orderBy(F.desc("doc_pos"))
    return (
        versions.withColumn("create_date", F.first("created").over(by_time))
        .withColumn("create_ts", F.first("created_ts").over(by_time))
        .withColumn("_last", F.row_number().over(last))
        .where(F.col("_last") == 1)
        .drop("_last")
    )


_CONTENT = (
    "pid", "control_group", "state", "version_id", "label", "created", "created_ts", "create_date", "create_ts", "mime_type",
    "declared_mime", "format_uri", "size", "digest_type", "digest_value", "content_kind", "content_ref", "content_path", "bytes", "target_digest",
)


def _spine(contents: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """Content versions and other events per datastream, each row with the content in force (``_c``)."""
    own = contents.select("path", "ds_id", F.col("created").alias("version"), F.struct(*_CONTENT).alias("_own"))
    rows = own.join(other, ["path", "ds_id", "version"], how)
    return history.asof_state(rows, ["path", "ds_id"], ["version"], {"_c": F.col("_own")})


_WRITE = (
    "path", "pid", "object_id", "resource_id", "version_date", "kind", "logical_path", "headers", "header_only", "deleted",
    "content_kind", "source", "bytes", "digest", "nt", "ds_state",
)


def _write_rows(df: DataFrame, opts: RunOptions, kind: str, **given: Column) -> DataFrame:
    obj = ids.object_resource(F.col("pid"), opts.id_prefix)
    resource = F.col("headers.resource_id")
    ds_resource = F.regexp_replace(resource, M.DESCRIPTION_SUFFIX + "$", "")
    target = obj if not opts.atomic or kind in ("container", "foxml") else ds_resource
    made = {
        "object_id": target, "resource_id": resource, "kind": F.lit(kind),
        "logical_path": ids.storage_path(target, resource, F.col("headers.model")),
        "header_only": F.lit(False), "deleted": F.lit(False), "source": F.lit(None).cast("string"), "nt": F.lit(None).cast("string"),
        "content_kind": F.lit("nt"), "ds_state": F.lit(None).cast("string"), **given,
    }
    if kind in ("container", "description"):
        made["bytes"] = F.octet_length("nt").cast("bigint")
        made["digest"] = F.sha2(F.encode("nt", "UTF-8"), _bits(opts))
        made.pop("nt")
    return df.select(*[(made[c] if c in made else F.col(c)).alias(c) for c in _WRITE])


def _binary_writes(opts: RunOptions, contents: DataFrame, renames: DataFrame) -> DataFrame:
    names = renames.where(F.col("filename").isNotNull()).select("path", "ds_id", "version", "filename")
    # A plain target has no header files, so a rename alone writes nothing there.
    rows = _spine(contents, names, "left" if opts.plain else "full_outer").where(F.col("_c").isNotNull())
    rows = rows.select("path", "ds_id", F.col("version").alias("version_date"), F.col("_own").isNull().alias("header_only"), "filename", "_c.*")
    rows = headers.datastream_headers(rows, opts.id_prefix, not opts.atomic, opts.user)
    return _write_rows(
        rows, opts, "binary", header_only=F.col("header_only"), source=F.coalesce("content_path", "content_ref"),
        content_kind=F.col("content_kind"), digest=F.col("target_digest"), ds_state=F.col("state"), bytes=F.col("bytes"),
    )


def _lines_by(rows: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Statement lines per document (and subject): a list one source document bounds."""
    return rows.groupBy(*keys).agg(F.collect_set(triples.ntriples_line()).alias(out))


def _nt(*lists: Column) -> Column:
    """N-Triples text of several line lists as one sorted set."""
    empty = F.expr("cast(array() as array<string>)")
    lines = F.array_sort(F.array_distinct(F.concat(*[F.coalesce(x, empty) for x in lists])))
    return F.concat(F.array_join(lines, "\n"), F.when(F.size(lines) > 0, "\n").otherwise(""))


def _description_writes(opts: RunOptions, facts: Facts, contents: DataFrame) -> DataFrame:
    stated = _own_subjects(facts.rels.where((F.col("ds_id") == M.RELS_INT) & F.col("parse_error").isNull()), "s", opts)
    lines = _lines_by(stated, ["path", "subject_ds", "created", "doc_pos"], "rels_lines")
    touched = lines.groupBy("path", F.col("subject_ds").alias("ds_id"), F.col("created").alias("version")).agg(
        F.max_by("rels_lines", "doc_pos").alias("_rels")
    )
    rows = _spine(contents, touched, "full_outer")
    rows = history.asof_state(rows, ["path", "ds_id"], ["version"], {"rels_lines": F.col("_rels")})
    rows = rows.where(F.col("_c").isNotNull()).select("path", "ds_id", F.col("version").alias("version_date"), "rels_lines", "_c.*")
    # The description states the type as declared; only the binary's header shows a detected one.
    shown = rows.withColumn("filename", F.lit(None).cast("string")).withColumn("mime_type", F.col("declared_mime"))
    shown = shown.withColumn("nt", _nt(triples.lines_of(triples.datastream_triple_array(opts.plain, opts.id_prefix)), F.col("rels_lines")))
    made = headers.datastream_headers(shown, opts.id_prefix, not opts.atomic, opts.user)
    made = made.withColumn("headers", headers.description_headers(F.col("headers")))
    return _write_rows(made, opts, "description", ds_state=F.col("state"))


def _container_writes(opts: RunOptions, facts: Facts, objects: DataFrame, versions: DataFrame) -> DataFrame:
    events = versions.groupBy("path").agg(F.min("created").alias("version")).select("path", "version")
    keys = versions.where(F.col("ds_id").isin(M.DC_DS, M.RELS_EXT)).groupBy("path", F.col("created").alias("version")).agg(
        F.max(F.when(F.col("ds_id") == M.RELS_EXT, F.col("doc_pos"))).alias("_rels"),
        F.max(F.when((F.col("ds_id") == M.DC_DS) & F.lit(facts.dc is not None), F.col("doc_pos"))).alias("_dc"),
    ).where(F.col("_rels").isNotNull() | F.col("_dc").isNotNull())
    rows = events.join(keys, ["path", "version"], "full_outer")
    rows = history.asof_state(rows, ["path"], ["version"], {"rels_pos": F.col("_rels"), "dc_pos": F.col("_dc")})
    rels = _lines_by(
        facts.rels.where((F.col("ds_id") == M.RELS_EXT) & F.col("parse_error").isNull()), ["path", F.col("doc_pos").alias("rels_pos")], "rels_lines"
    )
    rows = rows.join(rels, ["path", "rels_pos"], "left")
    if facts.dc is not None:
        dc = triples.dc_triples(facts.dc, ["path", "doc_pos"], ids.object_resource(F.col("pid"), opts.id_prefix))
        rows = rows.join(_lines_by(dc, ["path", F.col("doc_pos").alias("dc_pos")], "dc_lines"), ["path", "dc_pos"], "left")
    else:
        rows = rows.withColumn("dc_lines", F.lit(None).cast("array<string>"))
    rows = rows.join(objects.select("path", "pid", "properties"), "path")
    rows = rows.withColumn("nt", _nt(triples.lines_of(triples.object_triple_array()), F.col("rels_lines"), F.col("dc_lines")))
    rows = headers.object_headers(rows.withColumnRenamed("version", "version_date"), opts.id_prefix, not opts.atomic, opts.user)
    return _write_rows(rows, opts, "container")


def _record_writes(opts: RunOptions, objects: DataFrame, versions: DataFrame) -> DataFrame:
    """The source record itself as a resource of its object, to be deleted at once."""
    first = versions.groupBy("path").agg(F.min("created").alias("version_date"))
    obj = ids.object_resource(F.col("pid"), opts.id_prefix)
    rows = objects.join(first, "path").withColumn(
        "headers",
        headers.header_struct(
            resource_id=F.concat(obj, F.lit("/FOXML")), parent=obj, model=F.lit(M.MODEL_BINARY), deleted=F.lit(False)
        ),
    )
    return _write_rows(
        rows, opts, "foxml", source=F.col("path"), content_kind=F.lit("record"), bytes=F.col("length"), digest=F.col("record_digest"),
        ds_state=F.lit(M.DS_DELETED),
    )


def _marked(opts: RunOptions, gone: DataFrame, run_ts: str) -> DataFrame:
    """Rows that delete a resource: what it was last, with its headers marked."""
    now = F.to_timestamp(F.lit(run_ts))
    marked = headers.with_header(
        F.col("headers"), deleted=F.lit(True), **({} if opts.plain else {"last_modified_date": now, "memento_date": now})
    )
    return (
        gone.withColumn("headers", marked)
        .withColumn("deleted", F.lit(True))
        .withColumn("header_only", F.lit(False))
        .withColumn("bytes", F.lit(None).cast("bigint"))
        .withColumn("digest", F.lit(None).cast("string"))
        .withColumn("nt", F.lit(None).cast("string"))
    )


def derive_writes(opts: RunOptions, facts: Facts, renames: DataFrame, bad: DataFrame, run_ts: str) -> DataFrame:
    """Every write of every resource, numbered by version of its target object."""
    objects = facts.objects.join(bad, "path", "left_anti")
    versions = facts.versions.join(bad, "path", "left_anti")
    contents = _contents(versions)
    parts = [_binary_writes(opts, contents, renames.join(bad, "path", "left_anti"))]
    if opts.foxml_file:
        parts.append(_record_writes(opts, objects, versions))
    else:
        kept = Facts(
            facts.parsed, objects, versions, facts.rels.join(bad, "path", "left_anti"),
            None if facts.dc is None else facts.dc.join(bad, "path", "left_anti"),
        )
        parts += [_description_writes(opts, kept, contents), _container_writes(opts, kept, objects, versions)]
    return number_versions(opts, _union(parts), objects, run_ts)


def number_versions(opts: RunOptions, live: DataFrame, objects: DataFrame, run_ts: str) -> DataFrame:
    """Writes and deletions, numbered by version of their target object.

    Whole writes move once, to their object: there they are numbered and the last one of each resource is told. They are written with these marks; deletions are read off the marked rows.
    """
    # A record path that comes twice deletes twice, as it writes its container twice.
    doomed = lifecycle.object_doomed(F.col("object_state"), opts.delete_inactive)
    states = objects.groupBy("path").agg(F.count(F.lit(1)).alias("_objects"), F.count_if(doomed).alias("_doomed"))
    # The one path of a source object parts rows like its one archival target does.
    target = ["object_id"] if opts.atomic else ["path", "object_id"]
    resource = Window.partitionBy(*dict.fromkeys([*target, "path", "resource_id"])).orderBy(F.desc("version_date"))
    rows = live.join(states, "path", "left").withColumn("_last", F.row_number().over(resource) == 1)
    if opts.head_only:
        rows = rows.withColumn("_first", F.min("version_date").over(Window.partitionBy(*target))).where("_last")
        rows = rows.withColumn("version_date", F.col("_first")).withColumn("header_only", F.lit(False)).withColumn("version", F.lit(1))
        rows = rows.withColumn("_end", F.lit(2 if opts.plain else 1))
    else:
        rows = rows.withColumn("version", F.dense_rank().over(Window.partitionBy(*target).orderBy("version_date")))
        rows = rows.withColumn("_end", F.max("version").over(Window.partitionBy(*target)) + 1)
    own = (F.col("kind") != "container") & lifecycle.datastream_doomed(F.col("ds_state"), opts.delete_inactive)
    times = F.coalesce(F.when(F.col("_last"), F.when(own, F.col("_objects")).otherwise(F.col("_doomed"))), F.lit(0))
    rows = stage(rows.select(*_WRITE, "version", "_end", times.cast("int").alias("_times")), "writes")
    gone = rows.where("_times > 0").withColumn("_k", F.explode(F.sequence(F.lit(1), "_times"))).withColumn("version", F.col("_end"))
    if not opts.head_only:
        gone = gone.withColumn("version_date", F.lit(run_ts))
    if opts.head_only and not opts.plain:
        rows = rows.where("_times = 0")
    return rows.select(*_WRITE, "version").unionByName(_marked(opts, gone, run_ts).select(*_WRITE, "version"))


def build_outputs(opts: RunOptions, writes: DataFrame, found: DataFrame, done: DataFrame) -> dict[str, DataFrame]:
    stored = writes.where(~F.col("header_only") & ~F.col("deleted") & F.col("digest").isNotNull()).select(
        "object_id", F.col("logical_path").alias("path"), "version", "digest", "deleted"
    )
    gone = writes.where(F.col("deleted")).select("object_id", F.col("logical_path").alias("path"), "version", F.lit(None).cast("string").alias("digest"), "deleted")
    manifest = inventory.build_manifest(stored)
    states = inventory.version_state(stored.unionByName(gone))
    versions = writes.groupBy("object_id", "version").agg(F.min("version_date").alias("created")).select(
        "object_id", "version", "created", F.lit(M.VERSION_MESSAGE).alias("message"), F.lit(opts.user).alias("user_name"),
        F.lit(opts.user_uri).alias("user_address"),
    )
    fixity = inventory.fixity_block(
        writes.where(~F.col("deleted") & ~F.col("header_only")).select(
            "object_id", F.col("logical_path").alias("path"), F.col("headers.digest").alias("urn"), F.col("headers.external_url").alias("external_url")
        )
    )
    return {
        "manifest": manifest,
        "version_state": states,
        "versions": versions,
        "fixity": fixity,
        "inventory": inventory.inventory_json(manifest, states, versions, opts.digest_algorithm),
        "ntriples": writes.where(F.col("nt").isNotNull()).select("object_id", "version", "resource_id", "nt"),
        "report": report.run_report(writes.where(~F.col("deleted")), found),
        "ledger": done.select("pid", "position", F.lit("done").alias("status")),
    }


def migrate(
    spark: SparkSession, opts: RunOptions, raw: DataFrame | None = None, index: DataFrame | None = None,
    existing: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Run one migration and return its tables; ``sinks.write_outputs`` stores them.

    ``raw`` replaces the record scan, ``index`` the content scan, ``existing(object_id)`` are the objects
    the target already has (by default those of the runs published there).
    """
    existing = sinks.existing_objects(spark, opts) if existing is None else existing
    run_ts = opts.run_ts or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    raw, placed = select_records(spark, opts, raw, existing)
    facts = read_facts(spark, opts, raw, index)
    renames = stage(find_renames(opts, facts), "renames")
    problems = find_rejects(opts, facts, renames, existing)
    found = stage(problems, "rejects")
    if not opts.continue_on_error:
        rejects.partition_rejects(facts.objects, found, False)
    bad = found.where(F.col("path").isNotNull()).select("path").distinct()
    writes = derive_writes(opts, facts, renames, bad, run_ts)
    objects = facts.objects.join(bad, "path", "left_anti")
    done = objects.select("path", "pid")
    # Absolute positions in the order of the whole scan serve later resume points.
    done = done.withColumn("position", F.lit(None).cast("bigint")) if placed is None else done.join(placed.select("path", "position"), "path", "left")
    return {
        "objects": objects,
        "source_versions": facts.versions,
        "resources": writes,
        "rejects": found,
        "warnings": find_warnings(facts),
        **build_outputs(opts, writes, found, done),
    }

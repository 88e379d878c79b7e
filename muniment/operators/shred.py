"""Nested records to tables.

Texts are read by a pull reader in Arrow batches (``functions/recordreader.py``); what follows are narrow projections of its rows: no join, no window.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muniment import model as M
from muniment.functions import recordreader
from muniment.functions import values as V
from muniment.session import small_batches

#: Bytes of records whose rows are handed over at once.
PARSED_BYTES = 4 << 20


def record_pid(xml: Column) -> Column:
    """The id in the root tag by one pattern match: cheap enough to select records before parsing them."""
    tag = F.regexp_extract(xml, r"(?s)<(?:[\w.-]+:)?digitalObject\b([^>]*)>", 1)
    pid = F.regexp_extract(tag, r"""(?s)(?:^|\s)PID\s*=\s*["']([^"']*)["']""", 1)
    plain = F.replace(F.replace(pid, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))
    return F.when(pid != "", plain)


def parse_records(raw: DataFrame) -> DataFrame:
    """Raw records with their structure nested in columns; ``problem`` says why a record has none.

    Columns of ``raw`` other than the text pass through. One pass of the pull reader over each text tells its rows, its verbatim inline bodies, whether it is well-formed and whether
    every element stands in its place. Map only.
    """
    keep = [c for c in raw.columns if c not in ("xml", "pid", "text_problem")]
    told = "text_problem" in raw.columns
    inner = raw.select("xml", (F.col("text_problem") if told else F.lit(None).cast("string")).alias("_problem"), *[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)])
    schema = T.StructType([*(T.StructField(c, raw.schema[c].dataType) for c in keep), *T.StructType.fromDDL(recordreader.SCHEMA).fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            # A few texts at once: each is held by its row only.
            sizes = pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy(zero_copy_only=False)
            part = np.cumsum(sizes, dtype=np.int64) // PARSED_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
            for first, last in zip(cuts, cuts[1:]):
                some, rows = batch.slice(first, last - first), recordreader.Rows()
                for data, problem in zip(some.column(0).cast(pa.large_binary()), some.column(1).to_pylist()):
                    recordreader.read_record(rows, data.as_py(), problem)
                yield pa.RecordBatch.from_arrays([*some.columns[2:], *rows.arrays()], names=schema.names)

    return small_batches(inner).mapInArrow(run, schema)


def readable(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("problem").isNull())


def unreadable(parsed: DataFrame) -> DataFrame:
    """Rejects of records that could not be read at all."""
    return parsed.where(F.col("problem").isNotNull()).select(
        "pid", "path", F.lit("unreadable").alias("stage"), F.col("problem").alias("message")
    )


def _unnest(df: DataFrame, keep: list[str], array: Column, pos: str, item: str) -> DataFrame:
    """One row per array element. The outer form, because an inner explode makes Spark test the array's
    size in a filter below it, which would run the whole parse a second time."""
    return df.select(*keep, F.posexplode_outer(array).alias(pos, item)).where(F.col(pos).isNotNull())


def shred_objects(parsed: DataFrame) -> DataFrame:
    return readable(parsed).select("pid", "fedora_uri", "path")


def shred_properties(parsed: DataFrame) -> DataFrame:
    return _unnest(parsed, ["pid"], F.col("properties"), "pos", "_p").select("pid", "pos", "_p.name", "_p.value")


def shred_datastreams(parsed: DataFrame) -> DataFrame:
    return _unnest(parsed, ["pid"], F.col("datastreams"), "doc_pos", "_d").select(
        "pid", "_d.ds_id", "_d.control_group", "_d.fedora_uri", "_d.state", "_d.versionable", "doc_pos"
    )


# A record position is (datastream, version): one number with room for a million versions per datastream.
VERSION_ROOM = 1 << 31


def shred_versions(parsed: DataFrame, host: str = M.DEFAULT_HOST, keep: list[str] | None = None) -> DataFrame:
    """One row per datastream version with its content classified."""
    of_datastreams = _unnest(parsed, ["pid", *(keep or [])], F.col("datastreams"), "_dp", "_d")
    # A version's row has the texts of that version only, not those of its whole datastream.
    kept = ["pid", *(keep or []), "_dp", "ds_id", "control_group", "state"]
    of_datastreams = of_datastreams.select(*kept[:-3], "_d.ds_id", "_d.control_group", "_d.state", F.col("_d.versions").alias("_versions"))
    rows = (
        _unnest(of_datastreams, kept, F.col("_versions"), "_vp", "_v")
        .select(
            "pid",
            *(keep or []),
            "ds_id",
            "control_group",
            "state",
            "_v.version_id",
            "_v.label",
            "_v.created",
            V.parse_instant(F.col("_v.created")).alias("created_ts"),
            "_v.mime_type",
            "_v.alt_ids",
            "_v.format_uri",
            F.coalesce(F.col("_v.size_text").try_cast("bigint"), F.lit(-1).cast("bigint")).alias("size"),
            (F.col("_v.size_text").isNotNull() & F.col("_v.size_text").try_cast("bigint").isNull()).alias("bad_size"),
            "_v.digest_type",
            "_v.digest_value",
            "_v.location_type",
            "_v.location_ref",
            "_v.base64",
            "_v.inline_xml",
            (F.col("_dp") * F.lit(VERSION_ROOM).cast("bigint") + F.col("_vp")).alias("doc_pos"),
        )
    )
    return classify_content(rows, host)


def classify_content(versions: DataFrame, host: str = M.DEFAULT_HOST) -> DataFrame:
    """``content_kind`` (internal | url | base64 | inline | none) and ``content_ref`` with the host rewritten."""
    location = F.col("location_type")
    kind = (
        F.when(location == "INTERNAL_ID", "internal")
        .when(F.col("location_ref").isNotNull(), "url")
        .when(F.col("base64").isNotNull(), "base64")
        .when(F.col("inline_xml").isNotNull(), "inline")
        .otherwise("none")
    )
    ref = F.when(location == "INTERNAL_ID", F.col("location_ref")).otherwise(
        F.trim(V.rewrite_local_host(F.col("location_ref"), host))
    )
    return versions.withColumn("content_kind", kind).withColumn("content_ref", ref).drop("location_type", "location_ref")


# URL schemes a content location may use.
URL_PATTERN = r"(?i)^(https?|ftp|file|jar|mailto):"


def version_problems(versions: DataFrame) -> DataFrame:
    """Rejects of versions that make their whole object fail."""
    external = V.is_external(F.col("control_group"))
    problem = (
        F.when(F.col("bad_size"), F.concat(F.lit("invalid SIZE in "), "version_id"))
        .when(F.col("created_ts").isNull(), F.concat(F.lit("invalid CREATED in "), "version_id"))
        .when(
            (F.col("content_kind") == "url") & ~F.col("content_ref").rlike(URL_PATTERN),
            F.concat(F.lit("malformed URL "), "content_ref"),
        )
        .when(external & (F.col("content_kind") != "url"), F.concat(F.lit("no URL for "), "version_id"))
        .when(F.col("content_kind") == "none", F.concat(F.lit("no content for "), "version_id"))
    )
    keep = [c for c in ("path",) if c in versions.columns]
    return versions.select("pid", *keep, "ds_id", "version_id", problem.alias("message")).where(F.col("message").isNotNull())


def inline_count_problems(parsed: DataFrame) -> DataFrame:
    """Records whose inline bodies and inline versions do not pair up."""
    flat = F.flatten(F.transform("datastreams", lambda d: d["versions"]))
    used = F.size(F.filter(flat, lambda v: v["inline_xml"].isNotNull()))
    return parsed.where(used != F.col("n_inline")).select(
        "pid", "path", F.lit("structure").alias("stage"),
        F.concat(F.lit("inline bodies: "), F.col("n_inline").cast("string"), F.lit(", used: "), used.cast("string")).alias("message"),
    )


def structure_report(parsed: DataFrame) -> DataFrame:
    """Irregular records (rejects) and records with unexpected attributes (warnings)."""
    return parsed.select(
        "pid", "path", "structure_problem", F.array_join("unexpected_attributes", ",").alias("unexpected_attributes")
    ).where(F.col("structure_problem").isNotNull() | (F.col("unexpected_attributes") != ""))

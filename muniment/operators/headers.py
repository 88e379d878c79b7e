"""Resource headers: one row per resource and version, all by projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muniment import model as M
from muniment.functions import ids
from muniment.functions import values as V

HEADER_FIELDS = (
    "resource_id", "parent", "model", "archival_group_id", "archival_group", "object_root", "filename", "mime_type",
    "content_size", "digest", "external_handling", "external_url", "created_date", "last_modified_date",
    "memento_date", "created_by", "last_modified_by", "state_token", "deleted",
)
HEADER_TYPES = {
    "archival_group": "boolean", "object_root": "boolean", "deleted": "boolean", "content_size": "bigint",
    "created_date": "timestamp", "last_modified_date": "timestamp", "memento_date": "timestamp",
}


def header_struct(**given: Column) -> Column:
    """All header fields in order, nulls for those not given."""
    return F.struct(*[
        given.get(name, F.lit(None)).cast(HEADER_TYPES.get(name, "string")).alias(name) for name in HEADER_FIELDS
    ])


def property_dates(properties: Column) -> tuple[Column, Column]:
    """(created, last modified) text of an ordered property array; the last matching property wins."""
    modified = F.filter(properties, lambda p: p["name"].contains("lastModifiedDate"))
    created = F.filter(
        properties, lambda p: p["name"].contains("createdDate") & ~p["name"].contains("lastModifiedDate")
    )
    last = F.lit(-1)
    return (
        F.try_element_at(F.transform(created, lambda p: p["value"]), last),
        F.try_element_at(F.transform(modified, lambda p: p["value"]), last),
    )


def object_headers(df: DataFrame, prefix: str = M.ID_ROOT, archival: bool = True, user: str = M.DEFAULT_USER) -> DataFrame:
    """Adds ``headers`` to rows with ``pid`` and ``properties``."""
    created, modified = property_dates(F.col("properties"))
    modified_ts = V.parse_instant(modified)
    return df.withColumn(
        "headers",
        header_struct(
            resource_id=ids.object_resource(F.col("pid"), prefix),
            parent=F.lit(M.ID_ROOT),
            model=F.lit(M.MODEL_CONTAINER),
            archival_group=F.lit(archival),
            object_root=F.lit(True),
            created_date=V.parse_instant(created),
            last_modified_date=modified_ts,
            memento_date=modified_ts,
            created_by=F.lit(user),
            last_modified_by=F.lit(user),
            state_token=V.state_token(modified_ts),
            deleted=F.lit(False),
        ),
    )


def datastream_headers(
    df: DataFrame, prefix: str = M.ID_ROOT, archival: bool = True, user: str = M.DEFAULT_USER
) -> DataFrame:
    """Adds ``headers`` to datastream versions.

    Reads ``pid, ds_id, control_group, created_ts, create_ts, filename, mime_type, size, digest_type,
    digest_value, content_ref, content_kind``.
    """
    external = V.is_external(F.col("control_group"))
    # The digest of an inline body is checked but never shown.
    digest = F.when(F.col("content_kind") != "inline", V.digest_urn(F.col("digest_type"), F.col("digest_value")))
    object_id = ids.object_resource(F.col("pid"), prefix)
    return df.withColumn(
        "headers",
        header_struct(
            resource_id=ids.datastream_resource(F.col("pid"), F.col("ds_id"), prefix),
            parent=object_id,
            model=F.lit(M.MODEL_BINARY),
            archival_group_id=object_id if archival else F.lit(None),
            archival_group=F.lit(False),
            object_root=F.lit(not archival),
            filename=F.col("filename"),
            mime_type=F.col("mime_type"),
            content_size=V.content_size(F.col("size"), F.col("control_group")),
            digest=digest,
            external_handling=V.external_handling(F.col("control_group")),
            external_url=F.when(external, F.col("content_ref")),
            created_date=F.col("create_ts"),
            last_modified_date=F.col("created_ts"),
            memento_date=F.col("created_ts"),
            created_by=F.lit(user),
            last_modified_by=F.lit(user),
            state_token=V.state_token(F.col("created_ts")),
            deleted=F.lit(False),
        ),
    )


def description_headers(headers: Column) -> Column:
    """Headers of a binary's description, copied from the binary's."""
    return header_struct(
        resource_id=ids.description_resource(headers["resource_id"]),
        parent=headers["resource_id"],
        model=F.lit(M.MODEL_DESCRIPTION),
        archival_group_id=headers["archival_group_id"],
        archival_group=F.lit(False),
        object_root=F.lit(False),
        created_date=headers["created_date"],
        last_modified_date=headers["last_modified_date"],
        memento_date=headers["memento_date"],
        created_by=headers["created_by"],
        last_modified_by=headers["last_modified_by"],
        state_token=headers["state_token"],
        deleted=F.lit(False),
    )


def with_header(headers: Column, **changes: Column) -> Column:
    """The same headers with some fields replaced."""
    out = headers
    for name, value in changes.items():
        out = out.withField(name, value.cast(HEADER_TYPES.get(name, "string")))
    return out

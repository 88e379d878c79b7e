"""Identifier, path and name columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from muniment import model as M


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def internal_id_akubra(name: Column) -> Column:
    """Internal id of a URL-encoded content file name; null when the name is not one."""
    decoded = F.try_url_decode(name)
    return F.when(
        decoded.startswith(M.ID_ROOT),
        F.translate(F.substring(decoded, len(M.ID_ROOT) + 1, 2**31 - 1), "/", "+"),
    )


def internal_id_legacy(name: Column) -> Column:
    """Internal id of a legacy content file name: only the first underscore stands for a colon."""
    return F.regexp_replace(name, "^([^_]*)_", "$1:")


def object_resource(pid: Column, prefix: str = M.ID_ROOT) -> Column:
    return F.concat(F.lit(prefix), pid)


def datastream_resource(pid: Column, ds_id: Column, prefix: str = M.ID_ROOT) -> Column:
    return F.concat(F.lit(prefix), pid, F.lit("/"), ds_id)


def description_resource(resource: Column) -> Column:
    return F.concat(resource, F.lit(M.DESCRIPTION_SUFFIX))


def storage_path(object_id: Column, resource_id: Column, model: Column) -> Column:
    """Logical path of a resource inside its target object.

    The path is the id relative to the object (its last part when the resource is the object's root);
    containers and descriptions get a fixed N-Triples name.
    """
    binary_id = F.when(
        resource_id.endswith(M.DESCRIPTION_SUFFIX),
        F.substring(resource_id, F.lit(1), F.length(resource_id) - len(M.DESCRIPTION_SUFFIX)),
    ).otherwise(resource_id)
    relative = F.when(binary_id == object_id, F.substring_index(binary_id, "/", -1)).otherwise(
        F.substring(binary_id, F.length(object_id) + 2, F.length(binary_id))
    )
    return (
        F.when(model == M.MODEL_BINARY, relative)
        .when(model == M.MODEL_DESCRIPTION, F.concat(relative, F.lit("~fcr-desc.nt")))
        .when(binary_id == object_id, F.lit("fcr-container.nt"))
        .otherwise(F.concat(relative, F.lit("/fcr-container.nt")))
    )


def layout_path(object_id: Column) -> Column:
    """Hashed directory of a target object: three 3-character tuples, then the whole hash."""
    digest = F.sha2(object_id, 256)
    return F.concat_ws(
        "/", F.substring(digest, 1, 3), F.substring(digest, 4, 3), F.substring(digest, 7, 3), digest
    )


def layout_bucket(object_id: Column, characters: int = 3) -> Column:
    """Start of the layout's first tuple: 16 ** ``characters`` evenly filled write buckets."""
    return F.substring(F.sha2(object_id, 256), 1, characters)


def not_blank(col: Column) -> Column:
    """True for a string with at least one non-space character; never null."""
    return F.coalesce(col.rlike(r"\S"), F.lit(False))


def resolve_filename(ds_id: Column, label: Column, download: Column, extension: Column | None = None) -> Column:
    """Download name, else label, else datastream id; the extension only where the name has no dot."""
    base = F.when(not_blank(download), download).when(not_blank(label), label).otherwise(ds_id)
    if extension is None:
        return base
    return F.when(base.contains("."), base).otherwise(F.concat(base, F.coalesce(extension, F.lit(""))))

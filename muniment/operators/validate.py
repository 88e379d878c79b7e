"""Digest checks of inline documents, content files and inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muniment.functions import ids, xmltext
from muniment.functions import values as V


def validate_inline(versions: DataFrame, body: str = "inline_xml") -> DataFrame:
    """Adds ``inline_status`` and ``inline_actual`` to inline versions.

    ``skipped`` for a blank digest or type ``DISABLED``; ``unsupported`` where the document or its algorithm
    has no digest input; else ``ok`` or ``mismatch``. Only documents that carry a digest are normalised.
    """
    checked = (
        F.col(body).isNotNull()
        & ids.not_blank(F.col("digest_value"))
        & ~F.coalesce(F.col("digest_type") == "DISABLED", F.lit(False))
    )
    normal = versions.withColumn("_normal", xmltext.normalize_inline(F.when(checked, F.col(body))))
    actual = V.digest_by_name(F.col("digest_type"), F.encode(F.col("_normal.text"), "UTF-8"))
    status = (
        F.when(~checked, "skipped")
        .when(F.col("_normal.text").isNull() | ~V.known_algorithm(F.col("digest_type")), "unsupported")
        .when(F.lower(F.col("inline_actual")) == F.lower(F.col("digest_value")), "ok")
        .otherwise("mismatch")
    )
    return normal.withColumn("inline_actual", actual).withColumn("inline_status", status).drop("_normal")


def content_status(enabled: bool = True):
    """Status column of the content check.

    Reads ``control_group, content_kind, digest_type, digest_value, actual_digest``: ``skipped`` (check off,
    external, inline), ``missing`` (managed without digest), ``unknown_algorithm``, ``unread`` (no bytes to
    read), ``ok`` or ``mismatch``.
    """
    if not enabled:
        return F.lit("skipped")
    valid = ids.not_blank(F.col("digest_type")) & ids.not_blank(F.col("digest_value"))
    managed = F.coalesce(F.upper(F.col("control_group")) == "M", F.lit(False))
    return (
        F.when(V.is_external(F.col("control_group")) | (F.col("content_kind") == "inline"), "skipped")
        .when(~valid & managed, "missing")
        .when(~valid, "skipped")
        .when(~V.known_algorithm(F.col("digest_type")), "unknown_algorithm")
        .when(F.col("actual_digest").isNull(), "unread")
        .when(F.lower("actual_digest") == F.lower("digest_value"), "ok")
        .otherwise("mismatch")
    )


def indexed_digest(kind: str = "digest_type", columns: list[str] | None = None):
    """The digest of the algorithm a row names, out of the digest columns a content index carries."""
    out = F.lit(None).cast("string")
    for name, column in V.INDEX_COLUMNS.items():
        if columns is None or column in columns:
            out = F.when(F.upper(kind) == name, F.col(column)).otherwise(out)
    return out


def verify_manifest(manifest: DataFrame, index: DataFrame, keys: list[str]) -> DataFrame:
    """Every manifest path against the stored files: ``ok``, ``mismatch``, ``missing`` or ``extra``."""
    listed = manifest.select(*keys, F.col("digest").alias("expected"), F.lit(True).alias("_listed"))
    stored = index.select(*keys, F.col("digest").alias("actual"), F.lit(True).alias("_stored"))
    status = (
        F.when(F.col("_stored").isNull(), "missing")
        .when(F.col("_listed").isNull(), "extra")
        .when(F.lower("expected") == F.lower("actual"), "ok")
        .otherwise("mismatch")
    )
    return listed.join(stored, keys, "full_outer").withColumn("status", status).drop("_listed", "_stored")

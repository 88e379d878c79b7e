"""Filenames of binaries over the versions of their object."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muniment.functions import ids, mime
from muniment.operators import spread


def name_events(rels: DataFrame, names: DataFrame, obj: str, slice_by: Column | str | None = None) -> DataFrame:
    """Set and clear events of download names.

    ``rels(obj, version, pos)`` are the relationship versions of an object; ``names(obj, version, pos, ds_id,
    download_name)`` what each of them names. A name is cleared by the next relationship version of the
    object that does not repeat it.

    What one relationship version names is a list, bounded by its document; the next one's names travel with
    its place, so names are set and cleared from one row and no join back is needed.
    """
    at = ["version", "pos"]
    named = F.struct("ds_id", "download_name")
    listed = (
        rels.select(obj, *at, F.lit(None).cast(names.select(named.alias("n")).schema["n"].dataType).alias("_named"))
        .unionByName(names.select(obj, *at, named.alias("_named")))
        .groupBy(obj, *at)
        .agg(F.collect_list("_named").alias("_names"))
        .withColumn("_ids", F.col("_names.ds_id"))
        .withColumn("_here", F.struct(*at, "_ids"))
    )
    pairs = spread.next_value(listed, [obj], at, "_here", slice_by, "_next").drop("_here")
    sets = F.transform("_names", lambda n: F.struct(
        F.col("version"), F.col("pos"), n["ds_id"].alias("ds_id"), n["download_name"].alias("download_name"), F.lit("set").alias("kind")))
    cleared = F.transform(F.array_except("_ids", "_next._ids"), lambda i: F.struct(
        F.col("_next.version").alias("version"), F.col("_next.pos").alias("pos"), i.alias("ds_id"),
        F.lit(None).cast("string").alias("download_name"), F.lit("clear").alias("kind")))
    return pairs.select(obj, F.inline(F.concat(sets, F.coalesce(cleared, F.array()))))


def filename_history(
    content: DataFrame, rels: DataFrame, names: DataFrame, obj: str, add_extensions: bool = False,
    slice_by: Column | str | None = None, filename_compat: bool = True,
) -> DataFrame:
    """One row per (object, datastream, version) at which the filename is written anew.

    ``content(obj, version, pos, ds_id, label, mime_type)`` are the content versions. A content version uses
    the download name in force when it is read; a relationship version renames at the end of its version.
    With ``filename_compat`` that renaming writes the raw name without an extension, as the source tool does.
    ``missing`` marks a name given to a datastream that does not exist yet.
    """
    keys = [obj, "ds_id"]
    contents = content.select(
        obj, "ds_id", "version", "pos", F.lit("content").alias("kind"), "label", "mime_type",
        F.lit(None).cast("string").alias("download_name"),
    )
    renames = name_events(rels, names, obj, slice_by).select(
        obj, "ds_id", "version", "pos", "kind",
        F.lit(None).cast("string").alias("label"), F.lit(None).cast("string").alias("mime_type"), "download_name",
    )
    # A relationship version acts on names in reading order but writes at the end of its version: it sees all content of it.
    events = contents.unionByName(renames).withColumn("phase", (F.col("kind") != "content").cast("int"))
    is_content = F.col("kind") == "content"
    own = F.when(is_content, F.struct("label", "mime_type"))
    events = spread.carry_forward(
        events, keys, ["version", "pos", "phase"], {"_name": F.when(~is_content, F.struct("download_name"))}, slice_by, {"_read": own}
    ).withColumn("_content", F.coalesce(own, "_read"))
    extension = mime.mime_extension(F.col("_content.mime_type")) if add_extensions else None
    resolved = ids.resolve_filename(F.col("ds_id"), F.col("_content.label"), F.col("_name.download_name"), extension)
    named = (F.col("kind") == "set") & ids.not_blank(F.col("download_name"))
    raw = F.col("download_name") if filename_compat else resolved
    filename = F.when(named, raw).when(F.col("kind") != "set", resolved)
    exists = F.col("_content").isNotNull()
    return (
        events.where(((F.col("kind") != "clear") | exists))
        .withColumn("_filename", F.when(exists, filename))
        .groupBy(*keys, "version")
        .agg(
            F.max_by("_filename", F.when(F.col("_filename").isNotNull(), F.struct(named.cast("int").alias("named"), "phase", "pos"))).alias("filename"),
            F.max(~exists).alias("missing"),
        )
        .where(F.col("filename").isNotNull() | F.col("missing"))
    )

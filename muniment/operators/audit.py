"""Audit trail records of inline audit documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AUDIT_SCHEMA = """
record ARRAY<STRUCT<_ID: STRING, process: STRUCT<_type: STRING>, action: STRING, componentID: STRING,
  responsibility: STRING, date: STRING, justification: STRING>>
"""

# Source action -> target event type.
EVENT_TYPES = {
    "addDatastream": "premis:ing",
    "modifyDatastreamByReference": "audit:contentModification/metadataModification",
    "modifyObject": "audit:resourceModification",
    "modifyDatastreamByValue": "audit:contentModification/metadataModification",
    "purgeDatastream": "audit:contentRemoval",
}
VALIDATION_EVENT = "premis:validation"


def audit_events(df: DataFrame, keys: list[str], xml: str = "inline_xml") -> DataFrame:
    """One row per audit record, its action mapped to an event type (null for actions without one)."""
    parsed = F.from_xml(F.col(xml), AUDIT_SCHEMA, {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "false"})
    rows = df.select(*keys, F.posexplode_outer(parsed["record"]).alias("pos", "_r")).where(F.col("pos").isNotNull())
    mapped = F.try_element_at(F.create_map(*[F.lit(x) for kv in EVENT_TYPES.items() for x in kv]), F.col("_r.action"))
    event = F.when(
        (F.col("_r.action") == "modifyObject") & F.coalesce(F.col("_r.justification").contains("checksum"), F.lit(False)),
        F.lit(VALIDATION_EVENT),
    ).otherwise(mapped)
    return rows.select(
        *keys, "pos",
        F.col("_r._ID").alias("record_id"),
        F.col("_r.process._type").alias("process_type"),
        F.col("_r.action").alias("action"),
        F.col("_r.componentID").alias("component_id"),
        F.col("_r.responsibility").alias("responsibility"),
        F.col("_r.date").alias("date"),
        F.col("_r.justification").alias("justification"),
        event.alias("event_type"),
    )

"""Content-addressed manifests, version states, fixity and inventory documents."""

from __future__ import annotations

import json
from bisect import bisect_left, insort
from collections.abc import Iterable
from json.encoder import encode_basestring

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muniment import model as M
from muniment.operators import spread


def build_manifest(writes: DataFrame, obj: str = "object_id") -> DataFrame:
    """(object, digest, content_path): equal content is kept once, at its first version and path.

    A plain minimum per (object, digest): combined before the shuffle, so any number of copies costs one row.
    """
    first = F.min(F.struct("version", "path"))
    return writes.groupBy(obj, "digest").agg(first.alias("_first"), F.count(F.lit(1)).alias("n_writes")).select(
        obj,
        "digest",
        F.col("_first.version").alias("version"),
        F.concat(F.lit("v"), F.col("_first.version").cast("string"), F.lit("/content/"), F.col("_first.path")).alias("content_path"),
        "n_writes",
    )


def version_state(writes: DataFrame, obj: str = "object_id", slice_by: Column | None = None) -> DataFrame:
    """State of every version as intervals: ``path`` has ``digest`` from ``from_version`` until before ``to_version``.

    ``writes(obj, path, version, digest, deleted)`` has at most one row per path and version. The interval
    form grows with the writes, not with versions times paths; a null ``to_version`` is the head.
    """
    ends = spread.next_value(writes, [obj, "path"], ["version"], "version", slice_by, "to_version")
    return ends.where(~F.col("deleted")).select(obj, "path", "digest", F.col("version").alias("from_version"), "to_version")


def state_at(intervals: DataFrame, version: Column) -> DataFrame:
    """The (path, digest) pairs live at one version."""
    return intervals.where(
        (F.col("from_version") <= version) & (F.col("to_version").isNull() | (F.col("to_version") > version))
    ).drop("from_version", "to_version")


def fixity_block(writes: DataFrame, obj: str = "object_id") -> DataFrame:
    """(object, algorithm, digest, path) of the source digests, external content excluded."""
    return (
        writes.where(F.col("urn").isNotNull() & (F.coalesce(F.trim("external_url"), F.lit("")) == ""))
        .select(
            obj,
            F.substring_index(F.substring_index("urn", ":", 2), ":", -1).alias("algorithm"),
            F.substring_index("urn", ":", -1).alias("digest"),
            "path",
        )
        .distinct()
    )


#: Parts that are Python objects at once, and characters of documents that are handed over at once; an object with more makes a slice of its own.
PARTS_AT_ONCE, TEXT_AT_ONCE = 1 << 14, 4 << 20

_PARTS = "kind STRING, version INT, until INT, digest STRING, path STRING, body STRING"


def _parts(df: DataFrame, obj: str, kind: str, **columns: Column) -> DataFrame:
    """Rows of one kind in the common form of what an inventory is made of."""
    kinds = dict(x.split(" ") for x in _PARTS.split(", "))
    given = {n: columns.get(n, F.lit(None)).cast(t.lower()) for n, t in kinds.items() if n != "kind"}
    return df.select(obj, F.struct(F.lit(kind).alias("kind"), *[c.alias(n) for n, c in given.items()]).alias("part"))


def _text(x: object) -> str:
    """A value as JSON; strings, which nearly all are, without the set-up of an encoder."""
    return encode_basestring(x) if isinstance(x, str) else json.dumps(x, ensure_ascii=False)


def _document(obj: str, parts: list[tuple], algorithm: str) -> tuple[str | None, str | None]:
    """(head, inventory) of one object, whose parts are in the order of ``_PARTS``: its add and remove events are folded once, in the order of versions."""
    text = _text
    versions = sorted((version, body) for kind, version, _, _, _, body in parts if kind == "version")
    if not versions:
        return None, None
    events = sorted(
        (at, change, digest, path) for kind, version, until, digest, path, _ in parts if kind == "state" for at, change in ((version, 1), (until, 0)) if at is not None)
    live: dict[str, list[str]] = {}
    shown: dict[str, str] = {}  # the text of each digest's paths, made anew only where it changes
    state, i, out = "", 0, []
    for version, body in versions:
        changed = set()
        while i < len(events) and events[i][0] <= version:
            _, add, digest, path = events[i]
            paths = live.setdefault(digest, [])
            if add:
                insort(paths, path)
            else:
                del paths[bisect_left(paths, path)]
            changed.add(digest)
            i += 1
        for digest in changed:
            if live[digest]:
                shown[digest] = f"{text(digest)}:[{','.join(map(text, live[digest]))}]"
            else:
                del live[digest]
                shown.pop(digest, None)
        if changed:
            state = ",".join(shown[d] for d in sorted(shown))
        out.append(f'"v{version}":{body[:-1]}{"," if len(body) > 2 else ""}"state":{{{state}}}}}')
    stored = ",".join(f"{text(d)}:[{text(p)}]" for d, p in sorted((digest, path) for kind, _, _, digest, path, _ in parts if kind == "manifest"))
    head = f"v{versions[-1][0]}"
    fields = {"id": obj, "type": M.INVENTORY_TYPE, "digestAlgorithm": algorithm, "head": head, "contentDirectory": "content"}
    start = ",".join(f"{text(k)}:{text(v)}" for k, v in fields.items())
    return head, f'{{{start},"fixity":{{}},"manifest":{{{stored}}},"versions":{{{",".join(out)}}}}}'


def _documents(batches: Iterable[pa.RecordBatch], names: list[str], algorithm: str) -> Iterable[pa.RecordBatch]:
    """(object, head, inventory) of (object, parts): many documents to a batch, as a batch costs the same whatever it holds."""
    for batch in batches:
        keys, lists = batch.columns
        kinds = (keys.type, pa.string(), pa.string())
        ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(ends // PARTS_AT_ONCE)) + 1).tolist(), batch.num_rows]
        for first, last in zip(cuts, cuts[1:]):
            parts = list(zip(*[c.to_pylist() for c in lists.slice(first, last - first).flatten().flatten()]))
            at, made, size = 0, [], 0
            for key, n in zip(keys.slice(first, last - first).to_pylist(), np.diff(ends[first:last], prepend=ends[first - 1] if first else 0).tolist()):
                head, inventory = _document(key, parts[at : at + n], algorithm)
                at += n
                if head is not None:
                    made.append((key, head, inventory))
                    size += len(inventory)
                if size > TEXT_AT_ONCE:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*made), kinds)], names=names)
                    made, size = [], 0
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*made), kinds)], names=names)


def inventory_json(
    manifest: DataFrame, intervals: DataFrame, versions: DataFrame, algorithm: str, obj: str = "object_id"
) -> DataFrame:
    """(object, head, inventory): the inventory document of every target object.

    ``versions(obj, version, created, message, user_name, user_address)``. What an object's document is made of comes together in one row, whose size the one source record
    behind the object bounds; its state is swept over the versions, so no version is joined with the intervals. The document itself repeats the whole state
    per version by definition of its format.
    """
    body = F.to_json(F.struct("created", "message", F.struct(F.col("user_name").alias("name"), F.col("user_address").alias("address")).alias("user")))
    rows = (
        _parts(versions, obj, "version", version=F.col("version"), body=body)
        .unionByName(_parts(intervals, obj, "state", version=F.col("from_version"), until=F.col("to_version"), digest=F.col("digest"), path=F.col("path")))
        .unionByName(_parts(manifest, obj, "manifest", digest=F.col("digest"), path=F.col("content_path")))
    )
    schema = T.StructType([versions.schema[obj], T.StructField("head", T.StringType()), T.StructField("inventory", T.StringType())])

    return rows.groupBy(obj).agg(F.collect_list("part").alias("parts")).mapInArrow(lambda batches: _documents(batches, schema.names, algorithm), schema)

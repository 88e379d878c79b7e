"""Queries over versions, states and selections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muniment import model as M
from muniment.operators import filenames, history, lifecycle, resolve, select, spread, writes
from muniment.plans.tables import day, documents, events, orders, table

SNAPSHOT_AT = "2024-01-15 00:00:00"
RUN_TS = "2024-06-01T00:00:00.000000Z"


def version_history(spark: SparkSession, d: str) -> DataFrame:
    return history.version_history(orders(spark, d), "o_custkey", "created", spread.by_prefix("created", 7))


def changed_per_version(spark: SparkSession, d: str) -> DataFrame:
    return history.changed_per_version(
        orders(spark, d), "o_custkey", "created", "o_orderpriority", "o_orderkey", spread.by_prefix("created", 7)
    )


def first_last_versions(spark: SparkSession, d: str) -> DataFrame:
    return history.ds_extent(events(spark, d), ["user_id", "event_type"], ["ts", "event_id"], ["event_id", "created"])


def rank_ds_versions(spark: SparkSession, d: str) -> DataFrame:
    rows = events(spark, d).select("user_id", "event_type", "event_id", "ts")
    return history.rank_ds_versions(rows, ["user_id", "event_type"], ["ts", "event_id"], spread.by_day("ts")).drop("ts")


def create_date(spark: SparkSession, d: str) -> DataFrame:
    rows = events(spark, d).select("user_id", "event_type", "event_id", "created")
    return history.with_create_date(
        rows, ["user_id", "event_type"], ["created", "event_id"], "created", spread.by_prefix("created")
    )


def was_changed(spark: SparkSession, d: str) -> DataFrame:
    return history.was_changed(
        events(spark, d).withColumn("version", day("ts")), "user_id", "version", "event_type", "purchase"
    )


def asof_state(spark: SparkSession, d: str) -> DataFrame:
    rows = events(spark, d).select("user_id", "event_id", "ts", "event_type", "k", "value")
    return history.asof_state(
        rows, ["user_id"], ["ts", "event_id"],
        {
            "purchase_k": F.when(F.col("event_type") == "purchase", F.col("k")),
            "signup_value": F.when(F.col("event_type") == "signup", F.col("value")),
        },
        spread.by_day("ts"),
    ).select("user_id", "event_id", "purchase_k", "signup_value")


def asof_crowded(spark: SparkSession, d: str) -> DataFrame:
    """Four heavy groups, each crowded into a few days: slices by measured row counts."""
    rows = events(spark, d).select("event_type", "event_id", "ts", "user_id", "k")
    return history.asof_state(
        rows, ["event_type"], ["ts", "event_id"],
        {"low_k": F.when(F.col("k") < 10, F.col("k")), "even_user": F.when(F.col("user_id") % 2 == 0, F.col("user_id"))}, spread.MEASURED,
    ).select("event_type", "event_id", "low_k", "even_user")


def head_only(spark: SparkSession, d: str) -> DataFrame:
    rows = events(spark, d).select("user_id", "event_type", "event_id", "created", "k")
    return history.head_only(rows, "user_id", ["event_type"], ["created", "event_id"], "created")


def snapshot_at(spark: SparkSession, d: str) -> DataFrame:
    upto = F.col("ts") <= F.lit(SNAPSHOT_AT).cast("timestamp_ntz")
    rows = events(spark, d, upto).select("user_id", "event_type", "event_id", "created", "k")
    return history.snapshot_at(rows, ["user_id", "event_type"], ["created", "event_id"], deleted=F.col("k") < 10)


def target_objects(spark: SparkSession, d: str) -> DataFrame:
    rows = events(spark, d).select("user_id", "event_type", day("ts").alias("version_date"))
    obj = F.concat(F.lit("info:fedora/user:"), F.col("user_id").cast("string"))
    res = F.concat(obj, F.lit("/"), F.col("event_type"))

    def made(atomic: bool) -> DataFrame:
        found = history.target_objects(
            rows, atomic, obj, res, "version_date", F.col("event_type") == "signup", spread.by_prefix("version_date", 7)
        )
        return found.withColumn("mode", F.lit(M.ATOMIC if atomic else M.ARCHIVAL))

    return made(False).unionByName(made(True))


def _state_word() -> F.Column:
    return (
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "Deleted")
        .when(F.col("c_mktsegment") == "MACHINERY", "Inactive")
        .otherwise("Active")
    )


def apply_deletes(spark: SparkSession, d: str) -> DataFrame:
    objects = table(spark, d, "customer").select(F.col("c_custkey").alias("object_key"), _state_word().alias("object_state"))
    letters = F.when(F.col("o_orderstatus") == "F", "D").when(F.col("o_orderstatus") == "P", "I").otherwise("A")
    ds = orders(spark, d).select(
        F.col("o_custkey").alias("object_key"), F.col("o_orderkey").alias("ds"), letters.alias("ds_state")
    )

    def made(inactive: bool) -> DataFrame:
        return lifecycle.apply_deletes(
            objects, ds, "object_key", "ds", "object_state", "ds_state", inactive, RUN_TS
        ).withColumn("delete_inactive", F.lit(inactive))

    return made(False).unionByName(made(True))


def object_state(spark: SparkSession, d: str) -> DataFrame:
    def prop(name: str, value):
        return F.struct(F.lit(name).alias("name"), value.alias("value"))

    named = F.array(prop("info:fedora/fedora-system:def/model#label", F.col("c_name")), prop(M.STATE_PROPERTY, _state_word()),
                    prop(M.STATE_PROPERTY, F.lit("later")))
    unnamed = F.array(prop("info:fedora/fedora-system:def/model#label", F.col("c_name")))
    objects = table(spark, d, "customer").select(
        F.concat(F.lit("customer:"), F.col("c_custkey").cast("string")).alias("pid"),
        F.when(F.col("c_mktsegment") == "BUILDING", unnamed).otherwise(named).alias("properties"),
    ).withColumn("object_state", lifecycle.object_state(F.col("properties"))).drop("properties")
    return objects.join(lifecycle.missing_state(objects), "pid", "left")


def resolve_content(spark: SparkSession, d: str) -> DataFrame:
    versions = documents(spark, d).select(F.col("doc_id").alias("internal_id"), "source")
    index = table(spark, d, "labels").select(
        F.col("doc_id").alias("internal_id"), F.concat(F.lit("store/"), F.col("doc_id").cast("string")).alias("path")
    )
    return resolve.resolve_content(versions, index).select("internal_id", "source", "n_files", "path", "resolution")


def resolve_by_digest(spark: SparkSession, d: str) -> DataFrame:
    ids = documents(spark, d).select(
        F.md5("text").alias("internal_id"), "doc_id", F.format_string("store/%012d", "doc_id").alias("path")
    )
    found = resolve.resolve_content(ids.select("internal_id", "doc_id"), ids.select("internal_id", "path"))
    return found.select("doc_id", "internal_id", "n_files", "path", "resolution")


def filter_pids(spark: SparkSession, d: str) -> DataFrame:
    listed = table(spark, d, "benchmark").select("item_id")
    return select.filter_pids(orders(spark, d).select("o_orderkey", "o_custkey", "o_orderstatus"), listed, "o_custkey")


def pending(spark: SparkSession, d: str) -> DataFrame:
    ledger = table(spark, d, "labels").select(
        F.col("doc_id").alias("o_orderkey"),
        F.when(F.col("quality") == 1, "done").otherwise("failed").alias("status"),
    )
    return select.pending(orders(spark, d).select("o_orderkey", "created"), ledger, "o_orderkey")


def limit_objects(spark: SparkSession, d: str) -> DataFrame:
    return select.limit_objects(table(spark, d, "customer").select("c_name", "c_custkey"), 120, ["c_name"])


def scan_positions(spark: SparkSession, d: str) -> DataFrame:
    return select.with_positions(orders(spark, d).select("o_orderkey", "created"), ["created", "o_orderkey"])


def resume_after(spark: SparkSession, d: str) -> DataFrame:
    return select.resume_after(
        table(spark, d, "customer").select("c_custkey", "c_name"), 100, "customer#000000099", "c_name", ["c_name"]
    )


def accept_all(spark: SparkSession, d: str) -> DataFrame:
    """Resume off: everything is taken, the check at the boundary still runs."""
    return select.resume_after(
        table(spark, d, "customer").select("c_custkey", "c_name"), 100, "Customer#000000099", "c_name", ["c_name"], False
    )


def select_objects(spark: SparkSession, d: str) -> DataFrame:
    ledger = table(spark, d, "labels").select(
        F.col("doc_id").alias("c_custkey"), F.when(F.col("toxic") == 1, "done").otherwise("failed").alias("status")
    )
    return select.select_objects(
        table(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey", ["c_name"], limit=130,
        pid_list=table(spark, d, "benchmark").select("item_id"), position=10, last_id="9", resume=True, ledger=ledger,
    )


def conflicts(spark: SparkSession, d: str) -> DataFrame:
    return resolve.conflicts(documents(spark, d).select("doc_id", "lang"), table(spark, d, "labels"), "doc_id")


def without_existing(spark: SparkSession, d: str) -> DataFrame:
    return resolve.without_existing(documents(spark, d).select("doc_id", "lang"), table(spark, d, "labels"), "doc_id")


def rename_properties(spark: SparkSession, d: str) -> DataFrame:
    mapping = spark.createDataFrame(
        [("ECONOMY", "urn:kind#economy"), ("PROMO", "urn:kind#promo")], "source STRING, target STRING"
    )
    props = table(spark, d, "part").select("p_partkey", F.col("p_type").alias("name"), F.col("p_name").alias("value"))
    return resolve.rename_properties(props, mapping)


def filename_history(spark: SparkSession, d: str) -> DataFrame:
    """Users as objects, event types as datastreams; sign-ups play the relationship datastream."""
    rows = events(spark, d).select(
        F.col("user_id").alias("object"), day("ts").alias("version"), F.col("event_id").alias("pos"), "event_type", "k", "value"
    )
    content = rows.where(F.col("event_type") != "signup").select(
        "object", "version", "pos", F.col("event_type").alias("ds_id"),
        F.when(F.col("value") >= 20, F.concat(F.lit("label "), F.col("k").cast("string"))).alias("label"),
        F.when(F.col("event_type") == "click", "text/plain").when(F.col("event_type") == "view", "image/png").alias("mime_type"),
    )
    rels = rows.where(F.col("event_type") == "signup")
    names = rels.where(F.col("k") < 75).select(
        "object", "version", "pos",
        F.when(F.col("k") < 25, "click").when(F.col("k") < 50, "view").otherwise("error").alias("ds_id"),
        F.when(F.col("value") < 5, " ").otherwise(F.concat(F.lit("file"), F.col("k").cast("string"))).alias("download_name"),
    )
    return filenames.filename_history(
        content, rels.select("object", "version", "pos"), names, "object", True, spread.by_prefix("version", 7)
    )


def resources_to_write(spark: SparkSession, d: str) -> DataFrame:
    rows = events(spark, d).select("user_id", day("ts").alias("version"), "event_type", "k")
    changed = rows.where(F.col("event_type") != "signup").withColumnRenamed("event_type", "resource")
    touched = rows.where(F.col("event_type") == "signup").withColumn(
        "resource", F.when(F.col("k") < 50, "click").otherwise("view")
    )
    return writes.resources_to_write(changed, touched, "user_id", "version", "resource")


def memento_dates(spark: SparkSession, d: str) -> DataFrame:
    """A resource re-written by a relationship (sign-up) keeps the date of its last content write."""
    rows = events(spark, d).select("user_id", "event_id", "ts", "created", "event_type")
    carried = history.asof_state(
        rows, ["user_id"], ["ts", "event_id"],
        {"memento_date": F.when(F.col("event_type") != "signup", F.col("created"))}, spread.by_day("ts"),
    )
    return carried.where(F.col("event_type") == "signup").select("user_id", "event_id", "created", "memento_date")


QUERIES = {
    f.__name__: f
    for f in (
        version_history, changed_per_version, first_last_versions, rank_ds_versions, create_date, was_changed,
        asof_state, asof_crowded, head_only, snapshot_at, target_objects, apply_deletes, object_state, resolve_content,
        resolve_by_digest, filter_pids, pending, limit_objects, scan_positions, resume_after, accept_all,
        select_objects, conflicts, without_existing, rename_properties, filename_history, resources_to_write,
        memento_dates,
    )
}

_ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%fZ')"
_ORD = _ISO.format("o_orderdate")
_EV = _ISO.format("ts")
_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"
_DAY = "strftime(ts, '%Y-%m-%d')"
_STATE = "CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Deleted' WHEN 'MACHINERY' THEN 'Inactive' ELSE 'Active' END"


def _numbered(source: str, key: str, date: str, extra: str = "") -> str:
    return f"""
SELECT {key}, {date}, {extra} CAST(i AS INTEGER) AS version_index, i = 0 AS is_first, i = n - 1 AS is_last
FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {date}) - 1 AS i, count(*) OVER (PARTITION BY {key}) AS n
      FROM ({source}))"""


def _targets(mode: str, target: str) -> str:
    src = f"SELECT DISTINCT {target} AS target_id, {_DAY} AS version_date FROM events"
    return _numbered(src, "target_id", "version_date", f"'{mode}' AS mode,")


def _deletes(inactive: bool) -> str:
    words = "('Deleted','Inactive')" if inactive else "('Deleted')"
    letters = "('F','P')" if inactive else "('F')"
    return f"""
SELECT o_custkey AS object_key, CAST(o_orderkey AS VARCHAR) AS resource, 'datastream' AS scope, '{RUN_TS}' AS deleted_at,
       {inactive} AS delete_inactive
FROM orders LEFT JOIN customer ON c_custkey = o_custkey
WHERE coalesce({_STATE} IN {words}, false) OR o_orderstatus IN {letters}
UNION ALL
SELECT c_custkey, NULL, 'object', '{RUN_TS}', {inactive} FROM customer WHERE {_STATE} IN {words}"""


ORACLE = {
    "version_history": _numbered(f"SELECT DISTINCT o_custkey, {_ORD} AS created FROM orders", "o_custkey", "created"),
    "changed_per_version": f"""
SELECT o_custkey, {_ORD} AS created, o_orderpriority, o_orderkey AS doc_pos,
       min(o_orderkey) OVER (PARTITION BY o_custkey, o_orderpriority) AS ds_pos FROM orders""",
    "first_last_versions": f"""
SELECT user_id, event_type, count(*) AS n_versions,
       first(event_id ORDER BY ts, event_id) AS first_event_id, last(event_id ORDER BY ts, event_id) AS last_event_id,
       min({_EV}) AS first_created, max({_EV}) AS last_created
FROM events GROUP BY user_id, event_type""",
    "rank_ds_versions": """
SELECT user_id, event_type, event_id,
       row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1 AS is_first,
       row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1 AS is_last FROM events""",
    "create_date": f"""
SELECT user_id, event_type, event_id, {_EV} AS created,
       min({_EV}) OVER (PARTITION BY user_id, event_type) AS create_date FROM events""",
    "was_changed": f"""
SELECT user_id, {_DAY} AS version, bool_or(event_type = 'purchase') AS was_changed FROM events GROUP BY ALL""",
    "asof_state": f"""
SELECT user_id, event_id,
  last_value(CASE WHEN event_type = 'purchase' THEN {_K} END IGNORE NULLS) OVER w AS purchase_k,
  last_value(CASE WHEN event_type = 'signup' THEN value END IGNORE NULLS) OVER w AS signup_value
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "asof_crowded": f"""
SELECT event_type, event_id, last_value(CASE WHEN {_K} < 10 THEN {_K} END IGNORE NULLS) OVER w AS low_k,
  last_value(CASE WHEN user_id % 2 = 0 THEN user_id END IGNORE NULLS) OVER w AS even_user
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "head_only": f"""
SELECT user_id, event_type, event_id, created, k, version_date FROM (
  SELECT user_id, event_type, event_id, {_EV} AS created, {_K} AS k, min({_EV}) OVER (PARTITION BY user_id) AS version_date,
    row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""",
    "snapshot_at": f"""
SELECT user_id, event_type, event_id, created, k FROM (
  SELECT user_id, event_type, event_id, {_EV} AS created, {_K} AS k,
    row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r
  FROM events WHERE ts <= TIMESTAMP '2024-01-15 00:00:00') WHERE r = 1 AND k >= 10""",
    "target_objects": _targets("ARCHIVAL", "'info:fedora/user:' || user_id")
    + " UNION ALL "
    + _targets("ATOMIC", "'info:fedora/user:' || user_id || CASE WHEN event_type = 'signup' THEN '' ELSE '/' || event_type END"),
    "apply_deletes": _deletes(False) + " UNION ALL " + _deletes(True),
    "object_state": f"""
SELECT 'customer:' || c_custkey AS pid, CASE WHEN c_mktsegment <> 'BUILDING' THEN {_STATE} END AS object_state,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'no state property in customer:' || c_custkey END AS message
FROM customer""",
    "resolve_content": """
SELECT d.doc_id AS internal_id, source, count(l.doc_id) AS n_files, min('store/' || l.doc_id) AS path,
       CASE count(l.doc_id) WHEN 0 THEN 'unresolved' WHEN 1 THEN 'resolved' ELSE 'ambiguous' END AS resolution
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY d.doc_id, source""",
    "resolve_by_digest": """
SELECT doc_id, md5(text) AS internal_id, count(*) OVER (PARTITION BY md5(text)) AS n_files,
       'store/' || lpad(CAST(min(doc_id) OVER (PARTITION BY md5(text)) AS VARCHAR), 12, '0') AS path,
       CASE WHEN count(*) OVER (PARTITION BY md5(text)) = 1 THEN 'resolved' ELSE 'ambiguous' END AS resolution
FROM documents""",
    "filter_pids": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey IN (SELECT item_id FROM benchmark)",
    "pending": f"""
SELECT o_orderkey, {_ORD} AS created FROM orders
WHERE o_orderkey NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""",
    "limit_objects": "SELECT c_name, c_custkey FROM customer ORDER BY c_name LIMIT 120",
    "scan_positions": f"""
SELECT o_orderkey, {_ORD} AS created, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS position FROM orders""",
    "resume_after": """
SELECT c_custkey, c_name FROM (SELECT *, row_number() OVER (ORDER BY c_name) AS r FROM customer) WHERE r > 100""",
    "accept_all": "SELECT c_custkey, c_name FROM customer",
    "select_objects": """
WITH limited AS (SELECT c_custkey, c_name FROM customer ORDER BY c_name LIMIT 130),
listed AS (SELECT *, row_number() OVER (ORDER BY c_name) AS r FROM limited WHERE c_custkey IN (SELECT item_id FROM benchmark))
SELECT c_custkey, c_name FROM listed WHERE r > 10 AND c_custkey NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
    "conflicts": "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    "without_existing": "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "rename_properties": """
SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'urn:kind#economy' WHEN 'PROMO' THEN 'urn:kind#promo' ELSE p_type END AS name,
       p_name AS value FROM part""",
    "filename_history": f"""
WITH ev AS (SELECT user_id AS object, {_DAY} AS version, event_id AS pos, event_type, {_K} AS k, value FROM events),
content AS (
  SELECT object, version, pos, event_type AS ds_id, CASE WHEN value >= 20 THEN 'label ' || k END AS label,
         CASE event_type WHEN 'click' THEN '.txt' WHEN 'view' THEN '.png' ELSE '' END AS ext
  FROM ev WHERE event_type <> 'signup'),
rels AS (
  SELECT object, version, pos, k, value, lead(version) OVER w AS next_version, lead(pos) OVER w AS next_pos
  FROM ev WHERE event_type = 'signup' WINDOW w AS (PARTITION BY object ORDER BY version, pos)),
named AS (
  SELECT *, CASE WHEN k < 25 THEN 'click' WHEN k < 50 THEN 'view' ELSE 'error' END AS ds_id,
         CASE WHEN value < 5 THEN ' ' ELSE 'file' || k END AS name FROM rels WHERE k < 75),
expired AS (
  SELECT n.object, n.next_version AS version, n.next_pos AS pos, n.ds_id FROM named n
  WHERE n.next_pos IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM named m WHERE m.object = n.object AND m.pos = n.next_pos AND m.ds_id = n.ds_id)),
ev2 AS (
  SELECT object, ds_id, version, pos, 0 AS phase, 'content' AS kind, label, ext, NULL AS name FROM content
  UNION ALL SELECT object, ds_id, version, pos, 1, 'set', NULL, NULL, name FROM named
  UNION ALL SELECT object, ds_id, version, pos, 1, 'clear', NULL, NULL, NULL FROM expired),
seen AS (
  SELECT *,
    last_value(CASE WHEN kind <> 'content' THEN coalesce(name, '') END IGNORE NULLS) OVER (
      PARTITION BY object, ds_id ORDER BY version, pos, phase ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS in_force,
    last_value(CASE WHEN kind = 'content' THEN coalesce(label, '') END IGNORE NULLS) OVER (
      PARTITION BY object, ds_id ORDER BY version, phase, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_label,
    last_value(CASE WHEN kind = 'content' THEN ext END IGNORE NULLS) OVER (
      PARTITION BY object, ds_id ORDER BY version, phase, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_ext
  FROM ev2),
made AS (
  SELECT *, last_label IS NULL AS lost, kind = 'set' AND trim(name) <> '' AS renamed,
    CASE WHEN last_label IS NULL THEN NULL
         WHEN kind = 'set' THEN CASE WHEN trim(name) <> '' THEN name END
         ELSE coalesce(nullif(trim(in_force), ''), nullif(last_label, ''), ds_id) || last_ext END AS fn
  FROM seen WHERE kind <> 'clear' OR last_label IS NOT NULL)
SELECT object, ds_id, version,
       arg_max(fn, CAST(renamed AS INTEGER) * 1000000000000 + phase * 100000000000 + pos) FILTER (fn IS NOT NULL) AS filename,
       bool_or(lost) AS missing
FROM made GROUP BY object, ds_id, version HAVING count(fn) > 0 OR bool_or(lost)""",
    "resources_to_write": f"""
WITH ev AS (SELECT user_id, {_DAY} AS version, event_type, {_K} AS k FROM events),
own AS (SELECT user_id, version, event_type AS resource FROM ev WHERE event_type <> 'signup'),
named AS (SELECT user_id, version, CASE WHEN k < 50 THEN 'click' ELSE 'view' END AS resource FROM ev WHERE event_type = 'signup')
SELECT user_id, version, resource FROM own
UNION
SELECT user_id, version, resource FROM named n
WHERE EXISTS (SELECT 1 FROM own o WHERE o.user_id = n.user_id AND o.resource = n.resource AND o.version <= n.version)""",
    "memento_dates": f"""
SELECT user_id, event_id, created, memento_date FROM (
  SELECT user_id, event_id, event_type, {_EV} AS created,
    last_value(CASE WHEN event_type <> 'signup' THEN {_EV} END IGNORE NULLS) OVER (
      PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS memento_date
  FROM events) WHERE event_type = 'signup'""",
}

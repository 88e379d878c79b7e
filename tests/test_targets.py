"""What several runs into one target cost: how often records are rendered, which files are read, how many folders are made."""

from __future__ import annotations

import gc
import os

from pyspark.sql import functions as F

from muniment.functions import recordreader, xmltext
from muniment.model import RunOptions
from muniment.operators import triples
from muniment.plans import migration_queries as Q
from muniment.sources import sinks

_TABLES = ("resources", "ntriples", "manifest", "version_state", "versions", "fixity", "rejects", "report", "ledger")


def _store(spark, target: str, run: str, first: int) -> None:
    rows = spark.range(first, first + 60).select(F.concat(F.lit("info:fedora/o:"), F.col("id").cast("string")).alias("object_id"), F.lit("<a> <b> <c> .\n").alias("nt"))
    tables = dict.fromkeys(_TABLES, rows) | {"inventory": rows.select(F.lit("{}").alias("inventory"))}
    sinks.write_outputs(tables, RunOptions(target_dir=target), run)


def test_a_target_is_looked_up_in_its_narrow_table_and_has_folders_for_its_size(spark, tmp_path):
    target, key = f"{tmp_path}/target", "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    _store(spark, target, "007", 0)
    _store(spark, target, "1e3", 30)
    root = f"{target}/data/ocfl-root"
    existing = sinks.existing_objects(spark, RunOptions(target_dir=target))
    read = [f for f in existing.inputFiles() if "/runs/" not in f]
    assert read and all("/versions/run=" in f for f in read)
    assert {r.object_id for r in existing.collect()} == {f"info:fedora/o:{n}" for n in range(90)}
    stored = sinks.published(spark, root, "resources")
    assert {r.run for r in stored.select("run").distinct().collect()} == {"007", "1e3"} and stored.count() == 120
    assert stored.schema["bucket"].dataType.typeName() == "string" and spark.conf.get(key) == before
    for run in ("007", "1e3"):
        folders = [n for n in os.listdir(f"{root}/resources/run={run}") if n.startswith("bucket=")]
        assert 1 < len(folders) <= 16 and {len(n) for n in folders} == {len("bucket=") + 1}
    assert [sinks.bucket_characters(n) for n in (0, 8_000_000, 8_000_001, 128_000_000, 128_000_001)] == [1, 1, 2, 2, 3]


def test_records_of_several_runs_are_rendered_once(spark, monkeypatch):
    rendered, given = [], []

    def records(spark, d):
        rendered.append(d)
        return spark.range(3).select(F.col("id").cast("string").alias("path"))

    def migrated(spark, opts, raw=None):
        given.append(raw)
        return {"ledger": spark.sql("SELECT 'a' AS pid, 'done' AS status"), "rejects": spark.sql("SELECT 'b' AS pid")}

    monkeypatch.setattr(Q, "document_records", records)
    monkeypatch.setattr(Q.migrate, "migrate", migrated)
    monkeypatch.setattr(Q.sinks, "write_outputs", lambda *a, **k: None)
    assert {tuple(r) for r in Q.resume_without_ledger(spark, "d").collect()} == {("a", "done"), ("b", "failed")}
    assert len(rendered) == 1 and len(given) == 2 and given[0] is given[1] and given[0].count() == 3


def test_documents_reach_python_a_few_at_once(spark, monkeypatch):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "10000")
    text = '<d xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:title>t</dc:title><dc:title/></d>'
    made = triples.extract_dc(spark.range(5).select(F.when(F.col("id") == 3, "<broken").when(F.col("id") < 4, text).alias("inline_xml"), "id", F.lit(None).cast("bigint").alias("n")))
    rows = sorted((r.id, r.pos, r.value, r.n) for r in made.where("parse_error IS NULL").collect())
    assert int(spark.conf.get(key)) <= 1000
    spark.conf.set(key, before)
    assert rows == [(i, p, v, None) for i in range(3) for p, v in ((0, "t"), (1, ""))]
    assert made.where("parse_error LIKE 'Failed to parse DC XML: %' AND value IS NULL").count() == 1
    # Prefixes are looked up for markup inside of literals only, and a document is else read once.
    rdf = '<r:RDF xmlns:r="{0}"><r:Description r:about="u:a"><p xmlns="u:"{1}>{2}</p></r:Description></r:RDF>'
    marked = rdf.format(xmltext.RDF, ' r:parseType="Literal"', '<q:b xmlns:q="u:q">x</q:b>')
    assert xmltext.rdf_rows(marked)[0][2] == '<q:b xmlns:q="u:q">x</q:b>'
    monkeypatch.setattr(xmltext.ET, "iterparse", lambda *a: 1 / 0)
    assert xmltext.rdf_rows(rdf.format(xmltext.RDF, "", "x"))[0][:3] == ("u:a", "u:p", "x")


def test_a_record_that_was_read_is_freed_at_once():
    rows = recordreader.Rows()
    gc.collect()
    gc.disable()
    try:
        for data, problem in ((b"<digitalObject PID='a'/>", None), (b"<broken", None), (None, "no text")):
            recordreader.read_record(rows, data, problem)
        left = sum(isinstance(o, recordreader.RecordReader) for o in gc.get_objects())
    finally:
        gc.enable()
    assert left == 0 and rows.objects["pid"] == ["a", None, None] and rows.objects["problem"] == [None, "malformed record", "no text"]

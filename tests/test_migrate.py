"""Whole runs over hand-written records: one run per option set, many objects per run."""

from __future__ import annotations

import hashlib
import json
from dataclasses import replace

import handmade as X
import pytest

from muniment import model as M
from muniment.model import RunOptions
from muniment.operators.rejects import MigrationFailure
from muniment.plans.migrate import migrate
from muniment.sources import records, sinks

BASE = RunOptions(source_profile="exported", run_ts="2024-01-01T00:00:00.000Z", continue_on_error=True)


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def named(pid, ds_id, name):
    return (f"info:fedora/{pid}/{ds_id}", f"<m:downloadFilename>{name}</m:downloadFilename>")


def animal(pid, ds_id, what):
    return (f"info:fedora/{pid}/{ds_id}", f"<ex:animal>{what}</ex:animal>")


def rels_int(*versions):
    return X.ds("RELS-INT", [X.version(f"RELS-INT.{i}", at, X.rdf(*pairs), mime="application/rdf+xml") for i, (at, pairs) in enumerate(versions)])


def simple(pid, **kw):
    return X.record(pid, [X.ds("DS", [X.version("DS.0", X.t(1), X.b64("one"))], "M", kw.pop("ds_state", "A"))], **kw)


def rename_record(pid):
    return X.record(pid, [
        rels_int((X.t(2), [named(pid, "DS", "example.xml")]), (X.t(3), [])),
        X.ds("DS", [X.version("DS.0", X.t(1), X.b64("<h1/>"), label="ds3-label", mime="application/xml"),
                    X.version("DS.1", X.t(4), X.b64("<h2/>"), label="test", mime="application/xml")], "M"),
    ])


def animal_record(pid):
    return X.record(pid, [
        X.ds("A", [X.version("A.0", X.t(1), X.b64("a"))], "M"),
        X.ds("B", [X.version("B.0", X.t(1), X.b64("b")), X.version("B.1", X.t(2), X.b64("b2"))], "M"),
        X.ds("RELS-EXT", [
            X.version("RELS-EXT.0", X.t(1), X.rdf((f"info:fedora/{pid}", '<m:hasModel rdf:resource="info:fedora/TestObject"/>'))),
            X.version("RELS-EXT.1", X.t(2), X.rdf((f"info:fedora/{pid}", '<m:hasModel rdf:resource="info:fedora/ExampleObject"/>'))),
        ]),
        rels_int((X.t(1), [animal(pid, "A", "cat"), animal(pid, "B", "dog")]), (X.t(3), [animal(pid, "B", "frog")])),
    ])


@pytest.fixture(scope="module")
def run(spark):
    raw = X.frame(
        spark,
        rename_record("o:rename"),
        animal_record("o:animal"),
        simple("o:gone", state="Deleted"),
        simple("o:off", state="Inactive"),
        simple("o:dsgone", ds_state="D"),
        X.record("o:order", [X.ds("DS", [X.version("DS.1", X.t(5), X.b64("later")), X.version("DS.0", X.t(2), X.b64("sooner"))], "M")]),
        X.record("o:links", [
            X.ds("E", [X.version("E.0", X.t(1), X.at("URL", "http://local.fedora.server/x"), label="l")], "E"),
            X.ds("R", [X.version("R.0", X.t(1), X.at("URL", "http://other.example.org/y"))], "R"),
        ]),
        X.record("o:same", [X.ds("P", [X.version("P.0", X.t(1), X.b64("same"))], "M"), X.ds("Q", [X.version("Q.0", X.t(2), X.b64("same"))], "M")]),
        X.record("o:sum", [X.ds("DS", [X.version("DS.0", X.t(1), X.b64("x"), digest=("MD5", "wrong"))], "M")]),
        X.record("o:odd", [X.ds("DS", [X.version("DS.0", X.t(1), X.b64("x"), digest=("ODD", "ff"))], "M")]),
        X.record("o:lost", [X.ds("DS", [X.version("DS.0", X.t(1), X.at("INTERNAL_ID", "o:lost+DS+DS.0"))], "M")]),
        simple("o:nostate").replace("model#state", "model#other"),
        simple("o:twice"),
        simple("o:twice"),
        X.record("o:badrdf", [X.ds("RELS-EXT", [X.version("RELS-EXT.0", X.t(1), X.b64("<rdf"))], "M")]),
        X.record("o:early", [rels_int((X.t(1), [named("o:early", "DS", "x")])), X.ds("DS", [X.version("DS.0", X.t(2), X.b64("x"))], "M")]),
        X.record("o:frac", [X.ds("DS", [
            X.version("DS.0", "2015-01-27T19:07:33Z", X.b64("a")), X.version("DS.1", "2015-01-27T19:07:33.120Z", X.b64("b"))], "M")]),
        "<broken",
    )
    return migrate(spark, BASE, raw=raw)


def of(tables, pid, kind=None):
    rows = [r for r in tables["resources"].collect() if r.pid == pid and (kind is None or r.kind == kind)]
    return sorted(rows, key=lambda r: (r.version, r.logical_path))


def test_rejects(run):
    got = {(r.pid, r.stage) for r in run["rejects"].collect()}
    assert got == {
        ("o:sum", "content digest"), ("o:lost", "content"), ("o:nostate", "state"), ("o:twice", "conflict"), ("o:badrdf", "document"),
        ("o:early", "missing_resource"), ("o:frac", "version"), (None, "unreadable"),
    }
    moved = {r.pid for r in run["resources"].collect()}
    assert not moved & {"o:sum", "o:lost", "o:nostate", "o:badrdf", "o:early", "o:frac"}
    assert len(of(run, "o:twice", "binary")) == 1
    assert ("o:odd", "content digest") in {(r.pid, r.stage) for r in run["warnings"].collect()}


def test_filename_set_removed_and_relabelled(run):
    got = [(r.version, r.header_only, r.headers.filename) for r in of(run, "o:rename", "binary") if r.logical_path == "DS"]
    assert got == [(1, False, "ds3-label"), (2, True, "example.xml"), (3, True, "ds3-label"), (4, False, "test")]


def test_relationships_over_versions(run):
    def text(version, path):
        return [r.nt for r in of(run, "o:animal") if r.version == version and r.logical_path == path]

    assert '"cat"' in text(1, "A~fcr-desc.nt")[0] and "dog" not in text(1, "A~fcr-desc.nt")[0]
    assert '"dog"' in text(1, "B~fcr-desc.nt")[0] and '"dog"' in text(2, "B~fcr-desc.nt")[0]
    assert '"frog"' in text(3, "B~fcr-desc.nt")[0] and "dog" not in text(3, "B~fcr-desc.nt")[0]
    assert not text(2, "A~fcr-desc.nt") and not text(3, "A~fcr-desc.nt")
    assert "TestObject" in text(1, "fcr-container.nt")[0]
    assert "ExampleObject" in text(2, "fcr-container.nt")[0] and "TestObject" not in text(2, "fcr-container.nt")[0]
    assert not text(3, "fcr-container.nt")


def test_deletes(run):
    gone = [r for r in of(run, "o:gone") if r.deleted]
    assert {r.logical_path for r in gone} == {"DS", "DS~fcr-desc.nt", "fcr-container.nt"} and {r.version for r in gone} == {2}
    assert all(r.headers.deleted and r.headers.last_modified_date.year == 2024 for r in gone)
    assert {r.logical_path for r in of(run, "o:dsgone") if r.deleted} == {"DS", "DS~fcr-desc.nt"}
    assert not [r for r in of(run, "o:off") if r.deleted]


def test_versions_order_and_links(run):
    assert [(r.version, r.bytes) for r in of(run, "o:order", "binary")] == [(1, 6), (2, 5)]
    assert [str(r.headers.created_date.date()) for r in of(run, "o:order", "binary")] == ["2015-01-02"] * 2
    links = {r.logical_path: r for r in of(run, "o:links", "binary")}
    assert links["E"].headers.external_handling == "proxy" and links["E"].headers.external_url == "http://fedora.info/x"
    assert links["R"].headers.external_handling == "redirect" and links["R"].digest is None


def test_inventory(run):
    doc = json.loads(next(r.inventory for r in run["inventory"].collect() if r.object_id == "info:fedora/o:same"))
    digest = hashlib.sha512(b"same").hexdigest()
    assert doc["head"] == "v2" and doc["manifest"][digest] == ["v1/content/P"]
    assert doc["versions"]["v1"]["state"][digest] == ["P"] and doc["versions"]["v2"]["state"][digest] == ["P", "Q"]
    assert doc["versions"]["v2"]["user"] == {"name": "fedoraAdmin", "address": "info:fedora/fedoraAdmin"}
    deleted = json.loads(next(r.inventory for r in run["inventory"].collect() if r.object_id == "info:fedora/o:gone"))
    assert deleted["versions"]["v2"]["state"] == {} and len(deleted["versions"]["v1"]["state"]) == 3
    for r in run["inventory"].collect():
        d = json.loads(r.inventory)
        used = {k for v in d["versions"].values() for k in v["state"]}
        assert used == set(d["manifest"])


def test_plain_record_file_and_prefix(spark):
    raw = X.frame(
        spark, simple("p:1"),
        X.record("p:2", [X.ds("E", [X.version("E.0", X.t(1), X.at("URL", "http://local.fedora.server/x"))], "E", "I")], state="Inactive"),
    )
    opts = replace(BASE, migration_type=M.PLAIN_OCFL, id_prefix="urn:x:", foxml_file=True, delete_inactive=True, local_host="h:1", digest_algorithm="sha256")
    out = migrate(spark, opts, raw=raw)
    one = of(out, "p:1")
    assert [(r.version, r.logical_path, r.deleted) for r in one] == [(1, "DS", False), (1, "FOXML", False), (2, "FOXML", True)]
    assert one[0].object_id == "urn:x:p:1" and one[0].digest == hashlib.sha256(b"one").hexdigest()
    two = of(out, "p:2")
    assert {(r.version, r.logical_path, r.deleted) for r in two} == {(1, "E", False), (1, "FOXML", False), (2, "E", True), (2, "FOXML", True)}
    assert next(r for r in two if r.logical_path == "E" and not r.deleted).digest == hashlib.sha256(b"http://h:1/x").hexdigest()


def test_content_directory_sinks_and_ledger(spark, tmp_path):
    objects, store, target = tmp_path / "objects", tmp_path / "store", tmp_path / "target"
    objects.mkdir(), store.mkdir()
    body = "managed text"
    rels = X.rdf(named("c:1", "DS", "own.txt")).split("\n")[1]
    (store / "info%3Afedora%2Fc%3A1%2FDS%2FDS.0").write_text(body)
    (store / "info%3Afedora%2Fc%3A1%2FRELS-INT%2FRELS-INT.0").write_text(rels)
    for n, digest in ((1, md5(body).upper()), (2, "00")):
        (objects / f"r{n}").write_text(X.record(f"c:{n}", [
            X.ds("DS", [X.version("DS.0", X.t(1), X.at("INTERNAL_ID", "c:1+DS+DS.0"), digest=("MD5", digest), mime="")], "M"),
            *([X.ds("RELS-INT", [X.version("RELS-INT.0", X.t(2), X.at("INTERNAL_ID", "c:1+RELS-INT+RELS-INT.0"))], "M")] if n == 1 else []),
        ]))
    (objects / "r3").write_text(simple("c:3"))
    opts = RunOptions(
        source_profile="akubra", objects_dir=str(objects), datastreams_dir=str(store), target_dir=str(target), index_dir=str(tmp_path / "index"),
        continue_on_error=True, run_ts=BASE.run_ts, ledger_dir=str(tmp_path / "ledger"),
    )
    out = migrate(spark, opts)
    assert {(r.pid, r.stage) for r in out["rejects"].collect()} == {("c:2", "content digest")}
    ds = [r for r in of(out, "c:1", "binary") if r.logical_path == "DS"]
    assert [(r.version, r.headers.filename, r.header_only) for r in ds] == [(1, "DS", False), (2, "own.txt", True)]
    assert ds[0].digest == hashlib.sha512(body.encode()).hexdigest() and ds[0].headers.mime_type == "application/octet-stream"
    sinks.write_outputs(out, opts)
    root = f"{target}/data/ocfl-root"
    stored = spark.read.parquet(f"{root}/resources")
    assert stored.count() == out["resources"].count() and {"bucket", "object_dir", "version_user"} <= set(stored.columns)
    assert spark.read.text(f"{root}/inventories").count() == 2
    assert spark.read.text(f"{root}/ntriples").where("value like '<%> .' or value like '<%\" .' or value like '%^^<%> .'").count() > 0
    assert {r.pid for r in records.read_ledger(spark, opts.ledger_dir).collect()} == {"c:1", "c:3"}
    again = migrate(spark, replace(opts, resume=True))
    assert {r.pid for r in again["source_versions"].collect()} == {"c:2"}
    blocked = migrate(spark, replace(opts, limit=1), existing=stored.select("object_id").distinct())
    assert {(r.pid, r.stage) for r in blocked["rejects"].collect()} == {("c:1", "conflict")}
    blocked = migrate(spark, opts)  # the run finds by itself what the target holds
    assert {(r.pid, r.stage) for r in blocked["rejects"].collect()} == {("c:1", "conflict"), ("c:2", "content digest"), ("c:3", "conflict")}
    assert sinks.published(spark, root, "resources").count() == stored.count()
    unchecked = migrate(spark, replace(opts, disable_checksum_validation=True, target_dir=str(tmp_path / "other")))
    assert not unchecked["rejects"].collect() and {r.pid for r in unchecked["ledger"].collect()} == {"c:1", "c:2", "c:3"}


def test_a_run_that_dies_leaves_nothing_that_counts(spark, tmp_path, monkeypatch):
    opts = replace(BASE, target_dir=str(tmp_path / "target"))
    out = migrate(spark, opts, raw=X.frame(spark, simple("o:1"), simple("o:2")))
    root = sinks.target_root(opts)
    with monkeypatch.context() as m:
        m.setattr(sinks, "write_rejects", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sinks.write_outputs(out, opts, "first")
    assert sinks.existing_objects(spark, opts) is None
    assert sinks.write_outputs(out, opts, "first") == "first"  # the same run again
    sinks.write_outputs(migrate(spark, opts, raw=X.frame(spark, simple("o:3"))), opts)
    stored = sinks.published(spark, root, "resources")
    assert stored.count() == 3 * out["resources"].where("pid = 'o:1'").count() and {r.object_id for r in sinks.existing_objects(spark, opts).collect()} == {f"info:fedora/o:{n}" for n in (1, 2, 3)}
    assert sinks.published(spark, root, "inventories").count() == 3


def test_selections_keep_rejects_and_resume_is_checked(spark, tmp_path):
    raw = X.frame(spark, simple("o:1"), "<broken", simple("o:2"), X.record("o:bare", []), simple("o:4"))
    some = migrate(spark, replace(BASE, limit=2), raw=raw)
    assert {(r.pid, r.stage) for r in some["rejects"].collect()} == {(None, "unreadable")} and {r.pid for r in some["ledger"].collect()} == {"o:1", "o:2"}
    whole = migrate(spark, replace(BASE, target_dir=str(tmp_path / "t")), raw=raw)
    assert {r.pid: r.position for r in whole["ledger"].collect()} == {"o:1": 0, "o:2": 1, "o:bare": 2, "o:4": 3}
    rest = migrate(spark, replace(BASE, resume=True, resume_position=2, resume_last_id="O:2"), raw=raw)
    assert {r.pid for r in rest["ledger"].collect()} == {"o:bare", "o:4"}
    every = migrate(spark, replace(BASE, resume_position=2, resume_last_id="o:2"), raw=raw)
    assert every["ledger"].count() == 4
    for bad in (dict(resume_position=2, resume_last_id="o:1"), dict(resume=True, resume_last_id="o:1")):
        with pytest.raises(ValueError):
            migrate(spark, replace(BASE, **bad), raw=raw)


def test_names_for_foreign_resources_and_odd_forms(spark):
    other = X.record("o:other", [rels_int((X.t(2), [named("o:else", "DS", "x")])), X.ds("DS", [X.version("DS.0", X.t(1), X.b64("x"))], "M")])
    out = migrate(spark, BASE, raw=X.frame(spark, other, simple("o:1")))
    assert {(r.pid, r.stage) for r in out["rejects"].collect()} == {("o:other", "missing_resource")}


def test_fail_fast(spark):
    with pytest.raises(MigrationFailure, match="o:1"):
        migrate(spark, replace(BASE, continue_on_error=False), raw=X.frame(spark, simple("o:1").replace("model#state", "x")))


def test_options():
    for bad in (
        dict(source_profile="other"), dict(id_prefix="urn:x"), dict(digest_algorithm="md5"), dict(head_only=True, resource_type=M.ATOMIC),
    ):
        with pytest.raises(ValueError):
            replace(BASE, **bad)


@pytest.mark.parametrize("options", [dict(), dict(head_only=True), dict(migration_type=M.PLAIN_OCFL, head_only=True), dict(migration_type=M.PLAIN_OCFL, resource_type=M.ATOMIC)])
def test_whole_writes_are_stored_once_and_deletions_read_off_them(spark, monkeypatch, options):
    from muniment.plans import migrate as module

    stored, real = [], module.stage
    monkeypatch.setattr(module, "stage", lambda df, name, *a, **k: (stored.append(name) if "headers" in df.columns else None) or real(df, name, *a, **k))
    texts = [simple("ex:kept"), simple("ex:ds-gone", ds_state="D"), simple("ex:gone", state="Deleted"), rename_record("ex:renamed")]
    raw = spark.createDataFrame([(f"store/{i}", x, len(x)) for i, x in enumerate(texts)], "path string, xml string, length bigint")
    rows = migrate(spark, replace(BASE, **options), raw=raw)["resources"].collect()
    assert stored == ["writes"]
    plain, atomic, head = "migration_type" in options, "resource_type" in options, "head_only" in options
    last = {}
    for r in rows:
        key = (r.object_id, r.resource_id)
        assert not r.deleted or (r.headers.deleted and (r.bytes, r.digest, r.nt) == (None, None, None))
        last[key] = max(last.get(key, (0, False)), (r.version, r.deleted))
    gone = {k[1].removeprefix("info:fedora/") for k, (_, deleted) in last.items() if deleted}
    assert gone == {f"ex:ds-gone/DS{x}" for x in ("", "/fcr:metadata")} | {f"ex:gone{x}" for x in ("", "/DS", "/DS/fcr:metadata")}
    versions = {(r.object_id.removeprefix("info:fedora/"), r.resource_id.removeprefix("info:fedora/")): sorted(x.version for x in rows if (x.object_id, x.resource_id) == (r.object_id, r.resource_id)) for r in rows}
    assert versions[("ex:gone", "ex:gone")] == ([1] if head and not plain else [1, 2])
    ds = versions[("ex:renamed/DS" if atomic else "ex:renamed", "ex:renamed/DS")]
    assert ds == ([1] if head else [1, 3] if atomic else [1, 2, 3, 4])

"""Resume rules, error policy, and the incremental run."""

from __future__ import annotations

import handmade as X
import pytest

from muniment.operators import rejects, select
from muniment.session import fresh_path
from muniment.streaming import ingest


@pytest.fixture(scope="module")
def pids(spark):
    return spark.createDataFrame([(f"p{i}", f"{i:03d}") for i in range(10)], "pid string, path string")


def names(df):
    return sorted(r.pid for r in df.collect())


def test_limit(pids):
    assert select.limit_objects(pids, -1, ["path"]).count() == 10
    assert select.limit_objects(pids, 0, ["path"]).count() == 0
    assert names(select.limit_objects(pids, 3, ["path"])) == ["p0", "p1", "p2"]
    assert select.limit_objects(pids, 99, ["path"]).count() == 10


def test_resume(pids):
    assert names(select.resume_after(pids, 8, "P7", "pid", ["path"])) == ["p8", "p9"]
    assert select.resume_after(pids, 8, "p7", "pid", ["path"], resume=False).count() == 10
    assert select.resume_after(pids, 0, "foo", "pid", ["path"]).count() == 10
    for position, last in ((8, "p6"), (0, "p1")):
        with pytest.raises(ValueError):
            select.resume_after(pids, position, last, "pid", ["path"])


def test_lists(spark, pids):
    empty = spark.createDataFrame([], "pid string")
    assert select.filter_pids(pids, empty, "pid").count() == 10
    listed = spark.createDataFrame([("p1",), ("p5",), ("zz",)], "pid string")
    assert names(select.filter_pids(pids, listed, "pid")) == ["p1", "p5"]
    ledger = spark.createDataFrame([("p1", "done"), ("p2", "failed")], "pid string, status string")
    assert names(select.select_objects(pids, "pid", ["path"], 4, resume=True, ledger=ledger)) == ["p0", "p2", "p3"]


def test_error_policy(spark, pids):
    bad = spark.createDataFrame([("p1", "s", "m")], "pid string, stage string, message string")
    assert rejects.partition_rejects(pids, bad, True).count() == 9
    with pytest.raises(rejects.MigrationFailure):
        rejects.partition_rejects(pids, bad, False)
    assert rejects.partition_rejects(pids, bad.limit(0), False).count() == 10


def test_stream_takes_new_files_once(spark, tmp_path):
    root = tmp_path / "in" / "deep"
    root.mkdir(parents=True)
    sink, checkpoint = fresh_path(spark, "sink"), fresh_path(spark, "check")

    def put(n):
        (root / f"r{n}").write_text(X.record(f"s:{n}", [X.ds("DS", [X.version("DS.0", X.t(1), X.inline("<a/>"), digest=("MD5", "00"))])]))

    put(1), put(2)
    (root / ".hidden").write_text("x")
    out = ingest.ingest_available(ingest.stream_records(spark, str(tmp_path / "in")), sink, checkpoint)
    assert names(out["parsed"]) == ["s:1", "s:2"] and {r.inline_status for r in out["versions"].collect()} == {"mismatch"}
    put(3)
    out = ingest.ingest_available(ingest.stream_records(spark, str(tmp_path / "in")), sink, checkpoint)
    assert names(out["versions"]) == ["s:1", "s:2", "s:3"]
    out = ingest.ingest_available(ingest.stream_records(spark, str(tmp_path / "in")), sink, checkpoint)
    assert out["versions"].count() == 3


def test_stream_encodings_and_repeated_ids(spark, tmp_path):
    sink, checkpoint = fresh_path(spark, "sink"), fresh_path(spark, "check")

    def put(name, pid, encoding="UTF-8", label="x"):
        text = X.record(pid, [X.ds("DS", [X.version("DS.0", X.t(1), X.inline(f"<a>{label}</a>"))])]).split("?>", 1)[-1]
        (tmp_path / name).write_bytes(f'<?xml version="1.0" encoding="{encoding}"?>{text}'.encode(encoding))

    def run():
        return ingest.ingest_available(ingest.stream_records(spark, str(tmp_path)), sink, checkpoint)

    put("a", "s:1", "UTF-16", "h\u00e9"), put("b", "s:2", "ISO-8859-1", "\u00fc"), put("c", "s:2")
    (tmp_path / "bad").write_bytes(b'<?xml version="1.0"?><a>\xff</a>')
    out = run()
    bodies = {r.pid: r.inline_xml for r in out["versions"].collect()}
    assert set(bodies) == {"s:1", "s:2"} and "h\u00e9" in bodies["s:1"] and "\u00fc" in bodies["s:2"]
    assert [r.pid for r in out["rejects"].collect()] == ["s:2"]
    put("d", "s:1"), put("e", "s:3")
    out = run()
    assert sorted((r.pid, r.path[-2:]) for r in out["rejects"].collect()) == [("s:1", "/d"), ("s:2", "/c")]
    assert sorted(r.pid for r in out["parsed"].collect() if r.pid) == ["s:1", "s:2", "s:3"]
    assert {r.pid: r.inline_xml for r in out["versions"].collect()}.items() > bodies.items()

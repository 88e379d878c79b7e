"""What whole runs need not do for every element or object, with the same results."""

from __future__ import annotations

import pyarrow as pa

from muniment import model as M
from muniment.functions import recordreader
from muniment.operators import inventory

NAMES = ("kind", "version", "until", "digest", "path", "body")
PARTS = pa.list_(pa.struct([(n, pa.int32() if n in ("version", "until") else pa.string()) for n in NAMES]))


def _batch(n):
    parts = lambda i: [] if i % 5 == 4 else [("version", 1, None, None, None, '{"created":"c"}'), ("state", 1, None, f"d{i}", 'a"é', None), ("manifest", None, None, f"d{i}", "v1/content/a", None)]
    rows = [[dict(zip(NAMES, p)) for p in parts(i)] for i in range(n)]
    return pa.RecordBatch.from_arrays([pa.array([f"o{i}" for i in range(n)]), pa.array(rows, PARTS)], names=["object_id", "parts"])


def test_inventories_of_many_objects_share_a_batch(monkeypatch):
    batch, names = _batch(500), ["object_id", "head", "inventory"]
    together = list(inventory._documents([batch, batch.slice(100, 50)], names, "sha256"))
    assert len(together) == 2
    rows = [r for b in together for r in b.to_pylist()]
    assert [r["object_id"] for r in rows] == [f"o{i}" for i in [*range(500), *range(100, 150)] if i % 5 != 4]
    assert rows[7]["inventory"].endswith('"manifest":{"d8":["v1/content/a"]},"versions":{"v1":{"created":"c","state":{"d8":["a\\"é"]}}}}')
    monkeypatch.setattr(inventory, "PARTS_AT_ONCE", 7)
    monkeypatch.setattr(inventory, "TEXT_AT_ONCE", 300)
    apart = list(inventory._documents([batch, batch.slice(100, 50)], names, "sha256"))
    assert len(apart) > 100
    assert [r for b in apart for r in b.to_pylist()] == rows


def _record(body: str, after: str = "") -> bytes:
    version = lambda i, content: f'<f:datastreamVersion ID="V.{i}" CREATED="2020-01-01T00:00:00.000Z">{content}</f:datastreamVersion>'
    contents = (f"<f:xmlContent>{body}</f:xmlContent>{after}", "<f:binaryContent>YWJj\nZA==</f:binaryContent>", "<f:xmlContent/>", '<f:contentLocation TYPE="URL" REF="http://x/"/>')
    return (
        f'<f:digitalObject xmlns:f="{M.FOXML_NS}" PID="a:1"><f:objectProperties><f:property NAME="n" VALUE="v"/></f:objectProperties>\n'
        f'<f:datastream ID="D" CONTROL_GROUP="X">{"".join(version(i, c) for i, c in enumerate(contents))}</f:datastream>\n</f:digitalObject>'
    ).encode()


def test_reader_is_told_of_no_element_inside_inline_content(monkeypatch):
    told = []
    start = recordreader.RecordReader._start
    monkeypatch.setattr(recordreader.RecordReader, "_start", lambda self, name, given: (told.append(name), start(self, name, given))[1])
    body = "<a>" + "<b c='d'>x</b>" * 500 + "</a>"
    rows = recordreader.Rows()
    recordreader.read_record(rows, _record(body))
    assert len(told) < 20
    assert rows.versions["inline_xml"] == [body, None, None, None]
    assert rows.versions["base64"] == [None, "YWJj\nZA==", None, None]
    assert rows.versions["location_ref"] == [None, None, None, "http://x/"]
    assert rows.objects["problem"] == [None]
    assert rows.objects["structure_problem"] == [None]
    assert rows.objects["n_inline"] == [2]
    for odd, problem in ((" x ", "text outside of elements"), ("\n \n", None), ("<f:datastream/>", "element out of place: datastream in datastreamVersion")):
        rows = recordreader.Rows()
        recordreader.read_record(rows, _record(body, odd))
        assert rows.objects["structure_problem"] == [problem]

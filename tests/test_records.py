"""Shredding of hand-written records, scans, lists and XML helpers."""

from __future__ import annotations

import re

import handmade as X
import pytest
from pyspark.sql import functions as F

from muniment.functions import mime, xmltext
from muniment.operators import shred, triples, validate
from muniment.sources import content, records


def sample():
    return X.record(
        "example:1",
        [
            X.ds("DC", [X.version("DC.0", X.t(1), X.inline("<a>\n  <b/>\n</a>"), label=" spaced ", mime="text/xml", size=34)]),
            X.ds("DS1", [
                X.version("DS1.1", X.t(3), X.inline("<two/>")), X.version("DS1.0", X.t(2), X.inline("<one/>")),
            ]),
            X.ds("DS2", [X.version("DS2.0", X.t(2), X.at("INTERNAL_ID", "example:1+DS2+DS2.0"), digest=("MD5", "abc"))], "M"),
            X.ds("DS3", [X.version("DS3.0", X.t(2), X.at("URL", " http://local.fedora.server/x"))], "R", "I"),
            X.ds("DS4", [X.version("DS4.0", X.t(2), X.b64("hello"))], "M"),
        ],
        props=[("info:fedora/fedora-system:def/model#label", 'A "label" & <more>'), ("owner", "")],
    )


def test_shredding(spark):
    parsed = shred.parse_records(X.frame(spark, sample()))
    props = shred.shred_properties(parsed).orderBy("pos").collect()
    assert [p.name.rsplit("#")[-1] for p in props] == ["state", "createdDate", "lastModifiedDate", "label", "owner"]
    assert props[3].value == 'A "label" & <more>' and props[4].value == ""
    vs = {v.version_id: v for v in shred.shred_versions(parsed, "host:1").collect()}
    assert len(vs) == 6
    assert vs["DC.0"].inline_xml == "\n<a>\n  <b/>\n</a>\n" and vs["DC.0"].label == " spaced " and vs["DC.0"].size == 34
    assert vs["DS1.1"].inline_xml == "\n<two/>\n" and vs["DS1.0"].inline_xml == "\n<one/>\n" and vs["DS1.0"].size == -1
    assert vs["DS2.0"].content_kind == "internal" and vs["DS2.0"].digest_value == "abc"
    assert vs["DS3.0"].content_ref == "http://host:1/x" and vs["DS3.0"].state == "I"
    assert vs["DS4.0"].content_kind == "base64"
    assert not shred.inline_count_problems(parsed).collect()
    assert not shred.structure_report(parsed).collect()
    streams = shred.shred_datastreams(parsed).orderBy("doc_pos").collect()
    assert [s.ds_id for s in streams] == ["DC", "DS1", "DS2", "DS3", "DS4"] and all(s.versionable for s in streams)


def test_broken_records(spark):
    good = sample()
    bad = [good[:200], "", "no xml", good.replace("</a>", ""), good.replace(' PID="example:1"', "")]
    parsed = shred.parse_records(X.frame(spark, good, *bad))
    assert shred.shred_objects(parsed).count() == 1
    assert shred.unreadable(parsed).count() == len(bad)
    assert {r.pid for r in shred.shred_versions(parsed).collect()} <= {"example:1", None}


@pytest.mark.parametrize("change, problem", [
    (("</foxml:digitalObject>", "<foxml:odd/></foxml:digitalObject>"), "element not known here"),
    (("</foxml:digitalObject>", "words</foxml:digitalObject>"), "text outside of elements"),
    (("</foxml:digitalObject>", "<!-- c --></foxml:digitalObject>"), "comment or instruction"),
])
def test_structure(spark, change, problem):
    got = shred.structure_report(shred.parse_records(X.frame(spark, sample().replace(*change)))).collect()
    assert len(got) == 1 and got[0].structure_problem.startswith(problem)


def test_unpaired_inline_bodies(spark):
    xml = sample().replace("<foxml:xmlContent>\n<two/>", "<foxml:xmlContent >\n<two/>")
    assert shred.inline_count_problems(shred.parse_records(X.frame(spark, xml))).count() <= 1


def test_normal_form():
    assert xmltext.normal_form('\n<a z="1" b="x&#10;y">\n  <c></c> t &amp; u &gt;\n <!-- k --></a>\n') == (
        '<?xml version="1.0" encoding="UTF-8"?><a b="x&#xa;y" z="1"><c/> t &amp; u &gt;<!-- k --></a>'
    )
    assert xmltext.normal_form("<a><![CDATA[<&>]]></a>").endswith("<a><![CDATA[<&>]]></a>")
    for bad in ("<a>", "<p:a/>", "<?pi x?><a/>"):
        with pytest.raises(Exception):
            xmltext.normal_form(bad)


def test_inline_statuses(spark):
    rows = [("<a/>", "MD5", "bad"), ("<a/>", "DISABLED", "none"), ("<a/>", "MD5", ""), ("<a/>", "ODD", "ff"), (None, "MD5", "ff"), ("<a>", "MD5", "ff")]
    df = spark.createDataFrame(rows, "inline_xml string, digest_type string, digest_value string")
    got = [r.inline_status for r in validate.validate_inline(df).collect()]
    assert got == ["mismatch", "skipped", "skipped", "unsupported", "skipped", "unsupported"]


def test_rdf_forms():
    doc = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:e="urn:e#" xml:lang="en">
      <e:Thing rdf:about="urn:1" e:short="s"><e:p rdf:resource="urn:2"/><e:q rdf:datatype="urn:t">5</e:q>
      <e:r><rdf:Description><e:x>in</e:x></rdf:Description></e:r></e:Thing></rdf:RDF>"""
    got = set(xmltext.rdf_rows(doc))
    assert ("urn:1", xmltext.RDF + "type", "urn:e#Thing", "uri", None, None) in got
    assert ("urn:1", "urn:e#p", "urn:2", "uri", None, None) in got
    assert ("urn:1", "urn:e#q", "5", "literal", "urn:t", None) in got
    assert any(s == "_:b0" and p == "urn:e#x" for s, p, *_ in got)
    assert any(p == "urn:e#p" and o == xmltext.RDF + "nil" for _, p, o, *_ in xmltext.rdf_rows(doc.replace('rdf:resource="urn:2"', 'rdf:parseType="Collection"')))
    with pytest.raises(ValueError):
        xmltext.rdf_rows(doc.replace("<e:r>", "<e:r><rdf:Description/>"))


def test_rdf_forms_beyond_plain_statements():
    rdf, xs = xmltext.RDF, "http://www.w3.org/2001/XMLSchema#string"
    doc = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:e="urn:e#" xml:base="http://b.org/x/y">
      <rdf:Bag rdf:ID="bag"><rdf:li>one</rdf:li><rdf:li rdf:resource="z"/></rdf:Bag>
      <rdf:Description rdf:about=""><e:res rdf:parseType="Resource"><e:in>v</e:in></e:res>
        <e:lit rdf:parseType="Literal">a <e:b c="1"/></e:lit>
        <e:list rdf:parseType="Collection"><rdf:Description rdf:about="urn:1"/><rdf:Description rdf:about="urn:2"/></e:list>
        <e:said rdf:ID="st">w</e:said><e:short e:k="v" rdf:resource="#t"/></rdf:Description></rdf:RDF>"""
    got = set(xmltext.rdf_rows(doc))
    bag, me = "http://b.org/x/y#bag", "http://b.org/x/y"
    assert {(bag, rdf + "type", rdf + "Bag", "uri", None, None), (bag, rdf + "_1", "one", "literal", xs, None), (bag, rdf + "_2", "http://b.org/x/z", "uri", None, None)} <= got
    objects = {p: o for s, p, o, *_ in got if s == me}
    assert (objects["urn:e#res"], "urn:e#in", "v", "literal", xs, None) in got
    assert objects["urn:e#lit"] == 'a <e:b xmlns:e="urn:e#" c="1"></e:b>'
    first = objects["urn:e#list"]
    second = next(o for s, p, o, *_ in got if s == first and p == rdf + "rest")
    assert (first, rdf + "first", "urn:1", "uri", None, None) in got and (second, rdf + "rest", rdf + "nil", "uri", None, None) in got
    assert ("http://b.org/x/y#st", rdf + "object", "w", "literal", xs, None) in got and (me + "#t", "urn:e#k", "v", "literal", xs, None) in got


def test_dc_namespace_and_failures(spark):
    ns = "http://purl.org/dc/elements/1.1/"
    doc = f'<r xmlns:d="{ns}" xmlns:o="urn:o"><d:title>A</d:title><o:title>no</o:title><d:title></d:title><d:odd>x</d:odd></r>'
    df = spark.createDataFrame([(1, doc), (2, "<r>"), (3, None)], "id int, inline_xml string")
    got = triples.extract_dc(df).orderBy("id", "pos").collect()
    assert [(r.element, r.value) for r in got if r.id == 1] == [(ns + "title", "A"), (ns + "title", "")]
    assert [r.parse_error is not None for r in got if r.id == 2] == [True]
    assert not [r for r in got if r.id == 3]


def test_scan_and_lists(spark, tmp_path):
    root = tmp_path / "objects" / "a" / "b"
    root.mkdir(parents=True)
    (root / "one").write_text(sample())
    (root / ".hidden").write_text("x")
    (root / "_under").write_text("x")
    names = lambda df: sorted(r.path.rsplit("/")[-1] for r in df.collect())
    got = records.scan_records(spark, str(tmp_path / "objects"))
    assert names(got) == ["_under", "one"]
    assert {r.pid for r in records.scan_record_ids(got).collect()} == {"example:1", None}
    for folder in ("_dir", ".dir/.in", "a/_deep/.er"):
        (tmp_path / "objects" / folder).mkdir(parents=True)
        (tmp_path / "objects" / folder / f"in{folder[-2:]}").write_text(sample())
    (tmp_path / "objects" / "a" / "od[d]{x}*?").write_text(sample())
    (tmp_path / "objects" / ".dir" / ".in" / "_h").write_text(sample())
    every = ["_h", "_under", "iner", "inin", "inir", "od[d]{x}*?", "one"]
    assert names(records.scan_records(spark, str(tmp_path / "objects"))) == sorted(every)
    assert names(records.scan_records(spark, str(tmp_path / "objects"), ".*")) == sorted([*every, ".hidden"])


def test_declared_encodings(spark, tmp_path):
    text = sample().replace("<?xml version=\"1.0\" encoding=\"UTF-8\"?>", "").replace("example:1", "e:caf\u00e9")
    head = '<?xml version="1.0" encoding="{}"?>\n'
    (tmp_path / "latin").write_bytes((head.format("ISO-8859-1") + text).encode("latin-1"))
    (tmp_path / "utf16").write_bytes((head.format("UTF-16") + text).encode("utf-16"))
    (tmp_path / "utf16be").write_bytes((head.format("UTF-16BE") + text).encode("utf-16-be"))
    (tmp_path / "mark").write_bytes(b"\xef\xbb\xbf" + text.encode())
    (tmp_path / "plain").write_bytes(text.encode())
    (tmp_path / "wrong").write_bytes((head.format("UTF-8") + text).encode("latin-1"))
    (tmp_path / "odd").write_bytes((head.format("x-none") + text).encode())
    rows = {r.path.rsplit("/")[-1]: (r.pid, r.problem) for r in shred.parse_records(records.scan_records(spark, str(tmp_path))).collect()}
    assert {k for k, v in rows.items() if v == ("e:caf\u00e9", None)} == {"latin", "utf16", "utf16be", "mark", "plain"}
    assert "UTF-8" in rows["wrong"][1] and "X-NONE" in rows["odd"][1]


def test_id_lists(spark, tmp_path):
    (tmp_path / "list").write_text("a:1\n b:2\na:1\n")
    assert sorted(r.pid for r in records.read_pid_list(spark, str(tmp_path / "list")).collect()) == [" b:2", "a:1"]
    (tmp_path / "map").write_text("# note\n\ninfo\\:x/y\\:z#A:urn:target\nplain:t\n")
    got = {r.source: r.target for r in records.read_mapping(spark, str(tmp_path / "map"), ":").collect()}
    assert got == {"info:x/y:z#A": "urn:target", "plain": "t"}


def test_content_index_reads_large_files_in_chunks(spark, tmp_path):
    import hashlib

    root = tmp_path / "ds"
    root.mkdir()
    bodies = {"info%3Afedora%2Fe%3A1%2FDS%2FDS.0": b"x" * 10, "info%3Afedora%2Fe%3A1%2FDS%2FDS.1": b"y" * 5000, "odd": b"z"}
    for name, body in bodies.items():
        (root / name).write_bytes(body)
    got = {r.path.rsplit("/")[-1]: r for r in content.digest_content(spark, str(root), ["md5", "sha512"], 100).collect()}
    for name, body in bodies.items():
        row = got[name.replace("%", "%25")] if name.replace("%", "%25") in got else got[name]
        assert row.md5 == hashlib.md5(body).hexdigest() and row.sha512 == hashlib.sha512(body).hexdigest()
        assert bytes(row.head) == body[: len(row.head)] and len(row.head) == min(len(body), mime.MAGIC_BYTES)
    index = content.content_index(spark, str(root), "akubra", ["md5"], str(tmp_path / "index"))
    assert sorted(str(r.internal_id) for r in index.collect()) == ["None", "e:1+DS+DS.0", "e:1+DS+DS.1"]
    assert content.bad_names(index).count() == 1
    again = content.content_index(spark, str(tmp_path / "gone"), "akubra", ["md5"], str(tmp_path / "index"))
    assert again.count() == 3
    assert content.scan_content(spark, str(root), "akubra").where(F.col("internal_id").isNotNull()).count() == 2


@pytest.mark.parametrize("change, problem", [
    (('<foxml:datastream ID="DS1"', '<foxml:contentDigest TYPE="MD5" DIGEST="x"/><foxml:datastream ID="DS1"'), "element out of place: contentDigest in digitalObject"),
    (('<foxml:datastreamVersion ID="DS1.0"', '<foxml:contentLocation/><foxml:datastreamVersion ID="DS1.0"'), "element out of place: contentLocation in datastream"),
    (("</foxml:xmlContent>\n</foxml:datastreamVersion>\n<foxml:datastreamVersion ID=\"DS1.0\"", "</foxml:xmlContent><foxml:datastream ID='n'/>\n</foxml:datastreamVersion>\n<foxml:datastreamVersion ID=\"DS1.0\""), "element out of place: datastream in datastreamVersion"),
    (("</foxml:digitalObject>", '<foxml:datastreamVersion ID="x"/></foxml:digitalObject>'), "element out of place: datastreamVersion in digitalObject"),
    (("</foxml:digitalObject>", '<other:datastream xmlns:other="urn:o"/></foxml:digitalObject>'), "element out of place: datastream in digitalObject"),
    (("<foxml:objectProperties>", "<!-- c --><foxml:objectProperties>"), "comment or instruction"),
    (("</foxml:objectProperties>", "<!-- c --></foxml:objectProperties>"), None),
    (("<two/>", "<two><!-- c --><foxml:datastream>text</foxml:datastream><?pi x?></two>"), None),
    (("<?xml", "<?xml"), None),
])
def test_places_of_elements(spark, change, problem):
    got = shred.structure_report(shred.parse_records(X.frame(spark, sample().replace(*change)))).collect()
    assert [r.structure_problem.startswith(problem) for r in got] == ([True] if problem else [])


def test_reader_gives_the_same_rows_for_any_chunks():
    from muniment.functions import recordreader

    text = sample().replace("<two/>", "<two>é ü <![CDATA[</x>]]></two>").encode()
    want = recordreader.Rows()
    recordreader.read_record(want, text)
    for size in (1, 7, 64):
        rows = recordreader.Rows()
        reader = recordreader.RecordReader(rows)
        for at in range(0, len(text), size):
            reader.feed(text[at : at + size])
        reader.feed(b"", True)
        reader.close()
        assert [a.to_pylist() for a in rows.arrays()] == [a.to_pylist() for a in want.arrays()]
    assert want.versions["inline_xml"][1] == "\n<two>é ü <![CDATA[</x>]]></two>\n" and want.objects["problem"] == [None]


def test_large_and_empty_records_are_rejects(spark, tmp_path):
    (tmp_path / "good").write_text(sample())
    (tmp_path / "empty").write_text("")
    (tmp_path / "large").write_text(sample() + " " * 5000)
    parsed = shred.parse_records(records.scan_records(spark, str(tmp_path), limit=len(sample().encode()) + 100))
    problems = {r.path.rsplit("/")[-1]: r.problem for r in parsed.collect()}
    assert problems["good"] is None and problems["empty"] == "malformed record" and problems["large"].startswith("record too large")
    assert shred.unreadable(parsed).count() == 2


def test_listing_goes_on_from_folders_left_over(spark, tmp_path, monkeypatch):
    from muniment.sources import tree

    monkeypatch.setattr(tree, "AT_ONCE", 2)
    want = set()
    for i in range(30):
        folder = tmp_path / f"a{i % 3}" / f"_b{i % 5}" / f".c{i % 2}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"f {i}%").write_bytes(b"x" * (i % 4))
        want.add((f"f {i}%", i % 4))
    got = tree.list_tree(spark, str(tmp_path)).collect()
    assert {(r.path.rsplit("/")[-1], r.length) for r in got} == want and len(got) == 30
    (tmp_path / "nothing").mkdir()
    assert tree.list_tree(spark, str(tmp_path / "nothing")).count() == 0
    assert content.digest_content(spark, str(tmp_path / "nothing"), ["md5"]).count() == 0


def test_a_version_s_row_does_not_carry_its_whole_datastream(spark):
    raw = spark.createDataFrame([("p", "<x/>", 4)], "path string, xml string, length bigint")
    versions = shred.shred_versions(shred.parse_records(raw), keep=["path"])
    plan = versions._jdf.queryExecution().optimizedPlan().toString()
    # The exploded array is left out of the rows made from it, and the datastream that it stood in is not below.
    assert re.search(r"posexplode\(_versions#\d+\), \[\d+\]", plan) and not re.search(r"posexplode\(_d#", plan), plan

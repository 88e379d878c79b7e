"""Small hand-written records for tests."""

from __future__ import annotations

import base64
from xml.sax.saxutils import quoteattr

STATE = "info:fedora/fedora-system:def/model#state"
HEAD = '<?xml version="1.0" encoding="UTF-8"?>\n<foxml:digitalObject VERSION="1.1" PID={pid} xmlns:foxml="info:fedora/fedora-system:def/foxml#">\n'
RDF_HEAD = '<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:ex="http://example.com/#" xmlns:m="info:fedora/fedora-system:def/model#">'


def t(n: int) -> str:
    return f"2015-01-{n:02d}T00:00:00.000Z"


def version(vid, created, body, label=None, mime="text/plain", digest=None, size=None):
    attrs = {"ID": vid, "CREATED": created, "LABEL": label, "MIMETYPE": mime, "SIZE": size}
    text = "".join(f" {k}={quoteattr(str(v))}" for k, v in attrs.items() if v is not None)
    mark = f'<foxml:contentDigest TYPE="{digest[0]}" DIGEST="{digest[1]}"/>\n' if digest else ""
    return f"<foxml:datastreamVersion{text}>\n{mark}{body}\n</foxml:datastreamVersion>\n"


def inline(text):
    return f"<foxml:xmlContent>\n{text}\n</foxml:xmlContent>"


def b64(text):
    return f"<foxml:binaryContent>\n{base64.b64encode(text.encode()).decode()}\n</foxml:binaryContent>"


def at(kind, ref):
    return f'<foxml:contentLocation TYPE="{kind}" REF={quoteattr(ref)}/>'


def ds(ds_id, versions, group="X", state="A"):
    return f'<foxml:datastream ID="{ds_id}" STATE="{state}" CONTROL_GROUP="{group}" VERSIONABLE="true">\n' + "".join(versions) + "</foxml:datastream>\n"


def rdf(*pairs):
    body = "".join(f'<rdf:Description rdf:about="{s}">{edges}</rdf:Description>' for s, edges in pairs)
    return inline(RDF_HEAD + body + "</rdf:RDF>")


def record(pid, streams, state="Active", props=()):
    lines = [(STATE, state), ("info:fedora/fedora-system:def/model#createdDate", t(1)),
             ("info:fedora/fedora-system:def/view#lastModifiedDate", t(9)), *props]
    text = "".join(f"<foxml:property NAME={quoteattr(n)} VALUE={quoteattr(v)}/>\n" for n, v in lines if v is not None)
    return HEAD.format(pid=quoteattr(pid)) + f"<foxml:objectProperties>\n{text}</foxml:objectProperties>\n" + "".join(streams) + "</foxml:digitalObject>"


def frame(spark, *records):
    rows = [(f"r/{i:03d}", xml, len(xml)) for i, xml in enumerate(records)]
    return spark.createDataFrame(rows, "path string, xml string, length bigint")

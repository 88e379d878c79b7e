"""Rows rendered as object records with Spark expressions: the way back from tables to records.

Used by the round-trip queries and tests. Every record comes from one input row, so rendering is a
narrow projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from muniment import model as M

HEAD = (
    '<?xml version="1.0" encoding="UTF-8"?>\n<foxml:digitalObject VERSION="1.1"'
    ' xmlns:foxml="info:fedora/fedora-system:def/foxml#"'
    ' xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance"'
    ' xsi:schemaLocation="info:fedora/fedora-system:def/foxml# http://www.fedora.info/definitions/1/0/foxml1-1.xsd"'
)


def lit(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def escape(col) -> Column:
    """Escapes for element text and double-quoted attribute values."""
    out = lit(col).cast("string")
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\n", "&#10;"), ("\r", "&#13;"), ("\t", "&#9;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def attributes(**pairs) -> Column:
    """`` NAME="value"`` for every pair; a null value leaves its attribute out."""
    return F.concat(*[
        F.coalesce(F.concat(F.lit(f' {name}="'), escape(value), F.lit('"')), F.lit("")) for name, value in pairs.items()
    ])


def record(pid, properties: list[tuple[object, object]], datastreams: list[Column]) -> Column:
    props = [
        F.concat(F.lit("<foxml:property"), attributes(NAME=name, VALUE=value), F.lit("/>\n"))
        for name, value in properties
    ]
    return F.concat(
        F.lit(HEAD), attributes(PID=pid), F.lit(">\n<foxml:objectProperties>\n"), *props,
        F.lit("</foxml:objectProperties>\n"), *datastreams, F.lit("</foxml:digitalObject>"),
    )


def datastream(ds_id, control_group, state, versions: list[Column], versionable="true") -> Column:
    return F.concat(
        F.lit("<foxml:datastream"),
        attributes(ID=ds_id, STATE=state, CONTROL_GROUP=control_group, VERSIONABLE=versionable),
        F.lit(">\n"), *versions, F.lit("</foxml:datastream>\n"),
    )


def version(version_id, created, content: Column, label=None, mime=None, size=None, format_uri=None, alt_ids=None,
            digest: tuple | None = None) -> Column:
    pairs = {"ID": version_id, "LABEL": label, "CREATED": created, "ALT_IDS": alt_ids, "MIMETYPE": mime,
             "FORMAT_URI": format_uri, "SIZE": size}
    marks = []
    if digest:
        marks = [F.concat(F.lit("<foxml:contentDigest"), attributes(TYPE=digest[0], DIGEST=digest[1]), F.lit("/>\n"))]
    return F.concat(
        F.lit("<foxml:datastreamVersion"),
        attributes(**{k: v for k, v in pairs.items() if v is not None}), F.lit(">\n"), *marks, content,
        F.lit("\n</foxml:datastreamVersion>\n"),
    )


def inline(body) -> Column:
    return F.concat(F.lit("<foxml:xmlContent>\n"), lit(body), F.lit("\n</foxml:xmlContent>"))


def location(kind: str, ref) -> Column:
    return F.concat(F.lit("<foxml:contentLocation"), attributes(TYPE=kind, REF=ref), F.lit("/>"))


def base64(content: Column) -> Column:
    return F.concat(F.lit("<foxml:binaryContent>"), F.base64(content), F.lit("</foxml:binaryContent>"))


def dc(elements: list[tuple[str, object]]) -> Column:
    """An element-set document; a null value leaves its element out."""
    parts = [
        F.coalesce(F.concat(F.lit(f"<dc:{name}>"), escape(value), F.lit(f"</dc:{name}>\n")), F.lit(""))
        for name, value in elements
    ]
    return F.concat(
        F.lit('<oai_dc:dc xmlns:oai_dc="http://www.openarchives.org/OAI/2.0/oai_dc/" xmlns:dc="' + M.DC_NS + '">\n'),
        *parts, F.lit("</oai_dc:dc>"),
    )


def rdf(descriptions: list[tuple[object, list[Column]]]) -> Column:
    blocks = [
        F.concat(F.lit("<rdf:Description"), F.lit(' rdf:about="'), escape(about), F.lit('">\n'), *edges,
                 F.lit("</rdf:Description>\n"))
        for about, edges in descriptions
    ]
    return F.concat(F.lit('<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#">\n'), *blocks, F.lit("</rdf:RDF>"))


def edge(name: str, namespace: str, resource=None, value=None) -> Column:
    """One property element; null when its target is null, which leaves it out."""
    if resource is not None:
        made = F.concat(F.lit(f'<{name} xmlns="{namespace}" rdf:resource="'), escape(resource), F.lit('"/>\n'))
    else:
        made = F.concat(F.lit(f'<{name} xmlns="{namespace}">'), escape(value), F.lit(f"</{name}>\n"))
    return F.coalesce(made, F.lit(""))

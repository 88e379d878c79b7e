"""The three per-document XML helpers that Spark expressions cannot state.

Each one turns the text of a single small document into a string or a list of rows; Spark
partitions the documents and ships them in Arrow batches. Nothing here sees more than one
document at a time.
"""

from __future__ import annotations

import io
import itertools
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from urllib.parse import urljoin
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muniment import model as M
from muniment.session import small_batches

XML_DECLARATION = '<?xml version="1.0" encoding="UTF-8"?>'
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XML_LANG = "{http://www.w3.org/XML/1998/namespace}lang"
XML_BASE = "{http://www.w3.org/XML/1998/namespace}base"


class Unsupported(ValueError):
    """A construct outside what the helper covers; the row is rejected, never passed as good."""


# --- Normal form of an inline document -------------------------------------------------------

_TEXT = str.maketrans({"<": "&lt;", ">": "&gt;", "&": "&amp;"})
_ATTR = str.maketrans(
    {"<": "&lt;", "&": "&amp;", '"': "&quot;", "\n": "&#xa;", "\r": "&#xd;", "\t": "&#x9;"}
)


def normal_form(body: str) -> str:
    """The text an inline document's digest is taken over.

    Attributes in sorted order of their qualified names, no indentation, every line trimmed and
    the lines joined with nothing. Raises on malformed text and on constructs not covered.
    """
    out: list[str] = []
    scopes = [{"xml", "xmlns"}]
    open_tag = False
    in_cdata = False

    def close_open_tag():
        nonlocal open_tag
        if open_tag:
            out.append(">")
            open_tag = False

    def start(name, attributes):
        nonlocal open_tag
        close_open_tag()
        pairs = dict(zip(attributes[::2], attributes[1::2]))
        declared = {k[6:] for k in pairs if k.startswith("xmlns:")}
        scopes.append(scopes[-1] | declared)
        for qname in (name, *pairs):
            if ":" in qname and qname.split(":", 1)[0] not in scopes[-1]:
                raise Unsupported(f"undeclared prefix in {qname}")
        out.append("<" + name)
        out.extend(f' {k}="{pairs[k].translate(_ATTR)}"' for k in sorted(pairs))
        open_tag = True

    def end(name):
        nonlocal open_tag
        scopes.pop()
        out.append("/>" if open_tag else f"</{name}>")
        open_tag = False

    def text(data):
        close_open_tag()
        out.append(data if in_cdata else data.translate(_TEXT))

    def comment(data):
        close_open_tag()
        out.append(f"<!--{data}-->")

    def cdata(entering):
        nonlocal in_cdata
        close_open_tag()
        in_cdata = entering
        out.append("<![CDATA[" if entering else "]]>")

    def refuse(*_):
        raise Unsupported("processing instruction or document type in inline XML")

    parser = expat.ParserCreate("UTF-8")
    parser.ordered_attributes = True
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler = start, end
    parser.CharacterDataHandler, parser.CommentHandler = text, comment
    parser.StartCdataSectionHandler = lambda: cdata(True)
    parser.EndCdataSectionHandler = lambda: cdata(False)
    parser.ProcessingInstructionHandler = parser.StartDoctypeDeclHandler = refuse
    parser.Parse((XML_DECLARATION + body).encode("utf-8"), True)
    lines = "".join(out).replace("\r\n", "\n").replace("\r", "\n").split("\n")
    blank = "".join(map(chr, range(33)))
    return XML_DECLARATION + "".join(line.strip(blank) for line in lines)


_NORMAL_RESULT = T.StructType([T.StructField("text", T.StringType()), T.StructField("error", T.StringType())])


@F.arrow_udf(_NORMAL_RESULT)
def _normalize(bodies: pa.Array) -> pa.Array:
    texts: list[str | None] = []
    errors: list[str | None] = []
    for item in bodies:
        body, text, error = item.as_py(), None, None
        try:
            text = None if body is None else normal_form(body)
        except (expat.ExpatError, ValueError) as problem:
            error = str(problem)
        texts.append(text)
        errors.append(error)
    return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(errors, pa.string())], names=["text", "error"])


def normalize_inline(body: Column) -> Column:
    """STRUCT<text, error>: the digest input of an inline body, or why it has none."""
    return _normalize(body)


# --- Rows from documents -----------------------------------------------------------------------


def _direct_text(element: ET.Element) -> str:
    return (element.text or "") + "".join(child.tail or "" for child in element)


_DC_URIS = {f"{{{M.DC_NS}}}{name}": M.DC_NS + name for name in M.DC_ELEMENTS}


def dc_rows(text: str) -> Iterator[tuple[str, int, str]]:
    """(element URI, position, value) for the children in the element namespace, in document order."""
    for pos, child in enumerate(ET.fromstring(text.strip())):
        uri = _DC_URIS.get(child.tag)
        if uri:
            yield uri, pos, _direct_text(child)


def _uri(tag: str) -> str:
    if not tag.startswith("{"):
        raise Unsupported(f"name without a namespace: {tag}")
    return tag[1:].replace("}", "", 1)


def _text(text: str | None) -> str:
    return (text or "").replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace("\r", "&#xD;")


def _written(element, prefixes: dict[str, str], declared: tuple[str, ...]) -> str:
    """An element as canonical text: a namespace is declared where it is first used, names and declarations in order."""
    def name(tag: str) -> str:
        uri, _, local = tag[1:].partition("}") if tag.startswith("{") else ("", "", tag)
        if uri == "http://www.w3.org/XML/1998/namespace":
            return f"xml:{local}"
        if uri and uri not in used:
            used.append(uri)
        return f"{prefixes[uri]}:{local}" if uri and prefixes[uri] else local

    quoted = lambda v: _text(v).replace("&gt;", ">").replace('"', "&quot;").replace("\t", "&#x9;").replace("\n", "&#xA;")
    used: list[str] = []
    tag = name(element.tag)
    attributes = [f'{name(k)}="{quoted(v)}"' for k, v in sorted(element.attrib.items(), key=lambda kv: kv[0].partition("}")[::2] if kv[0][0] == "{" else ("", kv[0]))]
    fresh = sorted((prefixes[u], u) for u in used if u not in declared)
    spaces = [f'xmlns{":" * bool(p)}{p}="{quoted(u)}"' for p, u in fresh]
    inside = _text(element.text) + "".join(_written(c, prefixes, (*declared, *used)) for c in element)
    return " ".join([f"<{tag}", *spaces, *attributes]) + f">{inside}</{tag}>{_text(element.tail)}"


def rdf_rows(text: str) -> list[tuple]:
    """(s, p, o, kind, datatype, lang) triples of an RDF/XML document: a small recursive reader.

    Covers typed and nested nodes, property attributes, ``rdf:ID`` (also of statements), ``rdf:li``, ``xml:base`` and the three parse
    types. A relative name without a base stays as it is.
    """
    triples: list[tuple] = []
    blanks = itertools.count()
    local = lambda element, name: element.get(f"{{{RDF}}}{name}")
    resolve = lambda base, name: urljoin(base, name) if base else name

    def add(s, p, o, kind="uri", datatype=None, lang=None):
        triples.append((s, p, o, kind, datatype, lang))

    def literal(s, p, value, datatype=None, lang=None):
        add(s, p, value, "literal", datatype or M.XSD_STRING, lang)

    def blank():
        return f"_:b{next(blanks)}"

    def properties(subject, element, lang):
        for name, value in element.attrib.items():
            if name == f"{{{RDF}}}type":
                add(subject, RDF + "type", value)
            elif not name.startswith((f"{{{RDF}}}", "{http://www.w3.org/XML/1998/namespace}")):
                literal(subject, _uri(name), value, lang=lang)

    def edges(subject, element, lang, base):
        items = itertools.count(1)
        for child in element:
            edge(subject, child, lang, base, items)

    def node(element, lang, base):
        lang, base = element.get(XML_LANG, lang), resolve(base, element.get(XML_BASE, ""))
        if local(element, "about") is not None:
            subject = resolve(base, local(element, "about"))
        elif local(element, "ID") is not None:
            subject = resolve(base, "#" + local(element, "ID"))
        elif local(element, "nodeID") is not None:
            subject = "_:n" + local(element, "nodeID")
        else:
            subject = blank()
        if element.tag != f"{{{RDF}}}Description":
            add(subject, RDF + "type", _uri(element.tag))
        properties(subject, element, lang)
        edges(subject, element, lang, base)
        return subject, "blank" if subject.startswith("_:") else "uri"

    def collection(elements, lang, base):
        """A list of nodes as cells, each with its item and the next cell."""
        cells = [blank() for _ in elements]
        for cell, following, element in zip(cells, [*cells[1:], None], elements):
            item, kind = node(element, lang, base)
            add(cell, RDF + "first", item, kind)
            add(cell, RDF + "rest", following or RDF + "nil", "blank" if following else "uri")
        return (cells[0], "blank") if cells else (RDF + "nil", "uri")

    def value_of(element, lang, base):
        """(object, kind, datatype, lang) of a property element."""
        form, target = local(element, "parseType"), local(element, "resource")
        own = [a for a in element.attrib if a == f"{{{RDF}}}type" or not a.startswith((f"{{{RDF}}}", "{http://www.w3.org/XML/1998/namespace}"))]
        if form == "Resource":
            inner = blank()
            edges(inner, element, lang, base)
            return inner, "blank", None, None
        if form == "Collection":
            return *collection(list(element), lang, base), None, None
        if form is not None:  # Literal, and what is not known is read like it
            inside = "".join([_text(element.text), *(_written(c, prefixes(), ()) for c in element)])
            return inside, "literal", RDF + "XMLLiteral", None
        if len(element):
            if len(element) > 1:
                raise Unsupported("more than one node in a property")
            return *node(element[0], lang, base), None, None
        if target is None and local(element, "nodeID") is None and not own:
            datatype = local(element, "datatype")
            return element.text or "", "literal", datatype or M.XSD_STRING, None if datatype else lang
        named = local(element, "nodeID")
        inner, kind = (resolve(base, target), "uri") if target is not None else ("_:n" + named if named is not None else blank(), "blank")
        properties(inner, element, lang)
        return inner, kind, None, None

    def edge(subject, element, lang, base, items):
        lang, base = element.get(XML_LANG, lang), resolve(base, element.get(XML_BASE, ""))
        predicate = _uri(element.tag)
        if predicate == RDF + "li":
            predicate = f"{RDF}_{next(items)}"
        made = value_of(element, lang, base)
        add(subject, predicate, *made)
        if local(element, "ID") is not None:  # the statement itself has a name
            statement = resolve(base, "#" + local(element, "ID"))
            add(statement, RDF + "type", RDF + "Statement")
            add(statement, RDF + "subject", subject, "blank" if subject.startswith("_:") else "uri")
            add(statement, RDF + "predicate", predicate)
            add(statement, RDF + "object", *made)

    declared: dict[str, str] = {}

    def prefixes():
        """Prefix of each namespace of the document: told by a second reading, which only markup inside of literals needs."""
        if not declared:
            declared.update({uri: prefix for _, (prefix, uri) in ET.iterparse(io.StringIO(text.strip()), ["start-ns"])})
        return declared

    root = ET.fromstring(text.strip())
    lang, base = root.get(XML_LANG), root.get(XML_BASE, "")
    for element in root if root.tag == f"{{{RDF}}}RDF" else [root]:
        node(element, lang, base)
    return triples


def explode_documents(
    df: DataFrame, xml: str, rows: Callable[[str], object], fields: str, message: str
) -> DataFrame:
    """One output row per row of ``rows(document)``, next to the document's other columns.

    A document that fails gives one row with ``parse_error`` set, so nothing is lost silently.
    A document without rows gives none.
    """
    keys = [c for c in df.columns if c != xml]
    made = T.StructType.fromDDL(f"{fields}, parse_error STRING")
    schema = T.StructType([*(T.StructField(c, df.schema[c].dataType) for c in keys), *made.fields])
    kinds = [pa.int32() if isinstance(f.dataType, T.IntegerType) else pa.string() for f in made]

    def run(batches):
        for batch in batches:
            picked: list[int] = []
            out: list[tuple] = []
            for i, text in enumerate(batch.column(0)):
                text = text.as_py()
                try:
                    got = [(*row, None) for row in rows(text)] if text is not None else []
                except (ET.ParseError, ValueError) as problem:
                    got = [(*[None] * (len(kinds) - 1), f"{message}: {problem}")]
                picked.extend([i] * len(got))
                out.extend(got)
            left = batch.select(list(range(1, batch.num_columns))).take(pa.array(picked, pa.int64()))
            right = [pa.array([row[k] for row in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*left.columns, *right], names=schema.names)

    return small_batches(df.select(F.col(f"`{xml}`"), *[F.col(f"`{c}`") for c in keys])).mapInArrow(run, schema)

"""A pull reader of object records: one pass over the bytes, a state machine over elements in their places, rows as they are met.

The machine knows where each element may stand: properties come first in the object, datastreams only in the object, versions only in a datastream, content
elements only in a version. What stands elsewhere, unknown elements, text between elements, comments and instructions outside of content are the
record's structure problem (the first one met). Inline bodies are cut from the bytes as they stand; the bytes of one body at most are held besides the
chunk that is read, whatever the size of the record.
"""

from __future__ import annotations

import re
from xml.parsers import expat

import pyarrow as pa

from muniment import model as M

# Elements of a record and the attributes that each may have.
PLACES = {
    "objectProperties": "digitalObject", "property": "objectProperties", "datastream": "digitalObject", "datastreamVersion": "datastream",
    "contentDigest": "datastreamVersion", "contentLocation": "datastreamVersion", "xmlContent": "datastreamVersion", "binaryContent": "datastreamVersion",
}
ATTRIBUTES = {
    "digitalObject": frozenset(("PID", "VERSION", "FEDORA_URI", "schemaLocation")),
    "datastream": frozenset(("ID", "CONTROL_GROUP", "FEDORA_URI", "STATE", "VERSIONABLE")),
    "datastreamVersion": frozenset(("ID", "LABEL", "CREATED", "MIMETYPE", "ALT_IDS", "FORMAT_URI", "SIZE")),
    "contentDigest": frozenset(("TYPE", "DIGEST")),
    "contentLocation": frozenset(("REF", "TYPE")),
}
_VERSION_FIELDS = {
    "version_id": "ID", "label": "LABEL", "created": "CREATED", "mime_type": "MIMETYPE", "alt_ids": "ALT_IDS", "format_uri": "FORMAT_URI", "size_text": "SIZE",
}
_PROPERTY = frozenset(("NAME", "VALUE"))
_CONTENT_FIELDS = ("digest_type", "digest_value", "location_type", "location_ref", "base64", "inline_xml")

_TAG = re.compile(rb"""<[^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*>""")
_BLANK = " \t\r\n"
#: Names as the parser gives them, already cut into space and local name.
_NAMES = {f"{M.FOXML_NS} {local}": (M.FOXML_NS, local) for local in ("digitalObject", *PLACES)}
_XML_CONTENT, _BINARY_CONTENT = f"{M.FOXML_NS} xmlContent", f"{M.FOXML_NS} binaryContent"


def _cut(name: str) -> tuple[str, str]:
    space, _, local = name.rpartition(" ")
    return space, local


VERSION_SCHEMA = ", ".join(f"{n}: STRING" for n in (*_VERSION_FIELDS, *_CONTENT_FIELDS))
SCHEMA = (
    "pid STRING, fedora_uri STRING, properties ARRAY<STRUCT<name: STRING, value: STRING>>, "
    f"datastreams ARRAY<STRUCT<ds_id: STRING, state: STRING, control_group: STRING, fedora_uri: STRING, versionable: BOOLEAN, versions: ARRAY<STRUCT<{VERSION_SCHEMA}>>>>, "
    "n_inline INT, stored_digest_types ARRAY<STRING>, problem STRING, structure_problem STRING, unexpected_attributes ARRAY<STRING>"
)


class Rows:
    """Flat lists of what records hold, turned into nested Arrow arrays without a Python object per record."""

    def __init__(self):
        self.objects = {n: [] for n in ("pid", "fedora_uri", "n_inline", "stored_digest_types", "problem", "structure_problem", "unexpected_attributes")}
        self.properties = {"name": [], "value": []}
        self.datastreams = {n: [] for n in ("ds_id", "state", "control_group", "fedora_uri", "versionable")}
        self.versions = {n: [] for n in (*_VERSION_FIELDS, *_CONTENT_FIELDS)}
        self.property_ends, self.datastream_ends, self.version_ends = [0], [0], [0]
        self.add_property = [self.properties[n].append for n in ("name", "value")]
        self.add_datastream = [v.append for v in self.datastreams.values()]
        self.add_version = [(self.versions[f].append, n) for f, n in _VERSION_FIELDS.items()]
        self.add_content = [self.versions[f].append for f in _CONTENT_FIELDS]

    def arrays(self) -> list[pa.Array]:
        text = pa.string()

        def nested(columns: dict[str, list], ends: list[int], kinds: dict[str, pa.DataType] | None = None, more: dict[str, pa.Array] | None = None) -> pa.Array:
            arrays = {n: pa.array(v, (kinds or {}).get(n, text)) for n, v in columns.items()} | (more or {})
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(list(arrays.values()), list(arrays)))

        versions = nested(self.versions, self.version_ends)
        datastreams = nested(self.datastreams, self.datastream_ends, {"versionable": pa.bool_()}, {"versions": versions})
        o = self.objects
        return [
            pa.array(o["pid"], text), pa.array(o["fedora_uri"], text), nested(self.properties, self.property_ends), datastreams, pa.array(o["n_inline"], pa.int32()),
            pa.array(o["stored_digest_types"], pa.list_(text)), pa.array(o["problem"], text), pa.array(o["structure_problem"], text), pa.array(o["unexpected_attributes"], pa.list_(text)),
        ]


class RecordReader:
    """Reads one record, given in chunks of UTF-8, into ``rows``."""

    def __init__(self, rows: Rows):
        self.rows = rows
        self.state, self.depth, self.base, self.held = "prolog", 0, 0, b""
        self.pid = self.fedora_uri = self.structure = None
        self.version: dict = {}
        self.digest, self.content = (None, None), (None, None, None, None)
        self.in_datastream, self.n_inline, self.odd, self.stored = False, 0, set(), {}
        self.marks = (len(rows.properties["name"]), len(rows.datastreams["ds_id"]), len(rows.versions["label"]))
        p = self.parser = expat.ParserCreate("utf-8", " ")
        p.buffer_text = True
        if hasattr(p, "SetReparseDeferralEnabled"):
            p.SetReparseDeferralEnabled(False)  # a tag is told as soon as it is whole, so its bytes are still held
        p.StartElementHandler, p.EndElementHandler = self._start, self._end  # texts are told where they count: ``_into``
        p.CommentHandler = p.StartCdataSectionHandler = lambda *_: self._other()
        p.ProcessingInstructionHandler = lambda *_: self._other(True)

    def feed(self, chunk: bytes, last: bool = False) -> None:
        """Parse errors are raised as ``expat.ExpatError``."""
        # Bytes still needed: those of an open body, else those of a tag that may go on in this chunk.
        last_tag = self.held.rfind(b"<")
        keep = self.body_at - self.base if self.state == "inline" else last_tag if last_tag >= 0 else len(self.held)
        self.held, self.base = self.held[keep:] + chunk, self.base + keep
        self.parser.Parse(chunk, last)

    def close(self, problem: str | None = None) -> None:
        """Give out the record; with a ``problem`` only its id. The parser and the reader hold each other: let go, both are freed with the record."""
        self.parser = None
        rows, o = self.rows, self.rows.objects
        problem = problem or ("record without PID" if self.pid is None else None)
        if problem and problem != "record without PID":
            for columns, n in zip((rows.properties, rows.datastreams, rows.versions), self.marks):
                for values in columns.values():
                    del values[n:]
            del rows.version_ends[self.marks[1] + 1 :]
            self.structure, self.n_inline, self.stored, self.odd = None, 0, {}, None
        elif self.structure is None and self.state in ("prolog", "object"):
            self.structure = "record without properties"
        rows.property_ends.append(len(rows.properties["name"]))
        rows.datastream_ends.append(len(rows.datastreams["ds_id"]))
        odd = None if self.odd is None else sorted(self.odd)
        for name, value in zip(o, (self.pid, self.fedora_uri, self.n_inline, list(self.stored), problem, self.structure, odd)):
            o[name].append(value)

    def _into(self, state: str) -> None:
        """The parser tells texts only where one may be wrong or is base64."""
        self.parser.CharacterDataHandler = self._text if state in ("records", "version") else None
        self.state = state

    def _attributes(self, element: str, given: dict[str, str]) -> dict[str, str]:
        allowed, out = ATTRIBUTES[element], {}
        if given.keys() <= allowed:
            return given
        for name, value in given.items():
            local = name.rpartition(" ")[2]
            if local in allowed:
                out[local] = value
            else:
                self.odd.add(local)
        return out

    def _wrong(self, what: str) -> None:
        self.structure = self.structure or what

    def _misplaced(self, local: str, inside: str) -> None:
        self._wrong(f"element out of place: {local} in {inside}" if local in PLACES else f"element not known here: {local}")

    def _start(self, name: str, given: dict[str, str]) -> None:
        state = self.state
        if state == "skip":
            return
        if state == "base64":
            self._base64_over()
            return
        space, local = _NAMES.get(name) or _cut(name)
        if state == "version":
            if local == "contentDigest":
                a = self._attributes(local, given)
                self.digest = a.get("TYPE"), a.get("DIGEST")
            elif local == "contentLocation":
                a = self._attributes(local, given)
                self.content = a.get("TYPE"), a.get("REF"), None, None
            elif local == "xmlContent":
                tag = _TAG.match(self.held, self.parser.CurrentByteIndex - self.base)
                self.body_at, self.empty = self.base + tag.end(), tag[0].endswith(b"/>")
                self._into("inline")
                self.parser.StartElementHandler = None  # only the end of the content counts
            elif local == "binaryContent":
                self.parts, self.state = [], "base64"
                self.parser.CharacterDataHandler = self.parts.append
            else:
                self._misplaced(local, "datastreamVersion")
        elif state == "properties":
            self.depth += 1
            if self.depth == 2 and local == "property":
                if not given.keys() <= _PROPERTY:
                    given = {k.rpartition(" ")[2]: v for k, v in given.items()}
                named, valued = self.rows.add_property
                named(given.get("NAME"))
                valued(given.get("VALUE"))
        elif state == "records":
            if local == "datastream" and space == M.FOXML_NS:
                if self.in_datastream:
                    self._misplaced(local, "datastream")
                a = self._attributes(local, given)
                for add, value in zip(self.rows.add_datastream, (a.get("ID"), a.get("STATE"), a.get("CONTROL_GROUP"), a.get("FEDORA_URI"), a.get("VERSIONABLE", "").lower() == "true")):
                    add(value)
                self.rows.version_ends.append(len(self.rows.versions["label"]))
                self.in_datastream = True
            elif local == "datastreamVersion" and self.in_datastream:
                self.version = self._attributes(local, given)
                self.digest, self.content = (None, None), (None, None, None, None)
                self.state = "version"
            else:
                self._misplaced(local, "datastream" if self.in_datastream else "digitalObject")
        elif state == "object":
            if local != "objectProperties":
                self._wrong(f"element in the place of the properties: {local}")
            self.state, self.depth = "properties", 1
        else:
            a = self._attributes("digitalObject", given)
            self.pid, self.fedora_uri, self.state = a.get("PID"), a.get("FEDORA_URI"), "object"

    def _end(self, name: str) -> None:
        state = self.state
        if state == "inline":
            if name == _XML_CONTENT:
                body = None if self.empty else self.held[self.body_at - self.base : self.parser.CurrentByteIndex - self.base].decode()
                self.content = None, None, None, body
                self.n_inline += 1
                self._into("version")
                self.parser.StartElementHandler = self._start
            return
        if state == "properties":
            self.depth -= 1
            if not self.depth:
                self._into("records")
            return
        if state in ("base64", "skip"):
            if state == "base64":
                self._base64_over()
            if name == _BINARY_CONTENT:
                self._into("version")
            return
        local = (_NAMES.get(name) or _cut(name))[1]
        if state == "version":
            if local == "datastreamVersion":
                given, rows = self.version.get, self.rows
                for add, attribute in rows.add_version:
                    add(given(attribute))
                for add, value in zip(rows.add_content, (*self.digest, *self.content)):
                    add(value)
                rows.version_ends[-1] += 1
                if self.content[0] == "INTERNAL_ID":
                    self.stored[self.digest[0]] = True
                self.state = "records"
        elif state == "records":
            if local == "datastream" and self.in_datastream:
                self.in_datastream = False
            elif local != "digitalObject":
                self._misplaced(local, "digitalObject")

    def _base64_over(self) -> None:
        self.content = None, None, "".join(self.parts), None
        self.parts = []
        self._into("skip")

    def _text(self, text: str) -> None:
        if text != "\n" and text.strip(_BLANK):
            self._wrong("text outside of elements")

    def _other(self, instruction: bool = False) -> None:
        if self.state == "base64":
            if instruction:
                self._base64_over()
        elif self.state in ("object", "records", "version"):
            self._wrong("comment or instruction in the record")


#: Bytes given to the parser at once.
CHUNK = 1 << 20


def read_record(rows: Rows, data: bytes | None, problem: str | None = None) -> None:
    """One record's bytes into ``rows``; ``problem``: why it has no bytes that can be read."""
    reader = RecordReader(rows)
    if problem is None:
        try:
            view = data or b""
            for at in range(0, len(view) or 1, CHUNK):
                reader.feed(view[at : at + CHUNK], at + CHUNK >= len(view))
        except expat.ExpatError:
            problem = "malformed record"
    reader.close(problem)

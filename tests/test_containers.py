"""Container files by their directories: every known name, files that are cut or broken, long chains of sectors."""

from __future__ import annotations

import io
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from muniment.functions import containers, mime
from muniment.sources import content


def zipped(*names: str, comment: bytes = b"") -> bytes:
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        z.comment = comment
        for n in names:
            z.writestr(n, "x" * 100)
    return held.getvalue()


def compound(names: list[str], gap: int = 0) -> bytes:
    """A compound file of 512-byte sectors: one table, then ``gap`` unused sectors, then the directory's, each followed by an unused one."""
    entries = [n.encode("utf-16-le") + b"\0" * (64 - 2 * len(n)) + struct.pack("<HB", 2 * len(n) + 2, 2) + b"\0" * 61 for n in names]
    parts = [b"".join(entries[i : i + 4]).ljust(512, b"\0") for i in range(0, len(entries), 4)]
    places = [1 + gap + 2 * i for i in range(len(parts))]
    links = [0xFFFFFFFF] * 128
    links[0] = 0xFFFFFFFD
    for here, after in zip(places, [*places[1:], 0xFFFFFFFE]):
        links[here] = after
    sectors = [b"\0" * 512] * (places[-1] + 1)
    sectors[0] = struct.pack("<128I", *links)
    for place, part in zip(places, parts):
        sectors[place] = part
    header = bytearray(containers.COMPOUND.ljust(512, b"\0"))
    struct.pack_into("<H", header, 30, 9)
    struct.pack_into("<I", header, 48, places[0])
    struct.pack_into("<I", header, 68, 0xFFFFFFFE)
    struct.pack_into("<109I", header, 76, 0, *[0xFFFFFFFF] * 108)
    return bytes(header) + b"".join(sectors)


def told(body: bytes) -> str | None:
    return containers.media_type(io.BytesIO(body), len(body), body[:64])


@pytest.mark.parametrize("name, kind", containers.IN_ZIP.items())
def test_zip(name, kind):
    assert told(zipped("[Content_Types].xml", "a/b", name)) == kind
    assert told(zipped(name, comment=b"c" * 60_000)) == kind


@pytest.mark.parametrize("name, kind", containers.IN_COMPOUND.items())
def test_compound(name, kind):
    assert told(compound(["Root Entry", name])) == kind
    assert told(compound(["Root Entry", *[f"s{i}" for i in range(40)], name], gap=5)) == kind


def test_broken_and_unknown():
    for body in (zipped("a"), compound(["Root Entry"]), b"", b"%PDF-1.4", containers.COMPOUND, containers.ZIP, zipped("word/document.xml")[:150]):
        assert told(body) is None
    whole = compound(["Root Entry", *["x"] * 20, "WordDocument"])
    for cut in range(0, len(whole), 37):
        assert told(whole[:cut]) is None
    ring = bytearray(compound(["Root Entry", "x"]))
    struct.pack_into("<I", ring, 512 + 4, 1)
    assert len(list(containers.compound_names(io.BytesIO(bytes(ring)), 4096))) == 16
    assert told(zipped("word/document.xml")) and list(containers.zip_names(io.BytesIO(zipped("a")), len(zipped("a")), 10)) == []


def test_types_of_files(spark, tmp_path):
    files = {"w": compound(["Root Entry", "WordDocument"]), "o": compound(["Root Entry"]), "z": zipped("a"), "d": zipped("word/document.xml"),
             "g": b"GIF89a", "e": b"", "t.txt": b"text", "b": zipped("mimetype").replace(b"x" * 20, b"application/epub+zip", 1)}
    for n, body in files.items():
        (tmp_path / n).write_bytes(body)
    found = content.digest_content(spark, str(tmp_path), ["md5"])
    name = F.substring_index("path", "/", -1)
    rows = found.select(name.alias("n"), mime.detect_mime(F.lit(""), F.col("head"), name, F.col("inside")).alias("m")).collect()
    assert {r.n: r.m for r in rows} == {
        "w": "application/msword", "o": "application/x-ole-storage", "z": "application/zip", "d": containers.IN_ZIP["word/document.xml"],
        "g": "image/gif", "e": mime.UNKNOWN, "t.txt": "text/plain", "b": "application/epub+zip"}

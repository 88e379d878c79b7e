"""What kind of document a container file holds, told by the names in its directory.

A zip file's directory stands at its end, a compound file's in a chain of sectors: both are read by position, so
of a file of any size only the directory is opened. A directory of more than ``MOST_BYTES`` and one that can't be
read give None, and the type of the leading bytes stands.
"""

from __future__ import annotations

import struct
import zipfile
from collections.abc import Iterable
from typing import BinaryIO

ZIP, COMPOUND = b"PK\x03\x04", bytes.fromhex("D0CF11E0A1B11AE1")
#: Largest directory that is read.
MOST_BYTES = 64 << 20
#: Sector numbers from here on mark the end of a chain, free sectors and tables.
_NO_SECTOR = 0xFFFFFFFA

# Name in a zip file -> media type; the first one that is there decides.
IN_ZIP = {
    "word/document.xml": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "xl/workbook.xml": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "xl/workbook.bin": "application/vnd.ms-excel.sheet.binary.macroenabled.12",
    "ppt/presentation.xml": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "visio/document.xml": "application/vnd.ms-visio.drawing",
    "META-INF/container.xml": "application/epub+zip",
    "AndroidManifest.xml": "application/vnd.android.package-archive",
    "META-INF/MANIFEST.MF": "application/java-archive",
}

# Stream or storage in a compound file -> media type; the first one that is there decides.
IN_COMPOUND = {
    "WordDocument": "application/msword",
    "Quill": "application/x-mspublisher",
    "PowerPoint Document": "application/vnd.ms-powerpoint",
    "Workbook": "application/vnd.ms-excel",
    "Book": "application/vnd.ms-excel",
    "VisioDocument": "application/vnd.visio",
    "__properties_version1.0": "application/vnd.ms-outlook",
}


def compound_names(file: BinaryIO, most_bytes: int = MOST_BYTES) -> Iterable[str]:
    """Names of the streams and storages of a compound file, in the order of its directory."""
    file.seek(0)
    header = file.read(512)
    shift, = struct.unpack_from("<H", header, 30)
    if shift not in (9, 12):
        raise ValueError("sector size")
    size = 1 << shift
    sector, = struct.unpack_from("<I", header, 48)
    tables = list(struct.unpack_from("<109I", header, 76))
    more, = struct.unpack_from("<I", header, 68)

    def read(number: int) -> bytes:
        file.seek((number + 1) * size)
        got = file.read(size)
        if len(got) < size:
            raise ValueError("sector behind the end")
        return got

    held, links = 0, {}
    while sector < _NO_SECTOR and held < most_bytes:
        held += size
        got = read(sector)
        for at in range(0, size, 128):
            length, kind = struct.unpack_from("<HB", got, at + 64)
            if kind and 2 <= length <= 64:
                yield got[at : at + length - 2].decode("utf-16-le", "replace")
        table, place = divmod(sector, size // 4)
        while table >= len(tables) and more < _NO_SECTOR and 4 * len(tables) < most_bytes:
            *next_tables, more = struct.unpack(f"<{size // 4}I", read(more))
            tables.extend(next_tables)
        if table >= len(tables) or tables[table] >= _NO_SECTOR:
            raise ValueError("no table of the sector")
        if table not in links:
            links = {table: struct.unpack(f"<{size // 4}I", read(tables[table]))}
        sector = links[table][place]


def zip_names(file: BinaryIO, size: int, most_bytes: int = MOST_BYTES) -> Iterable[str]:
    """Names in the directory of a zip file."""
    file.seek(max(0, size - 65_557))
    tail = file.read()
    end = tail.rfind(b"PK\x05\x06")
    if end < 0 or len(tail) < end + 22 or min(struct.unpack_from("<I", tail, end + 12)[0], size) > most_bytes:
        return ()
    with zipfile.ZipFile(file) as archive:
        return archive.namelist()


def media_type(file: BinaryIO, size: int, head: bytes) -> str | None:
    """The media type that a container's directory tells, None for any other file."""
    try:
        if head.startswith(ZIP):
            names, known = set(zip_names(file, size)), IN_ZIP
        elif head.startswith(COMPOUND):
            names, known = set(compound_names(file)), IN_COMPOUND
        else:
            return None
    except (ValueError, struct.error, zipfile.BadZipFile, NotImplementedError):
        return None
    return next((kind for name, kind in known.items() if name in names), None)

"""Media types: extension of a type, type of leading bytes and names."""

from __future__ import annotations

import mimetypes

from pyspark.sql import Column
from pyspark.sql import functions as F

# Media type -> preferred file extension, in alphabetical order, where Python's own table has none or another one.
_PREFERRED = {
    "application/gzip": ".gz",
    "application/json": ".json",
    "application/msword": ".doc",
    "application/octet-stream": ".bin",
    "application/pdf": ".pdf",
    "application/rdf+xml": ".rdf",
    "application/rtf": ".rtf",
    "application/vnd.ms-excel": ".xls",
    "application/vnd.ms-powerpoint": ".ppt",
    "application/vnd.openxmlformats-officedocument.presentationml.presentation": ".pptx",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": ".xlsx",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": ".docx",
    "application/x-tar": ".tar",
    "application/xhtml+xml": ".xhtml",
    "application/xml": ".xml",
    "application/zip": ".zip",
    "audio/mp4": ".mp4a",
    "audio/mpeg": ".mp3",
    "audio/x-wav": ".wav",
    "image/bmp": ".bmp",
    "image/gif": ".gif",
    "image/jp2": ".jp2",
    "image/jpeg": ".jpg",
    "image/png": ".png",
    "image/svg+xml": ".svg",
    "image/tiff": ".tiff",
    "text/css": ".css",
    "text/csv": ".csv",
    "text/html": ".html",
    "text/plain": ".txt",
    "text/xml": ".xml",
    "video/mp4": ".mp4",
    "video/mpeg": ".mpeg",
    "video/quicktime": ".qt",
}
#: Media type -> file extension: the first one of the standard table, which this machine's settings don't change, or the preferred one.
EXTENSIONS = {t: e[0] for t, e in mimetypes.MimeTypes().types_map_inv[True].items()} | _PREFERRED

# Fixed values: (offset, bytes, media type); of those that fit, the longest decides. The types inside
# containers (RIFF, ISO media, zip files that begin with their type) are told by bytes further in; those of office
# documents by the names in their directory (see ``containers``).
SIGNATURES = [
    (0, b"%PDF", "application/pdf"),
    (0, b"\x89PNG\r\n\x1a\n", "image/png"),
    (0, b"\xff\xd8\xff", "image/jpeg"),
    (0, b"GIF8", "image/gif"),
    (0, b"II*\x00", "image/tiff"),
    (0, b"MM\x00*", "image/tiff"),
    (0, b"BM", "image/bmp"),
    (0, b"8BPS", "image/vnd.adobe.photoshop"),
    (0, b"\x00\x00\x00\x0cjP  \r\n\x87\n", "image/jp2"),
    (8, b"WEBP", "image/webp"),
    (8, b"WAVE", "audio/vnd.wave"),
    (8, b"AVI ", "video/x-msvideo"),
    (0, b"ID3", "audio/mpeg"),
    (0, b"OggS", "application/ogg"),
    (0, b"fLaC", "audio/x-flac"),
    (0, b"MThd", "audio/midi"),
    (4, b"ftypiso", "video/mp4"),
    (4, b"ftypmp4", "video/mp4"),
    (4, b"ftypqt  ", "video/quicktime"),
    (0, b"\x1aE\xdf\xa3", "video/x-matroska"),
    (0, b"\x00\x00\x01\xba", "video/mpeg"),
    (0, b"PK\x03\x04", "application/zip"),
    (30, b"mimetypeapplication/epub+zip", "application/epub+zip"),
    (30, b"mimetypeapplication/vnd.oasis.opendocument.text", "application/vnd.oasis.opendocument.text"),
    (30, b"mimetypeapplication/vnd.oasis.opendocument.spreadsheet", "application/vnd.oasis.opendocument.spreadsheet"),
    (30, b"mimetypeapplication/vnd.oasis.opendocument.presentation", "application/vnd.oasis.opendocument.presentation"),
    (0, b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1", "application/x-ole-storage"),
    (0, b"\x1f\x8b", "application/gzip"),
    (0, b"BZh", "application/x-bzip2"),
    (0, b"\xfd7zXZ\x00", "application/x-xz"),
    (0, b"7z\xbc\xaf'\x1c", "application/x-7z-compressed"),
    (0, b"Rar!\x1a\x07", "application/x-rar-compressed"),
    (257, b"ustar", "application/x-tar"),
    (0, b"%!PS", "application/postscript"),
    (0, b"{\\rtf", "application/rtf"),
    (0, b"<?xml", "application/xml"),
    (0, b"<!DOCTYPE html", "text/html"),
    (0, b"<!doctype html", "text/html"),
    (0, b"<html", "text/html"),
]
#: Bytes of a content that its type is told by.
MAGIC_BYTES = max(offset + len(magic) for offset, magic, _ in SIGNATURES)

# Name ending -> media type, tried when the bytes say nothing.
BY_NAME = {
    "pdf": "application/pdf", "png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg",
    "gif": "image/gif", "tif": "image/tiff", "tiff": "image/tiff", "zip": "application/zip",
    "xml": "application/xml", "html": "text/html", "htm": "text/html", "txt": "text/plain",
    "csv": "text/csv", "json": "application/json", "mp3": "audio/mpeg", "mp4": "video/mp4",
}
UNKNOWN = "application/octet-stream"


def _lookup(key: Column, table: dict[str, str]) -> Column:
    """Literal map lookup: the table is fixed and small, so no join is needed."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def mime_extension(mime: Column) -> Column:
    """Extension of a media type with its dot, empty for an unknown or malformed type."""
    bare = F.lower(F.trim(F.substring_index(mime, ";", 1)))
    return F.coalesce(_lookup(bare, EXTENSIONS), F.lit(""))


def detect_mime(declared: Column, head: Column, name: Column, inside: Column | None = None) -> Column:
    """Declared type, else the type told ``inside`` a container, else that of the leading bytes, else of the name's ending."""
    found = None
    for offset, magic, mime in sorted(SIGNATURES, key=lambda s: -len(s[1])):
        fits = F.substring(head, offset + 1, len(magic)) == F.lit(magic)
        found = F.when(fits, F.lit(mime)) if found is None else found.when(fits, F.lit(mime))
    ending = F.when(name.contains("."), F.lower(F.substring_index(name, ".", -1)))
    detected = F.coalesce(*([] if inside is None else [inside]), found, _lookup(ending, BY_NAME), F.lit(UNKNOWN))
    return F.when(declared.isNotNull() & (declared != ""), declared).otherwise(detected)

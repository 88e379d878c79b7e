"""Header and literal values: instants, tokens, digests, handling, sizes, URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from muniment import model as M

# Instants are ISO-8601 in UTC with seconds and an optional fraction.
INSTANT_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?Z$"


def parse_instant(col: Column) -> Column:
    """The instant of an ISO-8601 UTC string, null where the text is not one."""
    return F.when(col.rlike(INSTANT_PATTERN), F.try_to_timestamp(col))


def iso_instant(ts: Column) -> Column:
    """Fixed-width UTC text of a timestamp: string order equals time order."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def state_token(ts: Column) -> Column:
    return F.upper(F.md5(F.unix_millis(ts.cast("timestamp")).cast("string")))


def digest_urn(kind: Column, value: Column) -> Column:
    """``urn:type:value`` in lower case; null for a blank value or the word ``none``."""
    return F.when(
        value.isNotNull() & (value != "") & (value != "none"),
        F.lower(F.concat(F.lit("urn:"), kind, F.lit(":"), value)),
    )


def external_handling(control_group: Column) -> Column:
    out = F.lit(None).cast("string")
    for group, handling in M.EXTERNAL_HANDLING.items():
        out = F.when(control_group == group, F.lit(handling)).otherwise(out)
    return out


def is_external(control_group: Column) -> Column:
    return F.coalesce(control_group.isin(*M.EXTERNAL_HANDLING), F.lit(False))


def content_size(size: Column, control_group: Column) -> Column:
    return F.when((size > -1) & ~F.coalesce(control_group == M.INLINE, F.lit(False)), size)


def decode_base64(text: Column) -> Column:
    """Bytes of a base64 body, line breaks allowed; null when it is not base64."""
    return F.try_to_binary(F.regexp_replace(text, r"\s+", ""), F.lit("base64"))


def rewrite_local_host(url: Column, host: str) -> Column:
    return F.replace(url, F.lit(M.LOCAL_HOST_PLACEHOLDER), F.lit(host))


def self_url_parts(url: Column, host: str) -> tuple[Column, Column, Column]:
    """(pid, datastream id, is-an-unhandled-self-URL) of a URL that may point into the source server."""
    old = f"^http://{host}/fedora/get/([^/]+)/(.+)$"
    new = f"^http://{host}/fedora/objects/([^/]+)/datastreams/([^/]+)/content$"
    pid = F.when(url.rlike(old), F.regexp_extract(url, old, 1)).when(
        url.rlike(new), F.regexp_extract(url, new, 1)
    )
    ds_id = F.when(url.rlike(old), F.regexp_extract(url, old, 2)).when(
        url.rlike(new), F.regexp_extract(url, new, 2)
    )
    unhandled = pid.isNull() & url.rlike(f"^http://{host}/fedora/.*$")
    return pid, ds_id, unhandled


def map_self_url(url: Column, host: str, base_url: str, path) -> Column:
    """Target URL of a self-referencing URL; other URLs unchanged; null for an unhandled self URL.

    ``path(pid, ds_id) -> Column`` is the caller's id mapping.
    """
    pid, ds_id, unhandled = self_url_parts(url, host)
    return F.when(pid.isNotNull(), F.concat(F.lit(base_url), path(pid, ds_id))).when(~unhandled, url)


# Java digest names and the Spark expression that computes each over bytes.
ALGORITHMS = {
    "MD5": F.md5,
    "SHA": F.sha1,
    "SHA1": F.sha1,
    "SHA-1": F.sha1,
    "SHA-224": lambda c: F.sha2(c, 224),
    "SHA-256": lambda c: F.sha2(c, 256),
    "SHA-384": lambda c: F.sha2(c, 384),
    "SHA-512": lambda c: F.sha2(c, 512),
}
# The same algorithms by the column name their digest has in a content index.
INDEX_COLUMNS = {
    "MD5": "md5", "SHA": "sha1", "SHA1": "sha1", "SHA-1": "sha1",
    "SHA-224": "sha224", "SHA-256": "sha256", "SHA-384": "sha384", "SHA-512": "sha512",
}
INDEX_DIGESTS = {
    "md5": F.md5,
    "sha1": F.sha1,
    "sha224": lambda c: F.sha2(c, 224),
    "sha256": lambda c: F.sha2(c, 256),
    "sha384": lambda c: F.sha2(c, 384),
    "sha512": lambda c: F.sha2(c, 512),
}


def digest_by_name(kind: Column, content: Column) -> Column:
    """Hex digest of ``content`` by the algorithm each row names; null for an unknown algorithm."""
    out = F.lit(None).cast("string")
    for name, fn in ALGORITHMS.items():
        out = F.when(F.upper(kind) == name, fn(content)).otherwise(out)
    return out


def known_algorithm(kind: Column) -> Column:
    return F.coalesce(F.upper(kind).isin(*ALGORITHMS), F.lit(False))

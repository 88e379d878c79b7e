"""Fixed values of the data model, table schemas and run options."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: names and words the source records and the target layout are written in. ---

ID_ROOT = "info:fedora/"
FOXML_NS = "info:fedora/fedora-system:def/foxml#"
DESCRIPTION_SUFFIX = "/fcr:metadata"

STATE_PROPERTY = "info:fedora/fedora-system:def/model#state"
DOWNLOAD_NAME = "info:fedora/fedora-system:def/model#downloadFilename"

OBJECT_INACTIVE = "Inactive"
OBJECT_DELETED = "Deleted"
DS_INACTIVE = "I"
DS_DELETED = "D"

INLINE = "X"
MANAGED = "M"
EXTERNAL_HANDLING = {"E": "proxy", "R": "redirect"}

DC_DS = "DC"
RELS_EXT = "RELS-EXT"
RELS_INT = "RELS-INT"
AUDIT_DS = "AUDIT"

DC_NS = "http://purl.org/dc/elements/1.1/"
DC_ELEMENTS = (
    "contributor", "coverage", "creator", "date", "description", "format", "identifier", "language",
    "publisher", "relation", "rights", "source", "subject", "title", "type",
)

MODEL_CONTAINER = "http://www.w3.org/ns/ldp#BasicContainer"
MODEL_BINARY = "http://www.w3.org/ns/ldp#NonRDFSource"
MODEL_DESCRIPTION = "http://fedora.info/definitions/v4/repository#NonRdfSourceDescription"

XSD_STRING = "http://www.w3.org/2001/XMLSchema#string"
XSD_DATETIME = "http://www.w3.org/2001/XMLSchema#dateTime"
XSD_LONG = "http://www.w3.org/2001/XMLSchema#long"

P_CREATED = "http://fedora.info/definitions/v4/repository#created"
P_LAST_MODIFIED = "http://fedora.info/definitions/v4/repository#lastModified"
P_IDENTIFIER = "http://purl.org/dc/terms/identifier"
P_MIME = "http://www.ebu.ch/metadata/ontologies/ebucore/ebucore#hasMimeType"
P_SIZE = "http://www.loc.gov/premis/rdf/v1#size"
P_DIGEST = "http://www.loc.gov/premis/rdf/v1#hasMessageDigest"
P_TITLE = "http://purl.org/dc/terms/title"
P_STATE = "http://fedora.info/definitions/1/0/access/objState"
P_FORMAT = "http://www.loc.gov/premis/rdf/v1#formatDesignation"

LOCAL_HOST_PLACEHOLDER = "local.fedora.server"
VERSION_MESSAGE = "Generated by Fedora 3 to Fedora 6 migration"
DEFAULT_USER = "fedoraAdmin"
DEFAULT_USER_URI = "info:fedora/fedoraAdmin"
DEFAULT_HOST = "fedora.info"
INVENTORY_TYPE = "https://ocfl.io/1.0/spec/#inventory"

FEDORA_OCFL = "FEDORA_OCFL"
PLAIN_OCFL = "PLAIN_OCFL"
ARCHIVAL = "ARCHIVAL"
ATOMIC = "ATOMIC"

# --- Table schemas (DDL). ---

RAW_RECORDS = "path STRING, xml STRING, length BIGINT"
TRIPLE_FIELDS = "s STRING, p STRING, o STRING, o_kind STRING, o_datatype STRING, o_lang STRING"
REJECTS = "pid STRING, path STRING, stage STRING, message STRING"


@dataclass(frozen=True)
class RunOptions:
    """Everything one migration run can be told; defaults are those of a plain run."""

    source_profile: str = "legacy"              # akubra | legacy | exported
    objects_dir: str | None = None
    datastreams_dir: str | None = None
    exported_dir: str | None = None
    target_dir: str | None = None
    index_dir: str | None = None                # reuse a written content index
    name_regex: str = r"^[^\.].*$"
    migration_type: str = FEDORA_OCFL           # FEDORA_OCFL | PLAIN_OCFL
    resource_type: str = ARCHIVAL               # ARCHIVAL | ATOMIC
    id_prefix: str = ID_ROOT
    digest_algorithm: str = "sha512"            # sha512 | sha256
    user: str = DEFAULT_USER
    user_uri: str = DEFAULT_USER_URI
    local_host: str = DEFAULT_HOST
    add_extensions: bool = False
    delete_inactive: bool = False
    foxml_file: bool = False
    head_only: bool = False
    disable_checksum_validation: bool = False
    disable_dc: bool = False
    continue_on_error: bool = False
    limit: int = -1
    pid_file: str | None = None
    resume: bool = False
    ledger_dir: str | None = None
    resume_position: int = 0
    resume_last_id: str = "foo"                 # marker of a first run
    run_ts: str | None = None                   # the instant stamped on deletions; None = start of the run

    def __post_init__(self) -> None:
        if self.source_profile not in ("akubra", "legacy", "exported"):
            raise ValueError(f"unknown source profile {self.source_profile!r}")
        if self.migration_type not in (FEDORA_OCFL, PLAIN_OCFL):
            raise ValueError(f"unknown migration type {self.migration_type!r}")
        if self.resource_type not in (ARCHIVAL, ATOMIC):
            raise ValueError(f"unknown resource type {self.resource_type!r}")
        if self.migration_type != PLAIN_OCFL and self.id_prefix != ID_ROOT:
            raise ValueError("an id prefix may only be changed for PLAIN_OCFL runs")
        if self.digest_algorithm not in ("sha256", "sha512"):
            raise ValueError("digest algorithm must be sha256 or sha512")
        if self.head_only and self.resource_type == ATOMIC:
            raise ValueError("head-only cannot be combined with atomic resources")

    @property
    def plain(self) -> bool:
        return self.migration_type == PLAIN_OCFL

    @property
    def atomic(self) -> bool:
        return self.resource_type == ATOMIC

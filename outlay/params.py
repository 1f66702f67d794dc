"""Typed parameters for the pipeline and the reports.

Every report takes one of these frozen dataclasses, so a plan is a pure
function of (DataFrames, parameters) and the same parameters can be written
into the DuckDB oracle.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values. Codes, extensions, MIME types, default labels and the
# mapping rules equal the originals. The banner *label texts* are neutral
# stand-ins (the original labels name an organisation): each distinct
# original label has exactly one stand-in here, so groupings are unchanged.
# ---------------------------------------------------------------------------

# Store-type code -> banner label; any other non-blank code gets
# DEFAULT_BANNER, a blank or missing code gets BLANK_BANNER.
BANNER_MAP = {
    "SUP": "Main",
    "WNM": "Main",
    "W/M": "Main",
    "FASHION": "Main",
    "SAM": "Club",
    "FC": "DC",
    "GROCERY DC": "DC",
    "GDC": "DC",
}
DEFAULT_BANNER = "Main"
BLANK_BANNER = "Unknown"

# File extension -> MIME type; anything else is the default.
MIME_MAP = {
    "pdf": "application/pdf",
    "doc": "application/msword",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "xls": "application/vnd.ms-excel",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "png": "image/png",
    "jpg": "image/jpeg",
    "jpeg": "image/jpeg",
    "dwg": "application/acad",
    "zip": "application/zip",
    "msg": "application/vnd.ms-outlook",
    "txt": "text/plain",
    "csv": "text/csv",
}
DEFAULT_MIME = "application/octet-stream"

# Default labels for blank values.
UNKNOWN_VENDOR = "Unknown Vendor"
UNCATEGORISED = "Uncategorised"
GENERAL_FOLDER = "General"
UNASSIGNED = "Unassigned"
NOT_FOUND_DESCRIPTION = "Not found in SAP"
UNKNOWN_TS = "Unknown"

# Scope words that make a project ineligible as a store's owner (K5).
INELIGIBLE_SCOPE_WORDS = ("duplicate", "cancelled")

# Sentinel "no completion date" value shown as blank.
SENTINEL_DATE = "9999-12-31"

PAGE_SIZE = 100
TOP_K = 10

# ---------------------------------------------------------------------------
# Source parameters (what the reference hard-codes per deployment).
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class SourceParams:
    """Deployment constants of the refresh; the fixture values by default."""

    program_token: str = "PROG"
    umbrella_key: str = "PDUMBRELLA"
    # Vendors whose umbrella POs are re-attributed by store (rule-built list).
    umbrella_vendors: tuple[str, ...] = tuple(f"Supplier#{i:09d}" for i in range(20))
    item_store_suffix: str = "TankWork"
    comment_vendor_tokens: tuple[str, ...] = ("ACME", "INSTALLER")
    tracked_nodes: tuple[tuple[str, str], ...] = (
        ("MEDIUM", "Medium Works"),
        ("LARGE", "Large Works"),
        ("PROMO", "Promo Works"),
        ("ABSENT", "Absent Node"),
    )
    # The refresh clock; injected so every run is reproducible.
    refreshed_at: str = "2001-12-01 12:00:00"
    doc_url_base: str = "https://docs.example.invalid"
    project_page: str = "/projects/view?id="

    @property
    def item_store_regex(self) -> str:
        return rf"(?i)^(\d+){self.item_store_suffix}"

    @property
    def comment_po_regex(self) -> str:
        alts = "|".join(self.comment_vendor_tokens)
        return rf"(?i)(?:{alts})\s+PO#?\s*(\d{{8}})"


@dataclass(frozen=True)
class ProjectFilter:
    """R2 / A1-A6 parameters (falsy values mean "no filter")."""

    project_type: str | None = None
    status: str | None = None
    contractor: str | None = None
    banner: str | None = None
    search: str | None = None
    search_fields: tuple[str, ...] | None = None
    sort: str | None = None
    order: str | None = None


@dataclass(frozen=True)
class PoFilter:
    """R4 / A13 parameters."""

    vendor: str | None = None
    state: str | None = None
    project_status: str | None = None
    po_status: str | None = None
    has_remaining: bool = False
    give_back_only: bool = False
    aging_30: bool = False
    search: str | None = None
    search_fields: tuple[str, ...] | None = None
    sap_def: str | None = None
    sort: str | None = None
    order: str | None = None
    page: int = 1
    page_size: int = PAGE_SIZE


@dataclass(frozen=True)
class StaticFilter:
    """F11 / F12 client-side filters of the static bundle."""

    banner: str | None = None
    project_type: str | None = None
    status: str | None = None
    contractor: str | None = None
    vendor: str | None = None
    po_status: str | None = None
    project_status: str | None = None
    has_remaining: bool = False
    give_back_only: bool = False
    search: str | None = None


DEFAULT_AS_OF = "2001-12-01 12:00:00"

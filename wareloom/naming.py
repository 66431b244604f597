"""Warehouse table names: ``<layer>.<dept>_<source>_<table>`` and target-name rules."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

# The view/copy/geocode suffixes removed from source names
# before a copy, and the suffixes of the enrichment tables.
STRIP_SUFFIXES = ("_V", "_C", "_G")
GEOCODED_SUFFIX = "_G"
USPS_SUFFIX = "_uspsG"


@dataclass(frozen=True)
class TableRef:
    dept: str
    source: str
    table: str
    layer: str = "staging"

    @property
    def name(self) -> str:
        return f"{self.dept}_{self.source}_{self.table}"

    @property
    def qualified(self) -> str:
        return f"{self.layer}.{self.name}"

    def at(self, layer: str) -> "TableRef":
        return replace(self, layer=layer)

    def derived(self, suffix: str) -> str:
        return f"{self.layer}.{self.name}{suffix}"

    @property
    def geocoded(self) -> str:
        """The geocoded sibling table (``<name>_G``)."""
        return self.derived(GEOCODED_SUFFIX)

    @property
    def usps_geocoded(self) -> str:
        """The second-chance geocoding results (``<name>_uspsG``)."""
        return self.derived(USPS_SUFFIX)


def strip_host(name: str) -> str:
    """``db.example.org`` style host prefix removed: keep the last dotted part."""
    return name.split(".")[-1]


def strip_leading_underscore(name: str) -> str:
    return re.sub(r"^_+", "", name)


def strip_suffix(name: str, suffixes: tuple[str, ...] = STRIP_SUFFIXES) -> str:
    for s in suffixes:
        if name.endswith(s):
            return name[: -len(s)]
    return name


def target_name(source_table: str, suffix: str = "", prefix: str = "") -> str:
    """Copy target: host and leading ``_`` removed, view/copy suffix removed, suffix added."""
    base = strip_suffix(strip_leading_underscore(strip_host(source_table)))
    return f"{prefix}{base}{suffix}"

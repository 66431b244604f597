"""Encoding repair.

Spark 4 rejects ``windows-1252`` as a charset in ``decode`` and in the CSV
reader, so windows-1252 bytes are decoded as ISO-8859-1 (byte n -> U+00nn,
never fails) and the 32 code points U+0080..U+009F are translated to the
characters windows-1252 puts there.  Everything stays a JVM expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Windows-1252 bytes 0x80..0x9F and their characters
# (bytes 0x81, 0x8D, 0x8F, 0x90, 0x9D are unassigned and kept as is).
CP1252_HIGH = {
    0x80: "€", 0x82: "‚", 0x83: "ƒ", 0x84: "„", 0x85: "…",
    0x86: "†", 0x87: "‡", 0x88: "ˆ", 0x89: "‰", 0x8A: "Š",
    0x8B: "‹", 0x8C: "Œ", 0x8E: "Ž", 0x91: "‘", 0x92: "’",
    0x93: "“", 0x94: "”", 0x95: "•", 0x96: "–", 0x97: "—",
    0x98: "˜", 0x99: "™", 0x9A: "š", 0x9B: "›", 0x9C: "œ",
    0x9E: "ž", 0x9F: "Ÿ",
}
_FROM = "".join(chr(b) for b in CP1252_HIGH)
_TO = "".join(CP1252_HIGH.values())


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def cp1252_fix(col: Column | str) -> Column:
    """Text that was decoded as ISO-8859-1 but is really windows-1252."""
    return F.translate(_c(col), _FROM, _TO)


def from_cp1252(col: Column | str) -> Column:
    """windows-1252 bytes (binary column) to text."""
    return cp1252_fix(F.decode(_c(col), "ISO-8859-1"))


def from_utf8_lenient(col: Column | str) -> Column:
    """UTF-8 bytes to text; invalid sequences become U+FFFD instead of failing."""
    # cast(binary as string) keeps the raw bytes; make_valid_utf8 repairs them
    return F.make_valid_utf8(_c(col).cast("string"))

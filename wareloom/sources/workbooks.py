"""Folder of ``.xlsx`` workbooks -> one DataFrame.

Plan: ``binaryFile`` lists and reads the files (one task per file: a
workbook is a zip and cannot be split); ``mapInPandas`` turns each file into
long cell rows ``(file, sheet_index, sheet, row_no, col_no, value)`` with the
standard library only (zip + XML); everything after that is Spark:

* numbers in a date or time style become ISO text (both date systems);
* the cells are written once to the shared scratch folder, so header, body and
  checks read them there instead of parsing the files again;
* sheets are read event by event, so a task holds a workbook's packed bytes, its shared
  strings and some thousand cells;
* the header row (after ``skip`` rows) names the columns per (file, sheet);
  empty headers get the placeholder ``Unnamed: <k>`` and are dropped, and a
  header that repeats in a sheet (in any case of letters) gets the first of ``_2``, ``_3``, ...
  that no header of the sheet has; spellings of one header in several files that
  differ in case, or after cleaning not at all, are one column;
* cells are joined to their header name and pivoted back to rows with
  ``groupBy(file, sheet, row).pivot(name, names)`` (the distinct header names
  are metadata and read on the driver to fix the pivot columns);
* sheets of all files are thereby unioned by name (missing columns NULL);
* ``column_types`` casts with ``try_cast``.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from xml.etree import ElementTree as ET

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wareloom.functions.columns import UNNAMED_PREFIX, clean_name

CELL_SCHEMA = "file string, sheet_index int, sheet string, row_no int, col_no int, value string"
_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
       "pr": "http://schemas.openxmlformats.org/package/2006/relationships"}


def _col_index(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n


def _text(el) -> str:
    return "".join(t.text or "" for t in el.iter(f"{{{_NS['m']}}}t"))


# The built-in number formats that show dates or times
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles that show a date or a time."""
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ET.fromstring(z.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in root.iter(f"{{{_NS['m']}}}numFmt")}
    xfs = root.find("m:cellXfs", _NS)

    def shows_time(number: int) -> bool:
        if number not in own:
            return number in DATE_FORMATS
        code = re.sub(r'"[^"]*"|\\.|\[(?!h|m|s)[^\]]*\]', "", own[number].lower())
        return code != "general" and any(c in code for c in "dmyhs")

    return {i for i, xf in enumerate(xfs if xfs is not None else ()) if shows_time(int(xf.get("numFmtId", 0)))}


def serial_text(value: str, base1904: bool) -> str:
    """ISO text of a date serial: date, date and time, or time alone (under one day)."""
    micros = round(float(value) * 86_400_000) * 1000
    moment = (dt.datetime(1904, 1, 1) if base1904 else dt.datetime(1899, 12, 30)) + dt.timedelta(microseconds=micros)
    if 0 <= float(value) < 1:
        return moment.time().isoformat()
    return moment.date().isoformat() if moment.time() == dt.time() else moment.isoformat(" ")


def _sheets(z: zipfile.ZipFile):
    """(index, name, path) of the sheets."""
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    target = {r.get("Id"): r.get("Target") for r in rels.findall("pr:Relationship", _NS)}
    for idx, sh in enumerate(wb.find("m:sheets", _NS).findall("m:sheet", _NS)):
        path = target[sh.get(f"{{{_NS['r']}}}id")].lstrip("/")
        yield idx, sh.get("name"), path if path.startswith("xl/") else "xl/" + path


def _events(z: zipfile.ZipFile, path: str, tag: str):
    """The elements ``tag`` of a part, one by one; each is dropped when the next is asked for."""
    with z.open(path) as part:
        parents: list = []
        for event, el in ET.iterparse(part, events=("start", "end")):
            if event == "start":
                parents.append(el)
                continue
            parents.pop()
            if el.tag == f"{{{_NS['m']}}}{tag}":
                yield el
                if parents:
                    parents[-1].clear()


def parse_xlsx(data: bytes):
    """Yield (sheet_index, sheet_name, row_no, col_no, value) for every non-empty cell."""
    z = zipfile.ZipFile(io.BytesIO(data))
    shared = [_text(si) for si in _events(z, "xl/sharedStrings.xml", "si")] if "xl/sharedStrings.xml" in z.namelist() else []
    dated = _date_styles(z)
    props = ET.fromstring(z.read("xl/workbook.xml")).find("m:workbookPr", _NS)
    base1904 = props is not None and props.get("date1904") in ("1", "true")
    for idx, name, path in _sheets(z):
        for row in _events(z, path, "row"):
            r_no = int(row.get("r"))
            for c in row.findall("m:c", _NS):
                t = c.get("t")
                v = c.find("m:v", _NS)
                if t == "s" and v is not None:
                    val = shared[int(v.text)]
                elif t == "inlineStr":
                    val = _text(c)
                elif t == "b" and v is not None:
                    val = "TRUE" if v.text == "1" else "FALSE"
                else:
                    val = v.text if v is not None else None
                    if val and t in (None, "n") and int(c.get("s", 0)) in dated:
                        val = serial_text(val, base1904)
                if val is None or val == "":
                    continue
                yield idx, name, r_no, _col_index(c.get("r")), val


CELLS_AT_ONCE = 20_000


def header_names(headers: list[str], clean: bool = False) -> list[str]:
    """Column names of one sheet's headers, in order, no two alike in any case of letters."""
    base = [clean_name(h) if clean and not h.startswith(UNNAMED_PREFIX) else h for h in headers]
    reserved, used, out = {b.lower() for b in base}, set(), []
    for b in base:
        name, n = b, 2
        while name.lower() in used or (name != b and name.lower() in reserved):
            name, n = f"{b}_{n}", n + 1
        used.add(name.lower())
        out.append(name)
    return out


def _named_headers(heads: DataFrame, clean: bool) -> DataFrame:
    """``heads`` with the name that each header has in its sheet (a sheet's headers are one row here)."""
    import pandas as pd

    lists = heads.groupBy("file", "sheet_index").agg(F.sort_array(F.collect_list(F.struct("col_no", "name"))).alias("hs"))

    def name(frames):
        for pdf in frames:
            rows = [(f, s, h["col_no"], n) for f, s, hs in pdf.itertuples(index=False) for h, n in zip(hs, header_names([h["name"] for h in hs], clean))]
            yield pd.DataFrame(rows, columns=["file", "sheet_index", "col_no", "name"]).astype({"sheet_index": "int32", "col_no": "int32"})

    return lists.mapInPandas(name, "file string, sheet_index int, col_no int, name string")


def cells(files: DataFrame) -> DataFrame:
    """Long cell rows of every workbook of ``files`` (path, content), and one row without
    position or value for each of its sheets."""
    import pandas as pd

    from wareloom.session import ship_package

    ship_package(files.sparkSession)

    def frame(rows):
        return pd.DataFrame(rows, columns=["file", "sheet_index", "sheet", "row_no", "col_no", "value"]).astype(
            {"sheet_index": "int32", "row_no": "int32", "col_no": "int32"})

    def explode_files(batches):
        for pdf in batches:
            out = []
            for p, content in zip(pdf["path"], pdf["content"]):
                for sidx, sname, _ in _sheets(zipfile.ZipFile(io.BytesIO(content))):
                    out.append((p, sidx, sname, 0, 0, None))
                for sidx, sname, r, c, v in parse_xlsx(bytes(content)):
                    out.append((p, sidx, sname, r, c, v))
                    if len(out) >= CELLS_AT_ONCE:
                        yield frame(out)
                        out = []
            yield frame(out)

    return files.select("path", "content").mapInPandas(explode_files, CELL_SCHEMA)


def read_folder(spark: SparkSession, path: str, sheet: str | int | None = None, skip: int = 0,
                column_types: dict[str, str] | None = None, glob: str = "*.xlsx",
                keep_source: bool = False, clean: bool = False) -> DataFrame:
    """Workbooks of a folder as one table (see ``read_files``)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return read_files(files, sheet, skip, column_types, keep_source, clean)


def read_files(files: DataFrame, sheet: str | int | None = None, skip: int = 0, column_types: dict[str, str] | None = None,
               keep_source: bool = False, clean: bool = False) -> DataFrame:
    """Workbooks given as (path, content) as one table.

    ``sheet``: None = all sheets concatenated, an int = that sheet position
    (0 = first), a str = the sheet of that name; a workbook without that sheet is
    an error.  ``skip`` rows precede the header row.  ``clean`` turns the headers into
    lower snake case; ``column_types`` then goes by the clean names.
    """
    from wareloom.session import cut_lineage

    cl = cut_lineage(cells(files), "workbook-cells")
    if sheet is not None:
        here = F.col("sheet_index") == sheet if isinstance(sheet, int) else F.col("sheet") == sheet
        without = cl.groupBy("file").agg(F.max(here).alias("has")).where("not has").select("file").limit(5).collect()
        if without:
            raise ValueError(f"no sheet {sheet!r} in {', '.join(r.file for r in without)}")
        cl = cl.where(here)
    cl = cl.where("row_no > 0")
    header_row = skip + 1
    # first row of each sheet at or after the header position is the header
    heads = cl.where(F.col("row_no") == header_row).select(
        "file", "sheet_index", "col_no", F.col("value").alias("name"))
    heads = cut_lineage(_named_headers(heads, clean), "workbook-headers")
    # one spelling per name, the one that comes first
    spelt = {}
    for r in (heads.groupBy("name").agg(F.min(F.struct("sheet_index", "col_no")).alias("o")).orderBy("o", "name").collect()):
        spelt.setdefault(r["name"].lower(), r["name"])
    heads = heads.withColumn("name", F.lower("name"))
    body = cl.where(F.col("row_no") > header_row)
    named = body.join(heads, ["file", "sheet_index", "col_no"], "left").withColumn(
        "name", F.coalesce(F.col("name"), F.concat(F.lit(UNNAMED_PREFIX + ": "), (F.col("col_no") - 1).cast("string"))))
    named = named.where(~F.lower("name").startswith(UNNAMED_PREFIX.lower()))
    names = [n for n in spelt if not n.startswith(UNNAMED_PREFIX.lower())]
    keys = ["file", "sheet", "row_no"]
    wide = named.groupBy(*keys).pivot("name", names).agg(F.first("value"))
    taken = {k: f"__{k}" for k in keys}  # a sheet may have headers of these names
    wide = wide.toDF(*taken.values(), *wide.columns[len(keys):])
    out = wide.select(*([F.col(t).alias(k) for k, t in taken.items()] if keep_source else []),
                      *[F.col(f"`{n}`").alias(spelt[n]) if n in wide.columns else F.lit(None).cast("string").alias(spelt[n]) for n in names])
    if column_types:
        from wareloom.functions.types import safe_cast

        out = out.withColumns({c: safe_cast(F.col(f"`{c}`"), t) for c, t in column_types.items() if c in out.columns})
    return out

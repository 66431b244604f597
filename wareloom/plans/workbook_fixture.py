"""Test-fixture generator: customer rows written as small ``.xlsx`` workbooks.

Only used to give the workbook reader real input derived from the driver
tables (workbook writing is not an export of this library).  Rows are
grouped by (segment, key block), so each workbook holds a bounded number of
rows; two sheets per workbook (even / odd keys), a title row to skip and a
column with an empty header.
"""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_BOOK = 500
HEADERS = ("c_custkey", "c_name", "c_acctbal")

_CT = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
       '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
       '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
       '<Default Extension="xml" ContentType="application/xml"/>'
       '<Override PartName="/xl/workbook.xml" '
       'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
       '<Override PartName="/xl/worksheets/sheet1.xml" '
       'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
       '<Override PartName="/xl/worksheets/sheet2.xml" '
       'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
       '</Types>')
_RELS = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
         '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
         '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
         'officeDocument" Target="xl/workbook.xml"/></Relationships>')
_WB = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
       '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
       'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>'
       '<sheet name="customers" sheetId="1" r:id="rId1"/><sheet name="more" sheetId="2" r:id="rId2"/>'
       '</sheets></workbook>')
_WB_RELS = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
            'worksheet" Target="worksheets/sheet1.xml"/>'
            '<Relationship Id="rId2" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
            'worksheet" Target="worksheets/sheet2.xml"/></Relationships>')


def _cell(ref: str, v) -> str:
    if v is None:
        return ""
    if isinstance(v, (int, float)):
        return f'<c r="{ref}"><v>{v!r}</v></c>'
    return f'<c r="{ref}" t="inlineStr"><is><t>{escape(str(v))}</t></is></c>'


def _sheet(rows: list[tuple], headers: tuple = HEADERS) -> str:
    out = ['<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
           '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>']
    out.append(f'<row r="1">{_cell("A1", "Customer list")}</row>')
    out.append(f'<row r="2">{_cell("A2", headers[0])}{_cell("B2", headers[1])}{_cell("D2", headers[2])}</row>')
    for i, (k, name, bal) in enumerate(rows, start=3):
        out.append(f'<row r="{i}">{_cell(f"A{i}", int(k))}{_cell(f"B{i}", name)}{_cell(f"C{i}", "note")}'
                   f'{_cell(f"D{i}", float(bal))}</row>')
    out.append("</sheetData></worksheet>")
    return "".join(out)


def workbook_bytes(even: list[tuple], odd: list[tuple], headers: tuple = HEADERS) -> bytes:
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", _CT)
        z.writestr("_rels/.rels", _RELS)
        z.writestr("xl/workbook.xml", _WB)
        z.writestr("xl/_rels/workbook.xml.rels", _WB_RELS)
        z.writestr("xl/worksheets/sheet1.xml", _sheet(even, headers))
        z.writestr("xl/worksheets/sheet2.xml", _sheet(odd, headers))
    return buf.getvalue()


def customer_workbooks(customer: DataFrame, headers=None) -> DataFrame:
    """(path, content) of one workbook per (segment, block of ROWS_PER_BOOK keys), made in the tasks.

    ``headers(segment)`` gives the three header texts of a workbook (default: the column names)."""
    import pandas as pd

    from wareloom.session import ship_package

    ship_package(customer.sparkSession)

    def book(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("c_custkey")
        rows = list(zip(pdf["c_custkey"], pdf["c_name"], pdf["c_acctbal"]))
        segment, block = str(pdf["c_mktsegment"].iloc[0]), int(pdf["block"].iloc[0])
        names = headers(segment) if headers else HEADERS
        content = workbook_bytes([r for r in rows if r[0] % 2 == 0], [r for r in rows if r[0] % 2 == 1], names)
        return pd.DataFrame({"path": [f"{segment.lower()}-{block}.xlsx"], "content": [content]})

    grouped = customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment",
                              F.floor(F.col("c_custkey") / ROWS_PER_BOOK).alias("block"))
    return grouped.groupBy("c_mktsegment", "block").applyInPandas(book, "path string, content binary")

"""Workbooks with dates, repeated headers, clean names and missing sheets."""

import datetime as dt
import zipfile

import pytest

from wareloom.sources import workbooks as W

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def workbook(path, sheets, base1904=False):
    """``sheets``: name -> rows of cells (text, or (number, style))."""
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w") as z:
        names = "".join(f'<sheet name="{n}" sheetId="{i + 1}" r:id="r{i}"/>' for i, n in enumerate(sheets))
        z.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="{rel}"><workbookPr date1904="{int(base1904)}"/><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(len(sheets)))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        formats = '<numFmt numFmtId="170" formatCode="yyyy\\-mm\\-dd"/><numFmt numFmtId="171" formatCode="[Red]0.00 &quot;days&quot;"/>'
        z.writestr("xl/styles.xml", f'<styleSheet {MAIN}><numFmts>{formats}</numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs></styleSheet>')
        for i, rows in enumerate(sheets.values()):
            body = ""
            for r, row in enumerate(rows, 1):
                cells = "".join(f'<c r="{chr(65 + c)}{r}" t="inlineStr"><is><t>{v}</t></is></c>' if isinstance(v, str) else f'<c r="{chr(65 + c)}{r}" s="{v[1]}"><v>{v[0]}</v></c>'
                                for c, v in enumerate(row) if v is not None)
                body += f'<row r="{r}">{cells}</row>'
            z.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {MAIN}><sheetData>{body}</sheetData></worksheet>")


def test_dates_repeated_headers_and_clean_names(spark, tmp_path):
    workbook(tmp_path / "a.xlsx", {"One": [["Total Amt", "Total Amt", "when", "At"], [(1, 0), (2, 0), (45292, 1), (45292.5, 2)], [(3, 3), None, (45293, 2), (0.25, 1)]]})
    out = W.read_folder(spark, str(tmp_path), clean=True, column_types={"when": "timestamp", "total_amt": "double"})
    assert out.columns == ["total_amt", "total_amt_2", "when", "at"]
    rows = sorted(map(tuple, out.collect()), key=str)
    assert rows == [(1.0, "2", dt.datetime(2024, 1, 1), "2024-01-01 12:00:00"), (3.0, None, dt.datetime(2024, 1, 2), "06:00:00")]
    assert W.read_folder(spark, str(tmp_path)).columns == ["Total Amt", "Total Amt_2", "when", "At"]


def test_1904_dates(tmp_path):
    workbook(tmp_path / "b.xlsx", {"S": [[(0, 0), (1, 1)]]}, base1904=True)
    assert [v for *_, v in W.parse_xlsx((tmp_path / "b.xlsx").read_bytes())] == ["0", "1904-01-02"]


def test_a_missing_sheet_is_an_error_and_an_empty_one_is_not(spark, tmp_path):
    workbook(tmp_path / "a.xlsx", {"One": [["x"], ["1"]], "Two": [["x"], ["2"]]})
    workbook(tmp_path / "b.xlsx", {"One": []})
    assert [r.x for r in W.read_folder(spark, str(tmp_path), sheet="One").collect()] == ["1"]
    with pytest.raises(ValueError, match="b.xlsx"):
        W.read_folder(spark, str(tmp_path), sheet="Two")
    with pytest.raises(ValueError, match="no sheet 1"):
        W.read_folder(spark, str(tmp_path), sheet=1)

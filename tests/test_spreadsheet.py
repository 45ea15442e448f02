"""Spreadsheets that the tests write as zipped XML."""

import zipfile

import pytest

from sievework.operators import calibration
from sievework.sources import spreadsheet

BOOK = '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="First" sheetId="1" r:id="rId1"/><sheet name="Data &amp; more" sheetId="2" r:id="rId7"/></sheets></workbook>'
LINKS = '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId7" Target="/xl/worksheets/b.xml"/><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>'
SHEET = '<?xml version="1.0"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{}</sheetData></worksheet>'
SHARED = '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><si><t>seq</t></si><si><r><t>HKTD</t></r><r><t xml:space="preserve">SFVGLM </t></r></si><si><t/></si></sst>'
ROWS = """<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="inlineStr"><is><t>EC50</t></is></c><c r="C1" t="str"><v>made</v></c><c r="E1" t="s"><v>0</v></c></row>
<row r="2"><c r="A2" t="s"><v>1</v></c><c r="B2"><v>12.5</v></c><c r="C2"><v>1</v></c><c r="D2" t="b"><v>1</v></c></row>
<row r="3"/><row r="4"><c r="C4" t="str"><v>Difficult</v></c><c r="B4" t="e"><v>#N/A</v></c><c r="E4"><v>1e3</v></c></row>
<row><c t="s"><v>2</v></c><c><v>7</v></c></row>"""


def book(path, rows=ROWS, shared=SHARED):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", BOOK)
        z.writestr("xl/_rels/workbook.xml.rels", LINKS)
        z.writestr("xl/worksheets/sheet1.xml", SHEET.format(rows))
        z.writestr("xl/worksheets/b.xml", SHEET.format('<row r="1"><c r="AB1"><v>5</v></c></row><row r="2"><c r="AB2" t="b"><v>0</v></c></row>'))
        if shared:
            z.writestr("xl/sharedStrings.xml", shared)
    return str(path)


def test_cells_of_all_kinds(spark, tmp_path):
    path = book(tmp_path / "x.xlsx")
    found = spreadsheet.read_spreadsheet(spark, path)
    assert found.columns == ["seq", "EC50", "made", "column_4", "seq_5"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted([("HKTDSFVGLM ", "12.5", "1", "true", None), (None, None, "Difficult", None, "1000"), ("", "7", None, None, None)], key=str)
    typed = spreadsheet.read_spreadsheet(spark, path, schema="EC50 double, column_4 boolean, seq_5 long, made int, absent string")
    assert sorted(map(tuple, typed.collect()), key=str) == sorted([(12.5, True, None, 1, None), (None, None, 1000, None, None), (7.0, None, None, None, None)], key=str)
    other = spreadsheet.read_spreadsheet(spark, path, "Data & more")
    assert len(other.columns) == 28 and other.columns[27] == "5" and other.first()[27] == "false"
    with pytest.raises(Exception, match="no sheet"):
        spreadsheet.read_spreadsheet(spark, path, "None").collect()
    with pytest.raises(FileNotFoundError):
        spreadsheet.read_spreadsheet(spark, str(tmp_path / "no*.xlsx"))


def test_many_books_and_an_empty_one(spark, tmp_path):
    for i in range(3):
        book(tmp_path / f"n{i}.xlsx", f'<row r="1"><c r="A1" t="str"><v>k</v></c></row>' + "".join(f'<row r="{k + 2}"><c r="A{k + 2}"><v>{i * 1000 + k}</v></c></row>' for k in range(500)), None)
    book(tmp_path / "n9.xlsx", "", None)
    found = spreadsheet.read_spreadsheet(spark, str(tmp_path / "n*.xlsx"), schema="k long")
    assert sorted(r["k"] for r in found.collect()) == [i * 1000 + k for i in range(3) for k in range(500)] and found.rdd.getNumPartitions() == 4


def test_calibration_table_from_a_spreadsheet(spark, tmp_path):
    df = calibration.derive(calibration.read_table(spark, book(tmp_path / "t.xlsx")), "seq", "made", "EC50")
    assert tuple(calibration.totals(df).first()) == (3, 1, 1, 2, 2)

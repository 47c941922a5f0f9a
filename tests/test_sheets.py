"""Sheets are read as streams: memory does not follow their rows, and a file that breaks off late is no file."""

import io
import tracemalloc
import zipfile

from listwell.plans.lake import Lake
from listwell.sources.readers import _sheet_rows

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
LINK = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def workbook(sheets, strings=(), end="</sheetData></worksheet>"):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{LINK}"><sheets>' + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x">' + "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(len(sheets))) + "</Relationships>")
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">' + "".join(f"<si><t>{s}</t></si>" for s in strings) + "</sst>")
        for i, rows in enumerate(sheets.values()):
            with z.open(f"xl/worksheets/s{i}.xml", "w") as f:
                f.write(f'<worksheet xmlns="{MAIN}"><sheetData>'.encode())
                for row in rows:
                    f.write(f"<row>{row}</row>".encode())
                f.write(end.encode())
    return out.getvalue()


def test_memory_does_not_follow_the_rows():
    n = 120_000
    data = workbook({"s": (f'<c t="s"><v>{i % 60_000}</v></c><c><v>{i}</v></c>' for i in range(n))}, (f"text {i}" for i in range(60_000)))
    tracemalloc.start()
    count = last = 0
    for _, number, cells in _sheet_rows(data):
        count, last = count + 1, cells
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert count == number == n and last == [f"text {(n - 1) % 60_000}", str(n - 1)]
    assert peak < 30 << 20, peak


def test_two_sheets_a_merged_cell_and_a_broken_end(spark, tmp_path):
    rows = ['<c t="inlineStr"><is><t>k</t></is></c><c t="inlineStr"><is><t>v</t></is></c>', '<c r="A2"><v>1</v></c><c r="B2" t="s"><v>0</v></c>', '<c r="A3"/><c r="B3" t="b"><v>1</v></c>']
    (tmp_path / "good.xlsx").write_bytes(workbook({"one": rows, "two": rows[:2]}, ["merged"]))
    (tmp_path / "torn.xlsx").write_bytes(workbook({"one": rows}, ["x"], end="</sheetData>"))
    (tmp_path / "none.xlsx").write_bytes(workbook({"one": ['<c t="s"><v>5</v></c>']}))
    lake = Lake(spark, str(tmp_path / "lake"))
    assert lake.ingest([str(tmp_path)]) == {"good.xlsx": "success", "none.xlsx": "failed", "torn.xlsx": "failed"}
    assert lake.bronze_sources() == ["good_one", "good_two"]
    assert [(r.k, r.v) for r in lake.bronze("good_one").orderBy("_row_ordinal").collect()] == [(1, "merged"), (None, "true")] and lake.bronze("good_two").count() == 1

"""Workbooks made of rows, in tasks: one small XLSX file for each row of a DataFrame, as bytes."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_LINK = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
#: Cell style 1 shows a serial number as a date.
_PARTS = {
    "xl/workbook.xml": f'<workbook xmlns="{_MAIN}" xmlns:r="{_LINK}"><sheets><sheet name="rows" sheetId="1" r:id="r1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>',
    "xl/styles.xml": f'<styleSheet xmlns="{_MAIN}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
}


def _cell(value: object, days: bool) -> str:
    if value is None:
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, str):
        return f'<c t="inlineStr"><is><t>{escape(value)}</t></is></c>'
    return f'<c{" s=" + chr(34) + "1" + chr(34) if days else ""}><v>{value}</v></c>'


def with_workbooks(books: DataFrame, days: str = "day") -> DataFrame:
    """(path, content) of a workbook for each row of ``books`` (book, rows): a header, then ``rows``, an array of structs.

    The field named ``days`` holds serial numbers that are shown as dates.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for book, rows in zip(b.column(0), b.column(1), strict=True):
                names = [f.name for f in b.schema.field(1).type.value_type]
                lines = ["".join(_cell(n, False) for n in names)] + ["".join(_cell(r[n], n == days) for n in names) for r in rows.as_py() or []]
                body = "".join(f"<row>{line}</row>" for line in lines)
                out = io.BytesIO()
                with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                    for name, text in (_PARTS | {"xl/worksheets/sheet1.xml": f'<worksheet xmlns="{_MAIN}"><sheetData>{body}</sheetData></worksheet>'}).items():
                        z.writestr(name, text)
                yield pa.RecordBatch.from_pydict({"path": [f"book-{book.as_py()}.xlsx"], "content": pa.array([out.getvalue()], pa.binary())})

    return books.select("book", "rows").mapInArrow(run, "path string, content binary")

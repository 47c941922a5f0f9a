"""Readers of CSV, JSON and workbook files: every cell is text until its type is inferred, '' is null."""

from __future__ import annotations

import csv
import datetime as dt
import io
import itertools
import re
import uuid
import zipfile
from collections.abc import Iterator
from typing import IO
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.inference import filled
from ..functions.names import clean_names

ORDINAL, FILE = "_row_ordinal", "_source_path"


def plain_path(path: str) -> str:
    """A file's path without scheme and leading slashes."""
    return re.sub("^[a-z0-9]+:", "", path).lstrip("/")


def file_path() -> Column:
    """The plain path of a row's file; the scan gives it percent-encoded."""
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^(?:[a-z0-9]+:)?/*", "")


def header_names(line: str, delimiter: str) -> list[str]:
    """Names of a header as they stand in the file, without white space around them; a quoted name may span lines."""
    csv.field_size_limit(max(csv.field_size_limit(), len(line) + 1))
    return [name.strip() for name in next(csv.reader(io.StringIO(line, newline=""), delimiter=delimiter), [])]


def read_csv(spark: SparkSession, paths: list[str], names: list[str], *, delimiter: str = ",", encoding: str = "UTF-8", multiline: bool = True) -> DataFrame:
    """Rows below the header of files of one dialect, by position under ``names`` made clean.

    Short rows are filled with nulls and surplus fields dropped; a row whose cells are all empty is a row of nulls, a line
    without any character is none. ``multiline=False`` lets a large file be read in splits,
    where no quoted field holds a line break. ``_row_ordinal`` follows the order of rows within a file.
    """
    if not any(name.strip() for name in names):
        raise ValueError("no header: the first record has no names")
    clean = clean_names(names)
    schema = StructType([StructField(f"c{i}", StringType()) for i in range(len(clean))])
    raw = spark.read.schema(schema).options(header=True, sep=delimiter, encoding=encoding, quote='"', escape='"', multiLine=multiline, mode="PERMISSIVE", enforceSchema=True, maxColumns=max(20_480, 2 * len(clean))).csv(paths)
    placed = raw.withColumn(FILE, file_path()).withColumn(ORDINAL, F.monotonically_increasing_id())
    return placed.select(*(filled(F.col(f"c{i}")).alias(c) for i, c in enumerate(clean)), FILE, ORDINAL)


def _with_end(text: Column) -> tuple[Column, str]:
    """JSON text as the first of two values, the second a word drawn for this plan.

    The parser leaves what follows a value alone: only if that word comes next is ``text`` one value and nothing else.
    """
    end = uuid.uuid4().hex
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{end}"]'))), end


def _ended(pair: Column, end: str) -> Column:
    return F.try_variant_get(pair, "$[1]", "string") == end


def _json_rows(spark: SparkSession, paths: list[str], lines: bool, large: tuple[str, ...] = ()) -> DataFrame:
    """(value variant, file, ordinal) of every record; a record that isn't an object has a null value.

    Of ``paths`` the ``large`` ones are read in splits if they hold an array.
    """
    if large and not lines:
        from .arrays import array_records

        records, others = array_records(spark, list(large))
        parsed = records.select(F.try_parse_json("text").alias("v"), F.col("file").alias(FILE), F.col("ordinal").alias(ORDINAL))
        cut = parsed.select(F.when(F.schema_of_variant("v").startswith("OBJECT"), F.col("v")).alias("v"), FILE, ORDINAL)
        rest = [p for p in paths if p not in large or plain_path(p) in others]
        return cut.unionAll(_json_rows(spark, rest, lines)) if rest else cut
    text = spark.read.text(paths, wholetext=not lines).withColumn(FILE, file_path()).where(F.length(F.trim("value")) > 0)
    if lines:
        pair, end = _with_end(F.col("value"))
        pairs = text.withColumn("w", pair).withColumn(ORDINAL, F.monotonically_increasing_id())
        parsed = pairs.withColumn("v", F.when(_ended(F.col("w"), end), F.try_variant_get("w", "$[0]", "variant")))
    else:
        # an array of objects, or one object; a record's place in the file orders it
        pair, end = _with_end(F.col("value"))
        pairs = text.select(F.ltrim("value").startswith("[").alias("many"), pair.alias("w"), FILE)
        document = F.when(_ended(F.col("w"), end), F.when(F.col("many"), F.try_variant_get("w", "$[0]", "variant")).otherwise(F.col("w")))
        pairs.select("many", document.alias("document"), FILE).createOrReplaceTempView("_listwell_json")
        parsed = spark.sql(f"SELECT e.value AS v, {FILE}, coalesce(cast(e.pos AS bigint), 0) AS {ORDINAL} FROM _listwell_json, LATERAL variant_explode_outer(document) AS e WHERE document IS NULL OR e.pos = 0 OR many AND e.pos > 0")
    return parsed.select(F.when(F.schema_of_variant("v").startswith("OBJECT"), F.col("v")).alias("v"), FILE, ORDINAL)


def broken_json_files(spark: SparkSession, paths: list[str], *, lines: bool, large: tuple[str, ...] = ()) -> DataFrame:
    """(file, broken): files with records that are not objects, which fail as a whole."""
    return _json_rows(spark, paths, lines, large).groupBy(FILE).agg(F.count_if(F.col("v").isNull()).alias("broken")).where("broken > 0")


def read_json(spark: SparkSession, paths: list[str], *, lines: bool, large: tuple[str, ...] = ()) -> DataFrame:
    """Objects as rows of text: the union of all keys in the order first seen, over every record.

    Nested values are JSON text with sorted keys; booleans read true and false; null and '' are null. The ``large`` ones of
    ``paths`` are read in splits where they hold an array; ordinals then follow the records' places without being their numbers.
    """
    rows = _json_rows(spark, paths, lines, large).where("v IS NOT NULL")
    rows.createOrReplaceTempView("_listwell_objects")
    # as many rows as there are distinct keys
    seen = spark.sql(f"SELECT e.key, min(struct({FILE}, {ORDINAL}, e.pos)) AS at FROM _listwell_objects, LATERAL variant_explode(v) AS e GROUP BY e.key ORDER BY at").collect()
    keys = [r["key"] for r in seen]
    path = lambda k: "$[" + '"' + k.replace("\\", "\\\\").replace('"', '\\"') + '"' + "]"
    columns = [filled(F.try_variant_get("v", path(k), "string")).alias(c) for k, c in zip(keys, clean_names(keys), strict=True)]
    return rows.select(*columns, FILE, ORDINAL)


# Number formats of workbooks that are dates or times, and the days that serial numbers count from.
DATE_FORMATS = frozenset((*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)))
EPOCH, EPOCH_1904 = dt.datetime(1899, 12, 30), dt.datetime(1904, 1, 1)


def _date_styles(book: zipfile.ZipFile, main: str) -> dict[int, bool]:
    """Cell styles that show a date or time; true for those of elapsed time."""
    if "xl/styles.xml" not in book.namelist():
        return {}
    sheet = ElementTree.fromstring(book.read("xl/styles.xml"))
    codes = {int(f.get("numFmtId")): f.get("formatCode") or "" for f in sheet.iter(f"{main}numFmt")}
    found = {}
    for at, style in enumerate(x for formats in sheet.iter(f"{main}cellXfs") for x in formats.iter(f"{main}xf")):
        number = int(style.get("numFmtId") or 0)
        code = re.sub(r'"[^"]*"|\\.|_.|\[(?!hh?\]|mm?\]|ss?\])[^\]]*\]', "", codes.get(number, "").split(";")[0]).lower()
        if number in DATE_FORMATS or re.search("[dmhys]", code.replace("general", "")):
            found[at] = number == 46 or bool(re.search(r"\[(h|m|s)+\]", code))
    return found


def _moment_text(serial: str, epoch: dt.datetime, elapsed: bool) -> str:
    """A serial number as ISO date and time, as a time of day below one, or as elapsed time."""
    days = float(serial)
    span = dt.timedelta(milliseconds=round(days * 86_400_000))
    if elapsed:
        return str(span)
    if 0 <= days < 1 and epoch == EPOCH:
        return (dt.datetime.min + span).time().isoformat()
    # the calendar of 1900 has a 29 February that never was
    return (epoch + span + dt.timedelta(days=1 if epoch == EPOCH and 1 <= days < 60 else 0)).isoformat()


#: Rows of a sheet that are handed on at once, and shared strings of one Arrow array.
SHEET_ROWS, STRINGS_AT_ONCE = 5_000, 50_000


def _elements(stream: IO[bytes], tag: str) -> Iterator[ElementTree.Element]:
    """Elements of a name as they are read; each is dropped, with all before it, once the next one is asked for."""
    path: list[ElementTree.Element] = []
    for event, element in ElementTree.iterparse(stream, events=("start", "end")):
        if event == "start":
            path.append(element)
            continue
        path.pop()
        if element.tag == tag:
            yield element
            if path:
                path[-1].clear()


class _Strings:
    """Shared strings of a workbook in Arrow arrays: no Python object for each."""

    def __init__(self, stream: IO[bytes], main: str):
        self.arrays: list[pa.Array] = []
        held: list[str] = []
        for item in _elements(stream, f"{main}si"):
            held.append("".join(t.text or "" for t in item.iter(f"{main}t")))
            if len(held) == STRINGS_AT_ONCE:
                self.arrays.append(pa.array(held, pa.string()))
                held = []
        self.arrays.append(pa.array(held, pa.string()))

    def __getitem__(self, i: int) -> str:
        return self.arrays[i // STRINGS_AT_ONCE][i % STRINGS_AT_ONCE].as_py()


def _sheet_rows(data: bytes) -> Iterator[tuple[str, int, list[str | None]]]:
    """(sheet, row number, cells) of a workbook's filled rows: cached values, merged cells in their first place only, dates as ISO text.

    Sheets are read as streams: what is held is one row and the shared strings.
    """
    main = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    link = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        names = set(book.namelist())
        shared = None
        if "xl/sharedStrings.xml" in names:
            with book.open("xl/sharedStrings.xml") as stream:
                shared = _Strings(stream, main)
        targets = {r.get("Id"): r.get("Target", "") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        outline = ElementTree.fromstring(book.read("xl/workbook.xml"))
        epoch = EPOCH_1904 if any(p.get("date1904") in ("1", "true") for p in outline.iter(f"{main}workbookPr")) else EPOCH
        dates = _date_styles(book, main)
        for sheet in outline.iter(f"{main}sheet"):
            target = targets[sheet.get(link)].lstrip("/")
            with book.open(target if target.startswith("xl/") else f"xl/{target}") as stream:
                for number, row in enumerate(_elements(stream, f"{main}row"), 1):
                    cells: list[str | None] = []
                    for cell in row.iter(f"{main}c"):
                        letters = re.match("[A-Z]+", cell.get("r") or "")
                        at = sum((ord(ch) - 64) * 26**i for i, ch in enumerate(reversed(letters[0]))) - 1 if letters else len(cells)
                        cells += [None] * (at + 1 - len(cells))
                        kind, value = cell.get("t"), cell.findtext(f"{main}v")
                        if kind == "s" and value is not None:
                            value = shared[int(value)]
                        elif kind == "inlineStr":
                            value = "".join(t.text or "" for t in cell.iter(f"{main}t"))
                        elif kind == "b" and value is not None:
                            value = "true" if value == "1" else "false"
                        elif kind in (None, "n") and value and int(cell.get("s") or 0) in dates:
                            value = _moment_text(value, epoch, dates[int(cell.get("s") or 0)])
                        cells[at] = value or None
                    if any(cells):
                        yield sheet.get("name") or "", int(row.get("r") or number), cells


def workbook_rows(books: DataFrame) -> DataFrame:
    """(file, sheet, row_no, cells) of all sheets of ``books`` (path, content), in parallel, some thousand rows at a time.

    A file that turns out unreadable gives a row with a null sheet, perhaps after some rows that are not to be used.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(FILE, pa.string()), ("sheet", pa.string()), ("row_no", pa.int64()), ("cells", pa.list_(pa.string()))])
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                row = lambda sheet, number, cells, path=path: {FILE: path, "sheet": sheet, "row_no": number, "cells": cells}
                try:
                    found = _sheet_rows(content.as_py())
                    while part := [row(*r) for r in itertools.islice(found, SHEET_ROWS)]:
                        yield pa.RecordBatch.from_pylist(part, schema)
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError, IndexError, ValueError, OverflowError, TypeError):
                    yield pa.RecordBatch.from_pylist([row(None, 0, [])], schema)

    return books.select(F.regexp_replace("path", "^(?:[a-z0-9]+:)?/*", ""), "content").mapInArrow(run, f"{FILE} string, sheet string, row_no long, cells array<string>")


def read_workbooks(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The rows of workbook files."""
    return workbook_rows(spark.read.format("binaryFile").load(paths))


def sheet_headers(workbooks: DataFrame) -> DataFrame:
    """(file, sheet, header_row, names): the first filled row of each sheet."""
    return workbooks.where("sheet IS NOT NULL").groupBy(FILE, "sheet").agg(F.min("row_no").alias("header_row"), F.min_by("cells", "row_no").alias("names"))


def sheet_table(workbooks: DataFrame, path: str, sheet: str, header_row: int, names: list[str | None]) -> DataFrame:
    """One sheet's rows below its header as text columns."""
    rows = workbooks.where((F.col(FILE) == path) & (F.col("sheet") == sheet) & (F.col("row_no") > header_row))
    cells = [filled(F.get("cells", i)).alias(c) for i, c in enumerate(clean_names(names))]
    return rows.select(*cells, FILE, F.col("row_no").alias(ORDINAL))

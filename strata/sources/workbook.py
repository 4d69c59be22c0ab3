"""Report workbook (.xlsx) and HTML-table (.xls) readers (SRC-05, SRC-06).

Both produce a *long* all-text form first - one row per sheet row with
``cells array<string>`` - because every file may carry a different header;
``promote_header`` then turns it into named all-text columns, unioned by name
across files (a diagonal concat). Files are listed and read by Spark's
``binaryFile`` source, on whatever storage the path names, and parsed inside
the tasks; a file is known by its whole path, so equal names in two folders
stay two files."""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from html.parser import HTMLParser
from itertools import islice
from xml.etree import ElementTree as ET

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..functions.core import as_col
from .files import LOCK_PREFIX

LONG_SCHEMA = "source_path string, source_name string, mtime timestamp, row_no int, cells array<string>, error string"
#: Sheet rows that are handed on at once.
BATCH_ROWS = 20_000
#: Letters of an HTML file that are parsed at once.
PART_CHARS = 1 << 16

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
# Built-in number formats that show dates or times.
_DATE_FORMATS = {*range(14, 23), *range(45, 48)}


def _col_index(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    """Cell styles whose number format shows a date or a time."""
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ET.fromstring(z.read("xl/styles.xml"))
    dated = set(_DATE_FORMATS)
    for f in root.iter(f"{{{_NS['m']}}}numFmt"):
        code = re.sub(r'"[^"]*"|\\.|\[(?!h+\]|m+\]|s+\])[^\]]*\]', "", f.get("formatCode") or "")
        if re.search(r"[ymdhs]", code, re.IGNORECASE) and not re.search(r"General", code, re.IGNORECASE):
            dated.add(int(f.get("numFmtId")))
    styles = root.find("m:cellXfs", _NS)
    return {i for i, x in enumerate(styles if styles is not None else []) if int(x.get("numFmtId") or 0) in dated}


def serial_text(text: str, base: dt.datetime) -> str:
    """A day serial as ISO text: date, date and time, or (below one day) time; other text as it is."""
    try:
        days = float(text)
        at = base + dt.timedelta(seconds=round(days * 86400))
    except (ValueError, OverflowError):
        return text
    if 0 <= days < 1:
        return at.strftime("%H:%M:%S")
    return at.strftime("%Y-%m-%d" if at.time() == dt.time() else "%Y-%m-%d %H:%M:%S")


def xlsx_rows(data: bytes, sheet: int = 0):
    """Rows of one worksheet as lists of text: shared and inline strings, numbers as written, cells with a date
    format as ISO dates and times. Standard library only; the sheet is read row by row."""
    z = zipfile.ZipFile(io.BytesIO(data))
    names = z.namelist()
    shared = []
    if "xl/sharedStrings.xml" in names:
        root = ET.fromstring(z.read("xl/sharedStrings.xml"))
        for si in root.findall("m:si", _NS):
            shared.append("".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")))
    dated, base = _date_styles(z), dt.datetime(1899, 12, 30)
    if "xl/workbook.xml" in names:
        props = ET.fromstring(z.read("xl/workbook.xml")).find("m:workbookPr", _NS)
        if props is not None and props.get("date1904") in ("1", "true"):
            base = dt.datetime(1904, 1, 1)
    sheets = sorted(n for n in names if re.match(r"xl/worksheets/sheet\d+\.xml$", n))
    sheets.sort(key=lambda n: int(re.search(r"(\d+)", n.rsplit("/", 1)[1]).group(1)))
    with z.open(sheets[sheet]) as xml:
        for _, row in ET.iterparse(xml):
            if row.tag != f"{{{_NS['m']}}}row":
                continue
            vals: dict[int, str] = {}
            for cell in row.findall("m:c", _NS):
                ref, typ = cell.get("r"), cell.get("t")
                v = cell.find("m:v", _NS)
                if typ == "s" and v is not None:
                    text = shared[int(v.text)]
                elif typ == "inlineStr":
                    text = "".join(t.text or "" for t in cell.iter(f"{{{_NS['m']}}}t"))
                else:
                    text = v.text if v is not None else None
                    if text is not None and typ in (None, "n") and int(cell.get("s") or 0) in dated:
                        text = serial_text(text, base)
                vals[_col_index(ref) if ref else len(vals)] = text
            row.clear()
            if vals:
                yield [vals.get(i) for i in range(max(vals) + 1)]


def _parse_workbooks(sheet: int):
    """binaryFile rows -> sheet rows; an unreadable file becomes one row that says why."""
    names = ["source_path", "source_name", "mtime", "row_no", "cells", "error"]

    def parse(batches):
        for batch in batches:
            kinds = [batch.schema.field("path").type, pa.string(), batch.schema.field("modificationTime").type, pa.int32(), pa.list_(pa.string()), pa.string()]
            for k in range(len(batch)):
                path, name, mtime = batch["path"][k], batch["name"][k].as_py(), batch["modificationTime"][k]

                def rows(first, cells, error=None):
                    n = len(cells)
                    cols = [[path.as_py()] * n, [name] * n, [mtime.value] * n, list(range(first, first + n)), cells, [error] * n]
                    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, kinds)], names)

                at, part = 0, []
                try:
                    for cells in xlsx_rows(batch["content"][k].as_py(), sheet):
                        part.append(cells)
                        if len(part) == BATCH_ROWS:
                            yield rows(at, part)
                            at, part = at + len(part), []
                    yield rows(at, part)
                except Exception as e:  # noqa: BLE001 - an unreadable file is reported, not fatal
                    yield rows(-1, [None], f"{type(e).__name__}: {e}")

    return parse


def read_workbooks(spark: SparkSession, path: str, sheet: int = 0, exclude: tuple[str, ...] = (), only: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """SRC-05: (rows, errors) of all workbooks of a folder (or of a path pattern) on any storage that Spark reads, but
    lock files, those whose name holds one of ``exclude`` and, with ``only`` (path), those that are not in it. ``rows``
    has named all-text columns plus ``Source.Name`` and ``Fecha_Modificacion_Archivo``; unreadable files are in
    ``errors`` (source_name, error), with none of their rows among ``rows``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path)
    files = files.withColumn("name", F.regexp_extract("path", r"([^/\\]+)$", 1)).filter(~F.startswith(F.col("name"), F.lit(LOCK_PREFIX)))
    for e in exclude:
        files = files.filter(~F.contains(F.lower("name"), F.lit(e.lower())))
    if only is not None:
        files = files.join(only, "path", "left_semi")
    long = files.select("path", "name", "modificationTime", "content").mapInArrow(_parse_workbooks(sheet), LONG_SCHEMA)
    errors = long.filter(F.col("error").isNotNull()).select("source_path", "source_name", "error")
    rows = long.filter(F.col("error").isNull()).join(errors.select("source_path"), "source_path", "left_anti")
    return promote_header(rows), errors.select("source_name", "error")


class _TableParser(HTMLParser):
    def __init__(self):
        super().__init__()
        self.rows, self._row, self._cell, self._in_table = [], None, None, 0

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self._in_table += 1
        elif tag == "tr" and self._in_table:
            self._row = []
        elif tag in ("td", "th") and self._row is not None:
            self._cell = []

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self._row is not None and self._cell is not None:
            self._row.append(" ".join("".join(self._cell).split()))
            self._cell = None
        elif tag == "tr" and self._row is not None:
            if any(v.strip() for v in self._row):
                self.rows.append(self._row)
            self._row = None
        elif tag == "table" and self._in_table:
            self._in_table -= 1

    def handle_data(self, data):
        if self._cell is not None:
            self._cell.append(data)


def _table_rows(text: str):
    """The rows one after the other; the text is read in parts that end at a tag, so that rows do not pile up."""
    p, at = _TableParser(), 0
    while at < len(text):
        to = text.find(">", at + PART_CHARS) + 1 or len(text)
        p.feed(text[at:to])
        at = to
        yield from p.rows
        p.rows.clear()


def html_table_rows(text: str) -> list[list[str]]:
    return list(_table_rows(text))


def html_tables(df: DataFrame, name_col: str, content_col: str, encoding: str = "latin-1") -> DataFrame:
    """SRC-06: HTML tables (reports exported as ``.xls``) -> long rows. Input is
    any DataFrame of (name, content) - ``binaryFile`` rows or a text column. A worker holds one file and
    ``BATCH_ROWS`` of its rows."""
    names, kinds = ["source_name", "row_no", "cells"], [pa.string(), pa.int32(), pa.list_(pa.string())]

    def parse(batches):
        for batch in batches:
            for k in range(len(batch)):
                name, content = batch["source_name"][k].as_py(), batch["content"][k].as_py()
                text = content.decode(encoding, errors="replace") if isinstance(content, (bytes, bytearray)) else (content or "")
                del content
                rows = _table_rows(text)
                at = 0
                while part := list(islice(rows, BATCH_ROWS)):
                    n = len(part)
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(([name] * n, range(at, at + n), part), kinds)], names)
                    at += n

    src = df.select(F.col(name_col).cast("string").alias("source_name"), F.col(content_col).alias("content"))
    return src.mapInArrow(parse, "source_name string, row_no int, cells array<string>")


def comma_number(col) -> Column:
    """SRC-06: a number written with decimal comma and thousands dots; NULL for any other text."""
    x = F.trim(as_col(col))
    plain = F.replace(F.replace(x, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(x.rlike(r"^[+-]?(\d{1,3}(\.\d{3})+|\d+)(,\d+)?$"), plain.try_cast("double"))


def header_names(raw: list[str | None]) -> list[str]:
    """Blank header -> ``Col_i`` (i = position); a name that an earlier column has, whatever its case, gets ``_i``, again
    until it is new."""
    out: list[str] = []
    seen: set[str] = set()
    for i, h in enumerate(raw):
        h = (h or "").strip() or f"Col_{i}"
        while h.lower() in seen:
            h = f"{h}_{i}"
        seen.add(h.lower())
        out.append(h)
    return out


@F.pandas_udf(ArrayType(StringType()))
def _unique_headers(raw: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else header_names(list(x)) for x in raw])


def promote_header(long: DataFrame, drop_placeholders: bool = True) -> DataFrame:
    """First row of each file = header. Every other row becomes a map
    header -> cell (ragged rows padded/truncated to the header width); the
    union of header names (a small distinct set, read once on the driver to
    build the column list) becomes all-text columns; ``Col_*``/``Unnamed``
    placeholders are dropped. Files are told apart by ``source_path``, where there is one."""
    key = "source_path" if "source_path" in long.columns else "source_name"
    headers = long.filter(F.col("row_no") == 0).select(key, _unique_headers("cells").alias("__h"))
    body = long.filter(F.col("row_no") > 0).join(headers, key)
    n = F.size("__h")
    padded = F.slice(F.concat("cells", F.array_repeat(F.lit(None).cast("string"), n)), 1, n)
    body = body.withColumn("__m", F.map_from_arrays("__h", padded))
    names = sorted({h for r in headers.select(F.explode("__h").alias("h")).distinct().collect() for h in [r.h]})
    if drop_placeholders:
        names = [h for h in names if not re.match(r"^(Col_\d+|Unnamed.*)$", h)]
    # Spark column names are case-insensitive: spellings differing only by case
    # (``Id`` / ``ID`` across files) become one column, first spelling in sort order.
    groups: dict[str, list[str]] = {}
    for h in names:
        groups.setdefault(h.lower(), []).append(h)
    cols = [(F.coalesce(*[F.col("__m").getItem(h) for h in spellings]) if len(spellings) > 1
             else F.col("__m").getItem(spellings[0])).alias(spellings[0]) for spellings in groups.values()]
    extra = [F.col("source_name").alias("Source.Name")]
    if "mtime" in long.columns:
        extra.append(F.col("mtime").alias("Fecha_Modificacion_Archivo"))
    return body.select(*cols, *extra)

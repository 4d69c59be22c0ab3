"""Workbooks made from the given tables: what the reader's proofs and tests read back."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame

_MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def workbook(header: list[str], rows: list[list]) -> bytes:
    """A workbook of one sheet: text, numbers, and ("date", day serial) cells with a date format."""
    def cell(column: int, line: int, value) -> str:
        ref = f"{chr(65 + column)}{line}"
        if value is None:
            return ""
        if isinstance(value, tuple):
            return f'<c r="{ref}" s="1"><v>{value[1]}</v></c>'
        if isinstance(value, (int, float)):
            return f'<c r="{ref}"><v>{value}</v></c>'
        return f'<c r="{ref}" t="inlineStr"><is><t>{escape(str(value))}</t></is></c>'

    lines = "".join(f'<row r="{i}">{"".join(cell(j, i, v) for j, v in enumerate(r))}</row>' for i, r in enumerate([header, *rows], start=1))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", "<Types/>")
        z.writestr("xl/styles.xml", f'<styleSheet {_MAIN}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {_MAIN}><sheetData>{lines}</sheetData></worksheet>")
    return out.getvalue()


def write_workbooks(df: DataFrame, by: str, header: list[str], dates: tuple[str, ...], folder: str) -> None:
    """One workbook ``folder/{by}.xlsx`` for each value of ``by`` (a path below the folder), written by the tasks into
    the shared folder."""
    names = list(header)
    folder = folder.removeprefix("file://").removeprefix("file:")

    def write(group):
        import os

        import pandas as pd

        path = f"{folder}/{group[by].iloc[0]}.xlsx"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        own = group.sort_values(names[0])
        rows = [[None if v is None or v != v else ("date", v) if n in dates and isinstance(v, (int, float)) else v for n, v in zip(names, r)]
                for r in own[names].itertuples(index=False, name=None)]
        with open(path, "wb") as f:
            f.write(workbook(names, rows))
        return pd.DataFrame({"n": [len(rows)]})

    df.groupBy(by).applyInPandas(write, "n long").write.format("noop").mode("overwrite").save()

"""Workbook (.xlsx) collections as a Spark Python data source (S3, K3).

Reading: one partition per workbook file, so a folder or glob of workbooks is
read in parallel; cells are parsed from the zip's XML parts with the standard
library and typed afterwards by the same one-aggregate inference as CSV.
Writing: every task writes its partition as one workbook ``part-NNNNN.xlsx``
(inline strings, one sheet), guarded by the sheet row limit.

Paths must be visible to every executor (a shared mount).  Cell styles are
not interpreted: a date cell reads as its serial number.
"""

from __future__ import annotations

import glob
import os
import re
import uuid
import zipfile
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter,
                                    InputPartition, WriterCommitMessage)

from ..errors import SourceError
from .files import Destination, Source, _typed, infer_types

# Namespaces of the SpreadsheetML parts.
NS_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
NS_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
NS_PKG_REL = "http://schemas.openxmlformats.org/package/2006/relationships"
MAX_SHEET_ROWS = 1_048_576

_N = {"m": NS_MAIN}


def local_path(path: str) -> str:
    """Filesystem path of a ``file:`` URI (workbooks are read and written with
    Python file I/O, so they need a path every executor mounts)."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    if "://" in path:
        raise SourceError(f"workbooks need a locally mounted shared path, got {path}")
    return path


def _files(path: str) -> list[str]:
    path = local_path(path)
    if os.path.isdir(path):
        return sorted(glob.glob(os.path.join(path, "*.xlsx")))
    return sorted(glob.glob(path))


def _col_index(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _sheet_part(z: zipfile.ZipFile, sheet) -> str:
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    sheets = wb.findall("m:sheets/m:sheet", _N)
    if isinstance(sheet, int):
        if sheet >= len(sheets):
            raise SourceError(f"sheet index {sheet} out of range")
        el = sheets[sheet]
    else:
        found = [s for s in sheets if s.get("name") == sheet]
        if not found:
            raise SourceError(f"sheet {sheet!r} not found")
        el = found[0]
    rid = el.get(f"{{{NS_REL}}}id")
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    for r in rels:
        if r.get("Id") == rid:
            target = r.get("Target").lstrip("/")
            return target if target.startswith("xl/") else "xl/" + target
    raise SourceError("broken workbook relationships")


def read_rows(path: str, sheet=0):
    """Yield every row of one sheet as a list of strings (None for empty)."""
    with zipfile.ZipFile(path) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            for si in ET.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _N):
                shared.append("".join(t.text or "" for t in si.iter(f"{{{NS_MAIN}}}t")))
        part, seen = _sheet_part(z, sheet), 0
        with z.open(part) as fh:
            for _, row in ET.iterparse(fh):
                if row.tag != f"{{{NS_MAIN}}}row":
                    continue
                # rows without any cell may be left out of the file
                number = int(row.get("r") or seen + 1)
                for _ in range(number - seen - 1):
                    yield []
                seen = number
                cells = {}
                for c in row.findall("m:c", _N):
                    t = c.get("t")
                    v = c.find("m:v", _N)
                    if t == "inlineStr":
                        val = "".join(x.text or "" for x in c.iter(f"{{{NS_MAIN}}}t"))
                    elif v is None:
                        val = None
                    elif t == "s":
                        val = shared[int(v.text)]
                    elif t == "b":
                        val = "True" if v.text == "1" else "False"
                    else:
                        val = v.text
                        if val is not None and val.endswith(".0") and re.fullmatch(r"-?\d+\.0", val):
                            val = val[:-2]
                    cells[_col_index(c.get("r"))] = val
                row.clear()
                width = max(cells) + 1 if cells else 0
                yield [cells.get(i) for i in range(width)]


def header_names(cells: list) -> list[str]:
    return [str(h) if h is not None else f"_c{i}" for i, h in enumerate(cells)]


class _FilePartition(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, files, sheet, names):
        self.files, self.sheet, self.names = files, sheet, names

    def partitions(self):
        return [_FilePartition(f) for f in self.files]

    def read(self, partition):
        rows = read_rows(partition.path, self.sheet)
        header = header_names(next(rows, []))
        if sorted(header) != sorted(self.names):
            raise SourceError(f"{partition.path}: columns {header} differ from {self.names}")
        at = [header.index(n) for n in self.names]        # other files may order them otherwise
        for r in rows:
            if any(v not in (None, "") for v in r[len(header):]):
                raise SourceError(f"{partition.path}: a row has more cells than the header")
            r = r + [None] * (len(header) - len(r))
            yield tuple(r[i] for i in at)


class _Commit(WriterCommitMessage):
    def __init__(self, file: str):
        self.file = file


class _Writer(DataSourceWriter):
    def __init__(self, path, sheet, names, overwrite):
        self.path, self.sheet, self.names, self.overwrite = path, sheet, names, overwrite
        self.job = uuid.uuid4().hex[:8]

    def write(self, iterator):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        os.makedirs(self.path, exist_ok=True)
        out = os.path.join(self.path, f"part-{pid:05d}-{self.job}.xlsx")
        write_workbook(out, self.sheet, self.names, iterator)
        return _Commit(out)

    def commit(self, messages):
        if self.overwrite:
            keep = {m.file for m in messages if m is not None}
            for f in glob.glob(os.path.join(self.path, "part-*.xlsx")):
                if f not in keep:
                    os.remove(f)


class WorkbookDataSource(DataSource):
    """``format("workbook")``; options ``path``, ``sheet`` (name or index)."""

    @classmethod
    def name(cls):
        return "workbook"

    def _sheet(self):
        s = self.options.get("sheet", "0")
        return int(s) if str(s).isdigit() else s

    def schema(self):
        files = _files(self.options["path"])
        if not files:
            raise SourceError(f"File not found: {self.options['path']}")
        header = next(read_rows(files[0], self._sheet()), [])
        return T.StructType([T.StructField(h, T.StringType()) for h in header_names(header)])

    def reader(self, schema):
        return _Reader(_files(self.options["path"]), self._sheet(), [f.name for f in schema.fields])

    def writer(self, schema, overwrite):
        return _Writer(local_path(self.options["path"]), self.options.get("sheet", "Sheet1"),
                       [f.name for f in schema.fields], overwrite)


def _cell(ref: str, v) -> str:
    if v is None:
        return ""
    if isinstance(v, bool):
        return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (int, float)):
        return f'<c r="{ref}"><v>{v!r}</v></c>'
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'


def _letters(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def write_workbook(out: str, sheet: str, names: list[str], rows) -> None:
    """Stream rows into a one-sheet workbook."""
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml",
                   '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
                   '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
                   '<Default Extension="xml" ContentType="application/xml"/>'
                   '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
                   '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
                   '</Types>')
        z.writestr("_rels/.rels",
                   f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{NS_PKG_REL}">'
                   '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>'
                   '</Relationships>')
        z.writestr("xl/workbook.xml",
                   f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{NS_MAIN}" xmlns:r="{NS_REL}">'
                   f'<sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{NS_PKG_REL}">'
                   '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/>'
                   '</Relationships>')
        with z.open("xl/worksheets/sheet1.xml", "w") as fh:
            fh.write(f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{NS_MAIN}"><sheetData>'
                     .encode())
            letters = [_letters(i) for i in range(len(names))]
            fh.write(("<row r=\"1\">" + "".join(_cell(f"{letters[i]}1", n) for i, n in enumerate(names))
                      + "</row>").encode())
            r = 1
            for row in rows:
                r += 1
                if r > MAX_SHEET_ROWS:
                    raise ValueError(f"more than {MAX_SHEET_ROWS} rows in one sheet; repartition first")
                fh.write((f'<row r="{r}">' + "".join(_cell(f"{letters[i]}{r}", v)
                                                     for i, v in enumerate(row)) + "</row>").encode())
            fh.write(b"</sheetData></worksheet>")


def register(spark: SparkSession) -> None:
    from ..session import ship_package

    ship_package(spark)
    spark.dataSource.register(WorkbookDataSource)


class ExcelSource(Source):
    """Workbook(s) by sheet name or index (S3); typed like CSV."""

    def __init__(self, path: str, sheet_name=0, schema_overrides: dict[str, str] | None = None):
        self.path, self.sheet, self.overrides = path, sheet_name, schema_overrides

    def extract(self, spark: SparkSession) -> DataFrame:
        if not _files(self.path):
            raise SourceError(f"File not found: {self.path}")
        register(spark)
        raw = spark.read.format("workbook").option("sheet", str(self.sheet)).load(self.path)
        return _typed(infer_types(raw, exclude=set(self.overrides or ())), self.overrides)


class ExcelDestination(Destination):
    """One workbook per partition under ``path`` (K3)."""

    def __init__(self, path: str, sheet_name: str = "Sheet1", mode: str = "overwrite"):
        self.path, self.sheet, self.mode = path, sheet_name, mode

    def save(self, df: DataFrame) -> None:
        from ..errors import DestinationError
        try:
            register(df.sparkSession)
            df.write.format("workbook").mode(self.mode).option("sheet", self.sheet).save(self.path)
        except Exception as e:
            raise DestinationError(f"Could not write {self.path}: {str(e).splitlines()[0]}") from e

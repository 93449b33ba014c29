"""Workbooks (zipped XML sheets): written by tasks with a commit, read by ranges of their sheets' rows."""

from __future__ import annotations

import posixpath
import re
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

from pyarrow import fs as files
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from docketlake.places import place_of
from docketlake.session import ship
from docketlake.sources.case_files import _StagedWriter

#: Rows that a sheet has at most, its header among them; further ones go into another workbook.
MOST_ROWS = 1_048_576
#: Bytes of a sheet's XML, unpacked, that one task reads rows from.
RANGE_BYTES = 64 << 20
CHUNK = 1 << 20

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006"
HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_ROW = re.compile(rb"<(?:[A-Za-z_][\w.-]*:)?row[\s/>]")
_NOT_XML = re.compile(r"[\x00-\x08\x0b-\x1f￾￿]|_(?=x[0-9A-Fa-f]{4}_)")
_ESCAPED = re.compile(r"_x([0-9A-Fa-f]{4})_")


def column_name(i: int) -> str:
    """A, B, … Z, AA, …"""
    out = ""
    while i >= 0:
        out, i = chr(65 + i % 26) + out, i // 26 - 1
    return out


def column_number(reference: str) -> int:
    n = 0
    for c in reference:
        if not c.isalpha():
            break
        n = 26 * n + ord(c.upper()) - 64
    return n - 1


def _xml_text(value: str) -> str:
    """What XML cannot hold, and what would look like its escape, as the format has it: ``_xHHHH_``."""
    return escape(_NOT_XML.sub(lambda m: f"_x{ord(m[0]):04X}_", value))


def _cell(at: str, value) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{at}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)) and value == value and value not in (float("inf"), float("-inf")):
        return f'<c r="{at}"><v>{value!r}</v></c>'
    return f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{_xml_text(str(value))}</t></is></c>'


class _Forward:
    """A stream that can only be written on, so that archives are written without going back."""

    def __init__(self, stream):
        self.stream = stream

    def write(self, data) -> int:
        self.stream.write(bytes(data))
        return len(data)

    def flush(self) -> None:
        pass


class SheetWriter:
    """One workbook, sheet by sheet and row by row: header in bold, frozen, with a filter; columns as wide as told."""

    def __init__(self, stream, columns: Sequence[str], widths: Sequence[int] = ()):
        self.raw, self.columns, self.widths = stream, list(columns), list(widths)
        self.archive = zipfile.ZipFile(_Forward(stream), "w", zipfile.ZIP_DEFLATED)
        self.sheets: list[str] = []
        self.sheet = None
        self.rows = 0

    def _end_sheet(self) -> None:
        if self.sheet is not None:
            last = f"{column_name(len(self.columns) - 1)}{self.rows}"
            self.sheet.write(f'</sheetData><autoFilter ref="A1:{last}"/></worksheet>'.encode())
            self.sheet.close()
            self.sheet = None

    def begin(self, name: str) -> None:
        self._end_sheet()
        self.sheets.append(name)
        self.sheet = self.archive.open(f"xl/worksheets/sheet{len(self.sheets)}.xml", "w", force_zip64=True)
        widths = "".join(f'<col min="{i}" max="{i}" width="{w}" customWidth="1"/>' for i, w in enumerate(self.widths, 1))
        pane = '<sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews>'
        self.sheet.write(f'{HEAD}<worksheet xmlns="{MAIN}">{pane}{f"<cols>{widths}</cols>" if widths else ""}<sheetData>'.encode())
        self.rows = 0
        self.put([tuple(self.columns)], ' s="1"')

    def put(self, rows, style: str = "") -> None:
        out = []
        for row in rows:
            self.rows += 1
            cells = "".join(_cell(f"{column_name(i)}{self.rows}", v) for i, v in enumerate(row))
            out.append(f'<row r="{self.rows}"{style}{" customFormat=" + chr(34) + "1" + chr(34) if style else ""}>{cells}</row>')
        self.sheet.write("".join(out).encode("utf-8", "replace"))

    def close(self) -> None:
        self._end_sheet()
        names = "".join(f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(self.sheets, 1))
        links = "".join(f'<Relationship Id="rId{i}" Type="{RELATIONS}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(self.sheets) + 1))
        styles = f'<Relationship Id="rId{len(self.sheets) + 1}" Type="{RELATIONS}/styles" Target="styles.xml"/>'
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in range(1, len(self.sheets) + 1))
        defaults = '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
        fonts = '<fonts count="2"><font/><font><b/></font></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>'
        for name, text in {
            "xl/workbook.xml": f'<workbook xmlns="{MAIN}" xmlns:r="{RELATIONS}"><sheets>{names}</sheets></workbook>',
            "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{PACKAGE}/relationships">{links}{styles}</Relationships>',
            "xl/styles.xml": f'<styleSheet xmlns="{MAIN}">{fonts}<cellXfs count="2"><xf/><xf fontId="1" applyFont="1"/></cellXfs></styleSheet>',
            "_rels/.rels": f'<Relationships xmlns="{PACKAGE}/relationships"><Relationship Id="rId1" Type="{RELATIONS}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
            "[Content_Types].xml": f'<Types xmlns="{PACKAGE}/content-types">{defaults}<Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/>{parts}</Types>',
        }.items():
            self.archive.writestr(name, HEAD + text)
        self.archive.close()
        self.raw.close()


class _WorkbookWriter(_StagedWriter):
    """A workbook for each value of ``_file``, in it a sheet for each of ``_sheet``; rows come sorted by both."""

    def __init__(self, path: str, columns: list[str], widths: list[int]):
        super().__init__(path)
        self.columns, self.widths = columns, widths

    def fill(self, folder, iterator):
        rows: dict[str, int] = {}
        book, key, more = None, None, 0
        try:
            for batch in iterator:
                held = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in self.columns]
                keys = list(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("_file", "_sheet")), strict=True))
                start = 0
                while start < len(keys):
                    if book is not None and (keys[start][0] != key[0] or book.rows >= MOST_ROWS):
                        book.close()
                        more = more + 1 if keys[start][0] == key[0] else 0
                        book = None
                    if book is None:
                        name = f"{keys[start][0]}{f'.part{more}' if more else ''}.xlsx"
                        book, rows[name] = SheetWriter(folder.open(name), self.columns, self.widths), 0
                        book.begin(keys[start][1])
                    elif keys[start][1] != key[1]:
                        book.begin(keys[start][1])
                    key, end = keys[start], start + 1
                    while end < len(keys) and keys[end] == key and end - start < MOST_ROWS - book.rows:
                        end += 1
                    book.put(zip(*(c[start:end] for c in held), strict=True))
                    rows[name] += end - start
                    start = end
        finally:
            if book is not None:
                book.close()
        return rows

    def named(self, done):
        """``X.xlsx`` where one task has all rows of X, else ``X.1.xlsx`` and so on, by partition."""
        tasks: dict[str, int] = {}
        for attempt in done:
            for name in attempt.rows:
                tasks[name] = tasks.get(name, 0) + 1
        seen: dict[str, int] = {}
        for attempt in done:
            for name in attempt.rows:
                seen[name] = seen.get(name, 0) + 1
                yield attempt, name, name if tasks[name] == 1 else f"{name.removesuffix('.xlsx')}.{seen[name]}.xlsx"


# Reading.


@dataclass
class Range(InputPartition):
    """Rows of one sheet that begin in so many bytes of its XML."""

    file: str
    part: str
    low: int
    high: int


class _Seekable:
    """A file of any file system as archives want to read it."""

    def __init__(self, path: str):
        system, self.root = place_of(path)
        self.stream = system.open_input_file(self.root)

    def __enter__(self):
        return zipfile.ZipFile(self.stream)

    def __exit__(self, *_):
        self.stream.close()


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def sheets_of(archive: zipfile.ZipFile) -> list[tuple[str, str]]:
    """Names and parts of the sheets of a workbook, in order."""
    base, root = "xl/", ElementTree.fromstring(archive.read("xl/workbook.xml"))
    links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(archive.read("xl/_rels/workbook.xml.rels"))}
    out = []
    for sheet in (e for e in root.iter() if _local(e.tag) == "sheet"):
        target = links[next(v for k, v in sheet.attrib.items() if _local(k) == "id" and k.startswith("{"))]
        out.append((sheet.get("name"), target.lstrip("/") if target.startswith("/") else base + target))
    return out


def _shared(archive: zipfile.ZipFile) -> list[str]:
    """The workbook's table of shared strings, in which its cells may have numbers."""
    if "xl/sharedStrings.xml" not in archive.namelist():
        return []
    out = []
    with archive.open("xl/sharedStrings.xml") as stream:
        for _, element in ElementTree.iterparse(stream):
            if _local(element.tag) == "si":
                out.append(_unescaped("".join(t.text or "" for t in element.iter() if _local(t.tag) == "t")))
                element.clear()
    return out


def _unescaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: chr(int(m[1], 16)), text)


def _row_elements(archive: zipfile.ZipFile, part: str, low: int, high: int) -> Iterator[ElementTree.Element]:
    """The rows of a sheet whose tags begin at ``low`` or later, before ``high``, of its unpacked bytes."""
    with archive.open(part) as stream:
        head, parser = b"", ElementTree.XMLPullParser(["end"])
        while not (first := _ROW.search(head)):
            if not (more := stream.read(CHUNK)):
                return
            head += more
        parser.feed(head[: first.start()])
        held, at = head[first.start() :], first.start()
        while at < low:
            # Skips to the first row from ``low`` on, with what may be the beginning of a tag kept.
            found = _ROW.search(held, max(0, low - at))
            if found:
                held, at = held[found.start() :], at + found.start()
                break
            kept = max(0, min(len(held), max(len(held) - 64, low - at)))
            held, at = held[kept:], at + kept
            if not (more := stream.read(CHUNK)):
                return
            held += more
        depth_rows = 0
        while True:
            end = len(held)
            for tag in _ROW.finditer(held):
                if at + tag.start() >= high:
                    end = tag.start()
                    break
            final = end < len(held)
            # The last bytes may be the beginning of the tag of a row that is another task's.
            safe = end if final else max(0, end - 64)
            parser.feed(held[:safe])
            held, at = held[safe:], at + safe
            for _, element in parser.read_events():
                if _local(element.tag) == "row":
                    depth_rows += 1
                    yield element
                    element.clear()
            if final:
                return
            if not (more := stream.read(CHUNK)):
                stop = next((t.start() for t in _ROW.finditer(held) if at + t.start() >= high), len(held))
                parser.feed(held[:stop])
                for _, element in parser.read_events():
                    if _local(element.tag) == "row":
                        yield element
                return
            held += more


def _values(row: ElementTree.Element, shared: list[str]) -> dict[int, str | None]:
    """The texts of a row's cells by column."""
    out: dict[int, str | None] = {}
    at = -1
    for cell in (c for c in row if _local(c.tag) == "c"):
        at = column_number(cell.get("r")) if cell.get("r") else at + 1
        kind = cell.get("t", "n")
        if kind == "inlineStr":
            out[at] = _unescaped("".join(t.text or "" for t in cell.iter() if _local(t.tag) == "t"))
            continue
        value = next((v.text or "" for v in cell if _local(v.tag) == "v"), None)
        if value is not None and kind == "s":
            value = shared[int(value)]
        elif value is not None and kind == "b":
            value = "true" if value.strip() == "1" else "false"
        elif value is not None and kind == "str":
            value = _unescaped(value)
        out[at] = value
    return out


def _workbooks(path: str) -> list[str]:
    system, root = place_of(path)
    info = system.get_file_info(root)
    prefix = path[: len(path) - len(root)] if path.endswith(root) else ""
    if info.type == files.FileType.File:
        return [path]
    found = system.get_file_info(files.FileSelector(root))
    return sorted(prefix + f.path for f in found if f.base_name.endswith(".xlsx") and not f.base_name.startswith(("_", ".", "~")))


def _chosen(archive: zipfile.ZipFile, sheet: str | None) -> str:
    """SRC-2: the part of the named sheet, or of the first one where there is none of that name."""
    sheets = sheets_of(archive)
    return next((part for name, part in sheets if name == sheet), sheets[0][1])


def _header(archive: zipfile.ZipFile, part: str, shared: list[str]) -> dict[str, int]:
    """The column of each label of the first row; of labels that repeat the first, blank ones left out."""
    row = next(_row_elements(archive, part, 0, 1 << 62), None)
    found: dict[str, int] = {}
    for i, label in sorted(_values(row, shared).items()) if row is not None else ():
        if label is not None and label.strip():
            found.setdefault(label.strip(), i)
    return found


class _WorkbookReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, sheet: str | None, range_bytes: int):
        self.path, self.columns, self.sheet, self.range_bytes = path, schema.names, sheet, range_bytes

    def partitions(self):
        """Each chosen sheet in ranges of its unpacked size."""
        out = []
        for file in _workbooks(self.path):
            with _Seekable(file) as archive:
                part = _chosen(archive, self.sheet)
                size = archive.getinfo(part).file_size
            out += [Range(file, part, low, min(low + self.range_bytes, size)) for low in range(0, max(size, 1), self.range_bytes)]
        return out or [None]

    def read(self, partition):
        if partition is None:
            return
        with _Seekable(partition.file) as archive:
            shared = _shared(archive)
            place = _header(archive, partition.part, shared)
            wanted = [place.get(c) for c in self.columns]
            first = next(_row_elements(archive, partition.part, 0, 1 << 62), None)
            head = None if first is None else first.get("r", "1")
            for number, row in enumerate(_row_elements(archive, partition.part, partition.low, partition.high)):
                if row.get("r", None) == head if row.get("r") else not number and not partition.low:
                    continue
                values = _values(row, shared)
                if any(v not in (None, "") for v in values.values()):
                    yield tuple(None if i is None else values.get(i) for i in wanted)


class Workbook(DataSource):
    """``format("workbook")``: options ``path``, ``sheet`` (a name), ``rangeBytes``; for writing ``columns`` and ``widths``."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> T.StructType:
        """Text columns by the header of the first workbook."""
        for file in _workbooks(self.options["path"]):
            with _Seekable(file) as archive:
                part = _chosen(archive, self.options.get("sheet"))
                return T.StructType([T.StructField(c, T.StringType()) for c in _header(archive, part, _shared(archive))])
        raise ValueError(f"no workbook in {self.options['path']}")

    def reader(self, schema):
        return _WorkbookReader(self.options["path"], schema, self.options.get("sheet"), int(self.options.get("rangeBytes", str(RANGE_BYTES))))

    def writer(self, schema, overwrite: bool):
        widths = [int(w) for w in self.options["widths"].split(",")] if self.options.get("widths") else []
        return _WorkbookWriter(self.options["path"], self.options["columns"].split("\n"), widths)


def write_workbooks(df: DataFrame, path: str, columns: Sequence[str], by: str | None = None, sheet: str | None = None, widths: Sequence[int] = ()) -> None:
    """SNK-2, SNK-5: workbooks in ``path``, one for each value of ``by`` (else ``part``), in each a sheet for each value of ``sheet``.

    Numbers and truth values are written as such, all else as text, null as no cell. Rows of one workbook that several tasks
    have, or that do not fit a sheet, go into numbered ones. No rows make no file.
    """
    ship(df.sparkSession)
    df.sparkSession.dataSource.register(Workbook)
    plain = (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DoubleType, T.BooleanType)
    as_is = lambda c: F.col(f"`{c}`") if isinstance(df.schema[c].dataType, plain) else F.col(f"`{c}`").cast("string")
    file = F.coalesce(F.col(f"`{by}`").cast("string"), F.lit("unnamed")) if by else F.lit("part")
    tab = F.coalesce(F.col(f"`{sheet}`").cast("string"), F.lit("Sheet1")) if sheet else F.lit("Sheet1")
    rows = df.select(*[as_is(c).alias(c) for c in columns], file.alias("_file"), tab.alias("_sheet")).sortWithinPartitions("_file", "_sheet")
    rows.write.format("workbook").option("columns", "\n".join(columns)).option("widths", ",".join(map(str, widths))).mode("append").save(path)


def read_workbooks(spark: SparkSession, path: str, sheet: str | None = None, schema: str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """SRC-2: the rows of a workbook, or of all in a folder, as text by the labels of each one's first row.

    The named sheet, or the first where a workbook has none of that name. Rows without a value are left out. A sheet is read
    by several tasks where it is long; each unpacks it up to its own rows.
    """
    ship(spark)
    spark.dataSource.register(Workbook)
    reader = spark.read.format("workbook").option("rangeBytes", str(range_bytes))
    if sheet:
        reader = reader.option("sheet", sheet)
    return (reader.schema(schema) if schema else reader).load(path)

"""Files with names of their own: one CSV for each court, one text file for each link. Staged by tasks, named at commit.

Each task attempt writes into a folder of its own below ``_staging-…``. The driver's commit gives final names to the files of
those attempts that succeeded, and to no others; abort takes all of them away. So a failed, repeated or speculative
task leaves nothing that counts, and readers, which skip names that begin with an underscore, never see a half-written
file. Only tasks that still run when a job is aborted may leave a staging folder; ``sweep`` removes such folders.
"""

from __future__ import annotations

import csv
import io
import posixpath
import uuid
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyarrow import fs as files
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from docketlake.places import place_of
from docketlake.session import ship

BOM = "﻿"
#: Renames at a time, where a commit has many files.
RENAMES = 32


@dataclass
class Attempt(WriterCommitMessage):
    """What a task has staged: the folder of its attempt, and rows by file name."""

    folder: str
    partition: int
    rows: dict[str, int]


@dataclass
class _Folder:
    """An attempt's folder, made when its first file is."""

    system: files.FileSystem
    path: str

    def open(self, name: str):
        self.system.create_dir(self.path)
        return self.system.open_output_stream(posixpath.join(self.path, name))


def _remove(system: files.FileSystem, folder: str) -> None:
    if system.get_file_info(folder).type == files.FileType.Directory:
        system.delete_dir(folder)


class _StagedWriter(DataSourceArrowWriter):
    """Attempt folders, commit and abort; subclasses write an attempt's files."""

    def __init__(self, path: str):
        self.path = path
        self.staging = f"_staging-{uuid.uuid4().hex}"

    def write(self, iterator) -> Attempt:
        context = TaskContext.get()
        system, root = place_of(self.path)
        folder = posixpath.join(self.staging, f"{context.partitionId()}-{context.taskAttemptId()}")
        target = posixpath.join(root, folder)
        try:
            return Attempt(folder, context.partitionId(), self.fill(_Folder(system, target), iterator))
        except BaseException:
            _remove(system, target)
            raise

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, root = place_of(self.path)
        done = sorted((m for m in messages if isinstance(m, Attempt)), key=lambda m: m.partition)
        moves = [(posixpath.join(root, m.folder, name), posixpath.join(root, final)) for m, name, final in self.named(done)]
        taken = [target for target, n in Counter(t for _, t in moves).items() if n > 1]
        if taken:
            self.abort(messages)
            raise ValueError(f"{len(taken)} files are written by more than one row, {posixpath.basename(taken[0])} among them")
        with ThreadPoolExecutor(RENAMES) as pool:
            list(pool.map(lambda move: system.move(*move), moves))
        self._sweep()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._sweep()

    def _sweep(self) -> None:
        system, root = place_of(self.path)
        _remove(system, posixpath.join(root, self.staging))

    def fill(self, folder: _Folder, iterator) -> dict[str, int]:
        raise NotImplementedError

    def named(self, done: list[Attempt]):
        """Attempt, staged name and final name of each file."""
        for attempt in done:
            for name in attempt.rows:
                yield attempt, name, name


class _CsvWriter(_StagedWriter):
    def __init__(self, path: str, columns: list[str], by: str, prefix: str):
        super().__init__(path)
        self.columns, self.by, self.prefix = columns, by, prefix

    def fill(self, folder, iterator):
        """A file for each value of ``by``; rows come sorted by it, so one is open at a time."""
        rows: dict[str, int] = {}
        stream = name = None
        try:
            for batch in iterator:
                held = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in self.columns]
                keys = batch.column(batch.schema.get_field_index(self.by)).to_pylist()
                start = 0
                for i in range(1, len(keys) + 1):
                    if i < len(keys) and keys[i] == keys[start]:
                        continue
                    file = f"{self.prefix}{keys[start] or 'unnamed'}.csv"
                    text = io.StringIO()
                    lines = csv.writer(text, lineterminator="\r\n")
                    if file != name:
                        if stream is not None:
                            stream.close()
                        name, stream = file, folder.open(file)
                        text.write(BOM)
                        lines.writerow(self.columns)
                    lines.writerows(zip(*(c[start:i] for c in held), strict=True))
                    stream.write(text.getvalue().encode())
                    rows[file] = rows.get(file, 0) + i - start
                    start = i
        finally:
            if stream is not None:
                stream.close()
        return rows

    def named(self, done):
        """``cases_output_X.csv`` where one task has all rows of X, else ``cases_output_X.1.csv`` and so on, by partition."""
        tasks = Counter(name for attempt in done for name in attempt.rows)
        seen: Counter[str] = Counter()
        for attempt in done:
            for name in attempt.rows:
                seen[name] += 1
                yield attempt, name, name if tasks[name] == 1 else f"{name.removesuffix('.csv')}.{seen[name]}.csv"


class _TextWriter(_StagedWriter):
    def fill(self, folder, iterator):
        rows: dict[str, int] = {}
        for batch in iterator:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not name or "/" in name:
                    raise ValueError(f"{name!r} is no file name")
                if name in rows:
                    raise ValueError(f"{name} is written by more than one row")
                with folder.open(name) as stream:
                    stream.write((text or "").encode())
                rows[name] = 1
        return rows


class CaseCsv(DataSource):
    """``format("case_csv")``: options ``path``, ``by`` (column that names the file), ``prefix``, ``columns`` (comma-separated)."""

    @classmethod
    def name(cls) -> str:
        return "case_csv"

    def writer(self, schema, overwrite: bool) -> _CsvWriter:
        o = self.options
        return _CsvWriter(o["path"], o["columns"].split(","), o["by"], o.get("prefix", ""))


class NamedTexts(DataSource):
    """``format("named_texts")``: option ``path``; rows ``name, text``, each a file."""

    @classmethod
    def name(cls) -> str:
        return "named_texts"

    def writer(self, schema, overwrite: bool) -> _TextWriter:
        return _TextWriter(self.options["path"])


def write_case_csv(df: DataFrame, path: str, by: str, columns: list[str], prefix: str = "cases_output_") -> None:
    """SNK-1: ``<prefix><value of by>.csv`` in ``path``: UTF-8 with a byte order mark, CRLF, the fields in this order.

    No rows make no file. Values are written as text, null as an empty field. A value of ``by`` whose rows several tasks
    have gets a numbered file from each, so no court is collected into one task; a null one is called ``unnamed``.
    """
    ship(df.sparkSession)
    df.sparkSession.dataSource.register(CaseCsv)
    name = F.col(f"`{by}`").cast("string")
    rows = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in dict.fromkeys(columns)], name.alias("_file")).sortWithinPartitions("_file")
    rows.write.format("case_csv").option("by", "_file").option("prefix", prefix).option("columns", ",".join(columns)).mode("append").save(path)


def write_texts(df: DataFrame, path: str, name: str, text: str) -> None:
    """SNK-9, SNK-12: one file ``name`` in ``path`` for each row, which must have a name of its own; null text is empty."""
    ship(df.sparkSession)
    df.sparkSession.dataSource.register(NamedTexts)
    df.select(F.col(name).cast("string").alias("name"), F.col(text).cast("string").alias("text")).write.format("named_texts").mode("append").save(path)


def sweep(path: str) -> int:
    """Removes the staging folders in ``path``, of which no write may be going on; their number."""
    system, root = place_of(path)
    left = [f for f in system.get_file_info(files.FileSelector(root)) if f.base_name.startswith("_staging-")]
    for folder in left:
        system.delete_dir(folder.path)
    return len(left)

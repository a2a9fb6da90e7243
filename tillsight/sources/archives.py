"""Zip archives landed in a drop folder -> CSV records."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RECORD_SCHEMA = "archive string, entry string, record_no long, fields array<string>"
MEMBER_FORMAT = "zip_members"
CHUNK_RECORDS = 5_000
CHUNK_CHARS = 4 << 20


def _glob_literal(text: str) -> str:
    return "".join(f"[{ch}]" if ch in "*?[]{}\\" else ch for ch in text)


def list_drop_files(spark: SparkSession, path: str, keyword: str, day: dt.date | str | None = None) -> DataFrame:
    """Files under ``path`` whose name contains ``keyword`` and that were
    modified on ``day`` (default: today; midnight belongs to the day it opens),
    with their bytes (P21)."""
    day = dt.date.fromisoformat(str(day)) if day is not None else dt.date.today()
    files = (spark.read.format("binaryFile").option("pathGlobFilter", f"*{_glob_literal(keyword)}*").load(path))
    return files.where((F.col("modificationTime") >= F.lit(f"{day}").cast("timestamp"))
                       & (F.col("modificationTime") < F.lit(f"{day + dt.timedelta(days=1)}").cast("timestamp")))


def _record_reader(sep: str, encoding: str):
    """A function that reads members of an open archive as bounded Arrow batches; it travels with its task."""
    max_records, max_chars = CHUNK_RECORDS, CHUNK_CHARS

    def records(archive, path, members):
        import csv

        import pyarrow as pa

        def chunk(rows):
            cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
            kinds = (pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                              ["archive", "entry", "record_no", "fields"])

        csv.field_size_limit(1 << 30)
        rows, chars = [], 0
        for member in members:
            with archive.open(member) as raw, io.TextIOWrapper(raw, encoding=encoding, newline="") as text:
                for n, fields in enumerate(r for r in csv.reader(text, delimiter=sep) if r):
                    rows.append((path, member.filename, n, fields))
                    chars += sum(map(len, fields))
                    if len(rows) >= max_records or chars >= max_chars:
                        yield chunk(rows)
                        rows, chars = [], 0
        yield chunk(rows)

    return records


def _member_source() -> type[DataSource]:
    """The data source behind :func:`unzip_members`; a local class, so that it travels with its tasks."""

    class Seekable(io.RawIOBase):
        """A ``pyarrow`` file as Python's own: a position before its start is an ``OSError``, as ``zipfile`` expects."""

        def __init__(self, file):
            self.file = file

        def readable(self):
            return True

        def seekable(self):
            return True

        def tell(self):
            return self.file.tell()

        def seek(self, at, whence=io.SEEK_SET):
            at += {io.SEEK_SET: 0, io.SEEK_CUR: self.file.tell(), io.SEEK_END: self.file.size()}[whence]
            if at < 0:
                raise OSError("position before the start of the file")
            return self.file.seek(at)

        def readinto(self, buffer):
            return self.file.readinto(buffer)

    @contextlib.contextmanager
    def opened(path):
        import zipfile

        from pyarrow import fs

        scheme, _, rest = path.partition("://") if "://" in path else ("file", "", path.removeprefix("file:"))
        if scheme == "file":
            store, name = fs.LocalFileSystem(), rest
        else:
            host, _, name = rest.partition("/")
            store, root = fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{host}")
            name = f"{root.rstrip('/')}/{name}"
        with store.open_input_file(name) as file, io.BufferedReader(Seekable(file), 1 << 20) as raw, zipfile.ZipFile(raw) as archive:
            yield archive

    class MemberReader(DataSourceReader):
        def __init__(self, options):
            self.paths, self.task_bytes = json.loads(options["paths"]), int(options["taskBytes"])
            self.records = _record_reader(options["sep"], options["encoding"])

        def partitions(self):
            tasks = []
            for path in self.paths:
                held = None
                with opened(path) as archive:
                    for at, member in enumerate(archive.infolist()):
                        if member.is_dir():
                            continue
                        if held is None or held + member.file_size > self.task_bytes:
                            tasks.append((path, []))
                            held = 0
                        tasks[-1][1].append(at)
                        held += member.file_size
            return [InputPartition(task) for task in tasks] or [InputPartition(None)]

        def read(self, partition):
            if partition.value is None:
                return
            path, members = partition.value
            with opened(path) as archive:
                listed = archive.infolist()
                yield from self.records(archive, path, [listed[at] for at in members])

    class MemberSource(DataSource):
        @classmethod
        def name(cls):
            return MEMBER_FORMAT

        def schema(self):
            return RECORD_SCHEMA

        def reader(self, schema):
            return MemberReader(self.options)

    return MemberSource


def unzip_records(files: DataFrame, *, sep: str = ",", encoding: str = "utf-8-sig") -> DataFrame:
    """Every CSV record of every member of every archive as ``(archive, entry,
    record_no, fields)`` (P22).

    One archive is one task's unit of work; its members are streamed, so a task
    holds the archive's bytes and one bounded chunk of records.  Members are kept
    apart by ``entry`` (the original wrote them all to the same file name).
    A quoted field keeps its line breaks, and only CR and LF end a record.
    """

    records = _record_reader(sep, encoding)

    def read(batches):
        import zipfile

        for batch in batches:
            for path, content in zip(*batch.columns, strict=True):
                with zipfile.ZipFile(io.BytesIO(content.as_buffer())) as z:
                    yield from records(z, path.as_py(), [m for m in z.infolist() if not m.is_dir()])

    return files.select("path", "content").mapInArrow(read, RECORD_SCHEMA)


def unzip_members(files: DataFrame, *, sep: str = ",", encoding: str = "utf-8-sig", task_bytes: int = 0) -> DataFrame:
    """The records of :func:`unzip_records`, planned by member instead of by archive.

    The planner reads the directory at the end of each archive and makes one
    partition per member, so a day's single large archive is read by as many
    tasks as it has members, and a retried task repeats its member alone.  A
    task seeks to its member and holds one bounded chunk of records, never the
    archive.  With ``task_bytes``, an archive's members are taken together, in their order,
    while they hold no more bytes than that, unpacked, so that very many tiny ones need few tasks.

    The names of the chosen files and their directories pass through the driver, as in any
    file scan's plan; the contents do not.  Executors open the files by themselves
    (``pyarrow.fs``: local or shared folders, ``hdfs``, ``s3``, ``gs``).  No
    file, or archives without members, give no rows; a file that is no zip archive fails.
    """
    spark = files.sparkSession
    paths = sorted(r.path for r in files.select("path").distinct().collect())
    spark.dataSource.register(_member_source())
    return (spark.read.format(MEMBER_FORMAT).option("paths", json.dumps(paths)).option("sep", sep)
            .option("encoding", encoding).option("taskBytes", str(task_bytes)).load())


def parse_csv(records: DataFrame, schema: T.StructType | str, header: bool = True) -> DataFrame:
    """The records of :func:`unzip_records` with a known schema; a missing,
    empty (but for text) or unparsable field is null."""
    body = records.where(F.col("record_no") > 0) if header else records
    fields = T.StructType.fromDDL(schema).fields if isinstance(schema, str) else schema.fields
    value = [F.try_element_at("fields", F.lit(i + 1)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(fields)]
    return body.select("archive", "entry", *value)

"""Changes handed in through a registered format, ``INSERT INTO`` included.

Tasks write the changes they get, as they are, into files of their own; the
commit lists the files of all tasks in one manifest, and only listed files
count. So a task that failed, was tried again or ran twice leaves nothing, and
neither does a job that was aborted, whose tasks may still run: they look for the
mark of their job before they write and after. Handed-in changes wait in ``inbox/`` until
``DocumentSink.settle`` applies them: one commit is one batch of the collection,
recognised by its name, so settling twice applies it once.

The format only hands changes in. Documents are read through the sink, where
Spark joins base and log; a format in Python could not.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import suppress
from dataclasses import asdict, dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from docsink.functions.names import quote

FORMAT = "docsink"
ROW = "row:"  # column with the place of a row in its task
_WANTED = "_wanted"  # mark in a job's folder, removed first by an abort
_ROW_GROUP = 1 << 17


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return fs.LocalFileSystem(), path


@dataclass
class _Written(WriterCommitMessage):
    """What a task wrote; nothing if it got no rows."""

    task: int
    file: str | None
    rows: int


@dataclass(frozen=True)
class Commit:
    """Changes of one job: files in the order of tasks."""

    name: str
    folder: str
    schema: str
    files: list[str]


class InboxWriter(DataSourceArrowWriter):
    """Writes the rows of a job into ``<collection>/inbox``."""

    def __init__(self, path: str, schema: T.StructType) -> None:
        for field in schema.fields:
            if isinstance(field.dataType, (T.DayTimeIntervalType, T.YearMonthIntervalType, T.VariantType)):
                raise TypeError(f"column {field.name!r}: {field.dataType.simpleString()} cannot be handed in")
        self.inbox = f"{path}/inbox"
        self.folder = f"{self.inbox}/{uuid.uuid4().hex}"
        self.schema = schema.json()
        system, folder = open_path(self.folder)
        system.create_dir(folder, recursive=True)
        with system.open_output_stream(f"{folder}/{_WANTED}"):
            pass

    def _refuse_if_unwanted(self) -> None:
        """A task may outlive its job, which then has removed the mark first and what it found afterwards."""
        system, folder = open_path(self.folder)
        if system.get_file_info(f"{folder}/{_WANTED}").type == fs.FileType.NotFound:
            _delete_folder(system, folder)
            raise RuntimeError("the job of this task was aborted")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, folder = open_path(self.folder)
        context = TaskContext.get()
        # A task that is tried again writes another file.
        name = f"part-{context.partitionId():05d}-{uuid.uuid4().hex}.parquet"
        writer, rows = None, 0
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                place = pa.array(range(rows, rows + batch.num_rows), pa.int64())
                table = pa.Table.from_batches([batch]).append_column(ROW, place)
                if writer is None:
                    self._refuse_if_unwanted()
                    writer = pq.ParquetWriter(f"{folder}/{name}", table.schema, filesystem=system, compression="zstd")
                writer.write_table(table, row_group_size=_ROW_GROUP)
                rows += batch.num_rows
            if writer is not None:
                writer.close()
                # Either the abort finds the file, or the task finds the mark removed.
                self._refuse_if_unwanted()
        except BaseException:
            if writer is not None:
                with suppress(Exception):
                    writer.close()
                with suppress(OSError):
                    system.delete_file(f"{folder}/{name}")
            raise
        return _Written(context.partitionId(), name if rows else None, rows)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        written = sorted((m for m in messages if m is not None and m.file), key=lambda m: m.task)
        if not written:
            self.abort(messages)
            return
        name = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        commit = Commit(name, self.folder, self.schema, [m.file for m in written])
        system, inbox = open_path(f"{self.inbox}/_commits")
        system.create_dir(inbox, recursive=True)
        # Written aside and renamed, so that nobody sees half a list.
        with system.open_output_stream(f"{inbox}/.{name}.tmp") as out:
            out.write(json.dumps(asdict(commit)).encode())
        system.move(f"{inbox}/.{name}.tmp", f"{inbox}/{name}.json")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, folder = open_path(self.folder)
        with suppress(FileNotFoundError):
            system.delete_file(f"{folder}/{_WANTED}")
        _delete_folder(system, folder)


def _delete_folder(system: fs.FileSystem, folder: str) -> None:
    """Also while others delete it, or still write a file into it."""
    for _ in range(20):
        if system.get_file_info(folder).type == fs.FileType.NotFound:
            return
        with suppress(OSError):
            system.delete_dir(folder)
    if system.get_file_info(folder).type != fs.FileType.NotFound:
        system.delete_dir(folder)


class DocsinkFormat(DataSource):
    """``df.write.format("docsink").option("path", <collection>)``; appends only."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        raise ValueError("give the columns of the changes, and read documents through DocumentSink")

    def writer(self, schema: T.StructType, overwrite: bool) -> InboxWriter:
        if overwrite:
            raise ValueError("a collection takes changes: append them")
        path = self.options.get("path")
        if not path:
            raise ValueError("option path: the folder of the collection")
        return InboxWriter(path.rstrip("/"), schema)

    def reader(self, schema: T.StructType):
        raise ValueError("documents are read through DocumentSink.read")


def register_format(spark: SparkSession) -> None:
    """Make ``format("docsink")`` and ``using docsink`` known to a session."""
    spark.dataSource.register(DocsinkFormat)


def create_table(spark: SparkSession, table: str, columns: T.StructType, path: str) -> None:
    """A table for ``INSERT INTO`` whose rows are handed in to the collection at ``path``.

    A session's tables do not pass options on to a format, so the table gets one
    of its own that knows the path.
    """
    format_name = f"{FORMAT}_{uuid.uuid4().hex}"

    class TableFormat(DocsinkFormat):
        @classmethod
        def name(cls) -> str:
            return format_name

        def writer(self, schema: T.StructType, overwrite: bool) -> InboxWriter:
            if overwrite:
                raise ValueError("a collection takes changes: use insert into")
            return InboxWriter(path, schema)

    spark.dataSource.register(TableFormat)
    listed = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in columns.fields)
    spark.sql(f"create table {table} ({listed}) using {format_name}")


def waiting(path: str) -> list[Commit]:
    """Commits that wait at a collection, in the order in which they were made."""
    system, folder = open_path(f"{path}/inbox/_commits")
    if system.get_file_info(folder).type == fs.FileType.NotFound:
        return []
    names = [f.path for f in system.get_file_info(fs.FileSelector(folder)) if f.base_name.endswith(".json")]
    commits = []
    for name in sorted(names, key=lambda n: n.rsplit("/", 1)[-1]):
        with system.open_input_stream(name) as stream:
            commits.append(Commit(**json.loads(stream.read())))
    return commits


def changes_of(spark: SparkSession, commit: Commit) -> DataFrame:
    """The rows of a commit; without ``op`` all are inserts, without ``seq`` they are in the order of tasks and rows."""
    schema = T.StructType.fromJson(json.loads(commit.schema))
    files = [f"{commit.folder}/{name}" for name in commit.files]
    rows = spark.read.schema(schema.add(ROW, "long")).parquet(*files)
    names = [f.name for f in schema.fields]
    if "seq" not in names:
        task = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)-", 1).cast("long")
        rows = rows.withColumn("seq", F.shiftleft(task, 40) + F.col(quote(ROW)))
    if "op" not in names:
        rows = rows.withColumn("op", F.lit("+I"))
    return rows.drop(ROW)


def remove(commit: Commit, path: str) -> None:
    """Forget a commit that has been applied."""
    system, manifest = open_path(f"{path}/inbox/_commits/{commit.name}.json")
    system.delete_file(manifest)
    system, folder = open_path(commit.folder)
    system.delete_dir(folder)

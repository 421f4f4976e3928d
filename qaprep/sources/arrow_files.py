"""Arrow IPC files and streams as a Spark data source: batches are handed over as they are.

A file ends in a table of its batches. A stream has none, but each of its messages says ahead how long it is, so
a scan of the headers alone finds the batches, and several tasks read one stream."""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.ipc as ipc
from pyarrow import fs
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

# With more files than this the footers are left to the tasks, one file per task.
FOOTERS_ON_DRIVER = 1000


def _spark_friendly(kind: pa.DataType) -> pa.DataType:
    """The Arrow type Spark reads this one as."""
    if pa.types.is_uint64(kind):
        return pa.decimal128(20, 0)
    if pa.types.is_unsigned_integer(kind):
        return {8: pa.int16(), 16: pa.int32(), 32: pa.int64()}[kind.bit_width]
    if pa.types.is_string_view(kind) or pa.types.is_large_string(kind):
        return pa.string()
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        return pa.list_(_spark_friendly(kind.value_type))
    return kind


def _target_schema(schema: pa.Schema) -> pa.Schema:
    return pa.schema([pa.field(f.name, _spark_friendly(f.type), True) for f in schema])


def _open_path(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path inside it."""
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


def _files(path: str) -> tuple[fs.FileSystem, list[str]]:
    system, root = _open_path(path)
    info = system.get_file_info(root)
    if info.type == fs.FileType.File:
        return system, [root]
    found = system.get_file_info(fs.FileSelector(root, recursive=True))
    names = [f.path for f in found if f.type == fs.FileType.File and f.path.endswith(".arrow")]
    return system, sorted(n for n in names if not n.rsplit("/", 1)[-1].startswith(("_", ".")))


# Fixed values of the format: what a file begins with, what begins a message, kinds of messages.
FILE_MAGIC, CONTINUATION = b"ARROW1", b"\xff\xff\xff\xff"
DICTIONARY, BATCH = 2, 3


def is_stream(source: pa.NativeFile) -> bool:
    source.seek(0)
    head = source.read(len(FILE_MAGIC))
    source.seek(0)
    return head != FILE_MAGIC


def _message(metadata: bytes) -> tuple[int, int]:
    """Kind and body length of a message, from its FlatBuffers table (fields: version, kind, header, body length)."""
    table = struct.unpack_from("<I", metadata, 0)[0]
    fields = table - struct.unpack_from("<i", metadata, table)[0]
    size = struct.unpack_from("<H", metadata, fields)[0]

    def field(number: int, form: str) -> int:
        at = 4 + 2 * number
        offset = struct.unpack_from("<H", metadata, fields + at)[0] if at < size else 0
        return struct.unpack_from(form, metadata, table + offset)[0] if offset else 0

    return field(1, "<B"), field(3, "<q")


def stream_batches(source: pa.NativeFile) -> list[int] | None:
    """Where the record batches of a stream begin; only the headers are read. None if the stream holds dictionaries,
    which later batches build on: it is read from its beginning then."""
    size, at, found = source.size(), 0, []
    while at + 8 <= size:
        source.seek(at)
        head = source.read(8)
        long = head[:4] == CONTINUATION
        length = struct.unpack("<i", head[4:] if long else head[:4])[0]  # without the mark: a stream of the older form
        if length == 0:
            break
        begin = at + (8 if long else 4)
        source.seek(begin)
        kind, body = _message(source.read(length))
        if kind == DICTIONARY:
            return None
        if kind == BATCH:
            found.append(at)
        at = begin + length + body
    return found


@dataclass
class BatchRange(InputPartition):
    """Record batches of one file or stream: from number ``first`` to before ``stop``, None meaning to the end. For a
    stream, ``places`` are the positions of these batches."""

    file: str
    first: int
    stop: int | None
    places: tuple[int, ...] | None

    def __init__(self, file: str, first: int, stop: int | None, places: tuple[int, ...] | None = None):
        super().__init__((file, first, stop, places))
        self.file, self.first, self.stop, self.places = file, first, stop, places


class ArrowReader(DataSourceReader):
    def __init__(self, path: str, per_split: int):
        self.path, self.per_split = path, per_split

    def _ranges(self, system: fs.FileSystem, name: str) -> list[BatchRange]:
        with system.open_input_file(name) as source:
            places = None
            if is_stream(source):
                places = stream_batches(source)
                if places is None:
                    return [BatchRange(name, 0, None)]
                total = len(places)
            else:
                total = ipc.open_file(source).num_record_batches
        steps = [(i, min(i + self.per_split, total)) for i in range(0, total, self.per_split)]
        return [BatchRange(name, i, j, None if places is None else tuple(places[i:j])) for i, j in steps]

    def partitions(self) -> list[BatchRange]:
        system, names = _files(self.path)
        if len(names) > FOOTERS_ON_DRIVER:
            return [BatchRange(n, 0, None) for n in names]
        ranges = [r for n in names for r in self._ranges(system, n)]
        return ranges or [BatchRange(n, 0, 0) for n in names[:1]]  # Spark wants one, even of nothing

    def read(self, partition: BatchRange) -> Iterator[pa.RecordBatch]:
        system, _ = _open_path(self.path)
        with system.open_input_file(partition.file) as source:
            for batch in self._batches(source, partition):
                target = _target_schema(batch.schema)
                yield from pa.Table.from_batches([batch]).cast(target).to_batches()

    def _batches(self, source: pa.NativeFile, partition: BatchRange) -> Iterator[pa.RecordBatch]:
        if not is_stream(source):
            reader = ipc.open_file(source)
            stop = reader.num_record_batches if partition.stop is None else partition.stop
            yield from (reader.get_batch(i) for i in range(partition.first, stop))
        elif partition.places is None:
            yield from ipc.open_stream(source)
        else:
            schema = ipc.open_stream(source).schema
            for place in partition.places:
                source.seek(place)
                yield ipc.read_record_batch(ipc.read_message(source), schema)


class ArrowWriter(DataSourceArrowWriter):
    """One file per task. A file gets its final name when the job commits, so what a lost or
    repeated task leaves behind is never read."""

    def __init__(self, path: str, schema: StructType, stream: bool):
        self.path, self.schema, self.stream = path, schema, stream

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, root = _open_path(self.path)
        system.create_dir(root, recursive=True)
        name = f"{root}/_attempt-{uuid.uuid4().hex}.arrow"
        schema = to_arrow_schema(self.schema)
        with system.open_output_stream(name) as sink:
            opened = ipc.new_stream(sink, schema) if self.stream else ipc.new_file(sink, schema)
            with opened as writer:
                for batch in iterator:
                    writer.write_table(pa.Table.from_batches([batch]).cast(schema))
        message = WriterCommitMessage()
        message.name = name
        return message

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """Names carry the job, so that a second write into the folder adds to the first."""
        system, root = _open_path(self.path)
        job = uuid.uuid4().hex
        written = [m.name for m in messages if m is not None]
        for number, name in enumerate(written):
            system.move(name, f"{root}/part-{job}-{number:05d}.arrow")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Unfinished files keep their hidden name and are never read."""


class ArrowFiles(DataSource):
    """``spark.read.format("arrow_files").load(path)`` and the writer of the same name."""

    @classmethod
    def name(cls) -> str:
        return "arrow_files"

    def schema(self) -> StructType:
        system, names = _files(self.options["path"])
        if not names:
            raise ValueError(f"no .arrow file in {self.options['path']}")
        with system.open_input_file(names[0]) as source:
            opened = ipc.open_stream(source) if is_stream(source) else ipc.open_file(source)
            return from_arrow_schema(_target_schema(opened.schema))

    def reader(self, schema: StructType) -> ArrowReader:
        return ArrowReader(self.options["path"], int(self.options.get("batches_per_split", 64)))

    def writer(self, schema: StructType, overwrite: bool) -> ArrowWriter:
        return ArrowWriter(self.options["path"], schema, self.options.get("ipc", "file") == "stream")

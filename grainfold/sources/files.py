"""Python data sources: whole files from rows, and array files (.npy) read in ranges of rows.

Register them with ``register(spark)``; paths may lie in any store that pyarrow opens by its address.
"""

from __future__ import annotations

import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

#: Bytes of an array file that one partition reads, one batch holds, and one written file has at most.
RANGE_BYTES, BATCH_BYTES, FILE_BYTES = 64 << 20, 4 << 20, 64 << 20


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it; ``file:/x`` is taken as ``/x``."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


@dataclass
class ArrayHeader:
    """Where the rows of an array file begin, how many there are, their width and the type of their values."""

    begin: int
    rows: int
    width: int
    kind: str


def read_header(file) -> ArrayHeader:
    """Header of a .npy file: one- or two-dimensional, in C order. Arrays of one dimension have rows of one value."""
    version = np.lib.format.read_magic(file)
    shape, fortran, kind = np.lib.format.read_array_header_1_0(file) if version == (1, 0) else np.lib.format.read_array_header_2_0(file)
    if kind.hasobject or (fortran and len(shape) > 1) or not 1 <= len(shape) <= 2:
        raise ValueError(f"arrays of {shape}, {kind}{', Fortran order' if fortran else ''} aren't read as rows")
    return ArrayHeader(file.tell(), shape[0], shape[1] if len(shape) == 2 else 1, kind.str)


@dataclass
class ArrayRange(InputPartition):
    path: str
    first: int
    rows: int
    header: ArrayHeader

    def __init__(self, path: str, first: int, rows: int, header: ArrayHeader):
        self.path, self.first, self.rows, self.header = path, first, rows, header


class ArrayReader(DataSourceReader):
    def __init__(self, path: str, range_bytes: int):
        self.path, self.range_bytes = path, range_bytes

    def partitions(self) -> list[InputPartition]:
        """Ranges of rows of every file: only headers are read here."""
        store, path = _open(self.path)
        info = store.get_file_info(path)
        found = [info] if info.is_file else store.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
        parts: list[InputPartition] = []
        for one in sorted(found, key=lambda f: f.path):
            if not one.is_file or not one.path.endswith(".npy"):
                continue
            with store.open_input_file(one.path) as file:
                header = read_header(file)
            step = max(1, self.range_bytes // max(1, header.width * np.dtype(header.kind).itemsize))
            parts += [ArrayRange(one.path, at, min(step, header.rows - at), header) for at in range(0, header.rows, step)]
        return parts or [ArrayRange("", 0, 0, ArrayHeader(0, 0, 1, "<f8"))]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        part, kind = partition, np.dtype(partition.header.kind)
        size = part.header.width * kind.itemsize
        if not part.rows:
            return
        store, _ = _open(self.path)
        with store.open_input_file(part.path) as file:
            step = max(1, BATCH_BYTES // max(1, size))
            for at in range(part.first, part.first + part.rows, step):
                n = min(step, part.first + part.rows - at)
                file.seek(part.header.begin + at * size)
                values = np.frombuffer(file.read(n * size), kind).astype(np.float64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * part.header.width), pa.array(values))
                yield pa.RecordBatch.from_arrays([pa.array([part.path.rsplit("/", 1)[-1]] * n), pa.array(np.arange(at, at + n)), lists], ["file", "row", "values"])


class ArrayFiles(DataSource):
    """``spark.read.format("npy").load(path)``: (file, row, values) of the .npy files in a folder, or of one.

    A large file is read by several tasks, each a range of its rows (option ``rangeBytes``).
    """

    @classmethod
    def name(cls) -> str:
        return "npy"

    def schema(self) -> str:
        return "file string, row long, values array<double>"

    def reader(self, schema: StructType) -> DataSourceReader:
        return ArrayReader(self.options["path"], int(self.options.get("rangebytes", RANGE_BYTES)))


@dataclass
class Written(WriterCommitMessage):
    """Where a task's list of (held, name) lies; the names themselves, however many, don't pass through the driver's memory together."""

    names: str


class FileWriter(DataSourceArrowWriter):
    """Files get their names when the whole job has ended; a failed job leaves no more than a temporary folder."""

    def __init__(self, path: str):
        self.path = path
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, path = _open(self.path)
        folder, task = f"{path}/_temporary/{self.job}", uuid.uuid4().hex
        store.create_dir(folder, recursive=True)
        n = 0
        with store.open_output_stream(f"{folder}/{task}.names") as names:
            for batch in iterator:
                for name, content in zip(batch.column("name").to_pylist(), batch.column("content")):
                    held = f"{folder}/{task}-{n}"
                    with store.open_output_stream(held) as out:
                        out.write(content.as_buffer())
                    names.write(json.dumps([held, name]).encode() + b"\n")
                    n += 1
        return Written(f"{folder}/{task}.names")

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, path = _open(self.path)
        folder = None
        for message in messages:
            if not message:
                continue
            with store.open_input_stream(message.names) as names:
                for line in io.TextIOWrapper(names, "utf-8"):
                    held, name = json.loads(line)
                    name = f"{path}/{name}"
                    if folder != name.rsplit("/", 1)[0]:
                        folder = name.rsplit("/", 1)[0]
                        store.create_dir(folder, recursive=True)
                    store.move(held, name)
        self._clear(store, path)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear(*_open(self.path))

    def _clear(self, store: fs.FileSystem, path: str) -> None:
        if store.get_file_info(f"{path}/_temporary").type != fs.FileType.NotFound:
            store.delete_dir(f"{path}/_temporary")


class WholeFiles(DataSource):
    """``df.write.format("files").mode("append").save(path)``: every row of (name, content) as a file ``path/name``."""

    @classmethod
    def name(cls) -> str:
        return "files"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return FileWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    for source in (ArrayFiles, WholeFiles):
        spark.dataSource.register(source)


def read_arrays(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, row, values) of the .npy files below a path."""
    register(spark)
    return spark.read.format("npy").option("rangeBytes", range_bytes).load(path)


def write_files(files: DataFrame, path: str) -> None:
    """Each row of (name, content) as a file; names may hold folders."""
    register(files.sparkSession)
    files.select("name", "content").write.format("files").mode("append").save(path)


def write_arrays(df: DataFrame, values: str, path: str) -> None:
    """Arrays of equal length as .npy files of at most ``FILE_BYTES``, one or more per task."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            file = io.BytesIO()
            np.save(file, np.concatenate(held))
            return pa.RecordBatch.from_arrays([pa.array([f"part-{uuid.uuid4().hex}.npy"]), pa.array([file.getvalue()], pa.binary())], ["name", "content"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1))
                if sum(x.nbytes for x in held) >= FILE_BYTES:
                    yield out()
                    held = []
        if held:
            yield out()

    write_files(df.selectExpr(f"CAST(`{values}` AS array<double>) AS v").mapInArrow(pack, "name string, content binary"), path)

"""Delimited text files as a data source that knows each file as a whole.

What belongs to a file (its code page, its head rows, its first line) can't be told from a split of it. This source deals
files, small ones packed together, to tasks; a task streams each of its files twice, once to see whether all of it is
UTF-8, once to read it, so its memory holds a chunk and never a file. Paths are those the Arrow file systems open
(local and shared folders, object stores, HDFS).
"""

from __future__ import annotations

import codecs
import csv
import fnmatch
import io
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "file string, encoding string, row_no bigint, cells array<string>, line string"
PACK_BYTES = 128 << 20
CHUNK = 1 << 20
BATCH_ROWS = 4096


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:/") else (pafs.LocalFileSystem(), path)


class Lines:
    """Physical lines of a decoded stream; remembers those that the reader took since it was last asked."""

    def __init__(self, stream: io.TextIOBase):
        self.stream, self.taken = stream, []

    def __iter__(self):
        return self

    def __next__(self) -> str:
        line = self.stream.readline()
        if not line:
            raise StopIteration
        self.taken.append(line)
        return line

    def since(self) -> str:
        text, self.taken = "".join(self.taken), []
        return text.rstrip("\r\n")


class DelimitedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.glob = options.get("glob", "*")
        self.encodings = options.get("encodings", "utf-8").split(",")
        self.separator = options.get("sep", ",")

    def partitions(self) -> list[InputPartition]:
        system, root = opened(self.path)
        if system.get_file_info(root).type == pafs.FileType.File:
            return [Files([root])]
        found = system.get_file_info(pafs.FileSelector(root, recursive=True))
        files = [f for f in found if f.type == pafs.FileType.File and not f.base_name.startswith(("_", ".")) and fnmatch.fnmatch(f.base_name, self.glob)]
        packs, room = [], 0
        for f in sorted(files, key=lambda f: f.path):
            if room < f.size or not packs:
                packs.append([])
                room = PACK_BYTES
            packs[-1].append(f.path)
            room -= f.size
        return [Files(p) for p in packs] or [Files([])]

    def encoding(self, system: pafs.FileSystem, path: str) -> str:
        """The first code page in which all of the file can be read; the last one if none."""
        for name in self.encodings[:-1]:
            decoder = codecs.getincrementaldecoder(name)()
            try:
                with system.open_input_stream(path) as stream:
                    while chunk := stream.read(CHUNK):
                        decoder.decode(chunk)
                    decoder.decode(b"", final=True)
                return name
            except UnicodeDecodeError:
                continue
        return self.encodings[-1]

    def rows(self, system: pafs.FileSystem, path: str) -> Iterator[tuple]:
        name = self.encoding(system, path)
        stream = io.BufferedReader(system.open_input_stream(path), CHUNK)
        text = io.TextIOWrapper(stream, encoding="utf-8-sig" if name == "utf-8" else name, errors="replace", newline="")
        with text:
            lines = Lines(text)
            for n, cells in enumerate(csv.reader(lines, delimiter=self.separator)):
                yield path, name, n, cells, lines.since()

    def read(self, partition: Files):
        csv.field_size_limit(1 << 30)
        schema = pa.schema([("file", pa.string()), ("encoding", pa.string()), ("row_no", pa.int64()), ("cells", pa.list_(pa.string())), ("line", pa.string())])
        held = []
        for path in partition.paths:
            system, _ = opened(self.path)
            for row in self.rows(system, path):
                held.append(row)
                if len(held) == BATCH_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
                    held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


class DelimitedFiles(DataSource):
    """``spark.read.format("delimited_files")``: one row per record, with its file, its number in the file and its cells."""

    @classmethod
    def name(cls) -> str:
        return "delimited_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DelimitedReader:
        return DelimitedReader(dict(self.options))


def records(spark: SparkSession, path: str, glob: str = "*", encodings: tuple[str, ...] = ("utf-8",), sep: str = ",") -> DataFrame:
    """(file, encoding, row_no, cells, line) of all files below a path whose names match ``glob``."""
    spark.dataSource.register(DelimitedFiles)
    return spark.read.format("delimited_files").options(glob=glob, encodings=",".join(encodings), sep=sep).load(path)

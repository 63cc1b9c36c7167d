"""A stream source that reads Parquet chunks in micro-batches of a fixed number of rows.

An offset is a chunk and a number of rows of it: all chunks before it, by name, and that many of its rows have been read.
A batch is the next `rows` rows of one chunk, or what is left of it, so a large chunk gives many batches and an empty one
none. A micro-batch of the engine is one batch, or with `batches` up to that many of one chunk at once: the engine needs
about half a second for each micro-batch, whatever it holds, so small batches of large chunks are worked off together.
With `number` the rows say which batch they are of: the schema's column of that name holds the batch's first row in its
chunk, counted from 0. Tasks read row groups: a micro-batch is planned from the footer and touches only the groups it
overlaps, in up to `PARTS` partitions. One that failed is planned from the same offsets again and reads exactly the same
rows.

The engine asks a Python source for its newest offset without saying where it stands. The source keeps that position in
a file under `progress` (beside the checkpoint, in a folder of the stream's own): it is written when a batch is planned,
which the engine does after it has logged the batch, and again when it repeats one.

    spark.dataSource.register(RowBatches)
    spark.readStream.format("row_batches").schema(...).option("rows", 20000).option("progress", ...).load("/chunks")

Chunks are reached through Arrow's file systems (local, HDFS, S3, GCS), with a folder or a URI as path.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import importable

ROWS = 20_000
PARTS = 32  # partitions of a micro-batch
START = {"chunk": "", "row": 0}


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def chunks(path: str) -> list[str]:
    """Names of the Parquet files under a folder, relative to it, in order; hidden ones are passed over."""
    system, root = _open(path)
    found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    names = [f.path[len(root) :].strip("/") for f in found if f.type == fs.FileType.File]
    return sorted(n for n in names if n.endswith(".parquet") and not any(p[:1] in "._" for p in n.split("/")))


class Rows(InputPartition):
    """Rows `first` up to `last` of a chunk, in neighbouring row groups of which the first begins at row `at`.

    `start` is the row at which the micro-batch begins."""

    def __init__(self, chunk: str, groups: list[int], at: int, first: int, last: int, start: int) -> None:
        self.chunk, self.groups, self.at, self.first, self.last, self.start = chunk, groups, at, first, last, start


class RowBatchReader(DataSourceStreamReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]) -> None:
        self.schema, self.path = schema, options["path"]
        self.rows, self.batches = int(options.get("rows", ROWS)), int(options.get("batches", 1))
        self.number = options.get("number")
        self.progress = options["progress"]
        if self.rows < 1 or self.batches < 1:
            raise ValueError("a batch needs at least one row, a micro-batch one batch")
        if self.number and self.number not in schema.names:
            raise ValueError(f"no column {self.number!r} to number batches in")
        self.sizes: dict[str, list[int]] = {}

    def initialOffset(self) -> dict:  # noqa: N802
        return dict(START)

    def latestOffset(self) -> dict:  # noqa: N802
        """The end of the next batches: `batches` times `rows` rows on from where the stream stands, within one chunk."""
        at = self._position()
        names = [n for n in chunks(self.path) if n >= at["chunk"]]
        for name in names:
            done = at["row"] if name == at["chunk"] else 0
            left = sum(self._groups(name)) - done
            if left:
                return {"chunk": name, "row": done + min(left, self.batches * self.rows)}
        return at

    def partitions(self, start: dict, end: dict) -> list[Rows]:
        self._write(end)
        first = start["row"] if start["chunk"] == end["chunk"] else 0
        share = max(-(-(end["row"] - first) // PARTS), 1)
        out, at = [], 0
        for group, size in enumerate(self._groups(end["chunk"]) if end["chunk"] else []):
            low, high = max(first, at), min(end["row"], at + size)
            if low < high:
                if out and (low - first) // share == (out[-1].first - first) // share:
                    out[-1].groups.append(group)
                    out[-1].last = high
                else:
                    out.append(Rows(end["chunk"], [group], at, low, high, first))
            at += size
        return out

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        wanted = to_arrow_schema(self.schema)
        system, root = _open(self.path)
        with system.open_input_file(f"{root}/{partition.chunk}") as file:
            chunk = pq.ParquetFile(file)
            names = [n for n in wanted.names if n in chunk.schema_arrow.names and n != self.number]
            at = partition.at
            for batch in chunk.iter_batches(batch_size=8192, row_groups=partition.groups, columns=names):
                low, high = max(partition.first - at, 0), min(partition.last - at, batch.num_rows)
                if low < high:
                    part = batch.slice(low, high - low)
                    yield pa.RecordBatch.from_arrays([self._column(part, f, names, at + low, partition.start) for f in wanted], schema=wanted)
                at += batch.num_rows

    def _column(self, part: pa.RecordBatch, field: pa.Field, names: list[str], at: int, start: int) -> pa.Array:
        if field.name == self.number:
            row = np.arange(at, at + part.num_rows)
            return pa.array(row - (row - start) % self.rows).cast(field.type)
        return part.column(field.name).cast(field.type) if field.name in names else pa.nulls(part.num_rows, field.type)

    def commit(self, end: dict) -> None:
        pass

    def _groups(self, name: str) -> list[int]:
        """Rows in each row group of a chunk, from its footer."""
        if name not in self.sizes:
            system, root = _open(self.path)
            with system.open_input_file(f"{root}/{name}") as file:
                meta = pq.ParquetFile(file).metadata
                self.sizes = {name: [meta.row_group(i).num_rows for i in range(meta.num_row_groups)]}
        return self.sizes[name]

    def _position(self) -> dict:
        system, root = _open(self.progress)
        if system.get_file_info(f"{root}/position.json").type != fs.FileType.File:
            return dict(START)
        with system.open_input_stream(f"{root}/position.json") as file:
            return json.loads(file.read())

    def _write(self, end: dict) -> None:
        system, root = _open(self.progress)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/position.next") as file:
            file.write(json.dumps(end).encode())
        system.move(f"{root}/position.next", f"{root}/position.json")


class RowBatches(DataSource):
    @classmethod
    def name(cls) -> str:
        return "row_batches"

    def schema(self) -> str:
        raise ValueError("give the schema of the chunks")

    def streamReader(self, schema: T.StructType) -> RowBatchReader:  # noqa: N802
        return RowBatchReader(schema, self.options)


def read_row_batches(
    spark: SparkSession, path: str, schema: T.StructType, progress: str, rows: int = ROWS, batches: int = 1, number: str | None = None
) -> DataFrame:
    """Stream of the chunks under `path`, oldest name first, `rows` rows a batch. Columns a chunk lacks are null.

    A micro-batch holds up to `batches` batches of one chunk; `number` names the column of the schema that tells them
    apart. `progress` is a folder that belongs to one stream, as its checkpoint does. Chunks that appear later are read if
    their name comes after all that have been read.
    """
    importable(spark).dataSource.register(RowBatches)
    reader = spark.readStream.format("row_batches").schema(schema).option("rows", rows).option("progress", progress)
    reader = reader.option("batches", batches)
    return (reader.option("number", number) if number else reader).load(path)


def drain(query: StreamingQuery) -> None:
    """Work off everything there is, batch by batch, and stop the query."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()

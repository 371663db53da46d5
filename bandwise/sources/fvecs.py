"""Distributed reader and writer of ``.fvecs`` files.

Each record is a little-endian int32 length d followed by d float32 values; all
records are equally long. A file is cut into record-aligned byte ranges, one Spark
partition each. ``doc_id`` is the position of the record, counted over the files in
name order, so it is stable and needs no counting job.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)

PARTITION_BYTES = 64 * 1024 * 1024
BATCH_BYTES = 4 * 1024 * 1024
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


@dataclass
class RecordRange(InputPartition):
    """Records ``[first, first + count)`` of a file whose record 0 has id ``base``."""

    path: str
    dim: int
    base: int
    first: int
    count: int


def open_filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """Filesystem and inner path of a URI (hdfs, s3 or s3a, gs, file) or a local path."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return fs.LocalFileSystem(), path


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as Spark reads it: without a scheme it lies in the session's default file system."""
    if ":" in path:
        return path
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(folder).toString()


def list_files(path: str) -> list[tuple[str, int]]:
    """Data files under ``path`` in name order with their sizes."""
    system, inner = open_filesystem(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    prefix = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    found = system.get_file_info(fs.FileSelector(inner, recursive=True))
    files = [(prefix + f.path, f.size) for f in found if f.is_file and not f.base_name.startswith(("_", "."))]
    return sorted(files)


def record_length(path: str) -> int:
    system, inner = open_filesystem(path)
    with system.open_input_file(inner) as stream:
        return int(np.frombuffer(stream.read(4), dtype="<i4")[0])


class FvecsReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]):
        self.path = options["path"]
        self.partition_bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        self.limit = int(options["rows"]) if "rows" in options else None

    def partitions(self) -> list[RecordRange]:
        files = [(path, size) for path, size in list_files(self.path) if size]
        if not files:
            return []
        dim = record_length(files[0][0])
        if dim <= 0:
            raise ValueError(f"{files[0][0]}: record length {dim} is not positive")
        record = 4 * (dim + 1)
        step = max(1, self.partition_bytes // record)
        ranges, base = [], 0
        for path, size in files:
            if size % record:
                raise ValueError(f"{path}: size {size} is not a multiple of the {record}-byte record")
            total = size // record
            wanted = total if self.limit is None else max(0, min(total, self.limit - base))
            for first in range(0, wanted, step):
                ranges.append(RecordRange(path, dim, base, first, min(step, wanted - first)))
            base += total
        return ranges

    def read(self, partition: RecordRange) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        system, inner = open_filesystem(partition.path)
        with system.open_input_file(inner) as stream:
            dim, record = partition.dim, 4 * (partition.dim + 1)
            step = max(1, BATCH_BYTES // record)
            stop = partition.first + partition.count
            for first in range(partition.first, stop, step):
                count = min(step, stop - first)
                rows = np.frombuffer(stream.read_at(count * record, first * record), dtype="<i4").reshape(count, dim + 1)
                if (rows[:, 0] != dim).any():
                    raise ValueError(f"{partition.path}: records differ in length from {dim}")
                values = np.ascontiguousarray(rows[:, 1:]).view("<f4").ravel()
                offsets = np.arange(count + 1, dtype=np.int32) * dim
                ids = np.arange(partition.base + first, partition.base + first + count, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                    names=["doc_id", "vec"],
                )


class PrefixFvecsReader(FvecsReader):
    """Reader that also turns upper bounds on ``doc_id`` into fewer byte ranges."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for item in filters:
            bound = None
            if getattr(item, "attribute", None) == ("doc_id",):
                if isinstance(item, LessThan):
                    bound = item.value
                elif isinstance(item, (LessThanOrEqual, EqualTo)):
                    bound = item.value + 1
            if bound is not None:
                bound = max(0, bound)
                self.limit = bound if self.limit is None else min(self.limit, bound)
            if bound is None or isinstance(item, EqualTo):
                yield item


@dataclass
class WrittenPart(WriterCommitMessage):
    partition: int
    name: str
    dim: int | None


class FvecsWriter(DataSourceArrowWriter):
    """One file for each task, under a hidden name until all tasks are done. A lost attempt may leave its hidden file, which is never read."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenPart:
        system, inner = open_filesystem(self.path)
        system.create_dir(inner, recursive=True)
        partition, dim = TaskContext.get().partitionId(), None
        name = f"{inner}/_part-{partition:05d}-{uuid.uuid4().hex}"
        with system.open_output_stream(name) as out:
            for batch in iterator:
                vec = batch.column(1)
                lengths = set(vec.value_lengths().to_pylist()) | ({dim} - {None})
                if not batch.num_rows:
                    continue
                if len(lengths) > 1 or None in lengths or 0 in lengths or vec.flatten().null_count:
                    raise ValueError("vectors must be equally long, without nulls and not empty")
                dim = lengths.pop()
                rows = np.empty((batch.num_rows, dim + 1), "<i4")
                rows[:, 0] = dim
                rows[:, 1:] = vec.flatten().to_numpy().astype("<f4").view("<i4").reshape(-1, dim)
                out.write(rows.tobytes())
        return WrittenPart(partition, name, dim)

    def commit(self, messages: list[WrittenPart | None]) -> None:
        system, inner = open_filesystem(self.path)
        parts = [part for part in messages if part is not None]
        if len({part.dim for part in parts} - {None}) > 1:
            self.abort(messages)
            raise ValueError("vectors must be equally long")
        for part in parts:
            if part.dim is None:
                system.delete_file(part.name)
            else:
                system.move(part.name, f"{inner}/part-{part.partition:05d}.fvecs")

    def abort(self, messages: list[WrittenPart | None]) -> None:
        system, _ = open_filesystem(self.path)
        for part in messages:
            if part is not None:
                system.delete_file(part.name)


class FvecsDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fvecs"

    def schema(self) -> str:
        return "doc_id bigint, vec array<float>"

    def reader(self, schema) -> DataSourceReader:
        pushdown = self.options.get("pushdown", "false") == "true"
        return (PrefixFvecsReader if pushdown else FvecsReader)(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return FvecsWriter(self.options["path"])


def read_fvecs(
    spark: SparkSession, path: str, rows: int | None = None, partition_bytes: int = PARTITION_BYTES
) -> DataFrame:
    """Vectors of a file, or of a folder of files, as ``(doc_id, vec)``.

    ``rows`` reads only the first records. A filter ``doc_id < n`` does the same when
    the session allows filter pushdown into Python sources.
    """
    spark.dataSource.register(FvecsDataSource)
    reader = spark.read.format("fvecs").option("partitionBytes", str(partition_bytes))
    reader = reader.option("pushdown", str(spark.conf.get(PUSHDOWN, "false")).lower())
    if rows is not None:
        reader = reader.option("rows", str(rows))
    return reader.load(qualified(spark, path))


def write_fvecs(vectors: DataFrame, path: str) -> None:
    """Write ``vectors`` (``doc_id, vec``) to a new folder of ``.fvecs`` files, in the order of their ids.

    Ids are not stored: ``read_fvecs`` numbers the records from 0 in the same order. Vectors that are
    null, empty, hold a null or differ in length are an error.
    """
    spark = vectors.sparkSession
    path = qualified(spark, path)
    system, inner = open_filesystem(path)
    if system.get_file_info(inner).type != fs.FileType.NotFound and list_files(path):
        raise FileExistsError(path)
    spark.dataSource.register(FvecsDataSource)
    rows = vectors.select("doc_id", F.col("vec").cast("array<float>").alias("vec"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    rows.write.format("fvecs").mode("append").save(path)

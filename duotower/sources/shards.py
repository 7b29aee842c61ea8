"""A sharded dataset as a Spark data source: ``spark.read.format("shards")`` and ``df.write.format("shards")``.

A dataset is a folder of zstd Parquet shards and one merged index, ``index.json``: schema, and per shard its file, value
of the split column, rows, bytes and the range of every whole-number column. The index is the commit: a write adds its
shards to it (or, with mode ``overwrite``, replaces them) by one move of a finished file after all tasks are done, so a
reader sees a write whole or not at all, and files of lost or repeated tasks are never listed.

Options of a write: ``path``; ``split`` (default ``split``): the column by whose value rows are kept in shards of their own (it
is stored in the index only; a table without it is one split); ``rows_per_shard`` (1,000,000).
Options of a read: ``path``; ``columns`` (comma-separated): only these are read from the files, as with a schema given by the
user; ``splits`` (a JSON list; null for rows without one): only their entries; ``between`` (JSON: column to [low, high], either
may be null): entries whose range does not meet it are left out. ``read_dataset`` sets them and filters the rows as well.

A read has one input partition per index entry that is left, or, of more than ``PARTITIONS`` entries, runs of them (a task with a
Python worker for every small shard would cost more than its rows), and rows go between Parquet and Spark in Arrow batches. Pruning is
asked for by options, not by ``pushFilters``: a DataFrame of Spark 4.1 keeps the reader that one query's filters have pruned
for its later queries, which would then miss rows.

Files are reached by ``pyarrow.fs`` (local and mounted folders, ``hdfs://``, ``s3://``, ``gs://``, ``abfs://``): the path must
be one that driver and executors share. Two writes to one dataset at the same time are not coordinated.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from duotower.session import ship_package

INDEX = "index.json"
OPEN_SHARDS = 16        # shards that a task writes at a time
PARTITIONS = 200        # input partitions of a read up to which every shard is one of its own
PARTITION_BYTES = 64 << 20      # bytes of several shards in one partition
WHOLE = (pa.int8(), pa.int16(), pa.int32(), pa.int64())


def _located(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:") and "://" not in path:
        path = path[len("file:"):]
    fs, base = pafs.FileSystem.from_uri(path)
    return fs, base.rstrip("/")


def read_index(path: str) -> dict | None:
    """The merged index of a dataset: {"schema", "split", "shards": [...]}; None if there is none."""
    fs, base = _located(path)
    if fs.get_file_info(f"{base}/{INDEX}").type == pafs.FileType.NotFound:
        return None
    with fs.open_input_stream(f"{base}/{INDEX}") as f:
        return json.loads(f.read())


def index_frame(spark: SparkSession, path: str) -> DataFrame:
    """(split, shard, rows, bytes) of every listed shard."""
    shards = (read_index(path) or {"shards": []})["shards"]
    return spark.createDataFrame([(s["split"], s["file"], s["rows"], s["bytes"]) for s in shards], "split string, shard string, rows long, bytes long")


@dataclass
class Shards(InputPartition):
    """One input partition: index entries."""
    entries: list

    def __init__(self, entries: list):
        super().__init__(entries)
        self.entries = entries


@dataclass
class Written(WriterCommitMessage):
    shards: list = field(default_factory=list)


class ShardSource(DataSource):
    """See the module's docstring."""

    @classmethod
    def name(cls) -> str:
        return "shards"

    def _index(self) -> dict:
        index = read_index(self.options["path"])
        if index is None:
            raise ValueError(f"no {INDEX} under {self.options['path']}")
        return index

    def schema(self) -> StructType:
        full = StructType.fromJson(self._index()["schema"])
        names = [c.strip() for c in self.options.get("columns", "").split(",") if c.strip()]
        return StructType([full[c] for c in names]) if names else full

    def reader(self, schema: StructType) -> DataSourceReader:
        return ShardReader(self.options["path"], self._index(), schema, json.loads(self.options.get("splits", "null")),
                           json.loads(self.options.get("between", "{}")))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ShardWriter(self.options["path"], schema, self.options.get("split", "split"),
                           int(self.options.get("rows_per_shard", 1_000_000)), overwrite)


class ShardReader(DataSourceReader):
    def __init__(self, path: str, index: dict, schema: StructType, splits: list | None, between: dict):
        self.path, self.split, self.schema = path, index["split"], schema
        self.shards = [s for s in index["shards"] if (splits is None or s["split"] in splits)
                       and all(c not in s["ranges"] or may_hold(s["ranges"][c], *bounds) for c, bounds in between.items())]

    def partitions(self) -> list[InputPartition]:
        return [Shards(some) for some in grouped(self.shards)]

    def read(self, partition: Shards) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, Shards):     # no entry is left: Spark asks once without one
            return
        fs, base = _located(self.path)
        target = to_arrow_schema(self.schema)
        stored = [n for n in target.names if n != self.split]
        for entry in partition.entries:
            with fs.open_input_file(f"{base}/{entry['file']}") as f:
                for batch in pq.ParquetFile(f).iter_batches(columns=stored):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([entry["split"]] * batch.num_rows, target.field(n).type) if n == self.split
                         else batch.column(n).cast(target.field(n).type) for n in target.names], schema=target)


def grouped(shards: list) -> list[list]:
    """Index entries dealt to input partitions: one each up to ``PARTITIONS``, beyond that runs of up to ``PARTITION_BYTES``."""
    if len(shards) <= PARTITIONS:
        return [[s] for s in shards]
    most = min(PARTITION_BYTES, sum(s["bytes"] for s in shards) // PARTITIONS + 1)
    groups, size = [], most
    for s in shards:
        if size + s["bytes"] > most:
            groups.append([])
            size = 0
        groups[-1].append(s)
        size += s["bytes"]
    return groups


def may_hold(bounds: list | None, low, high) -> bool:
    """Whether a shard with these bounds (None: nulls only) may have a value from ``low`` to ``high`` (None: open)."""
    return bounds is not None and (low is None or bounds[1] >= low) and (high is None or bounds[0] <= high)


class ShardWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, split: str, rows_per_shard: int, overwrite: bool):
        if rows_per_shard < 1:
            raise ValueError("rows_per_shard must be >= 1")
        self.path, self.schema, self.split, self.rows_per_shard, self.overwrite = path, schema, split, rows_per_shard, overwrite
        if split in schema.names and schema[split].dataType.simpleString() != "string":
            raise ValueError(f"the split column {split} must be a string")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, base = _located(self.path)
        fs.create_dir(f"{base}/shards", recursive=True)
        done, open_shards = [], {}
        for batch in iterator:
            if not batch.num_rows:
                continue
            for value, part in self._by_split(batch):
                while part.num_rows:
                    if value not in open_shards:
                        if len(open_shards) == OPEN_SHARDS:
                            done.append(open_shards.pop(next(iter(open_shards))).close())
                        open_shards[value] = _Open(fs, base, value, part.schema)
                    shard = open_shards[value]
                    n = min(part.num_rows, self.rows_per_shard - shard.rows)
                    shard.add(part.slice(0, n))
                    part = part.slice(n)
                    if shard.rows == self.rows_per_shard:
                        done.append(open_shards.pop(value).close())
        return Written(done + [s.close() for s in open_shards.values()])

    def _by_split(self, batch: pa.RecordBatch):
        if self.split not in batch.schema.names:
            yield None, batch
            return
        values = batch.column(self.split)
        rest = batch.select([n for n in batch.schema.names if n != self.split])
        for value in values.unique().to_pylist():
            yield value, rest.filter(pc.is_null(values) if value is None else pc.fill_null(pc.equal(values, value), False))

    def commit(self, messages: list) -> None:
        fs, base = _located(self.path)
        old = read_index(self.path)
        new = [s for m in messages if m is not None for s in m.shards]
        kept = [] if old is None or self.overwrite else old["shards"]
        index = {"schema": json.loads(self.schema.json()), "split": self.split, "shards": sorted(kept + new, key=lambda s: (s["split"] or "", s["file"]))}
        if kept and old["schema"] != index["schema"]:
            self.abort(messages)
            raise ValueError("the rows' schema is not that of the dataset")
        fs.create_dir(base, recursive=True)
        draft = f"{base}/_{uuid.uuid4().hex}.json"
        with fs.open_output_stream(draft) as f:
            f.write(json.dumps(index).encode())
        fs.move(draft, f"{base}/{INDEX}")
        for s in (old or {"shards": []})["shards"] if self.overwrite else []:
            fs.delete_file(f"{base}/{s['file']}")

    def abort(self, messages: list) -> None:
        fs, base = _located(self.path)
        for s in [s for m in messages if m is not None for s in m.shards]:
            fs.delete_file(f"{base}/{s['file']}")


class _Open:
    """A shard being written."""

    def __init__(self, fs: pafs.FileSystem, base: str, value, schema: pa.Schema):
        self.fs, self.base, self.value, self.rows = fs, base, value, 0
        self.file = f"shards/{uuid.uuid4().hex}.parquet"
        self.ranges = {f.name: None for f in schema if f.type in WHOLE}
        self.out = fs.open_output_stream(f"{base}/{self.file}")
        self.writer = pq.ParquetWriter(self.out, schema, compression="zstd")

    def add(self, part: pa.RecordBatch) -> None:
        self.writer.write_batch(part)
        self.rows += part.num_rows
        for name, old in self.ranges.items():
            bounds = pc.min_max(part.column(name)).as_py()
            if bounds["min"] is not None:
                self.ranges[name] = [bounds["min"], bounds["max"]] if old is None else [min(old[0], bounds["min"]), max(old[1], bounds["max"])]

    def close(self) -> dict:
        self.writer.close()
        self.out.close()
        size = self.fs.get_file_info(f"{self.base}/{self.file}").size
        return {"split": self.value, "file": self.file, "rows": self.rows, "bytes": size, "ranges": self.ranges}


def register(spark: SparkSession) -> None:
    """Make ``format("shards")`` known to the session."""
    ship_package(spark)
    spark.dataSource.register(ShardSource)


def read_dataset(spark: SparkSession, path: str, splits: list | None = None, columns: list[str] | None = None,
                 between: dict[str, tuple] | None = None) -> DataFrame:
    """Rows of the dataset, of these splits (null: rows without one), with values in these ranges; only the shards and columns
    needed are read."""
    between = between or {}
    read = spark.read.format("shards").option("between", json.dumps(between))
    if splits is not None:
        read = read.option("splits", json.dumps(splits))
    if columns is not None:
        read = read.option("columns", ",".join(dict.fromkeys([*columns, *between])))
    out = read.load(path)
    for name, (low, high) in between.items():
        out = out.where(F.lit(True) if low is None else F.col(name) >= low).where(F.lit(True) if high is None else F.col(name) <= high)
        out = out.where(F.col(name).isNotNull())
    return out if columns is None else out.select(*columns)

"""Helpers shared by the operators: scratch tables, Arrow building blocks, tokenizer files."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duotower.session import new_run_id, scratch_path, ship_package


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared scratch folder and read back: one snapshot for all later readers.

    It cuts the lineage like a checkpoint does (a lost executor costs at most the running stage), but keeps column
    pruning and statistics.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name, new_run_id())
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def columns(docs: DataFrame, **names: str) -> DataFrame:
    """Exactly the asked-for columns under fixed names, so that extra columns of any name never clash."""
    ship_package(docs.sparkSession)
    return docs.select(*[F.col(f"`{src}`").alias(dst) for dst, src in names.items()])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """An absolute path is taken as it is; any other name is a file of the installed public tokenizers."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = 16 << 20
                ) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Batches cut to about ``max_bytes`` of text each, with the texts (null: empty) as Python strings."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        sizes = np.asarray(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            upto = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + max_bytes, side="right"))
            upto = max(upto, at + 1)
            part = batch.slice(at, upto - at)
            texts = part.column(batch.schema.get_field_index(column)).to_pylist()
            yield part, [t if t is not None else "" for t in texts]
            at = upto


def binary_pieces(flat: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Consecutive pieces of a flat number array (``lengths`` in numbers) as one Arrow binary column, without a copy."""
    flat = np.ascontiguousarray(flat)
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    offsets[1:] = np.cumsum(np.asarray(lengths, dtype=np.int64) * flat.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


def flat_numbers(col: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Inverse of ``binary_pieces``: all numbers of a binary column, and the count of each row."""
    if not len(col):
        return np.zeros(0, dtype), np.zeros(0, np.int64)
    size = np.dtype(dtype).itemsize
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int32)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.frombuffer(raw.tobytes(), dtype=dtype), np.diff(offsets) // size

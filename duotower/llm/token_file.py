"""Operator 6, token-id output: one wavelet matrix per shard.

Documents are range-partitioned and sorted by id, so file order is id order. Each task encodes its documents and cuts
shards of about ``shard_tokens`` ids at document ends. A shard is one row of a Parquet folder (zstd):

  part, shard      range partition and number of the shard in it
  first            ids of the partition before this shard
  n_tokens         ids in the shard
  alphabet         the ids that occur, sorted, uint32 little-endian
  planes           the bit-planes of the wavelet matrix, one after the other, each ceil(n_tokens / 8) bytes
  doc_ids, doc_tokens   documents in order and the number of ids of each, end id included

``read_documents`` decodes all of them. ``token_at`` (which id stands at a position), ``token_counts`` (how often ids
occur) and ``token_occurrences`` (where) answer from the bit-planes by rank and select, without decoding a shard. Positions count
all ids of the file in id order, from 0, as ``start`` of ``read_documents`` does.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duotower.llm.common import binary_pieces, columns, text_slices
from duotower.llm.wavelet import WaveletMatrix
from duotower.llm.wordbpe import word_bpe
from duotower.session import default_parallelism, new_run_id, scratch_path

SHARD_TOKENS = 4 << 20
BLOCK_BITS = 20             # positions meet the list of shards in blocks of 2^20


def write_token_file(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                     shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode the documents and write the shards to ``path``.

    Null texts are empty: such a document is just its end id. Rows with one id stand next to each other, in the
    order of their texts; null ids come first. Tied ids can be spread over partitions, as the range also looks at a
    hash of the text. An empty table writes no rows. Other columns are ignored.
    """
    docs = columns(docs, doc_id=id_col, text=text_col)
    order = [F.col("doc_id"), F.xxhash64("text"), F.col("text")]
    ranged = docs.repartitionByRange(default_parallelism(docs.sparkSession), *order[:2]).sortWithinPartitions(*order)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches):
        bpe, part = word_bpe(tokenizer), TaskContext.get().partitionId()
        flats, lengths, ids = [], [], []
        held = first = shard = 0

        def cut():
            nonlocal first, shard, held
            flat, sizes = np.concatenate(flats), np.concatenate(lengths)
            alphabet = np.flatnonzero(np.bincount(flat)).astype(np.uint32)
            code = np.zeros(int(alphabet[-1]) + 1, np.uint32)
            code[alphabet] = np.arange(len(alphabet))
            planes = np.concatenate(WaveletMatrix.planes_of(code[flat], len(alphabet)))
            row = [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([first], pa.int64()),
                   pa.array([len(flat)], pa.int64()), pa.array([alphabet.tobytes()], pa.binary()), pa.array([planes.tobytes()], pa.binary()),
                   pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), pa.concat_arrays(ids)),
                   pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), pa.array(sizes, pa.int64()))]
            first += len(flat)
            shard += 1
            held = 0
            for x in (flats, lengths, ids):
                x.clear()
            return pa.RecordBatch.from_arrays(row, ["part", "shard", "first", "n_tokens", "alphabet", "planes", "doc_ids", "doc_tokens"])

        for batch, texts in text_slices(batches, max_bytes=8 << 20):
            flat, sizes = bpe.encode(texts)
            ends = np.cumsum(sizes)
            flats.append(np.insert(flat, ends, np.uint32(end_id)))
            lengths.append(sizes + 1)
            ids.append(batch.column(batch.schema.get_field_index("doc_id")))
            held += len(flats[-1])
            if held >= shard_tokens:
                yield cut()
        if held:
            yield cut()

    (ranged.mapInArrow(encode, f"part int, shard int, first long, n_tokens long, alphabet binary, planes binary, doc_ids array<{id_type}>, "
                               "doc_tokens array<long>")
     .write.option("compression", "zstd").parquet(path))


def _bases(shards: DataFrame) -> DataFrame:
    """(part, base): ids before each range partition. One row per partition of the writer's shuffle: small enough to broadcast."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def _placed_shards(spark: SparkSession, path: str) -> DataFrame:
    """Shards without their documents, with ``at``: the position of a shard's first id in the file."""
    shards = spark.read.parquet(path)
    return (shards.join(F.broadcast(_bases(shards)), "part")
            .select("part", "shard", (F.col("base") + F.col("first")).alias("at"), "n_tokens", "alphabet", "planes"))


def _matrix(batch: pa.RecordBatch, i: int) -> WaveletMatrix:
    row = {name: batch.column(batch.schema.get_field_index(name))[i].as_py() for name in ("alphabet", "planes", "n_tokens")}
    return WaveletMatrix.load(row["alphabet"], row["planes"], row["n_tokens"])


def token_counts(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """(id, n): how often each of ``ids`` occurs in the file, 0 included; repeated ids are answered once.

    A shard that lacks an id is passed over by its alphabet; in the others an id's count is one rank per bit-plane.
    """
    wanted = np.unique(np.asarray(ids, np.uint32))

    def count(batches):
        for b in batches:
            for i in range(b.num_rows):
                held = np.intersect1d(wanted, np.frombuffer(b.column(b.schema.get_field_index("alphabet"))[i].as_py(), np.uint32))
                if len(held):
                    w = _matrix(b, i)
                    n = w.rank_code(w.code_of(held)[0], np.full(len(held), w.n))
                    yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int64)), pa.array(n, pa.int64())], ["id", "n"])

    found = spark.read.parquet(path).select("n_tokens", "alphabet", "planes").mapInArrow(count, "id long, n long")
    asked = spark.createDataFrame([(int(x),) for x in wanted], "id long")       # the caller's list
    return asked.join(found.groupBy("id").agg(F.sum("n").alias("n")), "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("n"))


def token_occurrences(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """(id, position) of every occurrence of ``ids`` in the file; an id that does not occur gives no row.

    Each shard walks its occurrences up from the last bit-plane by select, so the work grows with the hits.
    """
    wanted = np.unique(np.asarray(ids, np.uint32))

    def locate(batches):
        for b in batches:
            for i in range(b.num_rows):
                held = np.intersect1d(wanted, np.frombuffer(b.column(b.schema.get_field_index("alphabet"))[i].as_py(), np.uint32))
                if len(held):
                    w, at = _matrix(b, i), b.column(b.schema.get_field_index("at"))[i].as_py()
                    for x in held.tolist():
                        pos = w.occurrences(x)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pos), x, np.int64)), pa.array(pos + at, pa.int64())], ["id", "position"])

    return _placed_shards(spark, path).mapInArrow(locate, "id long, position long")


def token_at(positions: DataFrame, path: str, col: str = "position") -> DataFrame:
    """(position, id): the id at every distinct position of ``positions``; null outside the file and for a null position.

    A position finds its shard through the list of shard starts (without their data), by blocks of positions. Each shard
    answers its positions together, plane by plane; they are distinct, so at most as many as its ids.
    """
    shards = _placed_shards(positions.sparkSession, path)
    end = F.col("at") + F.col("n_tokens")
    starts = shards.select("part", "shard", "at", end.alias("end"), F.explode(F.sequence(F.shiftright("at", BLOCK_BITS), F.shiftright(end - 1, BLOCK_BITS))).alias("block"))
    rows = positions.select(F.col(f"`{col}`").cast("long").alias("position")).distinct().withColumn("asked_block", F.shiftright("position", BLOCK_BITS))
    inside = (F.col("asked_block") == F.col("block")) & (F.col("position") >= F.col("at")) & (F.col("position") < F.col("end"))
    met = rows.join(starts, inside, "left").select("position", "part", "shard")
    outside = met.where(F.col("part").isNull()).select("position", F.lit(None).cast("long").alias("id"))
    asked = met.where(F.col("part").isNotNull()).groupBy("part", "shard").agg(F.collect_list("position").alias("asked"))

    def access(batches):
        for b in batches:
            for i in range(b.num_rows):
                at = b.column(b.schema.get_field_index("at"))[i].as_py()
                pos = b.column(b.schema.get_field_index("asked"))[i].values.to_numpy()
                ids = _matrix(b, i).access(pos - at).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pos), pa.array(ids)], ["position", "id"])

    return shards.join(asked, ["part", "shard"]).mapInArrow(access, "position long, id long").unionByName(outside)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the shards: ``ids`` is little-endian uint32 binary."""
    shards = spark.read.parquet(path)
    id_type = shards.schema["doc_ids"].dataType.elementType.simpleString()

    def decode(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = {name: b.column(k)[i] for k, name in enumerate(b.schema.names)}
                n = row["n_tokens"].as_py()
                flat = WaveletMatrix.load(row["alphabet"].as_py(), row["planes"].as_py(), n).decode()
                sizes = row["doc_tokens"].values.to_numpy()
                start = row["first"].as_py() + np.concatenate([[0], np.cumsum(sizes)[:-1]])
                k = len(sizes)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(k, row["part"].as_py(), np.int32)), row["doc_ids"].values, pa.array(start, pa.int64()),
                                                  pa.array(sizes, pa.int64()), binary_pieces(flat.astype("<u4"), sizes)],
                                                 ["part", "doc_id", "local", "n_tokens", "ids"])

    docs = shards.mapInArrow(decode, f"part int, doc_id {id_type}, local long, n_tokens long, ids binary")
    return (docs.join(F.broadcast(_bases(shards)), "part")
            .select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids"))


def token_file_round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1, **kw) -> DataFrame:
    """Write the documents to a new folder in the shared scratch space and read every document back from it."""
    spark = docs.sparkSession
    path = scratch_path(spark, "llm", "token_file", new_run_id())
    write_token_file(docs, path, tokenizer, end_id, **kw)
    return read_documents(spark, path)

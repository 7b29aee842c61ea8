"""Operator 7, benchmark decontamination: an FM-index per shard of documents, searched for all benchmark windows.

1. Test texts become windows of ``width`` words (a shorter text is one window). They are taken in blocks of about
   ``block_bytes`` of text, so that what is broadcast has a fixed size.
2. Every task turns its documents into word codes over the block's vocabulary. A run of other words becomes one
   separator, as no window can match across it; every document ends with one. About ``shard_words`` codes make one
   shard, whose FM-index is written as a row of a table.
3. All windows are searched backwards at once through the ranks of the wavelet matrix, occurrences are found by the
   sampled suffix positions, and the word spans of each document are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duotower.llm.common import columns, text_slices, written
from duotower.llm.fm_index import FmIndex

WIDTH = 10
SHARD_WORDS = 1 << 20
BLOCK_BYTES = 32 << 20

# A-Z to lower case; digits, a-z and all bytes of non-ASCII characters are word bytes; the rest separates words.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class Windows:
    """Windows of a block of test items: distinct patterns over the block's vocabulary, and the items of each."""

    def __init__(self, items: list[tuple[str, str | None]], width: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for name, text in items:
            codes = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for k in range(max(1, len(codes) - width + 1) if codes else 0):
                owners.setdefault(tuple(codes[k:k + width]), set()).add(name)
        patterns = sorted(owners)
        self.items = [sorted(owners[p]) for p in patterns]
        self.lengths = np.array([len(p) for p in patterns], np.int64)
        self.patterns = np.zeros((len(patterns), max([1, *self.lengths.tolist()])), np.uint32)
        for k, p in enumerate(patterns):
            self.patterns[k, :len(p)] = p


_SHARD = "n long, alphabet binary, planes binary, marked binary, samples binary, separators binary, skipped binary, first binary, n_words binary, doc_ids array<{id}>"


def shard_codes(texts: list[str], vocabulary: dict[bytes, int]):
    """Codes of the texts with separators; per separator the words it stands for; per text its first code and its words."""
    flat, sizes = [], []
    get = vocabulary.get
    for text in texts:
        own = words_of(text)
        sizes.append(len(own))
        flat += map(get, own)
    sizes = np.array(sizes, np.int64)
    raw = np.fromiter((c or 0 for c in flat), np.uint32, len(flat))
    # every document's end is a separator that stands for no word
    ends = np.cumsum(sizes)
    codes = np.insert(raw, ends, np.uint32(0))
    real = np.ones(len(codes), bool)
    last = ends + np.arange(len(sizes))
    real[last] = False
    zero = codes == 0
    # keep a separator if the position before it is none or belongs to another document
    opens = zero & ~np.concatenate([[False], zero[:-1] & real[:-1]])
    keep = ~zero | opens
    run = np.cumsum(opens)[zero] - 1
    skipped = np.bincount(run, weights=real[zero], minlength=int(opens.sum())).astype(np.int32)
    place = np.cumsum(keep) - keep
    first = place[last - sizes]
    return codes[keep], skipped, first, sizes


def build_index(docs: DataFrame, vocabulary, shard_words: int) -> DataFrame:
    """One row per shard: the FM-index of its codes and what leads back from a code to a document's word."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def index(batches):
        texts, ids, size = [], [], 0

        def shard():
            codes, skipped, first, sizes = shard_codes(texts, vocabulary.value)
            parts = FmIndex.parts(codes) | {"separators": np.packbits(codes == 0, bitorder="little").tobytes(), "skipped": skipped.tobytes(),
                                            "first": first.astype(np.int64).tobytes(), "n_words": sizes.tobytes()}
            row = [pa.array([v]) for v in parts.values()]
            docs_of = pa.concat_arrays(ids)
            row.append(pa.ListArray.from_arrays(pa.array([0, len(docs_of)], pa.int32()), docs_of))
            return pa.RecordBatch.from_arrays(row, [*parts, "doc_ids"])

        for batch, part in text_slices(batches, max_bytes=5 * shard_words):
            texts += part
            ids.append(batch.column(batch.schema.get_field_index("doc_id")))
            size += sum(map(len, part))
            if size >= 5 * shard_words:     # about five bytes a word
                yield shard()
                texts, ids, size = [], [], 0
        if texts:
            yield shard()

    return docs.mapInArrow(index, _SHARD.format(id=id_type))


def occurrences(fm: FmIndex, windows: Windows):
    """(position, window) of every occurrence in a shard."""
    lo, hi = fm.search(windows.patterns, windows.lengths)
    hit = np.flatnonzero(hi > lo)
    n = (hi - lo)[hit]
    window = np.repeat(hit, n)
    rows = np.repeat(lo[hit] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return fm.locate(rows), window


def search_index(index: DataFrame, windows, all_documents: bool = True) -> DataFrame:
    """(doc_id, n_words, spans, items) per document: merged hit spans in words, and the items whose windows occur."""
    id_type = index.schema["doc_ids"].dataType.elementType.simpleString()

    def search(batches):
        w = windows.value
        for b in batches:
            for i in range(b.num_rows):
                row = {name: b.column(k)[i] for k, name in enumerate(b.schema.names)}
                n = row["n"].as_py()
                fm = FmIndex(n, *(row[x].as_py() for x in ("alphabet", "planes", "marked", "samples")))
                at, window = occurrences(fm, w)
                first = np.frombuffer(row["first"].as_py(), np.int64)
                n_words = np.frombuffer(row["n_words"].as_py(), np.int64)
                doc = np.searchsorted(first, at, side="right") - 1
                # words before a position: its separators stand for ``skipped`` words each
                sep = BitCount(row["separators"].as_py(), n, np.frombuffer(row["skipped"].as_py(), np.int32))
                word = sep.words_before(at) - sep.words_before(first[doc])
                order = np.lexsort((word, doc))
                spans = [[] for _ in range(len(first))]
                names = [set() for _ in range(len(first))]
                for d, a, k in zip(doc[order].tolist(), word[order].tolist(), window[order].tolist()):
                    e = a + int(w.lengths[k])
                    own = spans[d]
                    if own and a <= own[-1][1]:
                        own[-1][1] = max(own[-1][1], e)
                    else:
                        own.append([a, e])
                    names[d].update(w.items[k])
                spans = [[{"start": a, "length": e - a} for a, e in own] for own in spans]
                yield pa.RecordBatch.from_arrays(
                    [row["doc_ids"].values, pa.array(n_words), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                     pa.array([sorted(x) for x in names], pa.list_(pa.string()))], ["doc_id", "n_words", "spans", "items"])

    return index.mapInArrow(search, f"doc_id {id_type}, n_words long, spans array<struct<start:long,length:long>>, items array<string>")


class BitCount:
    """Words that stand before code positions of a shard."""

    def __init__(self, separators: bytes, n: int, skipped: np.ndarray):
        bits = np.unpackbits(np.frombuffer(separators, np.uint8), count=n, bitorder="little")
        worth = np.ones(n, np.int64)
        worth[bits.view(bool)] = skipped
        self.before = np.concatenate([[0], np.cumsum(worth)])

    def words_before(self, pos):
        return self.before[pos]


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", width: int = WIDTH, shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: the id column, n_words, spans (merged, in words of the document), items (sorted strings).

    Words are lower-cased (A-Z) runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``. A document word inside any occurrence
    of a window lies in a span. Defined results: null or wordless documents have no words, spans or items; null or
    wordless items match nothing; items with one id count once and a null item id is the id ''; repeated documents
    give one row each; empty tables give no rows or no hits; other columns are ignored.
    """
    docs = columns(docs, doc_id=id_col, text=text_col)
    bench = columns(benchmark, item_id=item_col, text=item_text_col).select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").distinct()     # repeated rows would fill one block
    total = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    spark = docs.sparkSession
    if n_blocks > 1:
        docs = written(docs.select(F.struct(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").alias("id")).alias("doc_id"), "text"),
                       "decontaminate_docs")
    found = []
    for k in range(n_blocks):
        block = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == k).collect()     # about block_bytes
        windows = Windows([(r["item_id"], r["text"]) for r in block], width)
        vocabulary = spark.sparkContext.broadcast(windows.vocabulary)
        index = written(build_index(docs, vocabulary, shard_words), "fm_index")
        found.append(search_index(index, spark.sparkContext.broadcast(windows)))
    if n_blocks == 1:
        return found[0]
    every = found[0]
    for f in found[1:]:
        every = every.unionAll(f)
    merged = every.groupBy("doc_id").agg(F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
                                         F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return merged.select(F.col("doc_id.id").alias("doc_id"), "n_words", merge_spans(F.col("spans")).alias("spans"), "items")


def merge_spans(spans):
    """Union of sorted (start, length) spans, with SQL functions."""
    empty = F.array().cast("array<struct<start:long,length:long>>")

    def add(acc, s):
        last = F.element_at(acc, -1)
        end = last["start"] + last["length"]
        joined = F.struct(last["start"].alias("start"), (F.greatest(end, s["start"] + s["length"]) - last["start"]).alias("length"))
        return (F.when(F.size(acc) == 0, F.array(s))
                .when(s["start"] <= end, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(joined)))
                .otherwise(F.concat(acc, F.array(s))))

    return F.aggregate(spans, empty, add)

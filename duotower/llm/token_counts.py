"""Operator 1, token counts: the pieces of every distinct pre-token are counted once, then joined to the documents.

1. Every task totals its pre-tokens; a shuffle merges them, so each distinct pre-token reaches the tokenizer once.
   The result (pre-token, occurrences, pieces) is written as a table.
2. The most frequent pre-tokens, at most ``head_size`` of them, are broadcast, those of more than 64 characters under
   their SHA-256, so the size of the broadcast does not depend on their length. They are found by a frequency level from
   a histogram of at most 64 rows, not by a global sort.
3. Every document is split again. The broadcast head answers most of its frequencies in place; the rest
   (pre-token, frequency) is joined to the table by a shuffle and summed per document. No id is ever materialised.

A pre-token that occurs everywhere is in the head, however long it is, so the shuffled join has no hot key: more than
``head_size`` pre-tokens are at least half as frequent as one that is left to it.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duotower.llm.common import columns, text_slices, written
from duotower.llm.wordbpe import word_bpe

HEAD_SIZE = 400_000         # most pre-tokens in the broadcast head
HEAD_CHARS = 64             # longer pre-tokens stand in it by their digest
_FLUSH = 300_000            # distinct pre-tokens that a task holds before it hands its totals on


def pretoken_table(texts: DataFrame, tokenizer: str) -> DataFrame:
    """(pretoken, n, pieces): occurrences in all texts and number of pieces of every distinct pre-token."""

    def totals(batches):
        bpe, seen = word_bpe(tokenizer), Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["pretoken", "n"])

        for _, part in text_slices(batches):
            for text in part:
                seen.update(bpe.pretokens(text)[0])
                if len(seen) > _FLUSH:
                    yield out()
                    seen.clear()
        yield out()

    def count(batches):
        bpe = word_bpe(tokenizer)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(bpe.piece_counts(b.column(0).to_pylist()), pa.int32())],
                                             ["pretoken", "n", "pieces"])

    merged = texts.select("text").mapInArrow(totals, "pretoken string, n long").groupBy("pretoken").agg(F.sum("n").alias("n"))
    return merged.mapInArrow(count, "pretoken string, n long, pieces int")


def frequent_head(table: DataFrame, head_size: int) -> dict[str, int]:
    """Pieces of the most frequent pre-tokens by ``head_key``; at most ``head_size`` entries."""
    levels = table.groupBy(F.floor(F.log2("n")).cast("int").alias("level")).agg(F.count(F.lit(1)).alias("k")).collect()
    least, total = None, 0
    for level, k in sorted(((r["level"], r["k"]) for r in levels), reverse=True):
        total += k
        if total > head_size:
            break
        least = 1 << level
    if least is None:
        return {}
    key = F.when(F.length("pretoken") <= HEAD_CHARS, F.col("pretoken")).otherwise(F.concat(F.lit(" "), F.sha2("pretoken", 256)))
    head = table.where(F.col("n") >= least).select(key.alias("key"), "pieces").toArrow()
    return dict(zip(head["key"].to_pylist(), head["pieces"].to_pylist()))


def head_key(pretoken: str) -> str:
    """The pre-token itself, or, if it is long, a blank (which no pre-token holds) and its SHA-256."""
    return pretoken if len(pretoken) <= HEAD_CHARS else " " + hashlib.sha256(pretoken.encode()).hexdigest()


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", over: int = 2048,
                 head_size: int = HEAD_SIZE) -> DataFrame:
    """One row per input row: the id column, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``over``).

    Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows and null ids give one row each;
    an empty table gives no rows; other columns are ignored. No begin, end or added special tokens are counted;
    a special token's string inside a text counts as the library's default has it, one token.
    """
    docs = columns(docs, doc_id=id_col, text=text_col)
    spark = docs.sparkSession
    table = written(pretoken_table(docs, tokenizer), "pretokens")
    head = spark.sparkContext.broadcast(frequent_head(table, head_size))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def frequencies(batches):
        bpe, known, row = word_bpe(tokenizer), head.value, TaskContext.get().partitionId() << 33
        for batch, part in text_slices(batches):
            uid, key, freq, sizes, at = [], [], [], [], []
            for i, text in enumerate(part):
                counts = Counter()
                words, special = bpe.pretokens(text)
                counts.update(words)
                total = special
                for word, n in counts.items():
                    pieces = known.get(word if len(word) <= HEAD_CHARS else head_key(word))
                    if pieces is None:
                        uid.append(row), key.append(word), freq.append(n), sizes.append(None), at.append(None)
                    else:
                        total += n * pieces
                # the document's own row; no pre-token holds a blank, so its key meets nothing in the join
                uid.append(row), key.append(f" {row}"), freq.append(total), sizes.append(len(text.encode("utf-8", "surrogatepass"))), at.append(i)
                row += 1
            ids = batch.column(batch.schema.get_field_index("doc_id")).take(pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(uid, pa.int64()), ids, pa.array(sizes, pa.int64()), pa.array(key, pa.string()),
                                              pa.array(freq, pa.int64())], ["uid", "doc_id", "n_bytes", "key", "freq"])

    rows = docs.mapInArrow(frequencies, f"uid long, doc_id {id_type}, n_bytes long, key string, freq long")
    pieces = table.select(F.col("pretoken").alias("key"), "pieces")
    summed = (rows.join(pieces, "key", "left").groupBy("uid")
              .agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"),
                   F.sum(F.col("freq") * F.coalesce("pieces", F.lit(1))).alias("n_tokens")))
    return summed.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > over).alias("over_limit"))

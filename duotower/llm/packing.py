"""Operator 8, packing: mixture-controlled windows by deficit round-robin over source queues.

Each source is a queue of ids, its documents one after the other. In every round a queue earns ``window`` times its
target share, exactly; what it has earned but not yet given is its deficit and stays with it. It gives only whole grains of
``grain`` ids (and its last rest), so pieces do not become tiny, and gives nothing any more once it is empty. The
rounds follow each other in one stream, and the stream is cut into windows of exactly ``window`` ids, so only the very
last window can be short.

What queue s has given before round r is min(grain * floor(r * window * w_s / (W * grain)), T_s), so a document's
place in the stream follows from its place in its queue alone. No task simulates rounds before its own, and deficits
carry across windows and partitions without any message. Three passes:

1. every task encodes its documents and writes them with their place among the documents of their source there;
2. totals per (partition, source) become the offset of each (partition, source) in its source;
3. every task turns its documents into pieces.

Sources that are neither among the largest nor named in ``target`` share one queue, in which they are dealt by grains
too: grain k of a source with n grains stands at (k + phase) / n of the queue, the phase being a hash of the source. So at any point
of the queue each of its sources has given its proportion to one grain, however many there are. A grain's place is the
number of ids before it, summed in ranges of the queue.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duotower.llm.common import binary_pieces, columns, flat_numbers, text_slices, written
from duotower.llm.wordbpe import word_bpe

WINDOW = 4096
GRAIN = 128
QUEUES = 512        # the sources with most ids, and those with a target, have a queue each; all others share the last queue
_RANGE = 4096       # grains in a range of the shared queue, and ranges in a group of them
_INT64 = 1 << 62
_PLACED = ("doc_id", "source", "lane", "place", "first", "n", "doc_tokens", "ids")


def exact_weights(lanes: list[tuple[str | None, int]], target: dict[str | None, float]) -> list[int]:
    """Whole weights in exactly the asked-for proportions: a named queue's target, or its part of the others' by its ids."""
    unnamed = max(1, sum(t for name, t in lanes if name is None or name not in target))
    rest = Fraction(str(target.get(None, 1.0)))
    share = [rest * t / unnamed if name is None or name not in target else Fraction(str(target[name])) for name, t in lanes]
    scale = math.lcm(*[s.denominator for s in share])
    whole = [max(1, int(s * scale)) for s in share]
    common = math.gcd(*whole)
    return [w // common for w in whole]


class RoundRobin:
    """Closed form of the deficit round-robin: totals T_s and integer weights w_s per queue.

    Weights are of any size: products are taken in 64 bits where they fit, else in Python's whole numbers.
    """

    def __init__(self, totals, weights, window: int, grain: int):
        self.totals = np.asarray(totals, np.int64)
        self.weights = [int(w) for w in weights]
        self.window, self.grain, self.sum = window, grain, sum(self.weights)
        self.top = window * max(self.weights, default=1)
        kind = np.int64 if max(self.top, self.sum * grain) < _INT64 else object
        self.per = np.array([window * w for w in self.weights], kind)

    def given(self, rounds, queue) -> np.ndarray:
        """Ids that queue ``queue`` has given before each round."""
        rounds = np.asarray(rounds, np.int64)
        if self.per.dtype == object or len(rounds) and int(rounds.max()) * self.top >= _INT64:
            rounds = rounds.astype(object)
        whole = self.grain * (rounds * self.per[queue] // (self.sum * self.grain))
        return np.minimum(whole, self.totals[queue]).astype(np.int64)

    def round_of(self, place, queue) -> np.ndarray:
        """Round in which a queue gives its id number ``place``."""
        grains = np.asarray(place, np.int64) // self.grain + 1
        if self.per.dtype == object or len(grains) and int(grains.max()) * self.sum * self.grain >= _INT64:
            grains = grains.astype(object)
        need = grains * (self.sum * self.grain)
        return (-(-need // self.per[queue]) - 1).astype(np.int64)

    def pieces(self, queue, place, size):
        """Cut documents (queue, place of the first id, number of ids > 0) into pieces that lie in one window each.

        Returns document index, start in the document, length, and place in the stream, in document order.
        """
        first, last = self.round_of(place, queue), self.round_of(place + size - 1, queue)
        n = last - first + 1
        doc = np.repeat(np.arange(len(n)), n)
        rounds = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
        q, lo, hi = queue[doc], place[doc], (place + size)[doc]
        begin = self.given(rounds, q)
        a, b = np.maximum(begin, lo), np.minimum(self.given(rounds + 1, q), hi)
        keep = b > a
        doc, rounds, q, begin, a, b = (x[keep] for x in (doc, rounds, q, begin, a, b))
        at = self._stream(rounds, q) + a - begin
        # a piece ends where a window does
        while len(a):
            room = (at // self.window + 1) * self.window
            over = at + (b - a) > room
            if not over.any():
                break
            reps = 1 + over.astype(np.int64)
            src = np.repeat(np.arange(len(a)), reps)
            second = np.concatenate([[False], src[1:] == src[:-1]])
            cut = (a + room - at)[src]
            split = over[src]
            a2 = np.where(second, cut, a[src])
            b2 = np.where(split & ~second, cut, b[src])
            at = np.where(second, room[src], at[src])
            doc, a, b = doc[src], a2, b2
        return doc, a - place[doc], b - a, at

    def _stream(self, rounds, queue) -> np.ndarray:
        """Place in the stream where each queue begins in each round."""
        distinct, back = np.unique(rounds, return_inverse=True)
        out = np.zeros(len(rounds), np.int64)
        before = np.zeros(len(distinct), np.int64)      # given by all queues before the round
        own = np.zeros((len(self.totals), len(distinct)), np.int64)
        for s in range(len(self.totals)):
            have = self.given(distinct, s)
            before += have
            own[s] = self.given(distinct + 1, s) - have
        earlier = np.cumsum(own, axis=0) - own          # given in the round by the queues before this one
        out += before[back] + earlier[queue, back]
        return out


def encoded(docs: DataFrame, tokenizer: str, end_id: int | None) -> DataFrame:
    """(part, source, local, doc_id, n, ids): documents as ids, with the ids of their source before them in the task."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches):
        bpe, part, seen = word_bpe(tokenizer), TaskContext.get().partitionId(), {}
        for batch, texts in text_slices(batches, max_bytes=8 << 20):
            flat, sizes = bpe.encode(texts)
            if end_id is not None:
                flat, sizes = np.insert(flat, np.cumsum(sizes), np.uint32(end_id)), sizes + 1
            source = batch.column(batch.schema.get_field_index("source"))
            local = np.zeros(len(sizes), np.int64)
            for i, (s, n) in enumerate(zip(source.to_pylist(), sizes.tolist())):
                local[i] = seen.get(s, 0)
                seen[s] = local[i] + n
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(sizes), part, np.int32)), source, pa.array(local), batch.column(batch.schema.get_field_index("doc_id")),
                                              pa.array(sizes, pa.int64()), binary_pieces(flat.astype("<u4"), sizes)], ["part", "source", "local", "doc_id", "n", "ids"])

    return written(docs.mapInArrow(encode, f"part int, source string, local long, doc_id {id_type}, n long, ids binary"), "packing_ids")


def queue_offsets(ids: DataFrame, queues: int, named: list[str]) -> DataFrame:
    """(part, source, lane, total, base): queue of each source (null: the shared one), its ids, and those before this partition's."""
    per_part = ids.groupBy("part", "source").agg(F.sum("n").alias("n"))
    inside = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = per_part.select("part", "source", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("base"))
    per_source = ids.groupBy("source").agg(F.sum("n").alias("total"))
    has_target = F.col("source").isin(named)
    largest = per_source.where(~has_target).orderBy(F.desc("total"), "source").limit(queues - 1).select("source").withColumn("own", F.lit(True))
    per_source = per_source.join(F.broadcast(largest), "source", "left").select("source", "total", F.when(F.col("own") | has_target, F.col("source")).alias("lane"))
    return per_part.join(per_source, "source").select("part", "source", "lane", "total", "base")


def shared_pieces(docs: DataFrame, total: int, grain: int) -> DataFrame:
    """The documents of the shared queue (``total`` ids) cut into its grains, with their place in it."""
    ranges = max(1, -(-total // (grain * _RANGE)))
    n_grains = F.ceil(F.col("total") / grain)
    phase = F.pmod(F.xxhash64("source"), F.lit(1 << 30)) / float(1 << 30)
    docs = docs.where("n > 0").withColumn("in_source", F.col("place"))

    def cut(with_ids: bool) -> DataFrame:
        def piece(k):
            a = F.greatest(F.col("in_source"), k * grain)
            length = F.least(F.col("in_source") + F.col("n"), (k + 1) * grain) - a
            at = (k + phase) / n_grains
            fields = [at.alias("at"), F.least(F.floor(at * ranges), F.lit(ranges - 1)).alias("range"), a.alias("a"), length.alias("length")]
            if with_ids:
                start = a - F.col("in_source")
                fields += [start.alias("first"), F.col("ids").substr((start * 4 + 1).cast("int"), (length * 4).cast("int")).alias("piece")]
            return F.struct(*fields)

        grains = F.sequence(F.floor(F.col("in_source") / grain), F.floor((F.col("in_source") + F.col("n") - 1) / grain))
        kept = ["doc_id", "source", "lane", "doc_tokens"] if with_ids else []
        return docs.select(*kept, F.inline(F.transform(grains, piece)))

    # one row per range of the queue, without the ids
    sums = cut(False).groupBy("range").agg(F.sum("length").alias("sum"))
    sums = sums.withColumn("group", F.floor(F.col("range") / _RANGE))
    within = Window.partitionBy("group").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)       # a row for 2**31 ids of the queue
    groups = sums.groupBy("group").agg(F.sum("sum").alias("all")).select("group", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("base"))
    before = (sums.withColumn("part", F.coalesce(F.sum("sum").over(within), F.lit(0))).join(groups, "group")
              .select("range", (F.col("base") + F.col("part")).alias("before")))
    inside = Window.partitionBy("range").orderBy("at", "source", "a").rowsBetween(Window.unboundedPreceding, -1)
    pieces = cut(True).withColumn("inside", F.coalesce(F.sum("length").over(inside), F.lit(0)))
    return pieces.join(before, "range").select("doc_id", "source", "lane", (F.col("before") + F.col("inside")).alias("place"), "first", F.col("length").alias("n"),
                                               "doc_tokens", F.col("piece").alias("ids"))


def pack(docs: DataFrame, tokenizer: str, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         window: int = WINDOW, grain: int = GRAIN, queues: int = QUEUES, target: dict[str, float] | None = None) -> DataFrame:
    """Pieces of all documents in windows of ``window`` ids: doc_id, source, start, length, doc_tokens, sequence_id, offset, ids.

    ``target`` gives the weight of each source in a window; sources that it does not name share the weight under the
    key None (default 1) by their numbers of ids. ``queues`` bounds the queues of sources without a target. Without
    ``target`` the shares are those of the whole corpus, so every window down to the last has the corpus' mixture. ``ids`` is little-endian uint32 binary.

    Defined results: a null text is empty and is just its end id (without end id it has no piece); a null source is
    the source ''; repeated rows are packed each; an empty table gives no rows; other columns are ignored.
    """
    docs = columns(docs, doc_id=id_col, text=text_col, source=source_col)
    docs = docs.withColumn("source", F.coalesce(F.col("source").cast("string"), F.lit("")))
    ids = encoded(docs, tokenizer, end_id)
    offsets = written(queue_offsets(ids, queues, [x for x in target or {} if x is not None]), "packing_offsets")
    # at most ``queues`` rows and those of ``target``
    lanes = offsets.select("lane", "source", "total").distinct().groupBy("lane").agg(F.sum("total").alias("total")).collect()
    lanes = sorted(((r["lane"], r["total"]) for r in lanes if r["total"]), key=lambda x: (x[0] is None, x[0] or ""))
    target = {None: 1.0} if target is None else target
    robin = RoundRobin([t for _, t in lanes], exact_weights(lanes, target), window, grain)
    number = {name: k for k, (name, _) in enumerate(lanes)}
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for b in batches:
            col = {name: b.column(k) for k, name in enumerate(b.schema.names)}
            size = col["n"].to_numpy()
            if not (size > 0).any():
                continue
            place, first = col["place"].to_numpy(), col["first"].to_numpy()
            queue = np.array([number.get(x, 0) for x in col["lane"].to_pylist()], np.int64)
            full = np.flatnonzero(size)
            doc, start, length, at = robin.pieces(queue[full], place[full], size[full])
            doc = full[doc]
            flat, _ = flat_numbers(col["ids"], "<u4")
            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays([col["doc_id"].take(take), col["source"].take(take), pa.array(start + first[doc]), pa.array(length), col["doc_tokens"].take(take),
                                              pa.array(at // window), pa.array(at % window), binary_pieces(flat, length)],
                                             ["doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    # the offsets were written, so Spark knows their size and broadcasts them only below its own threshold
    placed = (ids.join(offsets, ["part", "source"]).withColumn("place", F.col("local") + F.col("base"))
              .withColumn("first", F.lit(0).cast("long")).withColumn("doc_tokens", F.col("n")))
    out = placed.where("lane is not null").select(*_PLACED)
    if None in number:
        out = out.unionByName(shared_pieces(placed.where("lane is null"), dict(lanes)[None], grain).select(*_PLACED))
    return out.mapInArrow(cut, f"doc_id {id_type}, source string, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")

"""Operator 5, n-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of five-word shingles (64-bit hashes). Documents with equal sets are one representative with a
number of copies. Two representatives are linked if their Jaccard similarity is at least 0.8.

1. Every task sketches its documents: set fingerprint, 128 MinHash values. Banding (32 bands of 4 values) finds the
   candidates; a pair at the threshold is missed by all bands with probability 5e-8.
2. Each representative belongs to one chunk: the home that most members of its largest bucket have, split into parts
   of about ``CHUNK`` documents. A bucket makes candidates of the pairs of chunks that its members lie in, so a large
   group becomes many small chunk pairs, each of them once, whatever the number of bands its members share.
3. A chunk pair is one group: MinHash values are compared ``STEP`` at a time, a pair is dropped as soon as the posterior
   probability (uniform prior) of reaching the threshold falls below ``TOLERANCE``, and the rest is verified exactly on
   the shingle sets. The group returns a link count per document and a spanning forest of its links, not the pairs.
4. Forests of all groups become classes by connected components.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duotower.llm.common import columns, text_slices, written
from duotower.llm.components import components
from duotower.llm.decontaminate import words_of
from duotower.operators.skew import skew_left_join

WIDTH = 5
THRESHOLD = (4, 5)          # as a fraction, so the exact test stays in integers
HASHES, ROWS = 128, 4
STEP = 16
TOLERANCE = 1e-9
CHUNK = 256                 # documents in a part of a bucket
CHUNK_SHINGLES = 1 << 21    # and about as many shingles

_U = np.uint64
_MULTIPLIERS = (np.random.default_rng(20240501).integers(1 << 62, size=HASHES, dtype=np.uint64) << _U(1)) | _U(1)
_SPREAD = _U(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


class Shingler:
    """Shingle hashes of texts; word hashes are kept in a table of bounded size."""

    def __init__(self, bound: int = 1_000_000):
        self.known: dict[bytes, int] = {}
        self.bound = bound

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All shingle hashes in one array, and how many each text has. Under five words: one shingle of them all."""
        from xxhash import xxh64_intdigest

        if len(self.known) > self.bound:
            self.known.clear()
        words, sizes = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            own = words_of(text)
            sizes[i] = len(own)
            words += own
        for w in set(words).difference(self.known):
            self.known[w] = xxh64_intdigest(w)
        h = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        ends = np.cumsum(sizes)
        count = np.where(sizes >= WIDTH, sizes - WIDTH + 1, np.minimum(sizes, 1))
        first = np.repeat(ends - sizes, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        own = np.repeat(np.minimum(sizes, WIDTH), count)
        out = np.zeros(len(first), np.uint64)
        padded = np.concatenate([h, np.zeros(WIDTH, np.uint64)])
        for k in range(WIDTH):
            out = np.where(own > k, out * _SPREAD + padded[first + k], out)
        return _mix(out + own.astype(np.uint64)), count


_SHINGLER = Shingler()


def min_hashes(shingles: np.ndarray, count: np.ndarray) -> np.ndarray:
    """(texts with shingles) x HASHES matrix of uint32 minima."""
    full = count[count > 0]
    starts = np.cumsum(full) - full
    out = np.empty((len(full), HASHES), np.uint32)
    if len(full):
        v = np.empty_like(shingles)
        for k in range(HASHES):
            np.multiply(shingles, _MULTIPLIERS[k], out=v)
            out[:, k] = np.minimum.reduceat(v.view(np.uint32)[1::2], starts)    # the high half (little-endian)
    return out


def sketch(docs: DataFrame) -> DataFrame:
    """(uid, doc_id, text, fp, n, sig): row number, set fingerprint, distinct shingles, MinHash values; written as a table."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        row = TaskContext.get().partitionId() << 33
        for batch, texts in text_slices(batches, max_bytes=512 << 10):
            shingles, count = _SHINGLER(texts)
            sig = iter(min_hashes(shingles, count))
            at, fps, sizes, sigs = 0, [], [], []
            for n in count.tolist():
                own = np.unique(shingles[at:at + n])
                at += n
                sizes.append(len(own))
                fps.append(own.sum(dtype=np.uint64).tobytes() + _mix(own + _SPREAD).sum(dtype=np.uint64).tobytes() if n else None)
                sigs.append(next(sig).tobytes() if n else None)
            n = batch.num_rows
            col = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + n)), col["doc_id"], col["text"], pa.array(fps, pa.binary()),
                                              pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary())], ["uid", "doc_id", "text", "fp", "n", "sig"])
            row += n

    return written(docs.mapInArrow(run, f"uid long, doc_id {id_type}, text string, fp binary, n long, sig binary"), "near_sketch")


def band_rows(sigs: DataFrame) -> DataFrame:
    """(key, rid): one row per band of every signature."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(b.num_rows, HASHES)
            key = np.zeros((b.num_rows, HASHES // ROWS), np.uint64) + np.arange(HASHES // ROWS, dtype=np.uint64)
            for k in range(ROWS):
                key = _mix(key * _SPREAD + sig[:, k::ROWS])
            rid = np.repeat(b.column(0).to_numpy(), HASHES // ROWS)
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(rid)], ["key", "rid"])

    return sigs.mapInArrow(run, "key long, rid long")


@lru_cache
def least_agreement(tolerance: float) -> tuple[int, ...]:
    """For m = STEP, 2 STEP, ... compared values: the fewest agreements whose posterior is not below the tolerance.

    With a uniform prior and ``a`` of ``m`` values equal, P(J >= t) = P(Binomial(m + 1, t) <= a).
    """
    t = THRESHOLD[0] / THRESHOLD[1]
    out = []
    for m in range(STEP, HASHES + 1, STEP):
        total, a = 0.0, -1
        while total < tolerance and a < m:
            a += 1
            total += math.comb(m + 1, a) * t ** a * (1 - t) ** (m + 1 - a)
        out.append(a)
    return tuple(out)


def surviving_pairs(left: np.ndarray, right: np.ndarray, same: bool, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two signature matrices that are not pruned; of one matrix with itself, pairs i < j."""
    need = least_agreement(tolerance)
    agree = np.zeros((len(left), len(right)), np.uint16)
    for k in range(STEP):
        agree += left[:, k][:, None] == right[:, k][None, :]
    keep = agree >= need[0]
    if same:
        keep &= np.triu(np.ones_like(keep), 1)
    i, j = np.nonzero(keep)
    a = agree[i, j].astype(np.int64)
    for step in range(1, len(need)):
        if not len(i):
            break
        cols = slice(step * STEP, (step + 1) * STEP)
        size = 1 << 16
        a = np.concatenate([a[s:s + size] + (left[i[s:s + size], cols] == right[j[s:s + size], cols]).sum(1) for s in range(0, len(i), size)])
        on = a >= need[step]
        i, j, a = i[on], j[on], a[on]
    return i, j


def common_shingles(sets_a: list[np.ndarray], sets_b: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact intersection sizes of set pairs (i of a, j of b)."""
    if len(i) <= 4 * (len(sets_a) + len(sets_b)):
        return np.array([len(np.intersect1d(sets_a[x], sets_b[y], assume_unique=True)) for x, y in zip(i.tolist(), j.tolist())], np.int64)
    # many pairs: incidence matrices over the shingles that both sides have, a block of shingles at a time
    flat_a, flat_b = np.concatenate(sets_a), np.concatenate(sets_b)
    shared = np.intersect1d(flat_a, flat_b)
    total = np.zeros((len(sets_a), len(sets_b)), np.float32)      # whole numbers, exact below 2**24 (a block is added at a time)
    exact = np.zeros(total.shape, np.int64)

    def entries(sets, flat):
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        col = np.searchsorted(shared, flat)
        on = (col < len(shared)) & (shared[np.minimum(col, max(0, len(shared) - 1))] == flat) if len(shared) else np.zeros(len(flat), bool)
        order = np.argsort(col[on], kind="stable")
        return row[on][order], col[on][order]

    (ra, ca), (rb, cb) = entries(sets_a, flat_a), entries(sets_b, flat_b)
    size = 4096
    for s in range(0, len(shared), size):
        a = np.zeros((len(sets_a), size), np.float32)
        b = np.zeros((len(sets_b), size), np.float32)
        for m, r, c in ((a, ra, ca), (b, rb, cb)):
            lo, hi = np.searchsorted(c, (s, s + size))
            m[r[lo:hi], c[lo:hi] - s] = 1
        exact += (a @ b.T).astype(np.int64)
    return exact[i, j]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least index of each index' component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            return root


def verify(rows: pa.Table, tolerance: float = TOLERANCE) -> pa.Table:
    """A chunk pair: link counts (copies included) and the spanning forest of its links, by representative."""
    col = {name: rows.column(name) for name in rows.column_names}
    rid = col["rid"].to_numpy()
    order = np.argsort(rid)
    rid, side, copies = rid[order], col["side"].to_numpy()[order], col["copies"].to_numpy()[order]
    sig = np.frombuffer(b"".join(col["sig"].to_pylist()), np.uint32).reshape(len(rid), HASHES)[order]
    texts = col["text"].to_pylist()
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1)
    same = not len(right)
    if same:
        right = left
    i, j = surviving_pairs(sig[left], sig[right], same, tolerance)
    needed = set(left[i].tolist()) | set(right[j].tolist())
    sets = [None] * len(rid)
    for k in needed:
        shingles, _ = _SHINGLER([texts[order[k]]])
        sets[k] = np.unique(shingles)
    empty = np.zeros(0, np.uint64)
    inter = common_shingles([sets[k] if sets[k] is not None else empty for k in left], [sets[k] if sets[k] is not None else empty for k in right], i, j)
    i, j = left[i], right[j]
    sizes = np.array([0 if s is None else len(s) for s in sets], np.int64)
    num, den = THRESHOLD
    ok = den * inter >= num * (sizes[i] + sizes[j] - inter)
    i, j = i[ok], j[ok]
    links = np.zeros(len(rid), np.int64)
    np.add.at(links, i, copies[j])
    np.add.at(links, j, copies[i])
    root = rid[_roots(len(rid), i, j)]
    on = links > 0
    return pa.table({"rid": rid[on], "links": links[on], "root": root[on]})


def _join(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """A join whose both sides grow with the data: always by a shuffle, so the plan is the same at every size."""
    return left.join(right.hint("merge"), on, how)


def near_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tolerance: float = TOLERANCE, chunk: int = CHUNK) -> DataFrame:
    """One row per document: id, class_id, n_links.

    ``class_id`` is the least id of the document's class (nulls last); a class is a connected group of documents linked
    at a similarity of 0.8 or more. ``n_links`` counts the linked documents, copies included. Words are lower-cased
    (A-Z) runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``; a text of one to four words is one shingle.

    Defined results: null and wordless texts are classes of their own without links; repeated rows are copies of each
    other; an empty table gives no rows; other columns are ignored.
    """
    docs = columns(docs, doc_id=id_col, text=text_col)
    base = sketch(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id")))
    reps = written(base.where("n > 0").groupBy("fp").agg(F.min("uid").alias("rid"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"),
                                                          first.alias("first")), "near_reps")
    sigs = _join(base.select(F.col("uid").alias("rid"), "sig"), reps.select("rid"), "rid", "left_semi")
    bands = written(band_rows(sigs), "near_bands")
    sizes = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    # a band key, and the home below, can hold a third of all rows: such keys are joined apart, dealt evenly
    members = written(skew_left_join(bands, "key", sizes, "key", "found").where(F.col("found").isNotNull())
                      .select(*bands.columns, F.col("found.size").alias("size")), "near_members")

    # first the largest bucket; then what most members of that bucket chose, so that one group is not cut into many homes
    first_home = written(members.groupBy("rid").agg(F.max(F.struct("size", "key"))["key"].alias("key")), "near_first")
    votes = _join(members.select("key", "rid"), first_home.withColumnRenamed("key", "home"), "rid").groupBy("key", "home").count()
    chosen = votes.groupBy("key").agg(F.max(F.struct("count", "home"))["home"].alias("home"))
    moved = skew_left_join(first_home, "key", chosen, "key", "found").select("rid", F.col("found.home").alias("home"))
    homes = written(_join(moved, reps.select("rid", "n", "copies"), "rid"), "near_homes")
    parts = homes.groupBy("home").agg(F.greatest(F.ceil(F.count(F.lit(1)) / chunk), F.ceil(F.sum("n") / CHUNK_SHINGLES)).alias("parts"))
    cut = skew_left_join(homes, "home", parts.where("parts > 1"), "home", "found")
    chunks = written(cut.select("rid", "copies", F.xxhash64("home", F.pmod(F.xxhash64("rid"), F.coalesce("found.parts", F.lit(1).cast("long")))).alias("chunk")), "near_chunks")

    met = _join(members, chunks, "rid").select("key", "chunk").distinct()
    pairs = (_join(met.select("key", F.col("chunk").alias("a")), met.select("key", F.col("chunk").alias("b")), "key").where("a <= b")
             .select("a", "b").distinct())
    sides = pairs.select("a", "b", F.explode(F.when(F.col("a") == F.col("b"), F.array(F.struct(F.col("a").alias("chunk"), F.lit(0).alias("side"))))
                                             .otherwise(F.array(F.struct(F.col("a").alias("chunk"), F.lit(0).alias("side")),
                                                                F.struct(F.col("b").alias("chunk"), F.lit(1).alias("side"))))).alias("s"))
    sides = sides.select("a", "b", "s.chunk", "s.side")
    payload = _join(base.select(F.col("uid").alias("rid"), "text", "sig"), chunks, "rid")
    checked = (_join(sides, payload, "chunk").groupBy("a", "b")
               .applyInArrow(lambda t: verify(t.select(["rid", "side", "copies", "sig", "text"]), tolerance), "rid long, links long, root long"))
    checked = written(checked, "near_links")

    classes = components(checked.select(F.col("rid").alias("a"), F.col("root").alias("b")))
    linked = reps.join(checked.groupBy("rid").agg(F.sum("links").alias("links")), "rid", "left").join(
        classes.withColumnRenamed("node", "rid"), "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    named = linked.groupBy("component").agg(F.min("first").alias("class"))
    info = linked.join(named, "component").select("fp", F.col("class.id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                                                  F.lit(True).alias("found"))
    # a wordless document has no fingerprint: its row number spreads such rows, and it meets nothing
    key = F.coalesce("fp", F.col("uid").cast("string").cast("binary"))
    out = _join(base.select("doc_id", key.alias("fp")), info, "fp", "left")
    return out.select("doc_id", F.when(F.col("found"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))

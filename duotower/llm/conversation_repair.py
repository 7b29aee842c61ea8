"""Operator 12: damaged conversations, audited and repaired at least cost by iterative-deepening A*.

``damage`` harms rows by a checksum of (conv_id, turn); ``repair`` counts faults and finds, for every conversation, the
cheapest edits after which the role initials read ``(s?(ua)+)?``. The search walks the turns depth first, trying the
edits in ASCII order (Delete, Insert, Keep, Rerole) under a cost bound that rises to the least cost that broke it. A
transposition table keeps, for every failed (turn, state), the least cost that is still possible from there; the first
accepting path is therefore the cheapest one and, among those, the ASCII-least. The first estimate of a (turn, state)
adds up faulty rows and disjoint neighbours that cannot both stay (``lower_bounds``; it never exceeds the true cost).

The steps, none of which needs a conversation in one place:

1. Rows are range-partitioned and sorted by conversation, turn (nulls first), role, the text's first 64 characters and
   its hash (this defines the order of rows of one turn), numbered and written.
2. A row is a duplicate if it is not the first of its (conversation, role, text); the firsts are a map-side combined
   minimum and meet the rows by their unique number.
3. Blocks of ``2**BLOCK_BITS`` rows are searched independently. A run of one conversation inside a block is searched
   once; a run at a block's edge may go on in the next block, so it is searched from every state to every state (4 x 4).
4. Runs of one conversation are put together by a tree with a fan of ``FAN``: (cost, rank of the edit string) per pair of
   states is enough to choose, and the choice is handed down the tree again.
5. The chosen edits meet the texts by block. What a block holds of a longer conversation is one piece of repaired text,
   hashed in a stream by order; only this hash (SHA-256 is sequential) and the audit string are per conversation.

Results for special cases: nulls of every column count as one space in checks and hashes, but a null turn sorts first and is
left out of ``gaps``, and null ``conv_id`` is a conversation of its own. Rows of equal turn stand in the order above; equal
rows are duplicates of the first. A role's initial is its first character; an empty role has none, so it can be kept
anywhere, but counts as illegal next to any row. A conversation without rows after damage has zeros, an empty audit and
the hash of the empty text. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from duotower.llm.common import columns, written
from duotower.session import default_parallelism

BLOCK_BITS = 8
FAN = 256
PIECE_BYTES = 1 << 20

DELETE, INSERT, KEEP, REROLE = "DIKR"               # in ASCII order
COST_DELETE, COST_INSERT, COST_REROLE, COST_TRUNCATED = 2, 5, 1, 5
OK, BLANK, DUPLICATE, TRUNCATED = range(4)
START, SYSTEM, USER, ASSISTANT = range(4)           # states: what the last kept row was
NEXT = (USER, USER, ASSISTANT, USER)                # the state after a user or assistant row that fits
KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
ROLE = {USER: "user", ASSISTANT: "assistant"}
REACHES = ({0, 1, 2, 3}, {1, 2, 3}, {2, 3}, {2, 3})
END_INSERTS = (0, 2, 1, 0)                          # rows to insert after the last one, from each state
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
NEVER = 1 << 60


# ---------------------------------------------------------------- damage and order (native)

def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, alive): a dropped row stays as one that is not alive, so that its conversation is known."""
    src = columns(conversations, conv_id="conv_id", turn="turn", role="role", text="text")

    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    text = (F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(plain("text"), ".!?", "")).otherwise(plain("text")))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (src.withColumn("kind", kind).withColumn("copy", F.explode(copies))
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(plain("role")).alias("role"), text.alias("text"),
                    (F.col("kind") != 0).alias("alive")))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` in their order with a rising number ``pos`` (a block's numbers share their upper bits), written."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", F.substring("text", 1, 64),
             F.xxhash64("text"), "row"]
    ranged = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    return written(ranged.drop("row").withColumn("pos", F.monotonically_increasing_id()), "conversation_rows")


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, pos, alive, initial, fault) of numbered rows, written."""
    space = F.lit(" \t\n\x0b\x0c\r")
    last = F.substring(F.rtrim("text", space), -1, 1)
    key = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    narrow = rows.select("conv_id", "turn", "pos", "alive", F.substring("role", 1, 1).alias("initial"), key.alias("key"),
                         (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"))
    firsts = (narrow.where("alive").groupBy("conv_id", "key").agg(F.min("pos").alias("pos"))
              .select("pos", F.lit(True).alias("first")))
    fault = (F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), DUPLICATE).when(F.col("cut"), TRUNCATED).otherwise(OK))
    return written(narrow.join(firsts, "pos", "left").select("conv_id", "turn", "pos", "alive", "initial", fault.alias("fault")),
                   "conversation_faults")


# ---------------------------------------------------------------- the search

def lower_bounds(rows: list[tuple[str, int]], ends: set[int], trailing: bool) -> list[list[int]]:
    """For every turn and state, a cost that any way from there to a state of ``ends`` takes at least.

    Faulty rows cost a deletion. Of two neighbours (faulty and empty-role rows passed over) that may not follow each
    other one costs something; a row used by such a pair, or one that can never stay, is not used again. Where only
    START or SYSTEM is wanted, all else must be deleted.
    """
    n = len(rows)
    if ends <= {START, SYSTEM} and not trailing:
        end, = ends
        table = [[NEVER] * 4 for _ in range(n + 1)]
        table[n][end] = 0
        for i in range(n - 1, -1, -1):
            initial, fault = rows[i]
            keep = NEVER if fault in (BLANK, DUPLICATE) else COST_TRUNCATED if fault == TRUNCATED else 0
            drop = min(COST_DELETE, keep if initial == "" else NEVER)
            table[i][START] = table[i + 1][START] + drop if end == START else min(
                table[i + 1][START] + drop, table[i + 1][SYSTEM] + keep if initial == "s" else NEVER)
            table[i][SYSTEM] = table[i + 1][SYSTEM] + drop
        return table
    free = 4                                            # the row before was used up: no state to compare with
    after = [0 if q in ends else 1 for q in range(4)] + [0]
    table = [after]
    for initial, fault in reversed(rows):
        if fault != OK:
            now = [c + COST_DELETE for c in after]
        elif initial == "":
            now = after
        else:
            to = {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(initial)
            now = []
            for q in range(5):
                fits = to is not None and (KEPT[q].get(initial) == to if q < 4 else initial != "s")
                now.append(after[to] if fits else 1 + after[free])
        table.append(now)
        after = now
    return table[::-1]


def search(rows: list[tuple[str, int]], start: int, ends: set[int], trailing: bool) -> tuple[int, str] | None:
    """Least cost and ASCII-least edits of the rows (initial, fault) from ``start`` to a state of ``ends``, by IDA*.

    ``trailing`` allows insertions after the last row. None if there is no way.
    """
    n = len(rows)
    alive = [any(e in REACHES[q] for e in ends) for q in range(4)]
    estimate = lower_bounds(rows, ends, trailing)
    raised: dict[tuple[int, int], int] = {}             # failed states: a cost they need at least
    path: list[str] = []

    def visit(i: int, q: int, left: int) -> int:
        """-1 if the end is reached within ``left`` (edits go to ``path``, last first), else a cost above ``left`` that is needed."""
        need = raised.get((i, q))
        if need is None:
            need = estimate[i][q] if alive[q] else NEVER
        if need > left:
            return need
        if i == n and q in ends:
            return -1
        need = NEVER
        for edit, j, to, cost in moves(i, q):
            more = visit(j, to, left - cost)
            if more < 0:
                path.append(edit)
                return -1
            need = min(need, more + cost)
        raised[i, q] = need
        return need

    def moves(i: int, q: int) -> Iterator[tuple[str, int, int, int]]:
        if i == n:
            if trailing:
                yield INSERT, i, NEXT[q], COST_INSERT
            return
        initial, fault = rows[i]
        yield DELETE, i + 1, q, COST_DELETE
        yield INSERT, i, NEXT[q], COST_INSERT
        if fault in (OK, TRUNCATED):
            extra = COST_TRUNCATED if fault == TRUNCATED else 0
            to = q if initial == "" else KEPT[q].get(initial)
            if to is not None:
                yield KEEP, i + 1, to, extra
            yield REROLE, i + 1, NEXT[q], COST_REROLE + extra

    bound = estimate[0][start] if alive[start] else NEVER
    while bound < NEVER:
        need = visit(0, start, bound)
        if need < 0:
            return bound, "".join(reversed(path))
        bound = need
    return None


# ---------------------------------------------------------------- runs of one conversation

RUNS = ("conv_id {id}, block long, pos long, open boolean, first string, last string, illegal long, cost long, audit string, "
        "costs array<long>, ranks array<int>, audits array<string>")


def _streamed(batches: Iterator[pa.RecordBatch], key) -> Iterator[list[dict]]:
    """Lists of consecutive rows of equal key. A list has as many rows as a group, which callers bound."""
    group, at = [], None
    for batch in batches:
        for row in batch.to_pylist():
            k = key(row)
            if group and k != at:
                yield group
                group = []
            at = k
            group.append(row)
    if group:
        yield group


def _table(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _batched(rows: Iterator[dict], schema: pa.Schema, size: int = 1024) -> Iterator[pa.RecordBatch]:
    out = []
    for row in rows:
        out.append(row)
        if len(out) == size:
            yield _table(out, schema)
            out = []
    if out:
        yield _table(out, schema)


def search_runs(narrow: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """A row per run of a conversation in a block: the result of inner runs, all 16 results of runs at the block's edges."""
    ddl = RUNS.format(id=narrow.schema["conv_id"].dataType.simpleString())
    schema = _arrow(ddl)

    def results(batches):
        for block in _streamed(batches, lambda r: r["block"]):
            starts = [i for i, r in enumerate(block) if not i or r["conv_id"] != block[i - 1]["conv_id"]] + [len(block)]
            for lo, hi in zip(starts[:-1], starts[1:]):
                yield _run(block[lo:hi], lo == 0 or hi == len(block))

    rows = (narrow.where("alive").select("conv_id", F.shiftright("pos", block_bits).alias("block"), "pos", "initial", "fault")
            # few bytes, much work: a fixed number of tasks, as small partitions would be put together by size
            .repartition(default_parallelism(narrow.sparkSession), "block").sortWithinPartitions("block", "pos"))
    return written(rows.mapInArrow(lambda batches: _batched(results(batches), schema), ddl), "conversation_runs")


def _run(run: list[dict], edge: bool) -> dict:
    rows = [(r["initial"], r["fault"]) for r in run]
    out = {"conv_id": run[0]["conv_id"], "block": run[0]["block"], "pos": run[0]["pos"], "open": edge, "first": rows[0][0],
           "last": rows[-1][0], "illegal": sum((a[0], b[0]) not in LEGAL for a, b in zip(rows, rows[1:]))}
    if not edge:
        out["cost"], out["audit"] = search(rows, START, {START, ASSISTANT}, True)
        return out
    found = [search(rows, q, {e}, False) for q in range(4) for e in range(4)]
    out["costs"] = [None if f is None else f[0] for f in found]
    out["audits"] = [None if f is None else f[1] for f in found]
    out["ranks"] = _ranks(out["audits"])
    return out


def _ranks(keys: list) -> list:
    """Rank of every key among those of its start state (None: no way)."""
    out = [None] * 16
    for q in range(4):
        for rank, e in enumerate(sorted((e for e in range(4) if keys[4 * q + e] is not None), key=lambda e: keys[4 * q + e])):
            out[4 * q + e] = rank
    return out


def chains(nodes: list[dict], start: int) -> dict[int, tuple[int, tuple, tuple]]:
    """Per end state the best way through consecutive nodes: (cost, ranks, states passed).

    Ways of equal cost compare by their ranks: up to the first difference the edits, hence the states, are the same.
    """
    best = {start: (0, (), (start,))}
    for node in nodes:
        step: dict[int, tuple[int, tuple, tuple]] = {}
        for q, (cost, ranks, states) in best.items():
            for e in range(4):
                more = node["costs"][4 * q + e]
                if more is not None:
                    way = (cost + more, ranks + (node["ranks"][4 * q + e],), states + (e,))
                    if e not in step or way < step[e]:
                        step[e] = way
        best = step
    return best


def _joined(nodes: list[dict]) -> dict:
    """Several consecutive nodes as one."""
    costs, keys = [None] * 16, [None] * 16
    for q in range(4):
        for e, (cost, ranks, _) in chains(nodes, q).items():
            costs[4 * q + e], keys[4 * q + e] = cost, ranks
    return {"costs": costs, "ranks": _ranks(keys), "illegal": _illegal(nodes), "first": nodes[0]["first"], "last": nodes[-1]["last"]}


def _illegal(nodes: list[dict]) -> int:
    return sum(n["illegal"] for n in nodes) + sum((a["last"], b["first"]) not in LEGAL for a, b in zip(nodes, nodes[1:]))


NODES = "conv_id {id}, node long, first string, last string, illegal long, costs array<long>, ranks array<int>"
CHOICES = "conv_id {id}, node long, begin int, finish int, illegal long, cost long, tail string"


def choose(open_runs: DataFrame, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """For runs at block edges: the states (conv_id, node = block, begin, finish) each is passed by, and a row per
    conversation (conv_id, cost, illegal, tail)."""
    id_type = open_runs.schema["conv_id"].dataType.simpleString()
    nodes_ddl, choices_ddl = NODES.format(id=id_type), CHOICES.format(id=id_type)
    nodes_schema, choices_schema = _arrow(nodes_ddl), _arrow(choices_ddl)
    names = [f.name for f in nodes_schema]

    def by_group(df: DataFrame, fn, schema: pa.Schema, ddl: str) -> DataFrame:
        ordered = df.repartition("conv_id", "parent").sortWithinPartitions("conv_id", "parent", "node")

        def run(batches):
            groups = _streamed(batches, lambda r: (r["conv_id"], r["parent"]))
            return _batched((row for group in groups for row in fn(group)), schema)

        return ordered.mapInArrow(run, ddl)

    def up(group):
        yield _joined(group) | {"conv_id": group[0]["conv_id"], "node": group[0]["parent"]}

    def root(group):
        ways = {e: (cost + COST_INSERT * END_INSERTS[e], ranks, states) for e, (cost, ranks, states) in chains(group, START).items()}
        cost, _, states = min(ways.values())
        yield from _passed(group, states)
        yield {"conv_id": group[0]["conv_id"], "cost": cost, "illegal": _illegal(group), "tail": INSERT * END_INSERTS[states[-1]]}

    def down(group):
        parent = next(r for r in group if r["begin"] is not None)
        children = [r for r in group if r["begin"] is None]
        _, _, states = chains(children, parent["begin"])[parent["finish"]]
        yield from _passed(children, states)

    def _passed(nodes, states):
        for node, begin, finish in zip(nodes, states, states[1:]):
            yield {"conv_id": node["conv_id"], "node": node["node"], "begin": begin, "finish": finish}

    shift = fan.bit_length() - 1
    levels = [open_runs.withColumnRenamed("block", "node").select(*names)]
    while (levels[-1].groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0) > fan:
        level = levels[-1].withColumn("parent", F.shiftright("node", shift))
        levels.append(written(by_group(level, up, nodes_schema, nodes_ddl), "conversation_nodes"))
    top = written(by_group(levels[-1].withColumn("parent", F.lit(0).cast("long")), root, choices_schema, choices_ddl), "conversation_choices")
    whole, passed = top.where(F.col("node").isNull()), top.where(F.col("node").isNotNull()).select("conv_id", "node", "begin", "finish")
    for level in reversed(levels[:-1]):
        none = F.lit(None).cast("int")
        children = level.withColumn("parent", F.shiftright("node", shift)).select("*", none.alias("begin"), none.alias("finish"))
        parents = passed.select("conv_id", F.lit(None).cast("long").alias("node"), F.col("node").alias("parent"), "begin", "finish")
        both = children.unionByName(parents, allowMissingColumns=True)
        passed = written(by_group(both, down, choices_schema, choices_ddl).select("conv_id", "node", "begin", "finish"), "conversation_choices")
    return passed, whole.select("conv_id", "cost", "illegal", "tail")


# ---------------------------------------------------------------- repaired texts

PIECES = "conv_id {id}, pos long, part int, open boolean, sha256 string, piece binary"


def repaired_pieces(rows: DataFrame, edits: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Edits (conv_id, block, pos, open, audit, begin) applied to the numbered rows: the hash of a run that is a whole conversation,
    else its repaired rows, each after a line end, in pieces of about ``PIECE_BYTES``."""
    ddl = PIECES.format(id=rows.schema["conv_id"].dataType.simpleString())
    schema = _arrow(ddl)

    def results(batches):
        run = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["audit"] is not None:
                    if run is not None:
                        yield from run.finish()
                    run = _Repair(row)
                else:
                    yield from run.row(row["role"], row["text"])
        if run is not None:
            yield from run.finish()

    block = F.shiftright("pos", block_bits).alias("block")
    none = F.lit(None).cast("string")
    texts = rows.where("alive").select(block, "pos", F.lit(1).alias("kind"), "conv_id", "role", "text", F.lit(None).cast("boolean").alias("open"),
                                       none.alias("audit"), F.lit(None).cast("int").alias("begin"))
    heads = edits.select(block, "pos", F.lit(0).alias("kind"), "conv_id", none.alias("role"), none.alias("text"), "open", "audit", "begin")
    both = texts.unionByName(heads).repartition("block").sortWithinPartitions("block", "pos", "kind")
    return both.mapInArrow(lambda batches: _batched(results(batches), schema, 16), ddl)


class _Repair:
    """One run in the making."""

    def __init__(self, head: dict):
        self.head, self.edits, self.state = head, iter(head["audit"]), head["begin"]
        self.lines, self.size, self.part, self.hash, self.some = [], 0, 0, hashlib.sha256(), False

    def row(self, role: str, text: str):
        for edit in self.edits:
            if edit == INSERT:
                self._insert()
                continue
            if edit == KEEP:
                self.state = self.state if role == "" else KEPT[self.state][role[0]]
                self._add(f"{role}:{text}")
            elif edit == REROLE:
                self.state = NEXT[self.state]
                self._add(f"{ROLE[self.state]}:{text}")
            break
        if self.size > PIECE_BYTES:
            yield from self._flush()

    def _insert(self):
        self.state = NEXT[self.state]
        self._add(f"{ROLE[self.state]}:")

    def _add(self, line: str):
        self.lines.append(line.encode())
        self.size += len(self.lines[-1])

    def _flush(self):
        data = b"".join(b"\n" + line for line in self.lines)
        self.lines, self.size = [], 0
        if self.head["open"]:
            if data:
                yield {"conv_id": self.head["conv_id"], "pos": self.head["pos"], "part": self.part, "open": True, "piece": data}
                self.part += 1
        elif data:
            self.hash.update(data if self.some else data[1:])
            self.some = True

    def finish(self):
        for _ in self.edits:            # what is left are insertions after the last row
            self._insert()
        yield from self._flush()
        if not self.head["open"]:
            yield {"conv_id": self.head["conv_id"], "pos": self.head["pos"], "part": 0, "open": False, "sha256": self.hash.hexdigest()}


WHOLE = "conv_id {id}, cost long, illegal long, audit string, sha256 string"


def put_together(pieces: DataFrame, edits: DataFrame, whole: DataFrame) -> DataFrame:
    """Conversations over several runs: their audits and pieces, streamed in order (a task holds one piece and the audit)."""
    id_type = pieces.schema["conv_id"].dataType.simpleString()
    ddl = WHOLE.format(id=id_type)
    schema = _arrow(ddl)

    def results(batches):
        one = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    if one is not None:
                        yield _closed(one)
                    one = {"row": row, "audit": [], "hash": hashlib.sha256(), "some": False}
                elif row["kind"] == 1:
                    one["audit"].append(row["audit"])
                else:
                    one["hash"].update(row["piece"] if one["some"] else row["piece"][1:])
                    one["some"] = True
        if one is not None:
            yield _closed(one)

    def _closed(one):
        tail = one["row"]["tail"]
        lines = [b"user:", b"assistant:"][2 - len(tail):]       # what is missing at the end always ends with the assistant
        data = b"".join(b"\n" + line for line in lines)
        one["hash"].update(data if one["some"] else data[1:])
        return {"conv_id": one["row"]["conv_id"], "cost": one["row"]["cost"], "illegal": one["row"]["illegal"],
                "audit": "".join(one["audit"]) + tail, "sha256": one["hash"].hexdigest()}

    heads = whole.select("conv_id", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("pos"), F.lit(0).alias("part"), "cost", "illegal", "tail")
    audits = edits.select("conv_id", F.lit(1).alias("kind"), "pos", F.lit(0).alias("part"), "audit")
    texts = pieces.select("conv_id", F.lit(2).alias("kind"), "pos", "part", "piece")
    all_rows = heads.unionByName(audits, allowMissingColumns=True).unionByName(texts, allowMissingColumns=True)
    return (all_rows.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "pos", "part")
            .mapInArrow(lambda batches: _batched(results(batches), schema), ddl))


def repair(rows: DataFrame, block_bits: int = BLOCK_BITS, fan: int = FAN) -> DataFrame:
    """Audit of every conversation of ``rows`` (conv_id, turn, role, text, alive): conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256."""
    rows = numbered(rows)
    narrow = faults(rows)
    runs = search_runs(narrow, block_bits)
    passed, whole = choose(runs.where("open"), fan)
    inner = runs.where(~F.col("open"))
    # a conversation has one run at a block's edge per block, so (conv_id, node) is unique and no key is hot
    chosen = (runs.where("open").join(passed.withColumnRenamed("conv_id", "conv"), (F.col("block") == F.col("node")) & F.col("conv_id").eqNullSafe(F.col("conv")))
              .select("conv_id", "pos", "open", F.element_at("audits", 4 * F.col("begin") + F.col("finish") + 1).alias("audit"), "begin"))
    edits = inner.select("conv_id", "pos", "open", "audit", F.lit(START).alias("begin")).unionByName(chosen)
    pieces = written(repaired_pieces(rows, edits, block_bits), "conversation_pieces")
    hashes = pieces.where(~F.col("open")).select("conv_id", "pos", "sha256")
    none_long = F.lit(None).cast("long")

    turn = F.when(F.col("alive"), F.col("turn"))

    def count(fault: int) -> Column:
        return F.sum((F.col("alive") & (F.col("fault") == fault)).cast("long"))

    wide = F.expr("try_cast(CAST(max(t) AS DECIMAL(38,0)) - CAST(min(t) AS DECIMAL(38,0)) + 1 - count(DISTINCT t) AS BIGINT)")
    counts = narrow.withColumn("t", turn).groupBy("conv_id").agg(
        F.coalesce(wide, F.when(F.max("t").isNull(), 0)).cast("long").alias("gaps"), count(BLANK).alias("blank"),
        count(DUPLICATE).alias("duplicate"), count(TRUNCATED).alias("truncated"))
    found = (inner.select("conv_id", "cost", "illegal", "audit", F.lit(None).cast("string").alias("sha256"))
             .unionByName(hashes.select("conv_id", none_long.alias("cost"), none_long.alias("illegal"), F.lit(None).cast("string").alias("audit"), "sha256"))
             .unionByName(put_together(pieces.where("open"), edits.where("open"), whole))
             .select("conv_id", *[none_long.alias(c) for c in ("gaps", "blank", "duplicate", "truncated")], "cost", "illegal", "audit", "sha256"))
    all_rows = counts.select("*", none_long.alias("cost"), none_long.alias("illegal"), F.lit(None).cast("string").alias("audit"),
                             F.lit(None).cast("string").alias("sha256")).unionByName(found)
    # three rows per conversation at most: its counts, its search, its hash
    return all_rows.groupBy("conv_id").agg(
        *[F.max(c).alias(c) for c in ("gaps", "blank", "duplicate", "truncated")], F.coalesce(F.max("illegal"), F.lit(0)).alias("illegal"),
        F.coalesce(F.max("cost"), F.lit(0)).alias("cost"), F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("sha256"), F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def audit_conversations(conversations: DataFrame, block_bits: int = BLOCK_BITS, fan: int = FAN) -> DataFrame:
    """``conversations`` damaged, audited and repaired."""
    return repair(damage(conversations), block_bits, fan)

"""Conversation repair: the cheapest edits that make the turns of a conversation legal.

A conversation's rows in order are legal if their role initials read (s?(ua)+)?. Edits: Keep a row (cost 0), give it
the Role user or assistant (1), Delete it (2; blank rows and duplicates must go), Insert an empty turn of user or assistant
(5); a truncated row that stays costs 5 more. The roles asked for next depend on one of four states (nothing yet, after
s, after u, after a), so a row maps the vector of the states' costs-to-go behind it to the vector before it.

Four Russians: less its minimum, such a vector is one of a few dozen (``tables`` finds them all), and so is what BLOCK
rows make of it. The tables hold, for every vector and every block of BLOCK symbols, the vector before the block and the
cost added; a conversation is read backward a block at a time, by lookup. The audit (the edits' initials) is then traced
forward from block to block; a block is expanded backward into the vectors behind each of its rows, and of the edits that
cost least the one with the least letter is taken. Letters decide all that follows (a state asks for one role), so the
audit is the ASCII-least of all cheapest ones.

Spark: equal rows are counted before they move (repeats are deletions). A join with the repeated (conversation, role,
text) digests marks rows seen before; rows are then sorted into ranges of (conversation, turn, ...), so a conversation of
any size is spread over many tasks. A task cuts its range into pieces of at most PIECE rows (or PIECE_BYTES of text).
Conversations that lie whole in a piece are done there. Of the others, each piece yields four costs for each state behind
it (the same tables, started from unit vectors); one small table of these per conversation, a thirtieth of the size of
its audit, gives the vector behind each piece, the pieces map states to states, and a second pass over that table gives
the state before each piece. Then all pieces are traced on their own. Hashing a conversation's whole text is the only step
in order: one task reads the pieces' finished text as a stream.

Defined results: a null role or text is one space (a blank text). Rows are taken by turn, nulls first, then role, then
text in byte order. The first character of a role counts (none, or another one: neither s, u nor a). A null conversation
is a conversation. One of which no row is left has no edits and the hash of the empty text. Other columns are left
behind; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.common import bound_batches, cut, partitions, table

BLOCK = 4
#: rows, and bytes of text, of a piece (one row is never cut)
PIECE = 4096
PIECE_BYTES = 4 << 20
#: code points of a text that help to deal rows to ranges
LEAD = 64
SPACE = " \t\n\x0b\x0c\r"
#: results that are sent on together: conversations, and bytes of their texts
SENT, SENT_BYTES = 500, 8 << 20

INSERT, DELETE, REROLE, TRUNCATED = 5, 2, 1, 5
#: states: nothing yet, after s, after u, after a; the role each one asks for, and the state after it
ASKED = ("user", "user", "assistant", "user")
AFTER = (2, 2, 3, 2)
#: symbols: 0-3 a row with initial s, u, a, other; 4-7 the same, truncated; 8 a row that must go
SYMBOLS, GONE = 9, 8
NEVER = 1 << 40


def closed(costs: list[int]) -> tuple[int, ...]:
    """Costs-to-go per state if turns may be inserted first."""
    out = list(costs)
    for _ in range(3):
        out = [min(out[x], INSERT + out[AFTER[x]]) for x in range(4)]
    return tuple(min(c, NEVER) for c in out)


END = closed([0, NEVER, NEVER, 0])
UNITS = [closed([0 if x == y else NEVER for x in range(4)]) for y in range(4)]


def edits(costs: tuple[int, ...], symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state after) of what can happen to a row, by letter."""
    out = [("D", DELETE + costs[state], state)]
    if symbol != GONE:
        more, initial = TRUNCATED * (symbol >= 4), symbol % 4
        if initial == 0 and state == 0:
            out.append(("K", more + costs[1], 1))
        elif initial == (2 if ASKED[state] == "assistant" else 1):
            out.append(("K", more + costs[AFTER[state]], AFTER[state]))
        out.append(("R", more + REROLE + costs[AFTER[state]], AFTER[state]))
    return out


def before_row(costs: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Costs-to-go before a row, given those behind it."""
    return closed([min(c for _, c, _ in edits(costs, symbol, x)) for x in range(4)])


def normal(costs: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    low = min(costs)
    return tuple(c if c >= NEVER // 2 else c - low for c in costs), low


@dataclass
class Tables:
    vectors: list[tuple[int, ...]]
    number: dict[tuple[int, ...], int]
    step: np.ndarray  # (vector behind a row, symbol): vector before it
    step_cost: np.ndarray
    block: np.ndarray  # the same for blocks, by their symbols as one number
    block_cost: np.ndarray
    traced: dict = field(default_factory=dict)

    def backward(self, symbols: np.ndarray, vector: int) -> tuple[list[int], int, int]:
        """(vectors behind the blocks, from the last one on; vector before all; cost). Blocks are dealt from the end on;
        the rows that make no whole block come first and are stepped over one by one."""
        codes, head = blocks_of(symbols)
        behind, cost = [], 0
        rows, costs = self.block, self.block_cost
        for code in codes[::-1].tolist():
            behind.append(vector)
            cost += int(costs[vector, code])
            vector = int(rows[vector, code])
        for s in head[::-1].tolist():
            cost += int(self.step_cost[vector, s])
            vector = int(self.step[vector, s])
        return behind, vector, cost

    def rows_of(self, symbols: list[int], vector: int, state: int) -> tuple[str, int, int]:
        """(audit, state after, cost) of a block: its rows' vectors from the last one backward, then forward."""
        behind = [vector]
        for s in symbols[:0:-1]:
            behind.append(int(self.step[behind[-1], s]))
        audit, cost = [], 0
        for s, v in zip(symbols, behind[::-1], strict=True):
            costs = self.vectors[v]
            here = before_row(costs, s)
            while True:
                choices = edits(costs, s, state)
                if INSERT + here[AFTER[state]] == here[state]:
                    choices.append(("I", here[state], AFTER[state]))
                letter, to_go, then = min(c for c in choices if c[1] == here[state])
                audit.append(letter)
                if letter != "I":
                    cost += to_go - costs[then]
                    state = then
                    break
                cost += INSERT
                state = then
        return "".join(audit), state, cost

    def trace(self, symbols: np.ndarray, vector: int, state: int) -> tuple[str, int, int]:
        """(audit, state after, cost) of rows, from ``state`` on, with ``vector`` behind them."""
        codes, head = blocks_of(symbols)
        behind, at, _ = self.backward(symbols[len(head):], vector)
        audit, state, cost = self.rows_of(head.tolist(), at, state) if len(head) else ("", state, 0)
        parts = [audit]
        for code, v in zip(codes.tolist(), reversed(behind), strict=True):
            found = self.traced.get((v, code, state))
            if found is None:
                symbols_of = [code // SYMBOLS ** (BLOCK - 1 - i) % SYMBOLS for i in range(BLOCK)]
                found = self.traced[v, code, state] = self.rows_of(symbols_of, v, state)
            parts.append(found[0])
            state = found[1]
            cost += found[2]
        return "".join(parts), state, cost


def blocks_of(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols' blocks, dealt from the end on, as numbers; and the symbols before the first block."""
    head = len(symbols) % BLOCK
    powers = SYMBOLS ** np.arange(BLOCK - 1, -1, -1)
    return symbols[head:].astype(np.int64).reshape(-1, BLOCK) @ powers, symbols[:head]


@cache
def tables() -> Tables:
    """All vectors that any rows can lead to, and the tables over them."""
    vectors, number, steps, costs = [], {}, [], []

    def numbered(v: tuple[int, ...]) -> int:
        if v not in number:
            number[v] = len(vectors)
            vectors.append(v)
        return number[v]

    for v in (END, *UNITS):
        numbered(normal(v)[0])
    while len(steps) < len(vectors):
        found = [normal(before_row(vectors[len(steps)], s)) for s in range(SYMBOLS)]
        costs.append([c for _, c in found])
        steps.append([numbered(v) for v, _ in found])
    step, step_cost = np.array(steps), np.array(costs)
    block, cost = np.arange(len(vectors))[:, None], np.zeros((len(vectors), 1), np.int64)
    for _ in range(BLOCK):  # one more symbol in front of those done
        cost = (cost[:, None, :] + step_cost[block].transpose(0, 2, 1)).reshape(len(vectors), -1)
        block = step[block].transpose(0, 2, 1).reshape(len(vectors), -1)
    return Tables(vectors, number, step, step_cost, block, cost)


def unit_costs(symbols: np.ndarray) -> list[int]:
    """Row-major 4 x 4: the cost from each state before rows to each state behind them."""
    t, out = tables(), np.zeros((4, 4), np.int64)
    for y in range(4):
        vector, low = normal(UNITS[y])
        _, at, cost = t.backward(symbols, t.number[vector])
        out[:, y] = [min(NEVER, c + cost + low) for c in t.vectors[at]]
    return out.ravel().tolist()


# ---- rows of conversations ----

#: what is kept of the rows of a piece
COUNTS = ("blank", "duplicate", "truncated", "illegal")


def initial(role: Column) -> Column:
    """0 to 3: the role begins with s, u, a, or otherwise."""
    first = F.substr(role, F.lit(1), F.lit(1))
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def marked(rows: DataFrame) -> DataFrame:
    """Distinct rows (conv_id, turn, role, text, n) of ``rows`` (the same columns; n: how many copies there are, 0 for a row
    that is no longer there) with symbol and fault of the first copy: none, blank, duplicate or truncated."""
    rows = rows.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
                                            for c in ("role", "text")], "n")
    one = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    one = one.withColumns({"_blank": bare == "", "_end": F.right(bare, F.lit(1)),
                           "_digest": F.sha2(F.concat_ws(":", F.char_length("role"), "role", "text").cast("binary"), 256),
                           "_when": F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"))})
    seen = (one.where("n > 0 and not _blank").groupBy("conv_id", "_digest")
            .agg(F.min("_when").alias("_first"), F.count("*").alias("_c")).where("_c > 1")
            .select(F.col("conv_id").alias("_conv"), F.col("_digest").alias("_d"), "_first"))
    one = one.join(seen, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_digest") == F.col("_d")), "left")
    fault = (F.when(F.col("_blank"), "blank").when(F.col("_when") > F.col("_first"), "duplicate")
             .when(~F.col("_end").isin(".", "!", "?"), "truncated").otherwise("none"))
    start = initial(F.col("role"))
    return (one.withColumn("fault", fault).withColumn("initial", start)
            .withColumn("symbol", F.when(F.col("fault").isin("blank", "duplicate"), GONE)
                        .when(F.col("fault") == "truncated", start + 4).otherwise(start))
            .select("conv_id", "turn", "role", "text", "n", "fault", "initial", "symbol"))


LEGAL = {(0, 1), (1, 2), (2, 1)}


class Piece:
    """Consecutive rows of a conversation."""

    def __init__(self, conv, part: int, seq: int, opened: bool, most: int):
        self.conv, self.part, self.seq, self.whole, self.most = conv, part, seq, not opened, most
        self.counts = dict.fromkeys(COUNTS, 0)
        self.roles, self.texts, self.symbols, self.bytes = [], [], bytearray(), 0
        self.first = self.last = self.low = self.high = None
        self.turns = 0

    def add(self, turn, role: str, text: str, n: int, fault: str, start: int, symbol: int) -> None:
        if not n:
            return
        again = n - 1
        if fault in ("blank", "duplicate"):
            self.counts[fault] += n
        else:
            self.counts["truncated"] += fault == "truncated"
            self.counts["duplicate"] += again
        if self.first is None:
            self.first = start
        elif (self.last, start) not in LEGAL:
            self.counts["illegal"] += 1
        self.last = start
        self.counts["illegal"] += again
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.roles += [role] + [""] * again
        self.texts += [text] + [""] * again
        self.symbols += bytes([symbol]) + bytes([GONE]) * again
        self.bytes += len(text)

    @property
    def full(self) -> bool:
        return len(self.symbols) >= self.most or self.bytes >= PIECE_BYTES

    def head(self) -> dict:
        return {"conv_id": self.conv, "part": self.part, "seq": self.seq, "whole": self.whole, **self.counts,
                "first": self.first, "last": self.last, "low": self.low, "high": self.high, "turns": self.turns}

    def row(self) -> dict:
        symbols = np.frombuffer(bytes(self.symbols), np.uint8)
        if self.whole:
            return {**self.head(), **traced_row(symbols, self.roles, self.texts, tables().number[normal(END)[0]], 0, True)}
        return {**self.head(), "symbols": bytes(self.symbols), "roles": self.roles, "texts": self.texts,
                "costs": unit_costs(symbols)}


def traced_row(symbols: np.ndarray, roles: list[str], texts: list[str], vector: int, state: int, ends: bool) -> dict:
    """cost, audit and the repaired lines of rows."""
    audit, after, cost = tables().trace(symbols, vector, state)
    if ends:  # what is still missing of a last pair
        tail = {0: 0, 3: 0, 2: 1, 1: 2}[after]
        audit, cost = audit + "I" * tail, cost + INSERT * tail
    lines, i = [], 0
    for letter in audit:
        if letter == "I":
            lines.append(f"{ASKED[state]}:")
        elif letter == "R":
            lines.append(f"{ASKED[state]}:{texts[i]}")
        elif letter == "K":
            lines.append(f"{roles[i]}:{texts[i]}")
        if letter == "K" and not state and symbols[i] % 4 == 0:
            state = 1
        elif letter != "D":
            state = AFTER[state]
        i += letter != "I"
    return {"cost": cost, "audit": audit, "repaired": "\n".join(lines).encode("utf-8", "surrogatepass")}


HEAD = ("part int, seq int, whole boolean, " + ", ".join(f"{c} long" for c in COUNTS)
        + ", first int, last int, low long, high long, turns long")
DONE = "cost long, audit string, repaired binary"
LEFT = "symbols binary, roles array<string>, texts array<string>, costs array<long>"


def schema_of(conv: T.DataType, *fields: str) -> T.StructType:
    rest = T._parse_datatype_string(", ".join(fields))
    return T.StructType([T.StructField("conv_id", conv), *rest.fields])


def to_arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def sent(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row.get("repaired") or b"") + sum(map(len, row.get("texts") or ()))
        if len(held) >= SENT or size >= SENT_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def pieces_of(rows: DataFrame, most: int = PIECE) -> DataFrame:
    """Pieces (of about ``most`` rows) of ``marked`` rows: whole conversations done (DONE), the others still open (LEFT)."""
    spark = rows.sparkSession
    bound_batches(spark)
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role")]
    dealt = (rows.repartitionByRange(partitions(spark), *order, F.substr("text", F.lit(1), F.lit(LEAD)).asc())
             .sortWithinPartitions(*order, F.col("text").asc()))
    out = schema_of(rows.schema["conv_id"].dataType, HEAD, DONE, LEFT)
    arrow = to_arrow(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def found() -> Iterator[dict]:
            piece, seq = None, 0
            for batch in batches:
                for conv, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if piece is None or conv != piece.conv or piece.full:
                        if piece is not None:
                            piece.whole = piece.whole and conv != piece.conv
                            yield piece.row()
                        # the first conversation may have begun in the range before
                        opened = piece is None or (conv == piece.conv and not piece.whole)
                        piece, seq = Piece(conv, part, seq, opened, most), seq + 1
                    piece.add(*row)
            if piece is not None:
                piece.whole = False  # and the last one may go on in the next
                yield piece.row()

        yield from sent(found(), arrow)

    return cut(dealt.mapInArrow(run, out), "conversation-pieces")


def open_pieces(left: DataFrame) -> DataFrame:
    """The open pieces with the vector behind (number), the state before, and whether the conversation ends there."""
    conv = left.schema["conv_id"].dataType

    def behind(costs: pd.DataFrame) -> pd.DataFrame:
        """From the last piece on: the vector behind each one."""
        costs = costs.sort_values(["part", "seq"])
        vector, out = np.array(END, np.int64), []
        for row in costs["costs"][::-1]:
            out.append(tables().number[normal(tuple(np.minimum(vector, NEVER).tolist()))[0]])
            vector = (np.asarray(row, np.int64).reshape(4, 4) + vector).min(axis=1)
            vector = np.array(normal(tuple(np.minimum(vector, NEVER).tolist()))[0])
        ends = np.arange(len(costs)) == len(costs) - 1
        return pd.DataFrame({"part": costs["part"], "seq": costs["seq"], "vector": out[::-1], "ends": ends})

    small = left.select("conv_id", "part", "seq", "costs")
    with_vector = left.select("conv_id", "part", "seq", "symbols").join(
        small.groupBy("conv_id").applyInPandas(behind, "part int, seq int, vector int, ends boolean"), ["part", "seq"])
    schema = schema_of(conv, "part int, seq int, vector int, ends boolean, hops array<int>")
    arrow = to_arrow(schema)

    def hop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The state behind a piece, for each state before it."""
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                symbols = np.frombuffer(row.pop("symbols"), np.uint8)
                out.append({**row, "hops": [tables().trace(symbols, row["vector"], x)[1] for x in range(4)]})
            yield pa.RecordBatch.from_pylist(out, arrow)

    hops = cut(with_vector.mapInArrow(hop, schema), "conversation-hops")

    def states(rows: pd.DataFrame) -> pd.DataFrame:
        rows, state, out = rows.sort_values(["part", "seq"]), 0, []
        for to in rows["hops"]:
            out.append(state)
            state = int(to[state])
        return pd.DataFrame({"part": rows["part"], "seq": rows["seq"], "state": out})

    before = hops.groupBy("conv_id").applyInPandas(states, "part int, seq int, state int")
    return left.join(hops.select("part", "seq", "vector", "ends"), ["part", "seq"]).join(before, ["part", "seq"])


def repair(rows: DataFrame, most: int = PIECE) -> DataFrame:
    """Pieces of the repaired conversations of ``rows`` (conv_id, turn, role, text, n: copies of the row, 0 if it is gone):
    conv_id, HEAD and DONE. The pieces of a conversation, ordered by part and seq, make up its audit and its repaired
    lines; ``whole`` conversations have one. ``most``: rows of a piece."""
    found = pieces_of(marked(rows), most)
    schema = schema_of(found.schema["conv_id"].dataType, HEAD, DONE)
    arrow = to_arrow(schema)
    kept = [n for n in schema.names if n not in ("cost", "audit", "repaired")]

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> Iterator[dict]:
            for batch in batches:
                for i in range(batch.num_rows):
                    r = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                    yield {**{n: r[n] for n in kept},
                           **traced_row(np.frombuffer(r["symbols"], np.uint8), r["roles"], r["texts"], r["vector"],
                                        r["state"], r["ends"])}

        yield from sent(done(), arrow)

    left = found.where("not whole")
    traced = open_pieces(left).select(*kept, "symbols", "roles", "texts", "vector", "state", "ends").mapInArrow(trace, schema)
    return found.where("whole").select(*schema.names).unionByName(traced)


RESULT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def summed_up(pieces: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``'s pieces: conv_id and RESULT."""
    schema = schema_of(pieces.schema["conv_id"].dataType, RESULT)
    arrow = to_arrow(schema)
    gaps = F.when(F.col("low").isNull(), F.lit(0)).otherwise(F.col("high") - F.col("low") + 1 - F.col("turns"))
    whole = pieces.where("whole").select(
        "conv_id", gaps.cast("long").alias("gaps"), *COUNTS, "cost", "audit",
        F.sha2(F.col("repaired"), 256).alias("repaired_sha256"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            now = None
            for batch in batches:
                for i in range(batch.num_rows):
                    p = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                    if now is None or now.conv != p["conv_id"]:
                        if now is not None:
                            yield now.row()
                        now = Sum(p["conv_id"])
                    now.add(p)
            if now is not None:
                yield now.row()

        yield from sent(found(), arrow)

    parts = (pieces.where("not whole").repartition(partitions(pieces.sparkSession), "conv_id")
             .sortWithinPartitions("conv_id", "part", "seq"))
    return whole.unionByName(parts.mapInArrow(run, schema))


class Sum:
    """A conversation's result from its pieces in order."""

    def __init__(self, conv):
        self.conv, self.counts, self.cost, self.audit = conv, dict.fromkeys(COUNTS, 0), 0, []
        self.hash, self.lines = hashlib.sha256(), False
        self.last = self.low = self.high = None
        self.turns = 0

    def add(self, p: dict) -> None:
        for c in COUNTS:
            self.counts[c] += p[c]
        if p["first"] is not None:
            self.counts["illegal"] += self.last is not None and (self.last, p["first"]) not in LEGAL
            self.last = p["last"]
        if p["low"] is not None:
            self.turns += p["turns"] - (p["low"] == self.high)
            self.low = p["low"] if self.low is None else self.low
            self.high = p["high"]
        self.cost += p["cost"]
        self.audit.append(p["audit"])
        if p["repaired"]:  # a line is never empty
            if self.lines:
                self.hash.update(b"\n")
            self.hash.update(p["repaired"])
            self.lines = True

    def row(self) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"conv_id": self.conv, "gaps": gaps, **self.counts, "cost": self.cost, "audit": "".join(self.audit),
                "repaired_sha256": self.hash.hexdigest()}


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) as the query damages them, with the number of copies n."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn")).cast("binary")) % 20
    gone = F.lit("")
    return rows.select(
        "conv_id", "turn", F.when(h == 0, gone).when(h == 4, "user").otherwise(or_space("role")).alias("role"),
        F.when(h.isin(0, 1), gone).when(h == 2, F.translate(or_space("text"), ".!?", "")).otherwise(or_space("text"))
        .alias("text"), F.when(h == 0, 0).when(h == 3, 2).otherwise(1).cast("long").alias("n"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults, cheapest repair and the hash of the repaired text."""
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return summed_up(repair(damaged(rows)))

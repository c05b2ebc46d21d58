"""Faults of conversations, and the cheapest edits that give each a sound structure.

A sound conversation is empty, or an optional turn whose role begins with ``s`` and then pairs
of turns whose roles begin with ``u`` and ``a``.  Edits: Keep (0), Rerole to user or assistant
(1), Delete (2), Insert an empty user or assistant turn anywhere (5); blank and repeated rows
must be deleted, truncated ones cost 5 more unless they are.  Of the cheapest sequences of
edits the one whose initials come first in ASCII is taken.

The costs to the end of a conversation, by the state of a four-state automaton, are a Viterbi
recursion from the right.  It runs in parallel over chunks of a conversation's rows: every
chunk but the last starts from a speculative cost vector, and fix-up passes start chunks anew
from what their right neighbours found, until each vector differs from the one that was used
by a constant only.  Inside a chunk such a pass ends where old and new vectors differ by a
constant: to the left of it nothing changes.  Stitched together, the vectors lead one trace
per state through each chunk; the states at the borders pick one of the four.

Rows are put in order by a range shuffle and numbered by blocks, so no conversation is sorted or
solved in one task.  Only the digest of a whole conversation is sequential: its rows pass one
task as a stream, in constant memory but for its audit.

Null roles and texts are one space.  Rows are ordered by turn (null first), then role, then the
digest of the text; equal rows follow each other and count as rows of their own.  Rows without
a conversation id make up one conversation without id.  Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from feedarb.plans.ordered import running_number
from feedarb.plans.storage import durable

#: Rows of a conversation that one cost recursion walks through.
CHUNK_ROWS = 1 << 16
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
NEVER = 1 << 40
#: White space: the space and the controls 0x09 to 0x0D.
BLANKS = " \t\n\x0b\x0c\r"
# States: nothing yet, after s, after u, after a.  Rows are told by the initial of the role.
NOTHING, S, U, A = range(4)
INITIALS = "sua"
AFTER = {(NOTHING, 0): S, (NOTHING, 1): U, (S, 1): U, (U, 2): A, (A, 1): U}
#: Where an own turn (user, or assistant after a user) leads to.
OWN = (U, U, A, U)
FAULTS = ("none", "blank", "duplicate", "truncated")
CONVERSATION = ("_conv", "_without")

Vector = tuple[int, int, int, int]


def _with_inserts(costs: list[int]) -> Vector:
    """Costs by state if turns may be inserted first; the least is taken off all."""
    u, a = min(costs[U], INSERT + costs[A]), min(costs[A], INSERT + costs[U])
    whole = (min(costs[NOTHING], INSERT + u), min(costs[S], INSERT + u), u, a)
    least = min(whole)
    return tuple(min(c - least, NEVER) for c in whole)


#: At the end of a conversation: only nothing and a complete pair are sound.
END = _with_inserts([0, NEVER, NEVER, 0])
SPECULATIVE: Vector = (0, 0, 0, 0)


def _choices(right: Vector, symbol: str, state: int) -> dict[str, tuple[int, int]]:
    """Edits of a row, each with its cost to the end and the state after it."""
    kind, fault = int(symbol, 16) % 4, int(symbol, 16) // 4
    found = {"D": (DELETE + right[state], state)}
    if fault not in (1, 2):
        more = TRUNCATED if fault == 3 else 0
        if (state, kind) in AFTER:
            after = AFTER[state, kind]
            found["K"] = (KEEP + more + right[after], after)
        found["R"] = (REROLE + more + right[OWN[state]], OWN[state])
    return found


@functools.cache
def _before(right: Vector, symbol: str) -> Vector:
    """The vector to the left of a row, less a constant.  Vectors are few, so all are remembered."""
    return _with_inserts([min(c for c, _ in _choices(right, symbol, s).values()) for s in range(4)])


@functools.cache
def _edit(right: Vector, symbol: str, state: int) -> tuple[str, int]:
    """The least edits up to and including a row that begin a cheapest sequence, and the state then."""
    rows = [_choices(right, symbol, s) for s in range(4)]
    plain = [min(c for c, _ in row.values()) for row in rows]
    best = [plain[U], plain[A]]
    best = {U: min(best[0], INSERT + best[1]), A: min(best[1], INSERT + best[0])}
    best |= {s: min(plain[s], INSERT + best[U]) for s in (NOTHING, S)}
    edits = ""
    while True:
        options = {e: after for e, (cost, after) in rows[state].items() if cost == best[state]}
        if INSERT + best[OWN[state]] == best[state]:
            options["I"] = OWN[state]
        edit = min(options)
        edits, state = edits + edit, options[edit]
        if edit != "I":
            return edits, state


def _ending(state: int) -> str:
    """Inserts after the last row."""
    return {NOTHING: "", A: "", U: "I", S: "II"}[state]


def left_vector(symbols: str, right: Vector) -> Vector:
    for symbol in reversed(symbols):
        right = _before(right, symbol)
    return right


def fixed_up(symbols: str, used: Vector, left: Vector, right: Vector) -> Vector:
    """The left vector for another right one; ``left`` if both recursions meet."""
    for symbol in reversed(symbols):
        if used == right:
            return left
        used, right = _before(used, symbol), _before(right, symbol)
    return right


def trace(symbols: str, right: Vector, state: int) -> tuple[list[str], int]:
    """Edits by row, and the state after the last row."""
    vectors = [right]
    for symbol in reversed(symbols):
        vectors.append(_before(vectors[-1], symbol))
    edits = []
    for symbol, after in zip(symbols, reversed(vectors[:-1])):
        edit, state = _edit(after, symbol, state)
        edits.append(edit)
    return edits, state


def damaged(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with known damage, for measuring repair.

    By the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 takes the
    ends of sentences away, 3 repeats it, 4 makes it a user's.  Nulls of these columns but in the
    result's ids and turns are one space.
    """

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    return (
        turns.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            shown("role").alias("role"),
            shown("text").alias("text"),
            kind.alias("_kind"),
        )
        .where("_kind <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("_kind") == 1, "")
            .when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
        )
        .drop("_copy")
    )


def _ordered(turns: DataFrame) -> DataFrame:
    """The rows as a written table with ``pos``, a number that grows with their order.

    The last key of the range shuffle tells equal rows apart, so they can be split.
    """
    rows = turns.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("_conv"),
        F.col("conv_id").isNull().alias("_without"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.monotonically_increasing_id().alias("_row"),
    ).withColumn("digest", F.sha2("text", 256))
    order = [*CONVERSATION, "turn", "role", "digest", "_row"]
    return durable(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("_row")
        .withColumn("pos", F.monotonically_increasing_id()),
        "turns",
    )


def _symbols(rows: DataFrame) -> DataFrame:
    """(conversation, pos, symbol): a hexadecimal digit, 4 x fault + initial of the role."""
    firsts = rows.groupBy(*CONVERSATION, "role", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("_first"))
    kept = F.rtrim("text", F.lit(BLANKS))
    slim = rows.select(
        *CONVERSATION,
        "pos",
        F.substring("role", 1, 1).alias("_initial"),
        (F.ltrim(kept, F.lit(BLANKS)) == "").alias("_blank"),
        (~F.substring(kept, -1, 1).isin(".", "!", "?")).alias("_truncated"),
    )
    kind = F.lit(len(INITIALS))
    for n, initial in enumerate(INITIALS):
        kind = F.when(F.col("_initial") == initial, n).otherwise(kind)
    fault = (
        F.when(F.col("_blank"), 1).when(F.col("_first").isNull(), 2).when(F.col("_truncated"), 3).otherwise(0)
    )
    return slim.join(firsts, "pos", "left").select(
        *CONVERSATION, "pos", F.lower(F.hex((4 * fault + kind).cast("long"))).alias("symbol")
    )



@F.arrow_udf(StringType())
def _solved(symbols: pa.Array, used: pa.Array, left: pa.Array, right: pa.Array) -> pa.Array:
    """Left vectors as text; ``used`` and ``left`` are those of the pass before, or null."""
    out = []
    for s, u, l, r in zip(*(x.to_pylist() for x in (symbols, used, left, right))):
        vector = fixed_up(s, _read(u), _read(l), _read(r)) if u is not None else left_vector(s, _read(r))
        out.append(_write(vector))
    return pa.array(out, pa.string())


def _write(vector: Vector) -> str:
    return ",".join(map(str, vector))


def _read(vector: str) -> Vector:
    return tuple(map(int, vector.split(",")))


@F.arrow_udf(StringType())
def _exits(symbols: pa.Array, right: pa.Array) -> pa.Array:
    """The state after a chunk by the state before it, four digits."""
    pairs = zip(symbols.to_pylist(), right.to_pylist())
    return pa.array(["".join(str(trace(s, _read(r), state)[1]) for state in range(4)) for s, r in pairs], pa.string())


@F.arrow_udf(ArrayType(StringType()))
def _edits(symbols: pa.Array, right: pa.Array, state: pa.Array, last: pa.Array) -> pa.Array:
    """Edits by row; the last chunk has one entry more, for inserts at the end."""
    out = []
    for s, r, entered, ends in zip(*(x.to_pylist() for x in (symbols, right, state, last))):
        edits, after = trace(s, _read(r), entered)
        out.append(edits + [_ending(after)] * ends)
    return pa.array(out, pa.list_(pa.string()))


def _chunks(symbols: DataFrame, chunk_rows: int) -> DataFrame:
    """One row per chunk: its symbols and the places of its rows; at most ``chunk_rows`` of them."""
    numbered = running_number(symbols, CONVERSATION, "pos", "place")
    listed = (
        numbered.withColumn("chunk", F.floor((F.col("place") - 1) / chunk_rows).cast("long"))
        .groupBy(*CONVERSATION, "chunk")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "symbol"))).alias("_rows"))
        .select(
            *CONVERSATION,
            "chunk",
            F.col("_rows.pos").alias("places"),
            F.array_join(F.col("_rows.symbol"), "").alias("symbols"),
        )
    )
    return durable(listed, "chunks")


def _next_chunk(chunks: DataFrame, *columns: str) -> DataFrame:
    return chunks.select(*CONVERSATION, (F.col("chunk") - 1).alias("chunk"), *(F.col(c).alias(f"next_{c}") for c in columns))


def _converged(chunks: DataFrame) -> DataFrame:
    """Chunks with ``last`` and ``right``, the true cost vector at their right border."""
    key = [*CONVERSATION, "chunk"]
    last = F.col("next_chunk").isNull()
    found = (
        chunks.join(_next_chunk(chunks, "chunk"), key, "left")
        .select(*key, "symbols", last.alias("last"), F.when(last, _write(END)).otherwise(_write(SPECULATIVE)).alias("right"))
        .withColumn("left", _solved("symbols", F.lit(None).cast("string"), F.lit(None).cast("string"), "right"))
    )
    found = durable(found, "vectors")
    while True:
        asked = found.join(_next_chunk(found, "left"), key, "left").withColumn("next", F.coalesce("next_left", "right"))
        if asked.where("next <> right").isEmpty():
            return found
        same = F.col("next") == F.col("right")
        again = asked.where(~same).withColumn("left", _solved("symbols", "right", "left", "next")).withColumn("right", F.col("next"))
        found = durable(asked.where(same).unionByName(again).select(*found.columns), "vectors")


def _entered(found: DataFrame) -> DataFrame:
    """Adds ``state`` at the left border: the chunks of a conversation pass as a stream of four digits each."""

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conversation, state = None, NOTHING
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*CONVERSATION, "exits")]
            states = []
            for *own, exits in zip(*columns):
                if own != conversation:
                    conversation, state = own, NOTHING
                states.append(state)
                state = int(exits[state])
            kept = [batch.column(c) for c in (*CONVERSATION, "chunk")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(states, pa.int32())], [*CONVERSATION, "chunk", "state"])

    return (
        found.select(*CONVERSATION, "chunk", _exits("symbols", "right").alias("exits"))
        .repartition(*CONVERSATION)
        .sortWithinPartitions(*CONVERSATION, "chunk")
        .mapInArrow(follow, "_conv long, _without boolean, chunk long, state int")
    )


def edits(turns: DataFrame, chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, DataFrame]:
    """The rows in order, and what to do with each: (conversation, pos, after, symbol, edits).

    ``edits`` ends with the row's own edit, inserts before it come first; rows with ``after``
    hold inserts behind the last row, ``symbol`` is null there.
    """
    rows = _ordered(turns)
    chunks = _chunks(_symbols(rows), chunk_rows)
    found = _converged(chunks)
    key = [*CONVERSATION, "chunk"]
    told = (
        found.join(_entered(found), key)
        .join(chunks.select(*key, "places"), key)
        .select(
            *CONVERSATION,
            "places",
            "symbols",
            F.posexplode(_edits("symbols", "right", "state", "last")).alias("_n", "edits"),
        )
    )
    size = F.size("places")
    return rows, told.select(
        *CONVERSATION,
        F.get("places", F.least(F.col("_n"), size - 1)).alias("pos"),
        (F.col("_n") >= size).alias("after"),
        F.when(F.col("_n") < size, F.substr("symbols", F.col("_n") + 1, F.lit(1))).alias("symbol"),
        "edits",
    )


RESULT = (
    "_conv long, _without boolean, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string"
)


class _Told:
    """What is told of one conversation, row by row."""

    def __init__(self):
        self.faults = [0, 0, 0, 0]
        self.illegal = self.cost = self.distinct = 0
        self.low = self.high = self.kind = None
        self.audit: list[str] = []
        self.state = NOTHING
        self.digest = hashlib.sha256()
        self.begun = False

    def say(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) * self.begun}{role}:{text}".encode())
        self.begun = True

    def insert(self, inserts: str) -> None:
        for _ in inserts:
            self.cost += INSERT
            self.state = OWN[self.state]
            self.say("user" if self.state == U else "assistant", "")

    def row(self, symbol: str, done: str, turn: int | None, role: str, text: str) -> None:
        kind, fault = int(symbol, 16) % 4, int(symbol, 16) // 4
        self.faults[fault] += 1
        if self.kind is not None:
            self.illegal += (self.kind, kind) not in ((0, 1), (1, 2), (2, 1))
        self.kind = kind
        if turn is not None and turn != self.high:
            self.distinct += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        self.audit.append(done)
        self.insert(done[:-1])
        if done[-1] == "D":
            self.cost += DELETE
            return
        self.cost += TRUNCATED if fault == 3 else 0
        if done[-1] == "K":
            self.state = AFTER[self.state, kind]
        else:
            self.cost += REROLE
            self.state = OWN[self.state]
            role = "user" if self.state == U else "assistant"
        self.say(role, text)

    def end(self, done: str) -> None:
        self.audit.append(done)
        self.insert(done)

    def result(self) -> list:
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.distinct, (1 << 63) - 1)
        return [gaps, *self.faults[1:], self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest()]


def repaired(turns: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Per conversation that has rows: its faults, the edits and their cost, and a digest of the result."""
    rows, told = edits(turns, chunk_rows)
    none = F.lit(None)
    merged = rows.select(
        *CONVERSATION, "pos", F.lit(1).alias("_tag"), "turn", "role", "text",
        none.cast("string").alias("symbol"), none.cast("string").alias("edits"),
    ).unionByName(
        told.select(
            *CONVERSATION, "pos", F.when(F.col("after"), 2).otherwise(0).alias("_tag"), none.cast("long").alias("turn"),
            none.cast("string").alias("role"), none.cast("string").alias("text"), "symbol", "edits",
        )
    )
    schema = pa.schema(
        [("_conv", pa.int64()), ("_without", pa.bool_())]
        + [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
        + [("audit", pa.string()), ("repaired_sha256", pa.string())]
    )

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conversation, own, symbol, done = None, None, None, None

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip([*conversation, *own.result()], schema)], schema=schema)

        names = (*CONVERSATION, "_tag", "turn", "role", "text", "symbol", "edits")
        for batch in batches:
            for conv, without, tag, turn, role, text, mark, edit in zip(*(batch.column(c).to_pylist() for c in names)):
                if (conv, without) != conversation:
                    if own is not None:
                        yield batch_of()
                    conversation, own = (conv, without), _Told()
                if tag == 0:
                    symbol, done = mark, edit
                elif tag == 1:
                    own.row(symbol, done, turn, role, text)
                else:
                    own.end(edit)
        if own is not None:
            yield batch_of()

    return (
        merged.repartition(*CONVERSATION)
        .sortWithinPartitions(*CONVERSATION, "pos", "_tag")
        .mapInArrow(tell, RESULT)
        .withColumn("conv_id", F.when(~F.col("_without"), F.col("_conv")))
    )


def report(turns: DataFrame, known: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """:func:`repaired` for every conversation of ``known``; those without rows have nothing to tell."""
    ids = known.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("_conv"), F.col("conv_id").isNull().alias("_without")
    ).distinct()
    found = repaired(turns, chunk_rows).drop("conv_id")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return ids.join(found, [*CONVERSATION], "left").select(
        F.when(~F.col("_without"), F.col("_conv")).alias("conv_id"),
        *(F.coalesce(c, F.lit(0)).alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )

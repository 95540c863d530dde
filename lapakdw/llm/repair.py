"""Conversation structure repair: the cheapest edits that make a conversation alternate.

The rows of a conversation and the roles that may come next form a lattice: a
node is a number of rows read and a state (nothing yet, behind a system row,
behind a user row, behind an assistant row); an arc is an edit with its whole
cost. An auction prices the nodes: a path grows from the start along arcs whose
cost equals the fall in price, and where there is none, the price of its last
node rises to the least it has to pay and the path gives the node back. When the
path arrives, prices differ by exactly the least cost along every cheapest path,
so the arcs that are tight and lead on to the end are all the cheapest edits;
following the letter that sorts first gives the audit.

Conversations of any length are cut: rows are sorted by range over the whole
table, and a chunk is up to ``CHUNK_ROWS`` neighbouring rows of a conversation.
Where a conversation has several chunks, each tells by its own auctions what it
costs from every state to every other; a pass from the last chunk to the first
prices the ends of the chunks; then all chunks are traced side by side, from
every state they may be entered in, and one pass in order picks the traces that
fit together and hashes the repaired text as it goes by. No step holds more
than a chunk and the audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lapakdw.runtime import materialize

# What is blank, what ends a sentence, and what edits cost.
WHITE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
DELETE, INSERT, KEEP, REROLE = "D", "I", "K", "R"  # in the order that settles ties
COST = {DELETE: 2, INSERT: 5, KEEP: 0, REROLE: 1}
TRUNCATED_COST = 5
LEGAL = ("su", "ua", "au")

# States: nothing yet, behind a system, a user, an assistant row. It may end in the first and the last.
STATES = 4
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
ROLE = {2: "user", 3: "assistant"}
FAR = 1 << 60
FINAL = (0, FAR, FAR, 0)

# Rows and bytes of text of a chunk.
CHUNK_ROWS = 128
CHUNK_BYTES = 4_000_000
# Chunks in an Arrow batch, and about as many bytes of text.
BATCH_CHUNKS = 500
BATCH_BYTES = 8_000_000

# Faults of a row; none is FINE.
BLANK, DUPLICATE, TRUNCATED, FINE = "b", "d", "t", "-"

Row = tuple[str, str]  # first letter of the role, fault
Arc = tuple[str, int, int]  # edit, cost, node


def lattice(rows: Sequence[Row], ends: Sequence[int], last: bool) -> list[list[Arc]]:
    """The arcs out of every node, node 4 * i + state for i rows read; the node behind all others is the end.

    ``ends`` is what remains to be paid behind the last row in each state. Rows
    may be inserted in front of every row, and at the very end of a conversation.
    """
    n = len(rows)
    sink = STATES * (n + 1)
    arcs: list[list[Arc]] = []
    for i in range(n + 1):
        for state in range(STATES):
            out: list[Arc] = []
            follows = 3 if state == 2 else 2
            if i < n:
                letter, fault = rows[i]
                out.append((DELETE, COST[DELETE], STATES * (i + 1) + state))
                out.append((INSERT, COST[INSERT], STATES * i + follows))
                if fault in (TRUNCATED, FINE):
                    more = TRUNCATED_COST if fault == TRUNCATED else 0
                    kept = AFTER.get((state, letter))
                    if kept is not None:
                        out.append((KEEP, COST[KEEP] + more, STATES * (i + 1) + kept))
                    out.append((REROLE, COST[REROLE] + more, STATES * (i + 1) + follows))
            else:
                if ends[state] < FAR:
                    out.append(("", ends[state], sink))
                if last:
                    out.append((INSERT, COST[INSERT], STATES * i + follows))
            arcs.append(out)
    return arcs


def highest(rows: Sequence[Row], ends: Sequence[int]) -> int:
    """No node that reaches the end is further from it: all rows deleted, three more inserted."""
    return COST[DELETE] * len(rows) + 3 * COST[INSERT] + max((e for e in ends if e < FAR), default=0)


def auction(arcs: list[list[Arc]], prices: list[int], origin: int, limit: int) -> int:
    """Raise ``prices`` until a path of tight arcs leads from the origin to the end; the least cost, or FAR.

    Prices start at 0 or where an earlier auction for the same end left them.
    """
    sink = len(arcs)
    path = [origin]
    while True:
        node = path[-1]
        least, to = FAR, -1
        for _, cost, target in arcs[node]:
            if cost + prices[target] < least:
                least, to = cost + prices[target], target
        if least > limit:
            least = FAR  # no way from here to the end
        if prices[node] < least:
            prices[node] = least
            if node != origin:
                path.pop()
            elif least == FAR:
                return FAR
        elif least == FAR:
            return FAR
        elif to == sink:
            return prices[origin]
        else:
            path.append(to)


def tight_to_end(arcs: list[list[Arc]], prices: list[int]) -> list[bool]:
    """Which nodes reach the end along tight arcs. An insertion leads to a node of a lower price."""
    sink = len(arcs)
    good = [False] * sink + [True]
    for layer in range(sink // STATES - 1, -1, -1):
        nodes = range(STATES * layer, STATES * layer + STATES)
        for node in sorted(nodes, key=prices.__getitem__):
            good[node] = any(good[to] and prices[node] == cost + prices[to] < FAR for _, cost, to in arcs[node])
    return good


def trace(arcs: list[list[Arc]], prices: list[int], good: list[bool], origin: int) -> tuple[str, int]:
    """The letters of the cheapest edits that sort first, and the state they end in."""
    sink = len(arcs)
    node, audit = origin, []
    while True:
        found = {edit: to for edit, cost, to in arcs[node] if good[to] and prices[node] == cost + prices[to]}
        if "" in found:
            return "".join(audit), node % STATES
        edit = min(found)
        audit.append(edit)
        node = found[edit]
        assert node < sink


def chunk_costs(rows: Sequence[Row], last: bool) -> list[int]:
    """What the chunk costs from every state (outer) to every state (inner) behind it."""
    table = [FAR] * (STATES * STATES)
    for exit_state in range(STATES):
        ends = [0 if state == exit_state else FAR for state in range(STATES)]
        arcs, limit = lattice(rows, ends, last), highest(rows, ends)
        prices = [0] * (len(arcs) + 1)
        for state in range(STATES):
            table[STATES * state + exit_state] = auction(arcs, prices, state, limit)
    return table


def repairs(
    rows: Sequence[Row], ends: Sequence[int] = FINAL, last: bool = True, entries: Sequence[int] = (0,)
) -> dict[int, tuple[str, int, int]]:
    """For each state the rows may be entered in: audit, state behind them, and cost of the edits themselves."""
    arcs, limit = lattice(rows, ends, last), highest(rows, ends)
    prices = [0] * (len(arcs) + 1)
    costs = {state: auction(arcs, prices, state, limit) for state in entries}
    good = tight_to_end(arcs, prices)
    found = {}
    for state, cost in costs.items():
        if cost < FAR:
            audit, behind = trace(arcs, prices, good, state)
            found[state] = (audit, behind, cost - ends[behind])
    return found


# Rows to chunks


def damage(turns: DataFrame) -> DataFrame:
    """Rows with faults planted by a checksum of conversation and turn: ``conv_id, turn, role, text``.

    Of twenty remainders, 0 drops a row, 1 empties its text, 2 takes away its
    sentence ends, 3 repeats it, and 4 makes it a user row. Null values are one
    space, in the checksum too; ids and turns stay null.
    """

    def told(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn"))) % 20
    rows = turns.select("conv_id", "turn", told("role").alias("role"), told("text").alias("text"), code.alias("code"))
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("code") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("code") == 3, 2).otherwise(1)
    return rows.where("code <> 0").select(
        "conv_id", "turn", role.alias("role"), F.explode(F.array_repeat(text, copies)).alias("text")
    )


def _flagged(turns: DataFrame) -> DataFrame:
    """Equal rows once with their number ``n``, and the fault of the first of them."""
    rows = turns.select(
        "conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    )
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    said = rows.select("conv_id", digest.alias("digest"), place.alias("place")).groupBy("conv_id", "digest")
    again = said.agg(F.min("place").alias("first"), F.max("place").alias("last")).where("first <> last")
    again = again.select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "first")
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n"))
    counted = counted.withColumns({"digest": digest, "place": place})
    joined = counted.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")
    ending = F.rtrim("text", F.lit(WHITE))
    fault = (
        F.when(F.trim("text", F.lit(WHITE)) == "", BLANK)
        .when(F.col("first") < F.col("place"), DUPLICATE)
        .when(~F.right(ending, F.lit(1)).isin(*ENDS), TRUNCATED)
        .otherwise(FINE)
    )
    return joined.select("conv_id", "turn", "role", "text", "n", fault.alias("fault"))


_CHUNK = {
    "part": "int",
    "seq": "bigint",
    "roles": "array<string>",
    "texts": "array<string>",
    "faults": "string",
    "first_turn": "{turn}",
    "last_turn": "{turn}",
    "turns": "bigint",
    "illegal": "bigint",
    "costs": "array<bigint>",
}


def _schema(names: dict[str, str], conv: str, turn: str = "") -> str:
    return f"conv_id {conv}, " + ", ".join(f"{name} {kind.format(turn=turn)}" for name, kind in names.items())


def _initials(roles: Sequence[str]) -> list[str]:
    return [role[:1] for role in roles]


def _broken(initials: Sequence[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


class _Chunk:
    """Neighbouring rows of one conversation. Texts of rows that have to go are not kept."""

    def __init__(self, conv: object, begins: bool) -> None:
        self.conv, self.begins = conv, begins
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.faults: list[str] = []
        self.turns: list = []
        self.bytes = 0

    def add(self, turn: object, role: str, text: str, fault: str) -> None:
        text = "" if fault in (BLANK, DUPLICATE) else text
        self.roles.append(role)
        self.texts.append(text)
        self.faults.append(fault)
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)
        self.bytes += len(text)

    def full(self, most: int) -> bool:
        return len(self.roles) >= most or self.bytes >= CHUNK_BYTES

    def row(self, part: int, seq: int, whole: bool) -> tuple:
        """``whole``: no other chunk has rows of this conversation, so the costs between states are not asked for."""
        letters = _initials(self.roles)
        costs = None if whole else chunk_costs(list(zip(letters, self.faults)), last=False)
        first, last = (self.turns[0], self.turns[-1]) if self.turns else (None, None)
        told = (self.roles, self.texts, "".join(self.faults), first, last, len(self.turns), _broken(letters), costs)
        return (self.conv, part, seq, *told)


def _batches(rows: Iterator[tuple], fields: list[tuple[str, pa.DataType]], sizes: Sequence[int]) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches, bounded by number and by the characters in the string lists at ``sizes``."""

    def batch() -> pa.RecordBatch:
        columns = zip(*held)
        arrays = [pa.array(values, kind) for values, (_, kind) in zip(columns, fields)]
        return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(text) for i in sizes for text in row[i])
        if len(held) >= BATCH_CHUNKS or size >= BATCH_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for a in range(0, batch.num_rows, BATCH_CHUNKS):
            yield from zip(*(column.to_pylist() for column in batch.slice(a, BATCH_CHUNKS).columns))


def _fields(df_schema) -> list[tuple[str, pa.DataType]]:
    return [(f.name, to_arrow_type(f.dataType)) for f in df_schema.fields]


def _parsed(ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


def chunked(turns: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Chunks of all conversations in order: stored rows with roles, texts, faults and counts.

    Conversations are ordered by turn, nulls first, ties by role and text. The
    order is cut into ranges of rows, so a conversation may lie in several
    tasks; ``part`` and ``seq`` number the chunks.
    """
    conv, turn = (turns.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    schema = _parsed(_schema(_CHUNK, conv, turn))
    fields = _fields(schema)
    order = ["conv_id", "turn", "role", "text"]
    flagged = materialize(_flagged(turns), "faults")
    laid = flagged.repartitionByRange(*order).sortWithinPartitions(*order)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        part, seq = TaskContext.get().partitionId(), 0
        chunk, edge = None, True  # edge: the first conversation of the task may have begun in another one
        for conv_id, turn, role, text, n, fault in _rows(batches):
            if chunk is None or chunk.conv != conv_id:
                if chunk is not None:
                    yield chunk.row(part, seq, whole=chunk.begins and not edge)
                    seq, edge = seq + 1, False
                chunk = _Chunk(conv_id, begins=True)
            for copy in range(n):
                if chunk.full(chunk_rows):
                    yield chunk.row(part, seq, whole=False)
                    seq, chunk = seq + 1, _Chunk(conv_id, begins=False)
                chunk.add(turn, role, text, fault if copy == 0 or fault == BLANK else DUPLICATE)
        if chunk is not None:
            yield chunk.row(part, seq, whole=False)  # it may go on in the next task

    return materialize(laid.mapInArrow(lambda batches: _batches(cut(batches), fields, [4]), schema), "chunks")


# Chunks to repairs


def _end_prices(chunks: DataFrame) -> DataFrame:
    """``part, seq, ends``: what remains to be paid behind each chunk with costs, in every state.

    One pass per conversation from its last chunk to its first, over the tables
    of costs alone. Behind the last chunk rows may still be inserted.
    """
    costs = chunks.where(F.col("costs").isNotNull()).select("conv_id", "part", "seq", "costs")
    costs = costs.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("seq"))
    schema = _parsed("part int, seq bigint, ends array<bigint>, final boolean")
    fields = _fields(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        started, before, ends = False, None, FINAL
        for conv_id, part, seq, table in _rows(batches):
            final = not started or conv_id != before
            if final:
                ends = FINAL
            yield part, seq, list(ends), final
            behind = _inserted(ends) if final else ends
            started, before = True, conv_id
            ends = tuple(
                min(FAR, *(table[STATES * s + t] + behind[t] for t in range(STATES))) for s in range(STATES)
            )

    return costs.mapInArrow(lambda batches: _batches(run(batches), fields, []), schema)


def _inserted(ends: Sequence[int]) -> list[int]:
    """What remains to be paid if rows may be inserted at the end."""
    arcs = lattice([], ends, last=True)
    prices = [0] * (len(arcs) + 1)
    return [auction(arcs, prices, state, highest([], ends)) for state in range(STATES)]


_TRACED = {
    "part": "int",
    "seq": "bigint",
    "roles": "array<string>",
    "texts": "array<string>",
    "faults": "string",
    "first_turn": "{turn}",
    "last_turn": "{turn}",
    "turns": "bigint",
    "illegal": "bigint",
    "audits": "array<string>",
    "behind": "array<bigint>",
    "prices": "array<bigint>",
}


def traced(chunks: DataFrame) -> DataFrame:
    """Chunks with the cheapest edits from every state they may be entered in: ``audits, behind, prices``."""
    conv, turn = (chunks.schema[c].dataType.simpleString() for c in ("conv_id", "first_turn"))
    schema = _parsed(_schema(_TRACED, conv, turn))
    fields = _fields(schema)
    ends = _end_prices(chunks).withColumnsRenamed({"part": "p", "seq": "s"})
    known = [name for name in chunks.columns if name != "costs"]
    joined = chunks.join(ends, (F.col("part") == F.col("p")) & (F.col("seq") == F.col("s")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for *row, ends, final in _rows(batches):
            letters = list(zip(_initials(row[3]), row[5]))
            if ends is None:
                found = repairs(letters)
            else:
                found = repairs(letters, ends, final, range(STATES))
            audits, behind, prices = zip(*(found.get(state, (None, None, None)) for state in range(STATES)))
            yield (*row, audits, behind, prices)

    rows = joined.select(*known, "ends", "final")
    return rows.mapInArrow(lambda batches: _batches(run(batches), fields, [4]), schema)


def _repaired(roles: Sequence[str], texts: Sequence[str], audit: str, state: int) -> Iterator[tuple[str, str, str]]:
    """The edits that leave a row, each with role and text."""
    rows = iter(zip(roles, texts))
    for edit in audit:
        role, text = ("", "") if edit == INSERT else next(rows)
        if edit == DELETE:
            continue
        state = AFTER[state, role[:1]] if edit == KEEP else 3 if state == 2 else 2
        yield edit, role if edit == KEEP else ROLE[state], text


_AUDIT = {
    "gaps": "bigint",
    "blank": "bigint",
    "duplicate": "bigint",
    "truncated": "bigint",
    "illegal": "bigint",
    "cost": "bigint",
    "audit": "string",
    "repaired_sha256": "string",
}


def _together(chunks: DataFrame) -> DataFrame:
    return chunks.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")


def repaired_turns(turns: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The repaired rows: ``conv_id, position, edit, role, text``, positions from 0 in each conversation."""
    conv = turns.schema["conv_id"].dataType.simpleString()
    schema = _parsed(f"conv_id {conv}, position bigint, edit string, role string, text string")
    fields = _fields(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        started, before, state, position = False, None, 0, 0
        for conv_id, _, _, roles, texts, *_, audits, behind, _ in _rows(batches):
            if not started or conv_id != before:
                started, before, state, position = True, conv_id, 0, 0
            for edit, role, text in _repaired(roles, texts, audits[state], state):
                yield conv_id, position, edit, role, text
                position += 1
            state = behind[state]

    rows = _together(traced(chunked(turns, chunk_rows)))
    return rows.mapInArrow(lambda batches: _batches(run(batches), fields, []), schema)


def audit_conversations(turns: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """What is wrong with every conversation, and the cheapest repair.

    Columns ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256``. Takes conv_id, turn, role and text; other columns are
    ignored. Null roles and texts are one space; rows without a conversation id
    are one conversation. Rows are taken by turn, nulls first, rows of one turn
    by role and text; repeated rows count, all but the first as duplicates. A
    role whose first letter is not s, u or a can only be replaced or deleted.
    Texts and conversations may be of any length. An empty table gives no rows.
    """
    conv = turns.schema["conv_id"].dataType.simpleString()
    schema = _parsed(_schema(_AUDIT, conv))
    fields = _fields(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        conv, held = None, None
        for row in _rows(batches):
            if held is None or row[0] != conv:
                if held is not None:
                    yield held.row(conv)
                conv, held = row[0], _Audit()
            held.add(*row[3:])
        if held is not None:
            yield held.row(conv)

    rows = _together(traced(chunked(turns, chunk_rows)))
    return rows.mapInArrow(lambda batches: _batches(run(batches), fields, []), schema)


class _Audit:
    """What the chunks of a conversation add up to, one after the other."""

    def __init__(self) -> None:
        self.digest = hashlib.sha256()
        self.audits: list[str] = []
        self.faults = dict.fromkeys((BLANK, DUPLICATE, TRUNCATED, FINE), 0)
        self.state = self.cost = self.illegal = self.turns = 0
        self.first = self.last = self.letter = None
        self.written = False

    def add(self, roles, texts, faults, first, last, turns, illegal, audits, behind, prices) -> None:
        for fault in self.faults:
            self.faults[fault] += faults.count(fault)
        letters = _initials(roles)
        self.illegal += illegal + (self.letter is not None and self.letter + letters[0] not in LEGAL)
        self.letter = letters[-1]
        if first is not None:
            self.turns += turns - (first == self.last)
            self.first = first if self.first is None else self.first
            self.last = last
        for _, role, text in _repaired(roles, texts, audits[self.state], self.state):
            self.digest.update(f"{chr(10) * self.written}{role}:{text}".encode())
            self.written = True
        self.audits.append(audits[self.state])
        self.cost += prices[self.state]
        self.state = behind[self.state]

    def row(self, conv: object) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        counts = (self.faults[f] for f in (BLANK, DUPLICATE, TRUNCATED))
        return (conv, gaps, *counts, self.illegal, self.cost, "".join(self.audits), self.digest.hexdigest())


def damaged_audit(turns: DataFrame) -> DataFrame:
    """The audit of every conversation after ``damage``; one without rows left has zeros and an empty audit."""
    found = audit_conversations(damage(turns)).withColumnRenamed("conv_id", "found_id")
    every = turns.select("conv_id").distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").drop("found_id")
    empty = {name: F.lit(0).cast("bigint") for name, kind in _AUDIT.items() if kind == "bigint"}
    empty |= {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    return joined.select("conv_id", *(F.coalesce(name, empty[name]).alias(name) for name in _AUDIT))

"""Repair of damaged conversations: the cheapest edits that give `(s?(ua)+)?`, by auction.

A conversation is a lattice: a node for every number of rows read and every state of the role
pattern, an arc for every edit. Keep costs 0, rerole 3, delete 4, insert 3; a truncated row that
stays costs 3 more; blank and repeated rows must be deleted. The auction algorithm keeps a price
per node, never above the cost of an arc plus the price behind it, and a path of tight arcs from
the origin: it extends the path along a tight arc, or raises the last price and contracts. When
the path arrives, every arc of every cheapest path is tight, and the least edits are traced along
tight arcs that lead to the end.

Rows are dealt by range of (conversation, turn), so a very long conversation is spread like any
other data. Runs of up to 64 rows are segments. The costs of a segment from every entry to every
exit state are found by auction where the segment lies; one pass from the last segment of each
conversation to its first adds them up, 16 numbers a segment; then every segment is traced from
each entry state, and one pass forward picks among the four. Texts move once, to be hashed in
order: the digest and the edits of a conversation are one value each, and are built by reading
its sorted rows as a stream.

Cases: a null role or text is one space; a null conversation id is one conversation, a null turn
comes before all others. Rows of one turn are ordered by role, then by the SHA-256 of the text;
equal rows follow each other, and all but the first are duplicates. Roles that start with another letter
than s, u or a must be changed or deleted. Empty texts are blank. An empty table gives no rows.
Columns other than `conv_id`, `turn`, `role` and `text` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.session import cut_lineage

KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3

#: Where a kept role leads: the start, after a system row, after a user row, after an answer.
STATES = 4
NEXT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
#: The one role that rerole and insert may give in each state.
GIVEN = ["user", "user", "assistant", "user"]
#: What ends a conversation in each state.
TAIL = ["", "II", "I", ""]

SEGMENT_BITS = 6
_FAR = 1 << 30
_REMEMBERED = 200_000
_SOLID = r"[^\x20\x09-\x0D]"
_ENDED = r"[.!?][\x20\x09-\x0D]*\z"
_LEGAL = {"su", "ua", "au"}


# ------------------------------------------------------------------ lattice and auction


def _step(state: int, role: str) -> int:
    return NEXT[state][role[0]]


def lattice(shape: str) -> list[list[tuple[str, int, int]]]:
    """Arcs (edit, cost, node) of a segment, by node; the end node is the last and has none.

    One letter per row: its role's initial (o: another), upper case if it is truncated, x if it
    must go. Edits that insert after the last row are left to the next segment or the tail.
    """
    end = (len(shape) + 1) * STATES
    arcs: list[list[tuple[str, int, int]]] = [[] for _ in range(end + 1)]
    for row, letter in enumerate(shape):
        extra = TRUNCATED_COST if letter.isupper() else 0
        for state in range(STATES):
            out = arcs[row * STATES + state]
            ahead = (row + 1) * STATES
            given = _step(state, GIVEN[state])
            out.append((DELETE, COST[DELETE], ahead + state))
            out.append((INSERT, COST[INSERT], row * STATES + given))
            if letter != "x":
                kept = NEXT[state].get(letter.lower())
                if kept is not None:
                    out.append((KEEP, COST[KEEP] + extra, ahead + kept))
                out.append((REROLE, COST[REROLE] + extra, ahead + given))
    return arcs


def leading(arcs: list[list[tuple[str, int, int]]], tight=None) -> list[bool]:
    """The nodes from which the end can be reached (over arcs that `tight` accepts)."""
    found = [False] * len(arcs)
    found[-1] = True
    for layer in range(len(arcs) // STATES - 1, -1, -1):
        for _ in range(2):  # inserts stay in a layer, and two of them visit all it leads to
            for node in range(layer * STATES, layer * STATES + STATES):
                if not found[node]:
                    found[node] = any(found[j] and (tight is None or tight(node, c, j)) for _, c, j in arcs[node])
    return found


def auction(arcs: list[list[tuple[str, int, int]]], origin: int, price: list[int]):
    """Raises `price` until the path from the origin along tight arcs arrives at the last node.

    Prices must keep within arc costs, as zeros do; those left by other origins do, too. Every
    node must lead to the end, and no loop may be free.
    """
    path, end = [origin], len(arcs) - 1
    while path[-1] != end:
        node = path[-1]
        best, ahead = _FAR, end
        for _, cost, j in arcs[node]:
            if cost + price[j] < best:
                best, ahead = cost + price[j], j
        if price[node] < best:
            price[node] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(ahead)


def priced(shape: str, after: list[int | None]):
    """Arcs and converged prices of a segment with the costs behind its exit states."""
    arcs = lattice(shape)
    for state, cost in enumerate(after):
        if cost is not None:
            arcs[len(shape) * STATES + state].append(("", cost, len(arcs) - 1))
    alive = leading(arcs)
    arcs = [[a for a in out if alive[a[2]]] for out in arcs]
    price = [0] * len(arcs)
    for state in range(STATES):
        if alive[state]:
            auction(arcs, state, price)
    return arcs, price, alive


def crossing(shape: str) -> list[int]:
    """The cost from each entry state to each exit state, row by row; -1 where there is no way."""
    table = [-1] * STATES**2
    for out in range(STATES):
        _, price, alive = priced(shape, [0 if s == out else None for s in range(STATES)])
        for state in range(STATES):
            if alive[state]:
                table[state * STATES + out] = price[state]
    return table


def traced(shape: str, after: list[int]) -> tuple[list[str], list[int], list[int]]:
    """From each entry state: the least of the cheapest edits, the exit state, and the cost."""
    least = min(after)  # prices start at zero, so costs behind the segment are taken relative to it
    arcs, price, _ = priced(shape, [c - least for c in after])
    leads = leading(arcs, lambda i, c, j: price[i] == c + price[j])
    edits, exits = [], []
    for state in range(STATES):
        node, letters = state, []
        while node < len(shape) * STATES:
            letter, node = min((e, j) for e, c, j in arcs[node] if leads[j] and price[node] == c + price[j])
            letters.append(letter)
        edits.append("".join(letters))
        exits.append(node % STATES)
    return edits, exits, [price[s] + least for s in range(STATES)]


TAIL_COST = [len(t) * COST[INSERT] for t in TAIL]


# ------------------------------------------------------------------ Spark


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with faults planted by the CRC of their id and turn: some dropped, emptied, cut, repeated, reroled."""
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    return conversations.where(fault != 0).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(fault == 4, "user").otherwise(shown("role")).alias("role"),
        text.alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def _plain(rows: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        text.alias("text"),
        F.unhex(F.sha2(text, 256)).alias("twin"),
    )


def faults(rows: DataFrame) -> DataFrame:
    """One row per row: its keys, its digest and its first fault, without the text."""
    blank = ~F.col("text").rlike(_SOLID)
    counted = (
        _plain(rows)
        .withColumn("blank", blank)
        .withColumn("open", ~blank & ~F.col("text").rlike(_ENDED))
        .groupBy("conv_id", "turn", "role", "twin", "blank", "open")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    first = counted.groupBy(
        F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("twin").alias("_twin")
    ).agg(F.min(turn).alias("_first"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("twin") == F.col("_twin"))
    copy = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    again = (F.col("copy") > 1) | ~F.col("_turn").eqNullSafe(F.col("_first"))
    initial = F.when(F.col("role").rlike("^[sua]"), F.substring("role", 1, 1)).otherwise("o")
    return (
        counted.join(first, same)
        .select("conv_id", "turn", "role", "twin", "blank", "open", "_first", turn.alias("_turn"), copy)
        .withColumn("duplicate", ~F.col("blank") & again)
        .withColumn("truncated", F.col("open") & ~F.col("duplicate"))
        .withColumn("initial", initial)
        .withColumn(
            "shape",
            F.when(F.col("blank") | F.col("duplicate"), "x")
            .when(F.col("truncated"), F.upper("initial"))
            .otherwise(F.col("initial")),
        )
        .drop("_first", "_turn", "open")
    )


def _in_order(columns: str = "conv_id turn role twin copy") -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns.split()]


def segments(found: DataFrame) -> DataFrame:
    """(conv_id, segment, shape, initials): up to 64 neighbouring rows of a conversation each."""
    placed = cut_lineage(
        found.repartitionByRange(*_in_order())
        .sortWithinPartitions(*_in_order())
        .select("conv_id", "shape", "initial", F.monotonically_increasing_id().alias("at"))
    )
    rows = F.array_sort(F.collect_list(F.struct("at", "shape", "initial")))
    return (
        placed.groupBy("conv_id", F.shiftright("at", SEGMENT_BITS).alias("segment"))
        .agg(rows.alias("rows"))
        .select("conv_id", "segment", F.array_join("rows.shape", "").alias("shape"), F.array_join("rows.initial", "").alias("initials"))
    )


def _remember(function):
    known: dict = {}

    def call(*key):
        if key not in known:
            if len(known) > _REMEMBERED:
                known.clear()
            known[key] = function(*key)
        return known[key]

    return call


def _add_crossings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cost = _remember(crossing)
    for batch in batches:
        tables = [cost(s) for s in batch.column("shape").to_pylist()]
        yield batch.append_column("costs", pa.array(tables, pa.list_(pa.int32())))


def _look_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cost behind each segment by exit state; segments of a conversation come last first."""
    conversation, after, started = None, TAIL_COST, False
    for batch in batches:
        behind = []
        for conv, costs in zip(batch.column("conv_id").to_pylist(), batch.column("costs").to_pylist()):
            if not started or conv != conversation:
                conversation, after, started = conv, TAIL_COST, True
            behind.append(after)
            after = [
                min(costs[s * STATES + t] + after[t] for t in range(STATES) if costs[s * STATES + t] >= 0)
                for s in range(STATES)
            ]
        yield pa.record_batch(
            [*(batch.column(c) for c in ("conv_id", "segment", "shape", "initials")), pa.array(behind, pa.list_(pa.int64()))],
            names=["conv_id", "segment", "shape", "initials", "after"],
        )


def _trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # only differences of the costs behind a segment matter to its edits
    way = _remember(lambda shape, after: traced(shape, list(after)))
    for batch in batches:
        edits, exits, costs = [], [], []
        for shape, after in zip(batch.column("shape").to_pylist(), batch.column("after").to_pylist()):
            least = min(after)
            e, x, c = way(shape, tuple(a - least for a in after))
            edits.append(e)
            exits.append(x)
            costs.append(c[0] + least)
        yield pa.record_batch(
            [
                batch.column("conv_id"), batch.column("segment"), batch.column("initials"),
                pa.array(edits, pa.list_(pa.string())), pa.array(exits, pa.list_(pa.int32())), pa.array(costs, pa.int64()),
            ],
            names=["conv_id", "segment", "initials", "edits", "exits", "cost"],
        )


WAYS = "conv_id long, segment long, initials string, edits array<string>, exits array<int>, cost long"


def ways(found: DataFrame) -> DataFrame:
    """Per segment the edits from each entry state, given what follows it, and the cost from the start state."""
    shapes = "conv_id long, segment long, shape string, initials string"
    crossed = segments(found).mapInArrow(_add_crossings, f"{shapes}, costs array<int>")
    back = (
        crossed.repartition("conv_id")
        .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.desc("segment"))
        .mapInArrow(_look_back, f"{shapes}, after array<long>")
    )
    return back.repartition("conv_id", "segment").mapInArrow(_trace, WAYS)


class _Reader:
    """One conversation as it streams by: segments in order, then rows in order."""

    def __init__(self, conversation: int | None, lines: bool):
        self.conversation, self.lines = conversation, lines
        self.state, self.cost, self.illegal, self.last = 0, None, 0, ""
        self.edits: list[str] = []
        self.audit = ""
        self.read = None  # the place in the audit, once rows have begun
        self.hash, self.count = hashlib.sha256(), 0
        self.turns: list[tuple[str, str]] = []

    def segment(self, initials: str, edits: list[str], exits: list[int], cost: int):
        if self.cost is None:
            self.cost = cost
        chain = self.last + initials
        self.illegal += sum(chain[k : k + 2] not in _LEGAL for k in range(len(chain) - 1))
        self.last = initials[-1]
        self.edits.append(edits[self.state])
        self.state = exits[self.state]

    def _begin(self):
        if self.read is None:
            self.audit = "".join(self.edits) + TAIL[self.state]
            self.read, self.state = 0, 0

    def _say(self, role: str, text: str):
        self.hash.update((("\n" if self.count else "") + f"{role}:{text}").encode())
        self.state = _step(self.state, role)
        self.count += 1
        if self.lines:
            self.turns.append((role, text))

    def _inserts(self):
        while self.read < len(self.audit) and self.audit[self.read] == INSERT:
            self.read += 1
            self._say(GIVEN[self.state], "")

    def row(self, role: str, text: str):
        self._begin()
        self._inserts()
        edit = self.audit[self.read]
        self.read += 1
        if edit == KEEP:
            self._say(role, text)
        elif edit == REROLE:
            self._say(GIVEN[self.state], text)

    def end(self) -> tuple:
        self._begin()
        self._inserts()
        return self.conversation, self.illegal, self.cost, self.audit, self.hash.hexdigest()


def _stream(batches: Iterator[pa.RecordBatch], lines: bool) -> Iterator[tuple[_Reader, bool]]:
    """The reader after every batch and at the end of its conversation."""
    reader = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "initials", "edits", "exits", "cost", "role", "text")]
        for conv, initials, edits, exits, cost, role, text in zip(*columns):
            if reader is None or conv != reader.conversation:
                if reader is not None:
                    yield reader, True
                reader = _Reader(conv, lines)
            if initials is not None:
                reader.segment(initials, edits, exits, cost)
            else:
                reader.row(role, text)
        if reader is not None and lines:
            yield reader, False
    if reader is not None:
        yield reader, True


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "illegal", "cost", "audit", "repaired_sha256"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    done = []
    for reader, _ in _stream(batches, False):
        done.append(reader.end())
        if len(done) >= 5_000:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
            done = []
    if done:
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)


def _read_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for reader, over in _stream(batches, True):
        if over:
            reader.end()
        start = reader.count - len(reader.turns)
        if reader.turns:
            roles, texts = zip(*reader.turns)
            yield pa.record_batch(
                [
                    pa.array([reader.conversation] * len(roles), pa.int64()),
                    pa.array(range(start, reader.count), pa.int64()), pa.array(roles), pa.array(texts),
                ],
                names=["conv_id", "turn", "role", "text"],
            )
            reader.turns = []


def _sorted_stream(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's segments and then its rows, in order, in one partition."""
    texts = _plain(rows).withColumn("is_row", F.lit(True))
    both = ways(found).withColumn("is_row", F.lit(False)).unionByName(texts, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions(*_in_order("conv_id is_row segment turn role twin"))


def repaired_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): the repaired conversations, turns numbered from 0."""
    return _sorted_stream(rows, faults(rows)).mapInArrow(_read_turns, "conv_id long, turn long, role string, text string")


def repair(rows: DataFrame) -> DataFrame:
    """Per conversation: gaps in its turns, faults, the cost of the cheapest edits, and the repaired digest."""
    found = faults(rows)
    per_turn = found.groupBy("conv_id", "turn").agg(
        *[F.sum(F.col(c).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated")]
    )
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
    counts = per_turn.groupBy("conv_id").agg(
        gaps.alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]
    )
    read = _sorted_stream(rows, found).mapInArrow(
        _read, "conv_id long, illegal long, cost long, audit string, repaired_sha256 string"
    )
    read = read.withColumnRenamed("conv_id", "_conv")
    return counts.join(read, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


def with_empty(conversations: DataFrame, repaired: DataFrame) -> DataFrame:
    """`repaired` and a row of zeros for each conversation that lost all its rows."""
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    ids = conversations.select(F.col("conv_id").cast("long").alias("_id")).distinct()
    return ids.join(repaired, F.col("_id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("_id").alias("conv_id"),
        *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )

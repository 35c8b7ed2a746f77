"""Repair of the turn structure of conversations on a suffix-shared automaton.

Each turn becomes one letter for its role and fault, so a conversation is a signature. Signatures
are sorted from their ends: neighbours in that order share suffixes, and each different suffix is
one node of an acyclic automaton, kept on a stack while the sorted signatures stream by. A node
holds, for every state of the role grammar `(s?(ua)+)?`, the cost to go and the best edits for the
rest of the conversation. It is made once from its letter and the node after it, whichever and
however many conversations end in that suffix; only the path to the next partition is made again.

A conversation over `piece` turns or `piece_bytes` of text is cut into pieces by a range sort. The
costs of a piece from each state to each other are small matrices; one scan from the last piece to
the first gives what each piece has after it, which takes the place of the end of the automaton,
and one scan forwards the state that each piece starts in. So no task holds a whole long
conversation; only its digest, one cell and one SHA-256, is written by one task as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.exchange import written

PIECE = 2_000
PIECE_BYTES = 8 << 20
#: Up to so many long conversations are named to every task, more go through a shuffled join.
FEW = 50_000
BLANK_SPACE = "\x20\t\n\v\f\r"
DELETE, RELABEL, ADD, TRUNCATED = 2, 1, 5, 5
ROLES = {"s": "system", "u": "user", "a": "assistant"}
#: Grammar states: nothing yet, after system, after user, after assistant. It may end in 0 and 3.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: State that an added or relabelled turn leads to, and its role: each state allows only one.
GROWN = (2, 2, 3, 2)
GROWN_ROLE = ("user", "user", "assistant", "user")
FAR = 1 << 50
END = "0,10,5,0"
_TURN = "struct<turn:bigint,role:string,text:string,n:bigint,again:boolean>"


def damage(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n): turns as the contract damages them; n copies, 0 if dropped.

    Null roles and texts are one space; so are null numbers within the hashed name.
    """
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(name.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return turns.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind <= 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("bigint").alias("n"),
    )


# ---- the automaton ----


class Node:
    """Cost to go, best edits and last state for each state of the grammar."""

    __slots__ = ("cost", "edits", "last")

    def __init__(self, cost, edits, last):
        self.cost, self.edits, self.last = cost, edits, last


def sink(after: str) -> Node:
    """What follows a signature: costs by state, ahead of which nothing is added, or the end."""
    cost = tuple(map(int, after.split(",")))
    if after == END:
        return Node(cost, ("", "II", "I", ""), (0, 3, 3, 3))
    return Node(cost, ("",) * 4, (0, 1, 2, 3))


def grow(letter: str, rest: Node) -> Node:
    """The node of `letter` and then `rest`.

    The edits that may come first (Delete, Insert, Keep, Rerole) have different initials, and each
    leads to one state, so the least initial among the cheapest gives the least string.
    """
    cost, edits, last = [0] * 4, [""] * 4, [0] * 4
    role, extra = letter.lower(), TRUNCATED if letter.isupper() else 0
    for s in range(4):
        best = (DELETE + rest.cost[s], "D", s)
        if letter != "x":
            t = NEXT.get((s, role))
            if t is not None:
                best = min(best, (extra + rest.cost[t], "K", t))
            best = min(best, (RELABEL + extra + rest.cost[GROWN[s]], "R", GROWN[s]))
        cost[s], edits[s], last[s] = best[0], best[1] + rest.edits[best[2]], rest.last[best[2]]
    plain = list(zip(cost, edits, last))
    for s in (2, 3, 0, 1):  # one added turn between user and assistant is enough, two bring back the state
        c, e, z = plain[GROWN[s]] if s > 1 else (cost[2], edits[2], last[2])
        if (ADD + c, "I") < (plain[s][0], plain[s][1][0]):
            cost[s], edits[s], last[s] = ADD + c, "I" + e, z
    return Node(tuple(cost), tuple(edits), tuple(last))


class Automaton:
    """Nodes of the last signature; those of its common suffix with the next one are kept."""

    def __init__(self):
        self.after, self.reversed, self.nodes, self.made = None, "", [], 0

    def read(self, after: str, reverse: str) -> Node:
        if after != self.after:
            self.after, self.reversed, self.nodes = after, "", [sink(after)]
        same, most = 0, min(len(reverse), len(self.reversed))
        while same < most and reverse[same] == self.reversed[same]:
            same += 1
        del self.nodes[same + 1 :]
        for letter in reverse[same:]:
            self.nodes.append(grow(letter, self.nodes[-1]))
        self.made += len(reverse) - same
        self.reversed = reverse
        return self.nodes[-1]


def _walk(every: bool):
    """Reads (conv, seg, after, reverse) in order of the last two."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton()
        for batch in batches:
            nodes = [
                automaton.read(after, reverse)
                for after, reverse in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            ]
            states = range(4 if every else 1)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array([n.cost for n in nodes], pa.list_(pa.int64())),
                    pa.array([[n.edits[s] for s in states] for n in nodes], pa.list_(pa.string())),
                    pa.array([n.last for n in nodes], pa.list_(pa.int32())),
                ],
                names=["conv_id", "seg", "after", "cost", "edits", "last"],
            )

    return fn


def walked(signatures: DataFrame, every: bool) -> DataFrame:
    """Nodes of signatures (conv_id, seg, after, reverse); equal ones are dealt out by conversation."""
    kind = signatures.schema["conv_id"].dataType.simpleString()
    order = ["after", "reverse", "conv_id", "seg"]
    rows = signatures.select("conv_id", "seg", "after", "reverse")
    return (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(
            _walk(every),
            f"conv_id {kind}, seg bigint, after string, cost array<bigint>, edits array<string>, last array<int>",
        )
    )


# ---- turns to signatures ----


def letter(role: str, text: str, again: bool) -> str:
    tail = text.rstrip(BLANK_SPACE)
    if again or not tail:
        return "x"
    c = role[:1] if role[:1] in ROLES and role else "o"
    return c if tail[-1] in ".!?" else c.upper()


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the signature of each piece, read from its end."""
    for batch in batches:
        out = []
        for turns in batch.column("turns").to_pylist():
            seen: set = set()
            letters = []
            for t in turns:
                key = (t["role"], t["text"])
                letters.append(letter(*key, t["again"] or key in seen))
                seen.add(key)
            out.append("".join(reversed(letters)))
        yield batch.append_column("reverse", pa.array(out, pa.string()))


def _cut(piece: int, piece_bytes: int):
    """Packs sorted turns (conv, turn, role, text, n, again) into pieces."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = TaskContext.get().partitionId() << 32
        kind = pa.struct(
            [("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("n", pa.int64()), ("again", pa.bool_())]
        )
        conv_type, conv, held, size = None, None, [], 0

        def pack():
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], conv_type), pa.array([seg], pa.int64()), pa.array([held], pa.list_(kind))],
                names=["conv_id", "seg", "turns"],
            )

        for batch in batches:
            conv_type = batch.schema.field("conv_id").type
            for row in batch.to_pylist():
                if held and (row["conv_id"] != conv or len(held) >= piece or size >= piece_bytes):
                    yield pack()
                    seg, held, size = seg + 1, [], 0
                conv = row.pop("conv_id")
                held.append(row)
                size += len(row["text"])
        if held:
            yield pack()

    return fn


def _short(rows: DataFrame) -> DataFrame:
    """One piece for each conversation."""
    turn = F.struct("turn", "role", "text", "n", F.lit(False).alias("again"))
    turns = F.sort_array(F.collect_list(F.when(F.col("n") > 0, turn)))
    return rows.groupBy("conv_id").agg(F.lit(0).cast("bigint").alias("seg"), turns.alias("turns"))


def _long(rows: DataFrame, piece: int, piece_bytes: int) -> DataFrame:
    """Pieces of conversations of any length; equal turns are counted first, then the first is found."""
    rows = rows.filter("n > 0").groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    blank = F.length(F.translate("text", BLANK_SPACE, "")) == 0
    whole = rows.filter(~blank)
    first = whole.groupBy("conv_id", "role", "text").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("c"))
    first = first.filter("c > 1").toDF("conv", "by", "said", "first", "c")
    on = F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("role") == F.col("by")) & (F.col("text") == F.col("said"))
    again = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    names = ["conv_id", "turn", "role", "text", "n"]
    marked = whole.join(first, on, "left").select(*names, again.alias("again"))
    marked = marked.union(rows.filter(blank).select(*names, F.lit(True)))
    kind = rows.schema["conv_id"].dataType.simpleString()
    order = names[:4]
    return (
        marked.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_cut(piece, piece_bytes), f"conv_id {kind}, seg bigint, turns array<{_TURN}>")
    )


# ---- pieces of one conversation, in order ----


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each piece has after it, from rows (conv, seg, matrix) with the last piece first."""
    conv, after, begun = None, END, False
    for batch in batches:
        out = []
        for c, ways in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if not begun or c != conv:
                conv, after, begun = c, END, True
            out.append(after)
            then = list(map(int, after.split(",")))
            cost = [min(ways[q][s] + then[q] for q in range(4)) for s in range(4)]
            after = ",".join(str(x - min(cost)) for x in cost)
            if after == END:  # told apart from the end, where turns may still be added
                after = "0,10,5,00"
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out, pa.string())], names=["conv_id", "seg", "after"])


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of each piece from the state that the pieces before it lead to."""
    conv, state, begun = None, 0, False
    for batch in batches:
        starts, edits = [], []
        for c, e, z in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
            if not begun or c != conv:
                conv, state, begun = c, 0, True
            starts.append(state)
            edits.append(e[state])
            state = z[state]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(starts, pa.int32()), pa.array(edits, pa.string())],
            names=["conv_id", "seg", "start", "edits"],
        )


def _chosen_long(pieces: DataFrame) -> DataFrame:
    """(conv_id, seg, start, edits) for pieces of cut conversations."""
    kind = pieces.schema["conv_id"].dataType.simpleString()
    units = [",".join("0" if q == s else str(FAR) for s in range(4)) for q in range(4)]
    asked = pieces.withColumn("after", F.explode(F.array(*map(F.lit, units))))
    to = walked(asked, True).select("conv_id", "seg", F.struct("after", "cost").alias("way"))
    by_state = F.array(*(F.max(F.when(F.col("way.after") == u, F.col("way.cost"))) for u in units))
    ways = to.groupBy("conv_id", "seg").agg(by_state.alias("ways"))
    ways = ways.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("seg"))
    after = ways.mapInArrow(_backward, f"conv_id {kind}, seg bigint, after string")
    signed = pieces.select("conv_id", "seg", "reverse").alias("p").join(
        after.alias("a"), F.expr("p.conv_id <=> a.conv_id and p.seg = a.seg")
    )
    nodes = walked(signed.select("p.conv_id", "p.seg", "after", "reverse"), True)
    nodes = nodes.select("conv_id", "seg", "edits", "last").repartition("conv_id").sortWithinPartitions("conv_id", "seg")
    return nodes.mapInArrow(_forward, f"conv_id {kind}, seg bigint, start int, edits string")


def repaired_pieces(rows: DataFrame, piece: int = PIECE, piece_bytes: int = PIECE_BYTES):
    """Whole conversations and pieces of cut ones, (conv_id, seg, turns, reverse, start, edits) each.

    The second is None if no conversation is cut; the third has the ids of cut ones.
    """
    size = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b"))
    long = size.filter((F.col("n") > piece) | (F.col("b") > piece_bytes)).select(F.col("conv_id").alias("long_id"))
    long = written(long, "long")
    count = long.count()
    named = F.broadcast(long) if count <= FEW else long
    is_long = F.col("conv_id").eqNullSafe(F.col("long_id"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, seg bigint, turns array<{_TURN}>, reverse string"

    def signed(pieces: DataFrame) -> DataFrame:
        return written(pieces.mapInArrow(_signed, schema), "pieces")

    def joined(pieces: DataFrame, chosen: DataFrame) -> DataFrame:
        p, c = pieces.alias("p"), chosen.alias("c")
        both = p.join(c, F.expr("p.conv_id <=> c.conv_id and p.seg = c.seg"))
        return both.select("p.*", "c.start", "c.edits")

    short = signed(_short(rows.join(named, is_long, "left_anti") if count else rows))
    ends = walked(short.withColumn("after", F.lit(END)), False)
    chosen = ends.select("conv_id", "seg", F.lit(0).alias("start"), F.col("edits")[0].alias("edits"))
    short = joined(short, chosen)
    if not count:
        return short, None, long
    pieces = signed(_long(rows.join(named, is_long, "left_semi"), piece, piece_bytes))
    return short, joined(pieces, written(_chosen_long(pieces), "chosen")), long


# ---- results ----


def steps(turns: list[dict], edits: str, state: int) -> Iterator[tuple[str, dict | None, str, str]]:
    """(edit, turn, role, text) in order; copies of a turn after the first are deleted."""
    at = 0
    for e in edits:
        if e == "I":
            yield e, None, GROWN_ROLE[state], ""
            state = GROWN[state]
            continue
        t = turns[at]
        at += 1
        if e == "D":
            yield e, t, t["role"], t["text"]
        elif e == "K":
            yield e, t, t["role"], t["text"]
            state = NEXT[state, t["role"][0]]
        else:
            yield e, t, GROWN_ROLE[state], t["text"]
            state = GROWN[state]
        for _ in range(t["n"] - 1):
            yield "D", t, t["role"], t["text"]


class Fold:
    """Digest of one conversation, fed with its pieces in order."""

    def __init__(self):
        self.low = self.high = None
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.role, self.audit, self.sha, self.empty = None, [], hashlib.sha256(), True

    def feed(self, turns: list[dict], reverse: str, start: int, edits: str) -> None:
        for t, code in zip(turns, reversed(reverse)):
            n = t["n"]
            if t["turn"] is not None:
                if self.low is None:
                    self.low = t["turn"]
                self.distinct += t["turn"] != self.high
                self.high = t["turn"]
            initial = t["role"][:1]
            self.illegal += n - 1 + (self.role is not None and self.role + initial not in ("su", "ua", "au"))
            self.role = initial
            if not t["text"].strip(BLANK_SPACE):
                self.blank += n
            elif code == "x":
                self.duplicate += n
            else:
                self.duplicate += n - 1
                self.truncated += code.isupper()
        codes = iter(reversed(reverse))
        letters, before = [], None
        for e, t, role, text in steps(turns, edits, start):
            letters.append(e)
            code = next(codes) if t is not None and t is not before else "x"
            before = t if t is not None else before
            self.cost += {"D": DELETE, "I": ADD, "R": RELABEL, "K": 0}[e]
            if e != "D":
                self.cost += TRUNCATED if code.isupper() else 0
                self.sha.update(((b"" if self.empty else b"\n") + f"{role}:{text}".encode()))
                self.empty = False
        self.audit.append("".join(letters))

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        counts = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost)
        return (*counts, "".join(self.audit), self.sha.hexdigest())


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, fold, kind = None, None, None

    def out(rows: list[tuple]) -> pa.RecordBatch:
        types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        cols = list(zip(*rows)) if rows else [()] * 9
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, types)], names=["conv_id", *COUNTS, "audit", "repaired_sha256"]
        )

    for batch in batches:
        kind, done = batch.schema.field("conv_id").type, []
        for k, c in enumerate(batch.column("conv_id").to_pylist()):
            if fold is None or c != conv:
                if fold is not None:
                    done.append((conv, *fold.row()))
                conv, fold = c, Fold()
            fold.feed(*(batch.column(x)[k].as_py() for x in ("turns", "reverse", "start", "edits")))
        yield out(done)
    if fold is not None:
        yield out([(conv, *fold.row())])


def repair(rows: DataFrame, piece: int = PIECE, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Faults, cheapest edits and a digest of the repaired turns, a row for each conversation.

    `rows` are turns (conv_id, turn, role, text, n), with n copies each. Turns are ordered by
    number, role and text, nulls first; roles and texts must not be null, while numbers and
    conversation ids may be. Rows with n = 0 only name their conversation, which without turns has
    zeros, no edits and the hash of an empty string. Repeated rows are duplicates but for the first. Other columns are
    ignored. An empty table gives no rows. Texts are never cut; one over `piece_bytes` is a piece.
    """
    rows = rows.select("conv_id", "turn", "role", "text", "n")
    short, cut, long = repaired_pieces(rows, piece, piece_bytes)
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", audit string, repaired_sha256 string"
    result = short.mapInArrow(_folded, schema)
    if cut is None:
        return result
    folded = cut.repartition("conv_id").sortWithinPartitions("conv_id", "seg").mapInArrow(_folded, schema)
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    none = {c: 0 for c in COUNTS} | {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    every = long.join(folded, same, "left").drop("conv_id").withColumnRenamed("long_id", "conv_id")
    return result.union(every.select("conv_id", *(F.coalesce(F.col(c), F.lit(x)).alias(c) for c, x in none.items())))


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for k, c in enumerate(batch.column("conv_id").to_pylist()):
            turns, start, edits = (batch.column(x)[k].as_py() for x in ("turns", "start", "edits"))
            rows = [(c, batch.column("seg")[k].as_py(), i, e, t and t["turn"], role, text)
                    for i, (e, t, role, text) in enumerate(steps(turns, edits, start)) if e != "D"]
            types = [kind, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
            cols = list(zip(*rows)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(cols, types)],
                names=["conv_id", "seg", "place", "edit", "turn", "role", "text"],
            )


def repaired_turns(rows: DataFrame, piece: int = PIECE, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """The repaired turns (conv_id, seg, place, edit, turn, role, text), ordered by seg and place.

    `edit` is Keep, Rerole or Insert by its initial; an inserted turn has no number and no text.
    `rows` are those of `repair`. No conversation is gathered.
    """
    rows = rows.select("conv_id", "turn", "role", "text", "n")
    short, cut, _ = repaired_pieces(rows, piece, piece_bytes)
    every = short if cut is None else short.unionByName(cut)
    kind = rows.schema["conv_id"].dataType.simpleString()
    return every.mapInArrow(
        _lines, f"conv_id {kind}, seg bigint, place bigint, edit string, turn bigint, role string, text string"
    )

"""Conversation structure repair by survivor-coalescence Viterbi (operator 11).

A conversation's rows are edited at least cost so that the initials of its
roles read ``(s?(ua)+)?``: Keep costs 0, Rerole to user or assistant 1, Delete
2, Insert of an empty user or assistant turn 5; a truncated row that stays
costs 5 more, and blank and duplicate rows must go. Of the cheapest edits those
whose initials (D, I, K, R) are ASCII-least are taken.

**Survivors.** The grammar has four states. For each there is at most one
survivor, the best edits so far that end there. Survivors are leaves of a tree
of back pointers with reference counts; what no survivor needs is freed, and
edits that all survivors share are given out at once, so memory follows the
part that is still open. Of two survivors with equal cost the complete open
suffixes are compared. That is right for what comes later too: both end in a
row's edit and hold one for each row, so neither is the beginning of the other.
A survivor is dropped when another one can do whatever it may still do for
less (:data:`DETOUR`).

**Long conversations.** Rows are dealt out by ranges of (conversation, turn), so
one conversation may reach over many tasks. A conversation that lies within one
task and has at most :data:`WHOLE_ROWS` rows is repaired there. Others are cut
into pieces. Each piece is solved from every state it may be entered in; a
second Viterbi over the pieces then needs the cost and the rank of each way
through a piece, a few numbers instead of its rows. Their repeated turns are
found by an aggregate and a join, as they may stand in different pieces.

Defined results: null roles and texts are one space; turns go nulls first, rows
with one turn by md5 of their role and text; a null conv_id is a conversation.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from plume.llm.common import stored

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
#: Where a row with this initial leads from each state; others are not allowed there.
MOVES = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: Initials that may come next, and are inserted or put in place of a role.
NEXT = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
NAMES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: DETOUR[s][t]: what it costs at most to do from state t what can be done from state s. Any continuation from s is
#: followed from t after inserts (to the same next initial); a system row that only START may keep is deleted instead.
DETOUR = {
    START: {SYSTEM: 2 * INSERT, USER: INSERT + DELETE, ASSISTANT: DELETE},
    SYSTEM: {START: 0, USER: INSERT, ASSISTANT: 0},
    USER: {START: INSERT, SYSTEM: INSERT, ASSISTANT: INSERT},
    ASSISTANT: {START: 0, SYSTEM: 2 * INSERT, USER: INSERT},
}
#: Rows of a conversation that is repaired as one, and rows and characters of a piece, at most.
WHOLE_ROWS = 1024
WHOLE_CHARS = 1 << 18

BLANK = "\x20\x09\x0A\x0B\x0C\x0D"

PIECE = ("conv_id long, part long, piece long, whole boolean, n_rows long, blank long, duplicate long, truncated long, illegal long, "
         "gaps long, cost long, audit string, repaired array<struct<role:string,text:string>>")


class Node:
    """An edit in the tree of back pointers."""

    __slots__ = ("above", "edits", "refs")

    def __init__(self, above: "Node | None", edits: str) -> None:
        self.above, self.edits, self.refs = above, edits, 0
        if above:
            above.refs += 1


class Survivors:
    """Viterbi over a stream of rows or pieces. ``step`` returns the edits that became certain; ``close`` the rest."""

    def __init__(self, entry: int = START) -> None:
        self.root = Node(None, "")
        self.best = {entry: (0, self.root)}
        self.root.refs = 1
        self.live = 1

    def step(self, ways: dict[int, list[tuple[int, int, str]]]) -> str:
        """``ways[s]``: (state after, cost, edits) from state s."""
        found: dict[int, tuple[int, Node, str]] = {}
        for state, (cost, node) in self.best.items():
            for to, more, edits in ways.get(state, ()):
                old = found.get(to)
                if old is None or cost + more < old[0] or cost + more == old[0] and self._before(node, edits, old[1], old[2]):
                    found[to] = (cost + more, node, edits)
        for state in list(found):
            if any(other != state and found[state][0] > found[other][0] + DETOUR[state][other] for other in found):
                del found[state]
        before = [node for _, node in self.best.values()]
        self.best = {}
        for state, (cost, node, edits) in found.items():
            new = Node(node, edits)
            new.refs = 1
            self.live += 1
            self.best[state] = (cost, new)
        for node in before:
            self._release(node)
        return self._certain()

    def _before(self, a: Node, a_edits: str, b: Node, b_edits: str) -> bool:
        """Whether edits a come before edits b: the open suffixes from where they part."""
        left, right = [a_edits], [b_edits]
        below = {}  # how many parts of ``left`` stand below a node
        at: Node | None = a
        while at is not None:
            below[id(at)] = len(left)
            left.append(at.edits)
            at = at.above
        at = b
        while id(at) not in below:
            right.append(at.edits)
            at = at.above
        return "".join(reversed(left[:below[id(at)]])) < "".join(reversed(right))

    def _release(self, node: Node | None) -> None:
        while node is not None:
            node.refs -= 1
            if node.refs:
                return
            self.live -= 1
            above, node.above = node.above, None
            node = above

    def _certain(self) -> str:
        """Moves the root down to the lowest node that all survivors share, and returns the edits on the way."""
        if self.root.refs > 1:
            return ""
        paths = []
        for _, node in self.best.values():
            path = [node]
            while path[-1] is not self.root:
                path.append(path[-1].above)
            paths.append(path[::-1])
        shared = 1
        while all(len(p) > shared and p[shared] is paths[0][shared] for p in paths):
            shared += 1
        edits = "".join(n.edits for n in paths[0][1:shared])
        above, self.root = paths[0][shared - 1].above, paths[0][shared - 1]
        self.root.above, self.root.edits = None, ""
        self._release(above)
        return edits

    def open(self, state: int) -> str:
        out = []
        at: Node | None = self.best[state][1]
        while at is not None:
            out.append(at.edits)
            at = at.above
        return "".join(reversed(out))

    def close(self) -> tuple[int, str]:
        """(cost, edits still open) of the best way to end."""
        ends = [(cost + inserts * INSERT, self.open(state) + "I" * inserts)
                for state, (cost, _) in self.best.items() for inserts in [{START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}[state]]]
        return min(ends)


def fault(role: str, text: str, seen: bool) -> str:
    """A row's first fault: b(lank), d(uplicate), t(runcated) or none."""
    end = text.rstrip(BLANK)[-1:]
    return "b" if not end else "d" if seen else "t" if end not in ".!?" else ""


def row_ways(initial: str, found: str) -> dict[int, list[tuple[int, int, str]]]:
    """What may be done with a row from each state: inserts before it, then the row's own edit."""
    key = (initial if initial in MOVES else "", found)
    if key not in _WAYS:
        ways: dict[int, list[tuple[int, int, str]]] = {}
        for state in STATES:
            ways[state] = []
            at = state
            for inserts in range(3):
                cost, edits = inserts * INSERT, "I" * inserts
                ways[state].append((at, cost + DELETE, edits + "D"))
                if found not in ("b", "d"):
                    stay = TRUNCATED if found == "t" else 0
                    if at in MOVES.get(initial, {}):
                        ways[state].append((MOVES[initial][at], cost + KEEP + stay, edits + "K"))
                    ways[state].append((MOVES[NEXT[at]][at], cost + REROLE + stay, edits + "R"))
                at = MOVES[NEXT[at]][at]
        _WAYS[key] = ways
    return _WAYS[key]


_WAYS: dict[tuple[str, str], dict[int, list[tuple[int, int, str]]]] = {}


def apply(rows: list[tuple[str, str]], edits: str, entry: int = START) -> list[tuple[str, str]]:
    """The repaired rows."""
    out, at, state = [], 0, entry
    for edit in edits:
        if edit == "D":
            at += 1
            continue
        initial = rows[at][0][:1] if edit == "K" else NEXT[state]
        if edit == "I":
            out.append((NAMES[initial], ""))
        else:
            role, text = rows[at]
            out.append((role if edit == "K" else NAMES[initial], text))
            at += 1
        state = MOVES[initial][state]
    return out


def solve(initials: list[str], faults: list[str], entry: int) -> tuple[str, Survivors]:
    """The edits that are certain after the rows, and the survivors."""
    survivors = Survivors(entry)
    done = [survivors.step(row_ways(i, f)) for i, f in zip(initials, faults)]
    return "".join(done), survivors


def illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def spread(turns: list[int | None]) -> tuple[int | None, int | None, int]:
    """(smallest, largest, number of different ones) of sorted turns."""
    known = [t for t in turns if t is not None]
    return (known[0], known[-1], 1 + sum(a != b for a, b in zip(known, known[1:]))) if known else (None, None, 0)


def damage(conversations: DataFrame) -> DataFrame:
    """The query's test damage: by crc32 of ``conv_id:turn`` modulo 20 a row is dropped (0), emptied (1), robbed of its
    ``[.!?]`` (2), repeated (3) or given the role user (4)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    return rows.where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def repair(conversations: DataFrame, whole_rows: int = WHOLE_ROWS) -> DataFrame:
    """Pieces of conversations: conv_id, part and piece (in order), whole (the conversation is this piece), n_rows, the
    counts of faults, illegal neighbours, gaps and cost (all add up over the pieces), audit, and the repaired rows."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                text("role").alias("role"), text("text").alias("text"))
    rows = rows.withColumn("digest", digest()).withColumn("spread", F.rand(11))  # rows with one digest may be many
    key = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "digest", "spread")]
    dealt = rows.repartitionByRange(*key).sortWithinPartitions(*key)
    first = stored(dealt.select("conv_id", "turn", "role", "text").mapInArrow(
        lambda batches: first_pass(batches, whole_rows), f"{PIECE}, open array<struct<turn:bigint,role:string,text:string>>"), "pieces")
    whole = first.where("open IS NULL").drop("open")
    return whole.unionByName(stored(in_pieces(first.where("open IS NOT NULL").select("conv_id", "part", "piece", "open")), "split"))


def digest() -> Column:
    return F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))


def table_of(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


_PAIR = pa.struct([("role", pa.string()), ("text", pa.string())])
_TURN = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
_PIECE = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("piece", pa.int64()), ("whole", pa.bool_()), *[
    (c, pa.int64()) for c in ("n_rows", "blank", "duplicate", "truncated", "illegal", "gaps", "cost")],
    ("audit", pa.string()), ("repaired", pa.list_(_PAIR))])


def first_pass(batches: Iterator[pa.RecordBatch], whole_rows: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one task: conversations that lie inside are repaired; the task's first and last one, which may
    go on in other tasks, and long ones leave as raw pieces in ``open``."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    schema = _PIECE.append(pa.field("open", pa.list_(_TURN)))
    out: list[dict] = []
    size = 0
    held: list[tuple] = []
    chars = 0
    now: object = None
    begun = first = True
    spilled = False
    number = 0

    def raw() -> None:
        nonlocal number
        out.append({"conv_id": now, "part": part, "piece": number, "open": [dict(zip(("turn", "role", "text"), r)) for r in held]})
        number += 1
        held.clear()

    def finish(edge: bool) -> None:
        nonlocal number
        if not held:
            return
        if edge or spilled:
            raw()
        else:
            out.append(repaired(now, part, number, held))
            number += 1
            held.clear()

    for batch in batches:
        ids = batch.column("conv_id").to_pylist()
        for conv, row in zip(ids, zip(*[batch.column(c).to_pylist() for c in ("turn", "role", "text")])):
            if begun or conv != now:
                if not begun:
                    finish(first)
                    first = False
                now, begun, spilled, chars = conv, False, False, 0
            held.append(row)
            length = len(row[1]) + len(row[2])
            chars += length
            size += length
            if len(held) >= whole_rows or chars > WHOLE_CHARS:
                spilled = True
                raw()
                chars = 0
            if size > WHOLE_CHARS or len(out) > WHOLE_ROWS:
                if out:
                    yield table_of(out, schema)
                out, size = [], 0
    finish(True)
    if out:
        yield table_of(out, schema)


def repaired(conv: object, part: int, piece: int, rows: list[tuple]) -> dict:
    """A conversation that is held whole."""
    seen: set[tuple[str, str]] = set()
    faults = []
    for _, role, text in rows:
        faults.append(fault(role, text, (role, text) in seen))
        seen.add((role, text))
    initials = [r[1][:1] for r in rows]
    done, survivors = solve(initials, faults, START)
    cost, rest = survivors.close()
    low, high, different = spread([r[0] for r in rows])
    return {"conv_id": conv, "part": part, "piece": piece, "whole": True, "n_rows": len(rows), "blank": faults.count("b"),
            "duplicate": faults.count("d"), "truncated": faults.count("t"), "illegal": illegal(initials),
            "gaps": high - low + 1 - different if different else 0, "cost": cost, "audit": done + rest,
            "repaired": [dict(zip(("role", "text"), r)) for r in apply([r[1:] for r in rows], done + rest)]}


def in_pieces(open_: DataFrame) -> DataFrame:
    """Conversations that lie in several pieces."""
    # Repeated turns: the first place of each (role, text) that stands more than once in its conversation.
    slim = open_.select("conv_id", "part", "piece", F.posexplode("open").alias("at", "row")).select(
        "conv_id", "row.role", "row.text", F.struct("part", "piece", "at").alias("place"))
    slim = stored(slim.select("conv_id", "place", digest().alias("digest")), "turns")
    again = stored(slim.groupBy("conv_id", "digest").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "again")
    late = slim.alias("t").join(again.alias("g"), F.expr("t.conv_id <=> g.conv_id AND t.digest = g.digest AND t.place > g.first"))
    marked = late.groupBy(F.col("place.part").alias("part"), F.col("place.piece").alias("piece")).agg(
        F.collect_list("place.at").alias("late"))  # the rows of a piece at most
    ready = open_.join(marked, ["part", "piece"], "left")
    solved = stored(ready.mapInArrow(solve_pieces, f"conv_id long, part long, piece long, {_SUMMARY}, open array<struct<role:string,text:string>>"), "solved")
    ways = solved.drop("open", "edits").repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
    chosen = stored(ways.mapInArrow(choose, "part long, piece long, entry int, way int, cost_chosen long, tail string, gap long, crossing long"), "chosen")
    return solved.join(chosen, ["part", "piece"]).mapInArrow(apply_pieces, PIECE)


#: Of a piece: the counts, its turns and ends, and for each entry and exit state the cost, rank and edits of the best way.
_SUMMARY = ("n_rows long, blank long, duplicate long, truncated long, illegal long, low long, high long, different long, first_initial string, "
            "last_initial string, ways array<struct<entry:int,leave:int,cost:bigint,rank:int>>, edits array<string>")
_WAY = pa.struct([("entry", pa.int32()), ("leave", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32())])


def solve_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each piece from every state that it may be entered in. Edits are ranked within the piece; as all end in a row's
    edit and hold one for each row, ranks compare whole suffixes."""
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("piece", pa.int64()), *[
        (c, pa.int64()) for c in ("n_rows", "blank", "duplicate", "truncated", "illegal", "low", "high", "different")],
        ("first_initial", pa.string()), ("last_initial", pa.string()), ("ways", pa.list_(_WAY)), ("edits", pa.list_(pa.string())),
        ("open", pa.list_(_PAIR))])
    for batch in batches:
        for i in range(batch.num_rows):
            rows = batch.column("open")[i].as_py()
            late = set(batch.column("late")[i].as_py() or ())
            faults = [fault(r["role"], r["text"], at in late) for at, r in enumerate(rows)]
            initials = [r["role"][:1] for r in rows]
            ways = []
            for entry in STATES:
                done, survivors = solve(initials, faults, entry)
                ways += [(entry, leave, cost, done + survivors.open(leave)) for leave, (cost, _) in survivors.best.items()]
            order = {e: k for k, e in enumerate(sorted({w[3] for w in ways}))}
            low, high, different = spread([r["turn"] for r in rows])
            yield table_of([{
                **{c: batch.column(c)[i].as_py() for c in ("conv_id", "part", "piece")}, "n_rows": len(rows), "blank": faults.count("b"),
                "duplicate": faults.count("d"), "truncated": faults.count("t"), "illegal": illegal(initials), "low": low, "high": high,
                "different": different, "first_initial": initials[0], "last_initial": initials[-1],
                "ways": [{"entry": e, "leave": t, "cost": c, "rank": order[s]} for e, t, c, s in ways], "edits": [w[3] for w in ways],
                "open": [{"role": r["role"], "text": r["text"]} for r in rows]}], schema)


def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The way through each piece: Viterbi over the pieces of a conversation, which come in order. An edit of this tree
    is a character for the rank of a way, and it is certain as soon as all survivors share it."""
    schema = pa.schema([("part", pa.int64()), ("piece", pa.int64()), ("entry", pa.int32()), ("way", pa.int32()),
                        ("cost_chosen", pa.int64()), ("tail", pa.string()), ("gap", pa.int64()), ("crossing", pa.int64())])
    none = object()
    now: object = none
    waiting: deque = deque()
    survivors = Survivors()
    state = START
    low = high = last = None
    out: list[dict] = []

    def settle(ranks: str) -> None:
        nonlocal state
        for rank in ranks:
            piece = waiting.popleft()
            way, found = next((k, w) for k, w in enumerate(piece["ways"]) if w["entry"] == state and chr(97 + w["rank"]) == rank)
            out.append({"part": piece["part"], "piece": piece["piece"], "entry": state, "way": way, "cost_chosen": found["cost"], "tail": "",
                        "gap": piece["gap"], "crossing": piece["crossing"]})
            state = found["leave"]

    def finish() -> None:
        if now is none:
            return
        _, rest = survivors.close()
        settle(rest.rstrip("I"))
        inserts = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}[state]
        out[-1]["tail"] = "I" * inserts
        out[-1]["cost_chosen"] += inserts * INSERT

    for batch in batches:
        for piece in batch.to_pylist():
            if now is none or piece["conv_id"] != now:
                finish()
                now, state, survivors, low, high, last = piece["conv_id"], START, Survivors(), None, None, None
            # Turns and neighbours across the cut; what the turns' range grows by.
            piece["crossing"] = int(last is not None and last + piece["first_initial"] not in ("su", "ua", "au"))
            last = piece["last_initial"]
            piece["gap"] = 0
            if piece["different"]:
                piece["gap"] = piece["high"] - piece["low"] + 1 - piece["different"] if high is None else \
                    piece["high"] - high - piece["different"] + (piece["low"] == high)
                high = piece["high"]
            waiting.append(piece)
            ways: dict[int, list[tuple[int, int, str]]] = {}
            for way in piece["ways"]:
                ways.setdefault(way["entry"], []).append((way["leave"], way["cost"], chr(97 + way["rank"])))
            settle(survivors.step(ways))
            if len(out) > WHOLE_ROWS:  # a conversation's last piece may still get inserts at its end
                yield table_of(out[:-1], schema)
                del out[:-1]
    finish()
    if out:
        yield table_of(out, schema)


def apply_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            edits = row["edits"][row["way"]] + row["tail"]
            fixed = apply([(r["role"], r["text"]) for r in row["open"]], edits, row["entry"])
            yield table_of([{**{c: row[c] for c in ("conv_id", "part", "piece", "n_rows", "blank", "duplicate", "truncated")},
                             "whole": False, "illegal": row["illegal"] + row["crossing"], "gaps": row["gap"], "cost": row["cost_chosen"],
                             "audit": edits, "repaired": [dict(zip(("role", "text"), r)) for r in fixed]}], _PIECE)


def report(pieces: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per conversation of the original table: the counts added up, the audit, and the SHA-256 of the repaired
    rows as ``role:text`` lines. A conversation in one piece needs no shuffle of its texts; the lines of others are
    streamed through the digest in order, piece by piece, as SHA-256 is sequential."""
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    lines = F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"]))
    ready = pieces.select("conv_id", "part", "piece", "whole", *counts, "audit", lines.alias("lines"))
    whole = ready.where("whole").select("conv_id", *counts, "audit", F.sha2(F.array_join("lines", "\n"), 256).alias("repaired_sha256"))
    split = ready.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece").drop("whole")
    names = ", ".join(f"{c} long" for c in counts)
    streamed = split.mapInArrow(digest_pieces, f"conv_id long, {names}, audit string, repaired_sha256 string")
    found = whole.unionByName(streamed)
    known = conversations.select(F.col("conv_id").cast("long").alias("conv")).distinct()
    joined = known.join(found, F.col("conv").eqNullSafe(F.col("conv_id")), "left")
    return joined.select(F.col("conv").alias("conv_id"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
                         F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def digest_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in counts], ("audit", pa.string()), ("repaired_sha256", pa.string())])
    none = object()
    now: object = none
    sums: dict[str, int] = {}
    audit: list[str] = []
    sha, begun = hashlib.sha256(), False

    def made() -> pa.RecordBatch:
        return table_of([{"conv_id": now, **sums, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}], schema)

    for batch in batches:
        for i in range(batch.num_rows):
            conv = batch.column("conv_id")[i].as_py()
            if now is none or conv != now:
                if now is not none:
                    yield made()
                now, sums, audit, sha, begun = conv, dict.fromkeys(counts, 0), [], hashlib.sha256(), False
            for c in counts:
                sums[c] += batch.column(c)[i].as_py()
            audit.append(batch.column("audit")[i].as_py())
            for line in batch.column("lines")[i].as_py():
                sha.update((("\n" if begun else "") + line).encode())
                begun = True
    if now is not none:
        yield made()

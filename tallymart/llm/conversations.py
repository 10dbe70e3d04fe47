"""Cheapest repair of a conversation's structure, by bidirectional Dijkstra over its edit lattice.

A node of the lattice is a number of rows read and the state of the role pattern ``(s?(ua)+)?``; its edges keep, rerole or
delete the next row, or insert an empty turn. Two heaps search from the start and from the accepted ends; they stop
once no crossing can cost as little as the best one, so that all crossings of that cost are finished, and of
these the least concatenation of both audits is taken. Audits of one cost between two nodes never begin with one
another (only insertions could follow, and they cost), so the least audit of the whole is made of least parts.

Rows are sorted by range over conversation and turn, so that no conversation has to fit into a task; runs of
``BLOCK`` rows are searched on their own, from every state they can be entered in to every state they can be left
in, and a conversation's audit is put together from its runs. Repaired rows come from one streaming pass that
holds no more than an audit.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.session import materialise, tune

BLOCK = 1024  # rows of one search

# Costs of the edits, and faults of a row.
REROLE, DELETE, INSERT, LEFT_TRUNCATED = 2, 3, 2, 1
BLANK, DUPLICATE, TRUNCATED, SOUND = "b", "d", "t", "-"
LEGAL = ("su", "ua", "au")

# States: nothing yet, after a system turn, after a user turn, after an assistant turn.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (EMPTY, ASSISTANT)
KEPT = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
WANTED = (USER, USER, ASSISTANT, USER)  # the state after the one role of user and assistant that may come next
ROLES = {USER: "user", ASSISTANT: "assistant"}

Edge = tuple[str, int, int]  # letter, cost, state at the other end


@functools.cache
def _row_edges(initial: str, fault: str) -> tuple[list[list[Edge]], list[list[Edge]]]:
    """Edges that read a row, by the state they start in, and by the state they end in."""
    onward: list[list[Edge]] = [[], [], [], []]
    for state in range(4):
        onward[state].append(("D", DELETE, state))
        if fault not in (BLANK, DUPLICATE):
            more = LEFT_TRUNCATED if fault == TRUNCATED else 0
            if (state, initial) in KEPT:
                onward[state].append(("K", more, KEPT[state, initial]))
            onward[state].append(("R", REROLE + more, WANTED[state]))
    back: list[list[Edge]] = [[], [], [], []]
    for state, edges in enumerate(onward):
        for letter, cost, to in edges:
            back[to].append((letter, cost, state))
    return onward, back


INSERTS_ONWARD = [[("I", INSERT, to)] for to in WANTED]
INSERTS_BACK = [[("I", INSERT, state) for state, to in enumerate(WANTED) if to == end] for end in range(4)]


class _Side:
    """One of the two searches: labels (cost, audit) of nodes (rows read, state), final once settled."""

    def __init__(self, ends: Sequence[tuple[int, int]], direction: int):
        self.direction = direction
        self.labels = {node: (0, "") for node in ends}
        self.settled: dict[tuple[int, int], tuple[int, str]] = {}
        # of nodes of one cost, those that edges without cost leave come first
        self.heap = [(0, direction * at, state) for at, state in ends]
        heapq.heapify(self.heap)

    def top(self) -> float:
        while self.heap and (self.heap[0][1] * self.direction, self.heap[0][2]) in self.settled:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else float("inf")

    def offer(self, node: tuple[int, int], cost: int, audit: str) -> None:
        known = self.labels.get(node)
        if known is None or (cost, audit) < known:
            self.labels[node] = (cost, audit)
            heapq.heappush(self.heap, (cost, self.direction * node[0], node[1]))


@functools.lru_cache(50_000)
def search(initials: str, faults: str, entry: int, leaves: tuple[int, ...]) -> tuple[int, str] | None:
    """Cost and audit of the cheapest, then ASCII-least way through rows, from a state to one of ``leaves``."""
    n = len(initials)
    front, rear = _Side([(0, entry)], 1), _Side([(n, state) for state in leaves], -1)
    best = 0 if (0, entry) in rear.labels else float("inf")
    while (a := front.top()) + (b := rear.top()) <= best and a + b < float("inf"):
        side, other = (front, rear) if a <= b else (rear, front)
        cost, at, state = heapq.heappop(side.heap)
        at *= side.direction
        label = side.settled[at, state] = side.labels[at, state]
        for (letter, more, to), node in _edges(initials, faults, at, state, side.direction):
            side.offer(node, cost + more, label[1] + letter if side is front else letter + label[1])
            if node in other.labels:
                best = min(best, cost + more + other.labels[node][0])
    if best == float("inf"):
        return None
    # one search may have run out before the other took its first node; labels of the ends are final anyway
    before = front.settled | {(0, entry): (0, "")}
    behind = rear.settled | {(n, state): (0, "") for state in leaves}
    audits = []
    for node, (cost, audit) in before.items():
        if node in behind and cost + behind[node][0] == best:
            audits.append(audit + behind[node][1])
        for (letter, more, _), there in _edges(initials, faults, *node, 1):
            if there in behind and cost + more + behind[there][0] == best:
                audits.append(audit + letter + behind[there][1])
    return best, min(audits)


def _edges(initials: str, faults: str, at: int, state: int, direction: int) -> list[tuple[Edge, tuple[int, int]]]:
    row = at if direction > 0 else at - 1
    inserts = (INSERTS_ONWARD if direction > 0 else INSERTS_BACK)[state]
    found = [(edge, (at, edge[2])) for edge in inserts]
    if 0 <= row < len(initials):
        reading = _row_edges(initials[row], faults[row])[0 if direction > 0 else 1][state]
        found += [(edge, (at + direction, edge[2])) for edge in reading]
    return found


def through_runs(tables: Iterable[list]) -> tuple[int, str]:
    """Cost and audit of a conversation from the tables ``[entry, leave, cost, audit]`` of its runs, in order."""
    ways = {EMPTY: (0, "")}
    for table in tables:
        onward: dict[int, tuple[int, str]] = {}
        for entry, leave, cost, audit in table:
            if entry in ways:
                way = (ways[entry][0] + cost, ways[entry][1] + audit)
                onward[leave] = min(way, onward.get(leave, way))
        ways = onward
    return min(ways[state] for state in ACCEPTED if state in ways)


# Fixed value: white space of the contract's words.
FILLED = r"[^\x20\x09-\x0D]"
CUT_OFF = r"[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*\z"


def read(rows: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """conv (the id as text, one space if null), turn, role, text; null roles and texts are one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select(text(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"))


def damage(rows: DataFrame) -> DataFrame:
    """Rows of ``read`` with faults planted by the checksum of ``conv:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 takes full stops, exclamation and question marks out of it, 3 gives it twice, 4 makes
    its role user; all others stay.
    """
    kind = F.crc32(F.concat_ws(":", "conv", F.coalesce(F.col("turn").cast("string"), F.lit(" "))).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.filter(kind != 0).select("conv", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


@dataclass(frozen=True)
class Repair:
    """``audits``: conv, gaps, blank, duplicate, truncated, illegal, cost, audit. ``rows``: the rows read, with their place ``at``."""

    audits: DataFrame
    rows: DataFrame


def _tables(runs: DataFrame) -> DataFrame:
    """Per run (conv, block, first, last, initials, faults, turns): its counts and table as one JSON value."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for first, last, initials, faults, turns in zip(*(batch.column(c).to_pylist() for c in ("first", "last", "initials", "faults", "turns")), strict=True):
                entries, leaves = ([EMPTY] if first else range(4)), ([ACCEPTED] if last else [(k,) for k in range(4)])
                ways = [(s, t[-1], search(initials, faults, s, t)) for s in entries for t in leaves]
                known = [t for t in turns if t is not None]
                illegal = sum(initials[k : k + 2] not in LEGAL for k in range(len(initials) - 1))
                # where the accepted ends share a search, ACCEPTED[-1] stands for either
                found.append(json.dumps({
                    "counts": [faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED), illegal, len(set(known))],
                    "ends": [initials[0], initials[-1]], "turns": [known[0], known[-1]] if known else None,
                    "table": [[s, t, *way] for s, t, way in ways if way],
                }))
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("block"), pa.array(found, pa.string())], ["conv", "block", "run"])

    return runs.mapInArrow(work, "conv string, block long, run string")


AUDITS = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _put_together(per_conversation: DataFrame) -> DataFrame:
    """Per conversation (conv, runs in order; null without rows) its counts, cost and audit."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for conv, runs in zip(*(batch.column(c).to_pylist() for c in ("conv", "runs")), strict=True):
                runs = [json.loads(x) for x in runs or []]
                blank, duplicate, truncated, illegal, distinct = (sum(x["counts"][k] for x in runs) for k in range(5))
                illegal += sum(a["ends"][1] + b["ends"][0] not in LEGAL for a, b in zip(runs, runs[1:], strict=False))
                turns = [x["turns"] for x in runs if x["turns"]]
                distinct -= sum(a[1] == b[0] for a, b in zip(turns, turns[1:], strict=False))  # sorted by turn
                gaps = turns[-1][1] - turns[0][0] + 1 - distinct if turns else 0
                found.append((conv, gaps, blank, duplicate, truncated, illegal, *through_runs(x["table"] for x in runs)))
            names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
            types = [pa.string(), *[pa.int64()] * 6, pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], t) for k, t in enumerate(types)], names)

    return per_conversation.mapInArrow(work, AUDITS)


def repair(rows: DataFrame, conversations: DataFrame, block: int = BLOCK) -> Repair:
    """Audit every conversation of ``conversations`` (conv) from its ``rows`` (conv, turn, role, text, as ``read`` gives).

    Rows of a conversation go by turn, null turns first; rows of one turn by role, then the first 32 characters and a
    hash of the text. A row's first fault counts: no text, role and text of an earlier row, an end without
    a full stop, exclamation or question mark. A role whose first letter is none of s, u, a can only be reroled or deleted. A
    conversation without rows has zeros and an empty audit.
    """
    tune(rows.sparkSession)
    keys = ["conv", "turn", "role", "start", "h1", "h2"]
    marked = rows.select("conv", "turn", "role", "text", F.left("text", F.lit(32)).alias("start"), F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit("and"), "text", "role").alias("h2"))
    placed = marked.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()).drop("start")
    fault = F.when(~F.col("text").rlike(FILLED), BLANK).when(F.col("text").rlike(CUT_OFF), TRUNCATED).otherwise(SOUND)
    initial = F.left("role", F.lit(1))
    placed = materialise(placed.withColumn("fault", fault).withColumn("initial", F.when(initial.isin("s", "u", "a"), initial).otherwise("x")), "placed-turns")

    repeated = placed.groupBy("conv", "h1", "h2").agg(F.min("at").alias("since"), F.count("*").alias("c")).filter("c > 1").drop("c")
    later = (F.col("at") > F.col("since")) & (F.col("fault") != BLANK)
    turns = placed.select("conv", "turn", "at", "initial", "fault", "h1", "h2").join(repeated, ["conv", "h1", "h2"], "left")
    turns = turns.withColumn("fault", F.when(later, DUPLICATE).otherwise(F.col("fault")))
    runs = turns.groupBy("conv", F.expr(f"at div {block}").alias("block")).agg(F.array_sort(F.collect_list(F.struct("at", "initial", "fault", "turn"))).alias("x"))
    runs = runs.select("conv", "block", F.array_join("x.initial", "").alias("initials"), F.array_join("x.fault", "").alias("faults"), F.col("x.turn").alias("turns"))
    ends = placed.groupBy("conv").agg(F.expr(f"min(at) div {block}").alias("first"), F.expr(f"max(at) div {block}").alias("last"))
    runs = runs.join(ends, "conv").withColumns({"first": F.col("block") == F.col("first"), "last": F.col("block") == F.col("last")})
    tables = _tables(runs).groupBy("conv").agg(F.transform(F.array_sort(F.collect_list(F.struct("block", "run"))), lambda x: x["run"]).alias("runs"))
    audits = materialise(_put_together(conversations.select("conv").distinct().join(tables, "conv", "left")), "audits")
    return Repair(audits, placed.select("conv", "at", "role", "text"))


WALKED = "conv string, place long, role string, text string"


def _walk(found: Repair) -> DataFrame:
    """Per conversation its head (place 0, the audit's row as JSON in ``text``), then its repaired rows from 1.

    Rows of a conversation are in one partition, one after the other.
    """
    heads = found.audits.select("conv", F.lit(-1).cast("long").alias("at"), F.col("audit").alias("role"), F.to_json(F.struct(*[F.col(c) for c in found.audits.columns])).alias("text"))

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, state, place = "", 0, EMPTY, 0
        conv: str | None = None
        out: list[tuple[str | None, int, str, str]] = []

        def inserted() -> None:
            nonlocal at, state, place
            while audit[at : at + 1] == "I":
                at, state, place = at + 1, WANTED[state], place + 1
                out.append((conv, place, ROLES[state], ""))

        for batch in batches:
            for own, order, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "at", "role", "text")), strict=True):
                if order < 0:
                    inserted()
                    conv, audit, at, state, place = own, role, 0, EMPTY, 0
                    out.append((own, 0, "", text))
                else:
                    inserted()
                    letter, at = audit[at], at + 1
                    if letter != "D":
                        state = WANTED[state] if letter == "R" else KEPT[state, role[:1]]
                        place += 1
                        out.append((own, place, ROLES[state] if letter == "R" else role, text))
            yield _walked(out)
            out.clear()
        inserted()
        yield _walked(out)

    rows = found.rows.unionByName(heads.select("conv", "at", "role", "text"))
    return rows.repartition("conv").sortWithinPartitions("conv", "at").mapInArrow(walk, WALKED)


def _walked(out: list) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(types)], ["conv", "place", "role", "text"])


def repaired_rows(found: Repair) -> DataFrame:
    """conv, place (from 1 in each conversation), role, text after the cheapest edits."""
    return _walk(found).filter("place > 0")


def repair_report(rows: DataFrame, damaged: bool = True, block: int = BLOCK, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """Per conversation of ``rows``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``damaged`` plants faults first. ``repaired_sha256`` is that of the repaired rows as ``role:text``, one a line. A null
    id is a conversation of its own; repeated rows are duplicates; an empty table has no rows; other columns are not read.
    """
    given = read(rows, conv_col, turn_col, role_col, text_col)
    found = repair(damage(given) if damaged else given, given, block)

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, sha = None, hashlib.sha256()
        for batch in batches:
            out = []
            for place, role, text in zip(*(batch.column(c).to_pylist() for c in ("place", "role", "text")), strict=True):
                if place:
                    sha.update(f"{chr(10) if place > 1 else ''}{role}:{text}".encode())
                else:
                    out += [(head, sha.hexdigest())] if head else []
                    head, sha = text, hashlib.sha256()
            yield _digests(out)
        yield _digests([(head, sha.hexdigest())] if head else [])

    digests = _walk(found).mapInArrow(digest, "head string, repaired_sha256 string")
    own = F.from_json("head", AUDITS).alias("own")
    listed = digests.select(own, "repaired_sha256").select("own.*", "repaired_sha256")
    conv_id = F.when(F.col("conv") != " ", F.col("conv")).cast(rows.schema[conv_col].dataType).alias("conv_id")
    return listed.select(conv_id, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _digests(out: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.string()) for k in (0, 1)], ["head", "repaired_sha256"])

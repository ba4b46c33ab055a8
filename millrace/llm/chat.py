"""Chat formatting by minimum-cost role repair.

A legal chat is an optional system turn, then user and assistant in turn, the assistant last.  Each turn of the input is kept,
merged into the turn before, relabelled, or preceded by an empty turn; a dynamic programme over the automaton's states finds the
cheapest repair.  Of repairs of the same cost the one is taken that, read from the last turn back, has the earliest option
and state in the order of the tables below.

Turns are sorted by range over (conversation, turn, role, text) and checkpointed, so a conversation of any length is a run
over as many partitions as its share asks for; no task holds more than its partition and no conversation is a group.  A step of
the programme is a (min, +) matrix over four states.  For the runs that cross partitions, two per partition at most, a first
pass gives the product of their matrices and a second which state a run must be entered in for each state it is left in; the
driver chains these few rows, and the last pass repairs and renders every run between known states.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millrace.llm.common import slots
from millrace.session import cut_lineage

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
_STATE = {r: i + 1 for i, r in enumerate(ROLES)}
MERGE, RELABEL, INSERT = 2, 3, 5
_FAR = 1 << 60
Vector = list[int]


def _options(role: str) -> list[tuple[int, int, int, str, str, str]]:
    """(from, to, cost, action, role, inserted role) of a turn whose role is ``role`` or, if that is none of ROLES, any."""
    out = []
    for s in range(4):
        for r in ROLES:
            t, relabel = _STATE[r], 0 if r == role else RELABEL
            legal = (s == START) if r == "system" else (s != USER if r == "user" else s == USER)
            name = "keep" if not relabel else "relabel"
            if legal:
                out.append((s, t, relabel, name, r, ""))
            if s == t:
                out.append((s, t, relabel + MERGE, "merge" if not relabel else "relabel+merge", r, ""))
            if r == "user" and s == USER:
                out.append((s, t, relabel + INSERT, "insert" if not relabel else "relabel+insert", r, "assistant"))
            if r == "assistant" and s != USER:
                out.append((s, t, relabel + INSERT, "insert" if not relabel else "relabel+insert", r, "user"))
    return sorted(out, key=lambda o: o[2])


TABLE = {r: _options(r) for r in (*ROLES, "")}
#: Cost of ending in a state: after a user or system turn an empty turn has to follow, after the latter two.
END = {START: 0, SYSTEM: 2 * INSERT, USER: INSERT, ASSISTANT: 0}


def _role(role: str | None) -> str:
    r = (role or "").strip().lower()
    return r if r in ROLES else ""


def _step(costs: Vector, role: str) -> Vector:
    out = [_FAR] * 4
    for s, t, c, *_ in TABLE[role]:
        out[t] = min(out[t], costs[s] + c)
    return out


def product(roles: list[str]) -> list[Vector]:
    """Row s: least cost from state s to each state."""
    out = []
    for s in range(4):
        costs = [0 if x == s else _FAR for x in range(4)]
        for r in roles:
            costs = _step(costs, r)
        out.append(costs)
    return out


def _path(costs: Vector, roles: list[str], exits: list[int]) -> tuple[list[list[tuple]], list[int]]:
    """For each state the run is left in: the options taken, and the state it was entered in."""
    along = [costs]
    for r in roles:
        along.append(_step(along[-1], r))
    paths, entered = [], []
    for state in exits:
        taken: list[tuple] = []
        if along[-1][state] >= _FAR:
            paths.append([])
            entered.append(-1)
            continue
        for i in range(len(roles) - 1, -1, -1):
            best = next(o for o in TABLE[roles[i]] if o[1] == state and along[i][o[0]] + o[2] == along[i + 1][state])
            taken.append(best)
            state = best[0]
        paths.append(taken[::-1])
        entered.append(state)
    return paths, entered


def last_state(costs: Vector) -> int:
    return min(range(4), key=lambda s: (costs[s] + END[s], s))


_BEGIN = [0, _FAR, _FAR, _FAR]


def repair(roles: list[str | None]) -> tuple[list[tuple], int]:
    """(options taken, total cost) of one whole chat."""
    known = [_role(r) for r in roles]
    costs = _BEGIN
    for r in known:
        costs = _step(costs, r)
    end = last_state(costs)
    return _path(_BEGIN, known, [end])[0][0], costs[end] + END[end]


def _open(role: str) -> str:
    return f"<|im_start|>{role}\n"


CLOSE = "<|im_end|>\n"


def _render(option: tuple, first: bool, last: bool, text: str) -> str:
    """What one input turn adds to its chat: it closes the turn before, unless it continues it."""
    s, t, _, action, role, inserted = option
    out = "" if first or "merge" in action else CLOSE
    if inserted:
        out += _open(inserted) + CLOSE
    out += ("\n" if "merge" in action else _open(role)) + text
    if last:
        out += CLOSE
        if t == SYSTEM:
            out += _open("user") + CLOSE
        if t != ASSISTANT:
            out += _open("assistant") + CLOSE
    return out


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Any, list[tuple]]]:
    """(partition, conversation, rows) of each run; rows are (turn, role, text)."""
    part, conv, rows = None, None, []
    for batch in batches:
        for p, c, turn, role, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if rows and (p != part or c != conv):
                yield part, conv, rows
                rows = []
            part, conv = p, c
            rows.append((turn, role, text))
    if rows:
        yield part, conv, rows


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Any, bool, bool, list[tuple]]]:
    """Runs with whether they are the first and the last of their partition."""
    ahead, first = None, True
    for run in _runs(batches):
        if ahead is not None:
            yield *ahead[:2], first, False, ahead[2]
            first = False
        ahead = run
    if ahead is not None:
        yield *ahead[:2], first, True, ahead[2]


def format_chats(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per distinct input turn: conv, position, turn, role, new_role, action, inserted, cost, fragment.

    Turns of a conversation are ordered by turn, then role, then text (NULL first); rows that agree in all four columns are one
    turn.  ``position`` counts from 0 in a run and rises with the order; ``fragment``, concatenated in the order (run,
    position), is the rendered chat.  Roles are read without case and outer blanks; NULL and unknown roles may become any role
    at the cost of a relabel.  NULL text is empty.  Rows with a NULL conversation are one conversation.  ``cost`` is the
    turn's share of the repair's cost, the empty turns at the end included in the last one's.  An empty table gives no rows;
    other columns are not read.
    """
    spark = rows.sparkSession
    plain = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text")
    ).distinct()
    order = ["conv", "turn", "role", "text"]
    placed = plain.repartitionByRange(slots(spark), *order).sortWithinPartitions(*order)
    placed = cut_lineage(placed.select(F.spark_partition_id().alias("part"), *order))
    kinds = {f.name: f.dataType.simpleString() for f in placed.schema.fields}

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(p, c, first, last, sum(product([_role(r) for _, r, _ in run]), [])) for p, c, first, last, run in _edges(batches) if first or last]
        if found:
            kinds_of = (pa.int32(), kind_of_conv, pa.bool_(), pa.bool_(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*found), kinds_of)], names=["part", "conv", "first", "last", "m"])

    kind_of_conv = to_arrow_type(placed.schema["conv"].dataType)
    # at most two rows per partition
    ends = placed.mapInArrow(products, f"part int, conv {kinds['conv']}, first boolean, last boolean, m array<long>").collect()
    ends.sort(key=lambda r: (r["part"], not r["first"]))
    chains: list[list] = []  # runs of one conversation in consecutive partitions
    for r in ends:
        if r["first"] and chains and chains[-1][-1]["last"] and chains[-1][-1]["conv"] == r["conv"]:
            chains[-1].append(r)
        else:
            chains.append([r])
    chains = [c for c in chains if len(c) > 1]
    enter: dict[tuple[int, bool], Vector] = {}  # (partition, first of it) of a crossing run: costs it is entered with
    final: dict[tuple[int, bool], int] = {}
    for chain in chains:
        costs = _BEGIN
        for r in chain:
            enter[r["part"], r["first"]] = costs
            costs = [min(min(costs[s] + r["m"][4 * s + t] for s in range(4)), _FAR) for t in range(4)]
        final[chain[-1]["part"], chain[-1]["first"]] = last_state(costs)

    def entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for p, _, first, last, run in _edges(batches):
            if (first or last) and (p, first) in enter:
                found.append((p, first, _path(enter[p, first], [_role(r) for _, r, _ in run], [0, 1, 2, 3])[1]))
        if found:
            kinds_of = (pa.int32(), pa.bool_(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*found), kinds_of)], names=["part", "first", "s"])

    back = {(r["part"], r["first"]): r["s"] for r in placed.mapInArrow(entered, "part int, first boolean, s array<int>").collect()} if enter else {}
    left: dict[tuple[int, bool], int] = {}
    inner: dict[tuple[int, bool], tuple[bool, bool]] = {}
    for chain in chains:
        state = final[chain[-1]["part"], chain[-1]["first"]]
        for i, r in reversed(list(enumerate(chain))):
            at = r["part"], r["first"]
            left[at], inner[at] = state, (i == 0, i == len(chain) - 1)
            state = back[at][state]

    names = [conv_col, "run", "position", turn_col, role_col, "new_role", "action", "inserted", "cost", "fragment"]

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p, conv, first, last, run in _edges(batches):
            roles = [_role(r) for _, r, _ in run]
            at = (p, first)
            crossing = (first or last) and at in left
            begins, ends_here = inner[at] if crossing else (True, True)
            if crossing:
                path = _path(enter[at], roles, [left[at]])[0][0]
            else:
                path, _ = repair(roles)
            for start in range(0, len(run), 4096):
                cols: list[list] = [[] for _ in names]
                for i in range(start, min(start + 4096, len(run))):
                    turn, role, text = run[i]
                    end = ends_here and i == len(run) - 1
                    cost = path[i][2] + (END[path[i][1]] if end else 0)
                    row = (conv, p, i, turn, role, path[i][4], path[i][3], path[i][5], cost, _render(path[i], begins and i == 0, end, text or ""))
                    for c, v in zip(cols, row):
                        c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=fields)

    fields = ["conv", "run", "position", "turn", "role", "new_role", "action", "inserted", "cost", "fragment"]
    types = [kind_of_conv, pa.int32(), pa.int64(), to_arrow_type(placed.schema["turn"].dataType), *[pa.string()] * 4, pa.int64(), pa.string()]
    schema = f"conv {kinds['conv']}, run int, position long, turn {kinds['turn']}, role string, new_role string, action string, inserted string, cost long, fragment string"
    return placed.mapInArrow(repaired, schema).toDF(*names)

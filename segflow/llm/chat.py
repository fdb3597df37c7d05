"""Chat formatting: minimum-cost repair of role sequences over an automaton of legal turns, then rendering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segflow.llm.near_duplicates import grouped
from segflow.llm.tables import parts_for, stored

START = 0
ROLES = ("system", "user", "assistant", "tool")
#: Which roles may follow the start, or a message of a role; a conversation ends after an assistant's message.
FOLLOWS = {0: (1, 2), 1: (2,), 2: (3,), 3: (2, 4), 4: (3,)}
LAST = 3
#: Other names of roles.
ALIASES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "function": "tool", "developer": "system"}
#: Costs: joining a turn to the message before it, changing its role, inserting an empty message.
MERGE, RELABEL, INSERT = 1.0, 4.0, 2.0
UNKNOWN = 0
#: Turns of a range of conversations, on average.
RANGE_TURNS = 20_000
#: Ranges whose seams are settled together.
BLOCK_RANGES = 1_000


def role_number(role: str | None) -> int:
    """1 to 4 for the roles, UNKNOWN for any other name or null."""
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return ROLES.index(name) + 1 if name in ROLES else UNKNOWN


def inserted_between(state: int, goal: int) -> tuple[int, ...] | None:
    """The fewest roles to insert after `state` so that `goal` may follow; of equally few, the first in role order."""
    paths = [((), state)]
    for _ in range(4):
        for path, at in paths:
            if goal in FOLLOWS[at]:
                return path
        paths = [((*path, r), r) for path, at in paths for r in FOLLOWS[at]]
    return None


def _steps() -> tuple[np.ndarray, dict[tuple[int, int, int], tuple[str, tuple[int, ...]]]]:
    """For each turn's role, state before and state after: the least cost, and the action with insertions.

    The state is the role of the last message. At equal cost keeping comes before merging, that
    before relabelling.
    """
    cost = np.full((5, 5, 5), np.inf)
    action = {}
    for role in range(5):
        for state in range(5):
            for after in range(1, 5):
                options = []
                path = inserted_between(state, after)
                changed = RELABEL if after != role else 0.0
                if path is not None:
                    options.append((changed + INSERT * len(path), 2 if changed else 0, "relabel" if changed else "keep", path))
                if state == after:
                    options.append((MERGE + changed, 1, "merge", ()))
                if options:
                    best = min(options)
                    cost[role, state, after] = best[0]
                    action[role, state, after] = (best[2], best[3])
    return cost, action


STEP_COST, STEP_ACTION = _steps()
#: Cost and inserted roles to end after each state.
END_PATHS = [None] + [() if s == LAST else (*inserted_between(s, LAST), LAST) for s in range(1, 5)]
END_COST = np.array([np.inf] + [INSERT * len(p) for p in END_PATHS[1:]])


def run_cost(roles: np.ndarray) -> np.ndarray:
    """The least cost of a run of turns from each state to each state: a (min, +) product of its steps."""
    whole = np.where(np.eye(5, dtype=bool), 0.0, np.inf)
    for role in roles:
        whole = (whole[:, :, None] + STEP_COST[role][None, :, :]).min(axis=1)
    return whole


def run_states(roles: np.ndarray, entry: int, leaving: int | None) -> np.ndarray:
    """The states after each turn of a cheapest run from `entry` to `leaving`, or to the cheapest end if None."""
    n = len(roles)
    came = np.zeros((n, 5), np.int8)
    cost = np.full(5, np.inf)
    cost[entry] = 0.0
    for i, role in enumerate(roles):
        total = cost[:, None] + STEP_COST[role]
        came[i] = total.argmin(axis=0)
        cost = total.min(axis=0)
    state = int((cost + END_COST).argmin()) if leaving is None else leaving
    out = np.zeros(n, np.int8)
    for i in range(n - 1, -1, -1):
        out[i] = state
        state = int(came[i, state])
    return out


def boundary_states(costs: list[np.ndarray], entry: int = START, leaving: int | None = None) -> list[int]:
    """States between consecutive runs of a conversation, and after the last, at the least total cost.

    The runs begin in the state `entry` and end in `leaving`, or in the cheapest end if None.
    """
    forward = [np.where(np.arange(5) == entry, 0.0, np.inf)]
    for matrix in costs:
        forward.append((forward[-1][:, None] + matrix).min(axis=0))
    state = int((forward[-1] + END_COST).argmin()) if leaving is None else leaving
    out = [state]
    for before, matrix in zip(forward[-2:0:-1], costs[:0:-1]):
        state = int((before + matrix[:, state]).argmin())
        out.append(state)
    return out[::-1]


def _message(role: int, open_before: bool) -> str:
    return ("<|im_end|>\n" if open_before else "") + f"<|im_start|>{ROLES[role - 1]}\n"


def render(roles: np.ndarray, texts: list[str], entry: int, states: np.ndarray, ends: bool):
    """For each turn its action, its inserted roles and its piece of the rendered conversation."""
    actions, inserted, pieces = [], [], []
    state = entry
    for i, (role, text) in enumerate(zip(roles.tolist(), texts)):
        after = int(states[i])
        action, path = STEP_ACTION[role, state, after]
        piece = []
        for extra in path:
            piece.append(_message(extra, state != START))
            state = extra
        piece.append("\n\n" if action == "merge" else _message(after, state != START))
        # A text cannot open or close messages.
        piece.append(text.replace("<|im_", "< |im_"))
        state = after
        names = [ROLES[r - 1] for r in path]
        if ends and i == len(texts) - 1:
            for extra in END_PATHS[state]:
                piece.append(_message(extra, True))
                names.append(ROLES[extra - 1])
            piece.append("<|im_end|>\n")
        actions.append(action)
        inserted.append(names)
        pieces.append("".join(piece))
    return actions, inserted, pieces


def format_chats(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """A row per turn: conv, turn, role, new_role, action, inserted (roles of empty messages put in) and piece.

    The pieces of a conversation, in turn order, make up its rendering. Turns are kept, merged into
    the message before, or relabelled, and empty messages inserted, at the least total cost for
    which system (at the start only), user, assistant and tool messages alternate legally and an
    assistant's message comes last. Unknown and null roles are always relabelled. Null texts count
    as empty; null turns come last; turns with equal numbers, repeated rows included, are ordered by
    role and text; a null conversation key is one conversation. An empty table gives no rows.

    Turns are sorted over ranges, so a conversation of any length is dealt to as many tasks as it
    needs: each reports the cost matrix of its part of the first and last conversation, and the
    states at the seams follow from these, two matrices for each range.
    """
    source = turns.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    kinds = {f.name: f.dataType.simpleString() for f in source.schema}
    ranges = max(int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")), parts_for(source.count(), RANGE_TURNS))
    order = [F.asc_nulls_first("conv"), F.asc_nulls_last("turn"), F.asc_nulls_first("role"), F.xxhash64("text"), F.col("spread")]

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            places = [pa.array(np.full(n, part), pa.int32()), pa.array(np.arange(at, at + n), pa.int64())]
            at += n
            yield pa.RecordBatch.from_arrays([*places, *batch.columns], ["part", "place", "conv", "turn", "role", "text"])

    # `spread` lets even equal rows be dealt to several ranges; they may change places among themselves.
    spread = source.withColumn("spread", F.monotonically_increasing_id())
    spread = spread.repartitionByRange(ranges, *order).sortWithinPartitions(*order).drop("spread")
    schema = f"part int, place long, conv {kinds['conv']}, turn {kinds['turn']}, role string, text string"
    sorted_turns = stored(spread.mapInArrow(numbered, schema), "turns")

    seams = _seam_states(stored(_edge_costs(sorted_turns, kinds["conv"]), "edges"), kinds["conv"])

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches):
            part = table.column("part").to_numpy()
            bounds = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
            for a, b in zip(bounds[:-1], bounds[1:]):
                yield from _repaired(table.slice(a, b - a))

    columns = ["part", "conv", "turn", "role", "text", "first_entry", "first_leaving", "last_entry", "last_leaving"]
    joined = sorted_turns.join(seams, "part").repartition("part").sortWithinPartitions("part", "place")
    out = f"conv {kinds['conv']}, turn {kinds['turn']}, role string, new_role string, action string, inserted array<string>, piece string"
    repaired = joined.select(*columns).mapInArrow(repair, out)
    return repaired.withColumnsRenamed({"conv": conv, "turn": turn, "role": role})


def _runs(conv: pa.ChunkedArray) -> np.ndarray:
    """Where runs of equal conversation keys start, and the number of rows."""
    codes = conv.combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return np.flatnonzero(np.r_[True, codes[1:] != codes[:-1], True]) if len(codes) else np.zeros(1, np.int64)


def _edge_costs(sorted_turns: DataFrame, kind: str) -> DataFrame:
    """Rows (part, which, conv, cost matrix) of the first and the last conversation of each range.

    Two rows for each range: their number does not grow with the length of conversations.
    """

    def costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches):
            part = table.column("part").to_numpy()
            bounds = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
            for a, b in zip(bounds[:-1], bounds[1:]):
                piece = table.slice(a, b - a)
                cuts = _runs(piece.column("conv"))
                for which, run in enumerate(dict.fromkeys((0, len(cuts) - 2))):
                    x, y = int(cuts[run]), int(cuts[run + 1])
                    roles = np.array([role_number(r) for r in piece.column("role").slice(x, y - x).to_pylist()])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([part[a]], pa.int32()),
                            pa.array([which], pa.int32()),
                            piece.column("conv").slice(x, 1).combine_chunks(),
                            pa.array([run_cost(roles).ravel().tolist()], pa.list_(pa.float64())),
                        ],
                        ["part", "which", "conv", "cost"],
                    )

    rows = sorted_turns.select("part", "conv", "role", "place").repartition("part").sortWithinPartitions("part", "place")
    return rows.select("part", "conv", "role").mapInArrow(costs, f"part int, which int, conv {kind}, cost array<double>")


def _matrices(rows: pd.DataFrame) -> list[np.ndarray]:
    return [np.array(cost).reshape(5, 5) for cost in rows["cost"]]


def _settled(rows: pd.DataFrame, entry: int, leaving: int) -> pd.DataFrame:
    """Consecutive runs with the states that each begins and ends in; -1 leaves the end open."""
    left = boundary_states(_matrices(rows), entry, None if leaving < 0 else leaving)
    return rows.drop(columns="cost").assign(entry=[entry, *left[:-1]], leaving=[*left[:-1], leaving])


def _seam_states(edges: DataFrame, kind: str) -> DataFrame:
    """For each range the entry and leaving states of its first and last run; -1 leaves the end open.

    A conversation's runs in several ranges are consecutive, as turns are sorted by it. No task gets
    more of them than a block has, or the conversation blocks.
    """
    runs = edges.withColumn("place", F.col("part") * 2 + F.col("which")).withColumn("block", F.floor(F.col("part") / BLOCK_RANGES))
    counted = runs.groupBy("conv").agg(F.count("*").alias("n")).filter("n > 1").withColumnRenamed("conv", "of")
    several = F.col("conv").eqNullSafe(F.col("of"))
    long = runs.join(counted, several, "left_semi")
    alone = runs.join(counted, several, "left_anti").select("part", "which", F.lit(START).alias("entry"), F.lit(-1).alias("leaving"))

    def product(rows: pd.DataFrame) -> pd.DataFrame:
        whole = np.where(np.eye(5, dtype=bool), 0.0, np.inf)
        for matrix in _matrices(rows.sort_values("place")):
            whole = (whole[:, :, None] + matrix[None, :, :]).min(axis=1)
        return rows[["conv", "block"]].head(1).assign(cost=[whole.ravel().tolist()])

    def between(rows: pd.DataFrame) -> pd.DataFrame:
        return _settled(rows.sort_values("block"), START, -1)

    def within(rows: pd.DataFrame) -> pd.DataFrame:
        entry, leaving = int(rows["entry"].iloc[0]), int(rows["leaving"].iloc[0])
        return _settled(rows.sort_values("place").drop(columns=["entry", "leaving"]), entry, leaving)

    blocks = long.groupBy("conv", "block").applyInPandas(product, f"conv {kind}, block long, cost array<double>")
    seams = blocks.groupBy("conv").applyInPandas(between, f"conv {kind}, block long, entry int, leaving int")
    seams = seams.withColumnsRenamed({"conv": "of", "block": "of_block"})
    inside = long.join(seams, several & (F.col("block") == F.col("of_block"))).drop("of", "of_block")
    schema = f"part int, which int, conv {kind}, place int, block long, entry int, leaving int"
    solved = inside.groupBy("conv", "block").applyInPandas(within, schema).select("part", "which", "entry", "leaving")
    states = F.struct("entry", "leaving")
    ends = alone.unionByName(solved).groupBy("part").agg(
        F.max(F.when(F.col("which") == 0, states)).alias("first"), F.max(F.when(F.col("which") == 1, states)).alias("last")
    )
    last = F.coalesce("last", "first")
    return ends.select(
        "part",
        F.col("first.entry").alias("first_entry"),
        F.col("first.leaving").alias("first_leaving"),
        last["entry"].alias("last_entry"),
        last["leaving"].alias("last_leaving"),
    )


def _repaired(piece: pa.Table) -> Iterator[pa.RecordBatch]:
    """The output rows of one range."""
    cuts = _runs(piece.column("conv"))
    known = {k: piece.column(k)[0].as_py() for k in ("first_entry", "first_leaving", "last_entry", "last_leaving")}
    for start in range(0, len(cuts) - 1, 500):
        stop = min(start + 500, len(cuts) - 1)
        out: list[list] = [[], [], [], []]
        for run in range(start, stop):
            x, y = int(cuts[run]), int(cuts[run + 1])
            roles = np.array([role_number(r) for r in piece.column("role").slice(x, y - x).to_pylist()])
            entry, leaving = START, -1
            if run == len(cuts) - 2:
                entry, leaving = known["last_entry"], known["last_leaving"]
            if run == 0:
                entry, leaving = known["first_entry"], known["first_leaving"]
            states = run_states(roles, entry, None if leaving < 0 else leaving)
            texts = piece.column("text").slice(x, y - x).to_pylist()
            actions, inserted, pieces = render(roles, texts, entry, states, leaving < 0)
            for column, values in zip(out, ([ROLES[s - 1] for s in states], actions, inserted, pieces)):
                column.extend(values)
        rows = piece.slice(int(cuts[start]), int(cuts[stop] - cuts[start]))
        kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [rows.column(c).combine_chunks() for c in ("conv", "turn", "role")] + [pa.array(v, k) for v, k in zip(out, kinds)],
            ["conv", "turn", "role", "new_role", "action", "inserted", "piece"],
        )

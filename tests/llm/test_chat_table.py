"""The table of repaired conversations against brute force, with conversations over one and many ranges."""

import random
from collections import defaultdict

import pytest

from segflow.llm import chat
from segflow.llm.chat import INSERT, LAST, MERGE, RELABEL, ROLES, FOLLOWS, START, format_chats, role_number
from test_small_parts import least_cost


def told_cost(rows):
    """The cost of the repaired turns of one conversation, replayed; fails if a message may not stand where it does."""
    cost, state = 0.0, START
    for row in rows:
        if row["action"] == "merge":
            assert row["new_role"] == ROLES[state - 1] and (row is rows[-1] or not row["inserted"])
            cost += MERGE
        path = [ROLES.index(r) + 1 for r in row["inserted"]]
        ending = row is rows[-1]
        steps = path if row["action"] == "merge" else None
        if steps is None:
            after = ROLES.index(row["new_role"]) + 1
            # Messages before the turn's own, and on the last turn also those after it.
            for cut in range(len(path), -1, -1):
                before, at = path[:cut], state
                legal = True
                for r in [*before, after]:
                    legal &= r in FOLLOWS[at]
                    at = r
                if legal and (ending or cut == len(path)):
                    break
            assert legal
            path = path[cut:]
            cost += INSERT * cut
            state = after
        for r in path:
            assert ending and r in FOLLOWS[state]
            cost, state = cost + INSERT, r
        cost += RELABEL * (role_number(row["role"]) != (ROLES.index(row["new_role"]) + 1))
    assert state == LAST
    return cost


@pytest.mark.parametrize("blocks", [1, 2, 1_000])
def test_repairs_are_legal_and_cheapest(spark, monkeypatch, blocks):
    monkeypatch.setattr(chat, "BLOCK_RANGES", blocks)
    rng = random.Random(blocks)
    names = ["system", "user", "assistant", "tool", "User ", "gpt", "narrator", None]
    rows = [(None if c == 3 else c, t, rng.choice(names), f"{c} {t}") for c in range(40) for t in range(rng.randint(1, 7))]
    rows += [(7, 100 + t, rng.choice(names), f"long {t}") for t in range(150)]
    rows += [(100, t, rng.choice(names), None) for t in range(90)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    found, wanted = defaultdict(list), defaultdict(list)
    for r in format_chats(frame).collect():
        found[r["conv_id"]].append(r)
    for conv, turn, role, _ in rows:
        wanted[conv].append((turn, role_number(role)))
    assert found.keys() == wanted.keys()
    for conv, turns in found.items():
        ordered = sorted(turns, key=lambda r: r["turn"])
        assert [r["turn"] for r in ordered] == sorted(t for t, _ in wanted[conv])
        assert told_cost(ordered) == least_cost([role for _, role in sorted(wanted[conv])]), conv
        assert "".join(r["piece"] for r in ordered).endswith("<|im_end|>\n")

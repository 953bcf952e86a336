"""Cheapest edits of a conversation by a dynamic program over runs. Plain Python.

States: nothing kept yet, after the system turn, after a user turn, after an assistant
turn. A symbol is what a turn's role and fault mean for the program. The transition of a
symbol is a 4 x 4 matrix of costs in the min-plus semiring; a run of n equal symbols is
passed by the cached binary powers of its matrix.
"""

from __future__ import annotations

from functools import cache

Vector = tuple[float, ...]

# The costs of the edits.
RENAME, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

NEVER = float("inf")
START, SYSTEM, USER, ASSISTANT = range(4)
#: The symbol of a turn that has to go; others are 1 + 2 * role + truncated.
GONE = 0
ROLES = {"s": 1, "u": 2, "a": 3}
#: What follows a state when a turn of user or assistant is kept, renamed or inserted.
FOLLOWS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}


def symbol(initial: str, faulty: bool, truncated: bool) -> int:
    return GONE if faulty else 1 + 2 * ROLES.get(initial, 0) + truncated


def _keeps(state: int, role: int) -> bool:
    return (state == START and role == SYSTEM) or (role > SYSTEM and FOLLOWS[state] == role)


def times(matrix, columns):
    """Min-plus product."""
    return tuple(
        tuple(min(row[k] + columns[k][j] for k in range(4)) for j in range(len(columns[0]))) for row in matrix
    )


def apply(matrix, to_go: Vector) -> Vector:
    return tuple(min(row[k] + to_go[k] for k in range(4)) for row in matrix)


@cache
def _inserts():
    """The least cost of insertions from state to state."""
    found = [[0 if i == j else NEVER for j in range(4)] for i in range(4)]
    for _ in range(2):
        for i in range(4):
            for j in range(4):
                found[i][FOLLOWS[j]] = min(found[i][FOLLOWS[j]], found[i][j] + INSERT)
    return tuple(map(tuple, found))


@cache
def power(sign: int, doublings: int):
    """The matrix of 2 ** doublings turns with this symbol, insertions before each among them."""
    if doublings:
        half = power(sign, doublings - 1)
        return times(half, half)
    step = [[NEVER] * 4 for _ in range(4)]
    for state in range(4):
        step[state][state] = DELETE
        if sign != GONE:
            role, truncated = divmod(sign - 1, 2)
            step[state][FOLLOWS[state]] = RENAME + TRUNCATED * truncated
            if _keeps(state, role):
                step[state][role] = TRUNCATED * truncated
    return times(_inserts(), step)


def passed(sign: int, count: int, columns):
    """The costs to go before a run from those behind it; any number of columns."""
    doublings = 0
    while count:
        if count & 1:
            columns = times(power(sign, doublings), columns)
        count >>= 1
        doublings += 1
    return columns


def runs_of(signs) -> list[list[int]]:
    """[symbol, count] of runs; ``signs`` are (symbol, count) in order."""
    runs: list[list[int]] = []
    for sign, count in signs:
        if runs and runs[-1][0] == sign:
            runs[-1][1] += count
        else:
            runs.append([sign, count])
    return runs


def matrix_of(runs) -> list[list[float]]:
    """The costs of a stretch of turns, from the state before it to the state behind it."""
    columns = tuple(tuple(0 if i == j else NEVER for j in range(4)) for i in range(4))
    for sign, count in reversed(runs):
        columns = passed(sign, count, columns)
    return [list(row) for row in columns]


#: The costs to go behind the last turn: a conversation is empty or ends with an assistant.
LAST: Vector = apply(_inserts(), (0, NEVER, NEVER, 0))


def walk(signs, to_go: Vector, state: int, last: bool):
    """(state behind, edits): for every (symbol, count) its edits and the roles it leaves.

    ``to_go`` are the costs behind these turns. Of the cheapest edits the ASCII-least: at
    every place the least letter that is on a cheapest way is taken; a letter fixes the
    state behind it. Edits are (letters, roles inserted before, role kept or None, roles
    inserted at the end).
    """
    runs = runs_of(signs)
    behind = [to_go]  # costs to go behind each run
    for sign, count in reversed(runs):
        before = passed(sign, count, tuple((c,) for c in behind[-1]))
        behind.append(tuple(c for (c,) in before))
    behind.reverse()  # behind[r] is before run r
    edits, place, run, inner = [], 0, -1, []
    for sign, count in signs:
        if place == 0:
            run += 1
            place = runs[run][1]
            if sign != GONE:  # costs after 0, 1, ... turns of the run, from its end
                inner = [behind[run + 1]]
                for _ in range(place):
                    inner.append(apply(power(sign, 0), inner[-1]))
        if sign == GONE:  # deleting at once is cheapest, and the least letter
            edits.append(("D" * count, (), None, ()))
            place -= count
            continue
        here, after = inner[place], inner[place - 1]
        place -= 1
        role, truncated = divmod(sign - 1, 2)
        letters, inserted, kept = "", [], None
        while True:
            cost, follows = here[state], FOLLOWS[state]
            if DELETE + after[state] == cost:
                letters += "D"
                break
            if INSERT + here[follows] == cost:
                letters, state = letters + "I", follows
                inserted.append(NAMES[follows])
                continue
            if _keeps(state, role) and TRUNCATED * truncated + after[role] == cost:
                letters, state, kept = letters + "K", role, ""
            else:
                letters, state, kept = letters + "R", follows, NAMES[follows]
            break
        edits.append((letters, tuple(inserted), kept, ()))
    if last:
        added = []
        while to_go[state]:
            state = FOLLOWS[state]
            added.append(NAMES[state])
        if added:
            letters, inserted, kept, _ = edits[-1]
            edits[-1] = (letters + "I" * len(added), inserted, kept, tuple(added))
    return state, edits

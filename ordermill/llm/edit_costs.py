"""Cheapest edits that make a sequence of roles legal: a checkpointed dynamic program over a small automaton."""

from __future__ import annotations

from math import isqrt

#: The roles' initials, and where the automaton of `(s?(ua)+)?` goes with them. States: nothing yet, after s, after u, after a.
INITIALS = "sua"
START, SYSTEM, USER, ASSISTANT = range(4)
GOES = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The one role that an edit may put in a state: user, but assistant after user.
PUT = ("u", "u", "a", "u")
NEXT = tuple(GOES[state, PUT[state]] for state in range(4))
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
NEVER = 1 << 60

#: A row's code is a byte: which initial (3: another), plus 4 if it is truncated, or GONE if it must be deleted.
GONE = 8


def row_code(initial: str, truncated: bool, gone: bool) -> int:
    if gone:
        return GONE
    place = INITIALS.find(initial) if initial else -1
    return (place if place >= 0 else 3) + 4 * truncated


def _moves(code: int, state: int) -> list[tuple[str, int, int]]:
    """Edits of a row in a state, in the order of their letters: letter, cost, next state."""
    moves = [("D", DELETE, state)]
    if code != GONE:
        extra = TRUNCATED if code & 4 else 0
        kept = GOES.get((state, INITIALS[code & 3])) if code & 3 < 3 else None
        if kept is not None:
            moves.append(("K", KEEP + extra, kept))
        moves.append(("R", REROLE + extra, NEXT[state]))
    return moves


_MOVES = [[_moves(code, state) for state in range(4)] for code in range(GONE + 1)]


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    """The costs when rows may be put in before; three rounds reach every state from every other."""
    for _ in range(3):
        costs = [min(costs[state], INSERT + costs[NEXT[state]]) for state in range(4)]
    return tuple(costs)


#: Cost to the end of the sequence from each state, when no row is left: legal ends are free.
END = _with_inserts([0, NEVER, NEVER, 0])


class EditCosts:
    """Backward costs of rows, remembered by their differences: only few different cost vectors ever occur."""

    def __init__(self) -> None:
        self.back: dict[tuple, tuple] = {}
        self.walk: dict[tuple, tuple] = {}

    def before(self, code: int, after: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
        """The costs before a row, less their smallest, and that smallest; `after` are the costs behind it."""
        found = self.back.get((code, after))
        if found is None:
            costs = _with_inserts([min(cost + after[to] for _, cost, to in _MOVES[code][state]) for state in range(4)])
            least = min(costs)
            found = self.back[code, after] = (tuple(cost - least for cost in costs), least)
        return found

    def step(self, code: int, after: tuple[int, ...], state: int) -> tuple[str, int]:
        """The ASCII-least tight edits from a state up to and with this row, and the state behind it."""
        found = self.walk.get((code, after, state))
        if found is None:
            costs, least = self.before(code, after)
            letters, at = "", state
            while True:
                tight = costs[at] + least
                moves = [move for move in _MOVES[code][at] if move[1] + after[move[2]] == tight]
                may_insert = INSERT + costs[NEXT[at]] + least == tight
                if moves and (moves[0][0] == "D" or not may_insert):
                    found = (letters + moves[0][0], moves[0][2])
                    break
                letters, at = letters + "I", NEXT[at]
            self.walk[code, after, state] = found
        return found

    def edits(self, codes: bytes) -> tuple[int, str]:
        """The least cost of edits of rows with these codes, and of the cheapest sequences of edits the ASCII-least.

        The backward costs are kept at every sqrt(n)-th row only. Walking forward, the costs inside a block are computed anew
        from the checkpoint behind it, so 2 sqrt(n) vectors are held at a time, besides the codes and the letters.
        """
        n = len(codes)
        block = max(1, isqrt(n))
        costs = END  # from the start the least of END is 0
        total, checkpoints = 0, {n: costs}
        for at in range(n - 1, -1, -1):
            costs, least = self.before(codes[at], costs)
            total += least
            if at % block == 0:
                checkpoints[at] = costs
        total += costs[START]
        letters, state = [], START
        for begin in range(0, n, block):
            end = min(begin + block, n)
            inside = [checkpoints[end]]
            for at in range(end - 1, begin, -1):
                inside.append(self.before(codes[at], inside[-1])[0])
            for at in range(begin, end):
                found, state = self.step(codes[at], inside[end - 1 - at], state)
                letters.append(found)
        while state not in (START, ASSISTANT):
            letters.append("I")
            state = NEXT[state]
        return total, "".join(letters)


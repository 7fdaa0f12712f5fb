"""Cheapest edits that make a block of turns fit the alternating grammar.

The grammar is (s?(ua)+)? over role initials.  What is left to come depends on
the last initial only, so there are four states: nothing yet, after s, after
u, after a.  A block is aligned from each state to each state by the
Wagner-Fischer table of its turns against the alternating string that ends in
that state; one table, filled from the end, holds the alignments to every
feasible length of that string.  Ukkonen bands keep the cells that can still be
within the incumbent, the cost of the plain pass that never inserts; a result
above the band's cost widens it.  Lengths of equal cost are told apart by their
audits, traced forward: the ASCII-least letter of those that stay cheapest.

Every edit of a plan ends in a turn (inserts come before it), so plans of one
block that differ are never one another's beginning, and blocks can be chained
by cost and by the order of their audits alone.
"""

from __future__ import annotations

from functools import lru_cache

# Role classes of a turn, and what keeps it from staying as it is.
S, U, A, OTHER = range(4)
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
#: The symbol of (role class, fault): one ASCII letter from this one on.
FIRST_SYMBOL = ord("A")

# States: the last initial so far.
NOTHING, AFTER_S, AFTER_U, AFTER_A = STATES = range(4)
INSERT, REROLE, DELETE, MEND = 3, 3, 4, 3
FAR = 1 << 40

#: What a plan says of one turn: inserted initials, then one of these.
KEEP, TO_USER, TO_ASSISTANT, DROP = "KUAD"
_AUDIT = str.maketrans({"u": "I", "a": "I", TO_USER: "R", TO_ASSISTANT: "R", ",": None})

#: At the end of a conversation: what a state still needs.
TAIL = {NOTHING: "", AFTER_S: "ua", AFTER_U: "a", AFTER_A: ""}


def audit_of(plan: str) -> str:
    return plan.translate(_AUDIT)


def _turns(symbols: str) -> list[tuple[int, int]]:
    """(role class, cost of keeping besides a new role; FAR if it must go)."""
    cost = {FINE: 0, TRUNCATED: MEND, BLANK: FAR, DUPLICATE: FAR}
    return [((ord(x) - FIRST_SYMBOL) // 4, cost[(ord(x) - FIRST_SYMBOL) % 4]) for x in symbols]


class _Table:
    """Alignments of the rest of a block to the last r initials of the string
    that ends in `end`: cost[i][r] from turn i on."""

    def __init__(self, turns: list[tuple[int, int]], end: int, bound: int):
        self.turns, self.end, n = turns, end, len(turns)
        self.width = n + bound // INSERT + 2
        nothing_left = [0] + [FAR] * self.width
        self.cost = [nothing_left]
        after = nothing_left
        for i in range(n - 1, -1, -1):
            left = n - i
            low, high = max(0, left - bound // DELETE), min(self.width, left + bound // INSERT)
            now = [FAR] * (self.width + 1)
            for r in range(low, high + 1):
                best = DELETE + after[r]
                if r:
                    best = min(best, INSERT + now[r - 1], self.match(i, r) + after[r - 1])
                now[r] = best
            self.cost.append(now)
            after = now
        self.cost.reverse()
        # the same with an s kept before the string
        self.with_s = [[FAR] * (self.width + 1) for _ in range(n + 1)]
        for i in range(n - 1, -1, -1):
            role, keep = turns[i]
            for r in range(self.width + 1):
                kept = keep + self.cost[i + 1][r] if role == S else FAR
                self.with_s[i][r] = min(kept, DELETE + self.with_s[i + 1][r], FAR)

    def initial(self, r: int) -> int:
        """The first of the last r initials."""
        return self.end if r % 2 else U + A - self.end

    def match(self, i: int, r: int) -> int:
        role, keep = self.turns[i]
        return keep + (0 if role == self.initial(r) else REROLE)

    def trace(self, r: int, with_s: bool) -> str:
        """The plan of the ASCII-least audit with r initials (after an s)."""
        pieces, piece, i = [], "", 0
        while i < len(self.turns):
            if with_s:
                if self.with_s[i][r] == DELETE + self.with_s[i + 1][r]:
                    pieces.append(DROP)
                else:
                    pieces.append(KEEP)
                    with_s = False
                i += 1
                continue
            want = self.cost[i][r]
            if want == DELETE + self.cost[i + 1][r]:
                pieces.append(piece + DROP)
            elif want == INSERT + self.cost[i][r - 1]:
                piece += "sua"[self.initial(r)]
                r -= 1
                continue
            else:
                kept = self.turns[i][0] == self.initial(r)
                pieces.append(piece + (KEEP if kept else (None, TO_USER, TO_ASSISTANT)[self.initial(r)]))
                r -= 1
            piece, i = "", i + 1
        return ",".join(pieces)

    def lengths(self, state: int) -> list[tuple[int, int, bool]]:
        """(cost, r, with s) of the feasible lengths from a state."""
        last = {AFTER_U: U, AFTER_A: A}.get(state)
        out = []
        for r in range(self.width + 1):
            if r == 0:
                if last == self.end:
                    out.append((self.cost[0][0], 0, False))
                continue
            first = self.initial(r)
            if first != last and (last is not None or first == U):
                out.append((self.cost[0][r], r, False))
            if state == NOTHING and first == U:
                out.append((self.with_s[0][r], r, True))
        return out


def _incumbent(turns: list[tuple[int, int]]) -> int:
    """Cost of the pass that keeps or reroles every turn it may, and what a
    missed last initial costs at most."""
    cost, due = 0, U
    for role, keep in turns:
        if keep == FAR:
            cost += DELETE
            continue
        if role == S and due == U and not cost:
            cost += keep
            continue
        cost += keep + (0 if role == due else REROLE)
        due = U + A - due
    return min(cost, DELETE * len(turns)) + 2 * INSERT


@lru_cache(maxsize=20_000)
def aligned(symbols: str) -> tuple[tuple[int, ...], tuple[int, ...], tuple[str, ...]]:
    """Costs, ranks and plans, each by 4 * (state before) + (state after).

    A cost is -1 where no plan leads there.  Ranks order the audits of one
    state before; a plan is a comma-separated list with a piece for each turn.
    """
    turns = _turns(symbols)
    found: dict[tuple[int, int], tuple[int, str]] = {}
    everything = (DELETE * len(turns), ",".join([DROP] * len(turns)))
    found[NOTHING, NOTHING] = found[AFTER_S, AFTER_S] = everything
    most = DELETE * len(turns) + 2 * INSERT  # delete all, with an insert or two before
    for after, end in ((AFTER_U, U), (AFTER_A, A)):
        bound = min(most, _incumbent(turns))
        while True:
            table = _Table(turns, end, bound)
            lengths = {state: table.lengths(state) for state in STATES}
            least = {state: min((x[0] for x in lengths[state]), default=FAR) for state in STATES}
            if bound >= most or max(least.values()) <= bound:
                break
            bound = min(most, 2 * bound)
        for state in STATES:
            if least[state] < FAR:
                plans = [table.trace(r, s) for cost, r, s in lengths[state] if cost == least[state]]
                found[state, after] = least[state], min(plans, key=audit_of)
        if table.with_s[0][0] < FAR:
            found[NOTHING, AFTER_S] = table.with_s[0][0], table.trace(0, True)
    costs, ranks, plans = [-1] * 16, [0] * 16, [""] * 16
    for state in STATES:
        reached = sorted((audit_of(found[state, e][1]), e) for e in STATES if (state, e) in found)
        for rank, (_, e) in enumerate(reached):
            costs[4 * state + e], plans[4 * state + e] = found[state, e]
            ranks[4 * state + e] = rank
    return tuple(costs), tuple(ranks), tuple(plans)


class Chain:
    """The blocks of one conversation in order: cheapest states, then least audits."""

    def __init__(self) -> None:
        #: state: (cost, rank of its audit among the states)
        self.now = {NOTHING: (0, 0)}
        self.before: list[tuple[int, ...]] = []

    def add(self, costs: list[int], ranks: list[int]) -> None:
        best = {}
        for after in STATES:
            ways = [(cost + costs[4 * s + after], rank, ranks[4 * s + after], s)
                    for s, (cost, rank) in self.now.items() if costs[4 * s + after] >= 0]
            if ways:
                best[after] = min(ways)
        order = sorted(best, key=lambda e: best[e][1:3])
        self.now = {e: (best[e][0], order.index(e)) for e in best}
        self.before.append(tuple(best[e][3] if e in best else -1 for e in STATES))

    def picks(self) -> tuple[list[int], str]:
        """The plan taken of each block, and what is inserted at the end."""
        last = min(self.now, key=lambda e: (self.now[e][0] + INSERT * len(TAIL[e]), self.now[e][1]))
        out, state = [], last
        for states in reversed(self.before):
            out.append(4 * states[state] + state)
            state = states[state]
        return out[::-1], TAIL[last]

"""Alignment of a run of turns with the alternating grammar ``(s?(ua)+)?`` of role initials.

A turn is one letter: its role's initial (``s``, ``u``, ``a``, else ``o``), upper case if its text is truncated, or ``x`` if it must be deleted. A block of turns is
entered and left in one of four states: nothing said yet (``-``), only the system turn (``s``), last said by the user (``u``) or the assistant (``a``).
Edits and costs: Keep 0, Rerole 3 (to ``u`` or ``a``), Delete 4, Insert 3 (``u`` or ``a``), and 3 more for a truncated turn that stays.

An audit is the edits' initials in order. In a block, inserts stand before a turn, never after the last (``ENDINGS`` has those of a whole conversation), so no audit
of a block begins another one of the same block: audits of equal cost compare block by block.
"""

from __future__ import annotations

from functools import lru_cache

STATES = "-sua"
#: What can be entered and left in one block.
PAIRS = [p + q for p in STATES for q in STATES if (p, q) in {
    ("-", "-"), ("-", "s"), ("-", "u"), ("-", "a"), ("s", "s"), ("s", "u"), ("s", "a"), ("u", "u"), ("u", "a"), ("a", "u"), ("a", "a"),
}]
#: Cost and edits after the last turn, by the state it leaves.
ENDINGS = {"-": (0, ""), "s": (6, "II"), "u": (3, "I"), "a": (0, "")}
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
NEVER = 1 << 40


class _Tails:
    """Costs of turns from any one on against the last k symbols of a string that alternates and ends with ``last``.

    The targets of all feasible lengths are tails of one another, so one Wagner-Fischer matrix serves them all. Its band is Ukkonen's: the incumbent, an alignment that
    keeps every turn in its place, costs ``most``; a cell (turn, k) is left out if the inserts or deletes its diagonal needs already cost more.
    """

    def __init__(self, turns: str, last: str) -> None:
        self.turns, self.symbols = turns, (last, "a" if last == "u" else "u")
        n = len(turns)
        rest = [0] * (n + 1)  # turns that may stay, from each one on
        for i in range(n - 1, -1, -1):
            rest[i] = rest[i + 1] + (turns[i] != "x")
        free = n - rest[0]
        straight = sum(
            CUT * t.isupper() + REROLE * (t.lower() != self.symbols[(rest[i] - 1) % 2]) for i, t in enumerate(turns) if t != "x"
        )
        slack = straight + 2 * INSERT  # up to two inserts in front bring the length a pair of states needs
        self.most = DELETE * free + slack
        below, above = slack // DELETE, slack // INSERT
        self.longest = rest[0] + above
        self.cost = [[NEVER] * (self.longest + 2) for _ in range(n + 1)]
        self.cost[n][0] = 0
        for i in range(n - 1, -1, -1):
            own, after, turn = self.cost[i], self.cost[i + 1], turns[i]
            cut = CUT * turn.isupper()
            initial = turn.lower()
            for k in range(max(0, rest[i] - below), min(self.longest, rest[i] + above) + 1):
                best = DELETE + after[k]
                if k:
                    best = min(best, INSERT + own[k - 1])
                    if turn != "x":
                        best = min(best, after[k - 1] + cut + (0 if initial == self.symbols[(k - 1) % 2] else REROLE))
                own[k] = best

    def audit(self, i: int, k: int) -> str:
        """The ASCII-least of the cheapest audits of turns i.. against k symbols, read off the matrix from its first edit on."""
        cost, edits = self.cost, []
        while i < len(self.turns):
            turn, here = self.turns[i], cost[i][k]
            stays = k and turn != "x"
            held = cost[i + 1][k - 1] + CUT * turn.isupper() if stays else NEVER
            if here == DELETE + cost[i + 1][k]:
                edits.append("D")
                i += 1
            elif k and here == INSERT + cost[i][k - 1]:
                edits.append("I")
                k -= 1
            elif stays and turn.lower() == self.symbols[(k - 1) % 2] and here == held:
                edits.append("K")
                i, k = i + 1, k - 1
            else:
                edits.append("R")
                i, k = i + 1, k - 1
        return "".join(edits)


def _cheapest(found: list[tuple[int, object]]) -> tuple[int, str] | None:
    """The least cost with the least of its audits, each backtraced only if its cost is the least."""
    least = min((c for c, _ in found), default=NEVER)
    return (least, min(audit() for c, audit in found if c == least)) if least < NEVER else None


@lru_cache(maxsize=100_000)
def align(turns: str) -> dict[str, tuple[int, str]]:
    """(cost, audit) of one block (a turn at least) for each pair of states that it can be entered and left in."""
    n = len(turns)
    tails = {last: _Tails(turns, last) for last in "ua"}
    gone = (DELETE * n, lambda: "D" * n)
    found: dict[str, list] = {pair: [] for pair in PAIRS}
    for state in STATES:
        found[state + state].append(gone)
    for last, tail in tails.items():
        for k in range(1, tail.longest + 1):
            one = (tail.cost[0][k], lambda t=tail, k=k: t.audit(0, k))
            before = ("u" if last == "a" else "a") if k % 2 else last
            found[before + last].append(one)
            if before == "a":  # the string begins with a user's turn
                found["s" + last].append(one)
                found["-" + last].append(one)
    # The system turn cannot be inserted: one that is there is kept, all before it go.
    for i, turn in enumerate(turns):
        if turn in "sS":
            here = DELETE * i + CUT * (turn == "S")
            found["-s"].append((here + DELETE * (n - i - 1), lambda i=i: "D" * i + "K" + "D" * (n - i - 1)))
            for last, tail in tails.items():
                for k in range(1 if last == "u" else 2, tail.longest + 1, 2):
                    if tail.cost[i + 1][k] < NEVER:
                        found["-" + last].append((here + tail.cost[i + 1][k], lambda t=tail, i=i, k=k: "D" * i + "K" + t.audit(i + 1, k)))
    return {pair: best for pair, some in found.items() if (best := _cheapest(some))}


def repaired(turns: list[tuple[str, str]], audit: str, state: str) -> list[tuple[str, str, str]]:
    """(edit, role, text) of what an audit makes of a block entered in ``state``; deleted turns are left with their own role and text."""
    made, at = [], 0
    for edit in audit:
        role, text = (None, "") if edit == "I" else turns[at]
        at += edit != "I"
        if edit != "D":
            needed = "a" if state == "u" else "u"
            state = "s" if edit == "K" and role[:1] == "s" else needed
            if edit in "RI":
                role = "user" if needed == "u" else "assistant"
        made.append((edit, role, text))
    return made

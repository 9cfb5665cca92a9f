"""The repair of one stretch of turns: a shortest path through a lattice, found by an auction.

A turn is a letter of a stretch: what may be done with it depends only on its role's initial, on whether it has to go and on whether it is
truncated. The lattice has a node for each (turn, state); a state is what has been put out so far: nothing, an opening system turn, a
user turn or an assistant turn. Arcs are the edits Keep, Rerole, Delete and Insert with whole costs, so from a node every letter leads to one
other node.

The auction keeps a price for every node, at most the cost of an arc plus the price at its head. A path grows from its origin:
where the price of its last node is below its cheapest arc, the price rises to it and the path contracts by that node; otherwise it extends along that
arc. When the path reaches the target, the price of the origin is its distance. An arc is tight where its cost is the
difference of the prices; tight arcs whose heads have converged as well are the arcs of the shortest paths, and the least
letters along them are the answer.

Prices start at what the turns ahead cost at least: four for one that has to go, three for a truncated one.
"""

from __future__ import annotations

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: What comes after a state by insertion or a new role, and what each kept initial leads to.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
DELETE, NEW_ROLE, INSERT, TRUNCATED = 4, 3, 3, 3
#: A turn that has to go; others are their initial (``-`` for any that cannot be kept), in capitals where truncated.
GONE = "x"
#: The distance from where the end cannot be reached.
NEVER = 1 << 40


def code(initial: str, has_to_go: bool, truncated: bool) -> str:
    if has_to_go:
        return GONE
    initial = initial if initial in ("s", "u", "a") else "-"
    return ("_" if initial == "-" else initial.upper()) if truncated else initial


class Lattice:
    """The lattice of one stretch; ``ends`` has the price of each state behind the last turn (None: no way out).

    With ``last`` the stretch is the conversation's end: turns may still be inserted behind its last turn.
    """

    def __init__(self, codes: str, ends: tuple, last: bool):
        self.codes, self.ends, self.last = codes, ends, last
        self.target = 4 * (len(codes) + 1)
        price, floor = [0] * (self.target + 1), min(e for e in ends if e is not None)
        # no way leads back from a turn put out to none, or from a user's turn to an opening one
        closed = [not last and all(e is None for e in ends[min(s, USER) :]) for s in STATES]
        for turn in range(len(codes), -1, -1):
            if turn < len(codes):
                c = codes[turn]
                floor += DELETE if c == GONE else TRUNCATED if c.isupper() or c == "_" else 0
            price[4 * turn : 4 * turn + 4] = [NEVER if shut else floor for shut in closed]
        self.price, self.known, self.exact = price, {}, {self.target}

    def arcs(self, node: int) -> list[tuple[str, int, int]]:
        """(letter, cost, head), letters in ASCII order; the way to the target has no letter."""
        found = self.known.get(node)
        if found is not None:
            return found
        turn, state = divmod(node, 4)
        found = []
        if turn == len(self.codes):
            if self.ends[state] is not None:
                found.append(("", self.ends[state], self.target))
            if self.last:
                found.append(("I", INSERT, 4 * turn + NEXT[state]))
        else:
            c = self.codes[turn]
            found.append(("D", DELETE, node + 4))
            found.append(("I", INSERT, 4 * turn + NEXT[state]))
            if c != GONE:
                more = TRUNCATED if c.isupper() or c == "_" else 0
                kept = KEPT.get((state, c.lower()))
                if kept is not None:
                    found.append(("K", more, 4 * turn + 4 + kept))
                found.append(("R", NEW_ROLE + more, 4 * turn + 4 + NEXT[state]))
        self.known[node] = found
        return found

    def distance(self, origin: int) -> int:
        """The cost of the cheapest way from a node to the target; ``NEVER`` if there is none.

        The path may stop at a node whose price has converged before; its own nodes have converged then.
        """
        price, path = self.price, [origin]
        while path[-1] not in self.exact:
            node = path[-1]
            best, where = NEVER, None
            for _, cost, head in self.arcs(node):
                if cost + price[head] < best:
                    best, where = cost + price[head], head
            if price[node] < best:
                price[node] = best
                if len(path) > 1:
                    path.pop()
                elif best >= NEVER:
                    return NEVER
            elif where is None:
                return NEVER
            else:
                path.append(where)
        self.exact.update(path)
        return price[origin]

    def trace(self, state: int) -> tuple[int, str, int | None]:
        """(cost, letters, state behind the last turn) of the cheapest edits from a state, the least letters on ties."""
        cost = self.distance(state)
        if cost >= NEVER:
            return NEVER, "", None
        node, letters = state, []
        while True:
            for letter, price, head in self.arcs(node):
                # a head that is not the target is compared once its own price has converged
                if price + self.price[head] == self.price[node] and (head == self.target or price + self.distance(head) == self.price[node]):
                    break
            else:
                raise AssertionError("a node on a cheapest path has a tight arc")
            if head == self.target:
                return cost, "".join(letters), node % 4
            letters.append(letter)
            node = head


#: The conversation may end with nothing or behind an assistant turn.
CLOSED = (0, None, None, 0)


def solved(codes: str) -> tuple[int, str]:
    """(cost, letters) of a whole conversation."""
    cost, letters, _ = Lattice(codes, CLOSED, True).trace(START)
    return cost, letters


def costs_through(codes: str, last: bool) -> list[int]:
    """The cheapest costs from each state before a stretch to each state behind it, by row; the end is one state, the first column."""
    out = [NEVER] * 16
    for end in STATES if not last else (0,):
        ends = CLOSED if last else tuple(0 if s == end else None for s in STATES)
        lattice = Lattice(codes, ends, last)
        for state in STATES:
            out[4 * state + end] = lattice.distance(state)
    return out


def roles(letters: str, initials: list[str], state: int = START) -> tuple[list[tuple[str, str]], str, int]:
    """What edits from a state make of turns with these initials: (edits of each turn, roles inserted behind the last, state there).

    The edits of a turn are the roles inserted before it and its own: k if kept, a new initial, '' if deleted.
    """
    turn, before, out = 0, "", []
    for letter in letters:
        if letter == "D":
            own = ""
        elif letter == "K":
            own, state = "k", KEPT[(state, initials[turn])]
        else:
            state = NEXT[state]
            own = "u" if state == USER else "a"
            if letter == "I":
                before += own
                continue
        out.append((before, own))
        turn, before = turn + 1, ""
    return out, before, state

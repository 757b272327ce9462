"""Regular expressions as minimal deterministic automata over bytes.

Patterns are read by the standard library, turned into one nondeterministic
automaton, made deterministic by subset construction and minimised by
partition refinement. Literals, classes, groups, alternatives and greedy
repeats are understood; anchors, look-around and references are refused.
"""

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass, field

ALPHABET = 256


@dataclass
class Nfa:
    """States are numbers; each has byte moves and empty moves."""

    moves: list[list[tuple[frozenset[int], int]]] = field(default_factory=list)
    empty: list[list[int]] = field(default_factory=list)

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def add(self, tree, start: int, any_case: bool) -> int:
        """Append the parsed pattern after ``start``; returns its last state."""
        at = start
        for operation, value in tree:
            at = self._one(operation, value, at, any_case)
        return at

    def _one(self, operation, value, at: int, any_case: bool) -> int:
        if operation is sre.LITERAL:
            for byte in (chr(value).encode() if value > 127 else (value,)):
                at = self._step(at, {byte}, any_case)
            return at
        if operation is sre.IN:
            return self._step(at, _members(value), any_case)
        if operation is sre.SUBPATTERN:
            return self.add(value[3], at, any_case)
        if operation is sre.BRANCH:
            end = self.state()
            for branch in value[1]:
                first = self.state()
                self.empty[at].append(first)
                self.empty[self.add(branch, first, any_case)].append(end)
            return end
        if operation is sre.MAX_REPEAT:
            least, most, inner = value
            for _ in range(least):
                at = self.add(inner, at, any_case)
            if most is sre.MAXREPEAT:
                loop = self.state()
                self.empty[at].append(loop)
                self.empty[self.add(inner, loop, any_case)].append(loop)
                return loop
            end = self.state()
            self.empty[at].append(end)
            for _ in range(most - least):
                at = self.add(inner, at, any_case)
                self.empty[at].append(end)
            return end
        raise ValueError(f"not supported in a rule: {operation}")

    def _step(self, at: int, members: set[int], any_case: bool) -> int:
        if any_case:
            members = members | {byte ^ 32 for byte in members if chr(byte).isascii() and chr(byte).isalpha()}
        to = self.state()
        self.moves[at].append((frozenset(members), to))
        return to

    def closure(self, states) -> frozenset[int]:
        found, open_ = set(states), list(states)
        while open_:
            for to in self.empty[open_.pop()]:
                if to not in found:
                    found.add(to)
                    open_.append(to)
        return frozenset(found)

    def reversed(self, starts, end: int) -> tuple["Nfa", int, int]:
        """The automaton of the reversed strings, with its start and its end."""
        back = Nfa()
        for _ in range(len(self.moves) + 1):
            back.state()
        for at, moves in enumerate(self.moves):
            for members, to in moves:
                back.moves[to].append((members, at))
            for to in self.empty[at]:
                back.empty[to].append(at)
        first = len(self.moves)
        back.empty[first].extend(starts)
        return back, first, end


def _members(items) -> set[int]:
    found: set[int] = set()
    for kind, value in items:
        if kind is sre.LITERAL:
            found.add(value)
        elif kind is sre.RANGE:
            found.update(range(value[0], value[1] + 1))
        else:
            raise ValueError(f"not supported in a class: {kind}")
    if found and max(found) > 127:
        raise ValueError("classes hold ASCII characters only")
    return found


@dataclass(frozen=True)
class Dfa:
    """``step[state * 256 + byte]`` is the next state, times 256; ``marks[state]`` is a bit set of rules."""

    step: list[int]
    start: int
    marks: list[int]

    def dead(self) -> int | None:
        """The state that accepts nothing and is never left, times 256."""
        for state in range(len(self.marks)):
            row = self.step[state * ALPHABET : (state + 1) * ALPHABET]
            if not self.marks[state] and all(to == state * ALPHABET for to in row):
                return state * ALPHABET
        return None


def determinise(nfa: Nfa, start: int, accept: dict[int, int], everywhere: bool) -> Dfa:
    """Subset construction, then minimisation.

    ``accept`` gives the rule bits of final states. With ``everywhere`` a match
    may begin at any byte, else only at the first.
    """
    begin = nfa.closure([start])
    number = {begin: 0}
    rows: list[list[int]] = []
    waiting = [begin]
    for subset in waiting:
        targets: list[set[int]] = [set() for _ in range(ALPHABET)]
        for state in subset:
            for members, to in nfa.moves[state]:
                for byte in members:
                    targets[byte].add(to)
        row, known = [], {}
        for target in map(frozenset, targets):
            if target not in known:
                closed = nfa.closure(target) | begin if everywhere else nfa.closure(target)
                if closed not in number:
                    number[closed] = len(number)
                    waiting.append(closed)
                known[target] = number[closed]
            row.append(known[target])
        rows.append(row)
    marks = []
    for subset in waiting:
        bits = 0
        for state in subset:
            bits |= accept.get(state, 0)
        marks.append(bits)
    return _minimised(rows, marks)


def _minimised(rows: list[list[int]], marks: list[int]) -> Dfa:
    """Split blocks of states by where their bytes lead until nothing splits.

    Marked blocks are numbered last, so one comparison tells a match.
    """
    block = list(marks)
    while True:
        keys = [(block[i], *(block[to] for to in row)) for i, row in enumerate(rows)]
        names: dict[tuple, int] = {}
        renamed = [names.setdefault(key, len(names)) for key in keys]
        if len(names) == len(set(block)):
            break
        block = renamed
    order = {old: new for new, old in enumerate(sorted(set(renamed), key=lambda b: (marks[renamed.index(b)] != 0, b)))}
    first: dict[int, int] = {}
    for state, b in enumerate(renamed):
        first.setdefault(order[b], state)
    step = [order[renamed[to]] * ALPHABET for new in range(len(first)) for to in rows[first[new]]]
    return Dfa(step, order[renamed[0]] * ALPHABET, [marks[first[new]] for new in range(len(first))])


@dataclass(frozen=True)
class Rule:
    """A kind of match: its pattern, an optional head before the counted part, and the least count."""

    kind: str
    pattern: str
    head: str = ""
    least: int = 0
    any_case: bool = False


def _whole(pattern: str, any_case: bool) -> tuple[Nfa, int, int]:
    nfa = Nfa()
    start = nfa.state()
    return nfa, start, nfa.add(sre_parser.parse(pattern), start, any_case)


class RuleSet:
    """All rules in one automaton, plus small ones that find where a match begins and ends."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        union = Nfa()
        start = union.state()
        accept: dict[int, int] = {}
        self.forward, self.backward, self.heads = [], [], []
        for number, rule in enumerate(rules):
            first = union.state()
            union.empty[start].append(first)
            end = union.add(sre_parser.parse(rule.head + rule.pattern), first, rule.any_case)
            accept[end] = 1 << number
            nfa, begin, last = _whole(rule.head + rule.pattern, rule.any_case)
            self.forward.append(determinise(nfa, begin, {last: 1}, False))
            # a match under way may stand at any state, so its reversal starts from all of them
            back, origin, goal = nfa.reversed(range(len(nfa.moves)), begin)
            self.backward.append(determinise(back, origin, {goal: 1}, False))
            self.heads.append(None if not rule.head else determinise(*_headed(rule), False))
        self.combined = determinise(union, start, accept, True)
        self._dead = [(f.dead(), b.dead(), h.dead() if h else None) for f, b, h in zip(self.forward, self.backward, self.heads)]

    def spans(self, text: bytes) -> list[tuple[int, int, int]]:
        """Matches as (start, rule number, end) in bytes.

        Per rule they are leftmost, longest and do not overlap. One pass over
        the bytes tells for all rules where a match ends first; from there its
        start is found backwards and its end forwards.
        """
        found = []
        free = [0] * len(self.rules)
        combined = self.combined
        step, state = combined.step, combined.start
        marks = combined.marks
        marked = next((i for i, bits in enumerate(marks) if bits), len(marks)) * ALPHABET
        for at, byte in enumerate(text):
            state = step[state + byte]
            if state >= marked:
                bits = marks[state >> 8]
                number = 0
                while bits:
                    if bits & 1 and at >= free[number]:
                        span = self._leftmost(text, number, free[number], at + 1)
                        if span:
                            free[number] = span[1]
                            if self._long_enough(text, number, *span):
                                found.append((span[0], number, span[1]))
                    bits >>= 1
                    number += 1
        return sorted(found)

    def _leftmost(self, text: bytes, number: int, low: int, seen: int) -> tuple[int, int] | None:
        """The match under way at byte ``seen`` that begins first, at ``low`` or later."""
        back, dead = self.backward[number], self._dead[number][1]
        state, starts = back.start, []
        for at in range(seen - 1, low - 1, -1):
            state = back.step[state + text[at]]
            if state == dead:
                break
            if back.marks[state >> 8]:
                starts.append(at)
        for start in reversed(starts):
            end = _longest(self.forward[number], self._dead[number][0], text, start)
            if end is not None:
                return start, end
        return None

    def _long_enough(self, text: bytes, number: int, start: int, end: int) -> bool:
        least, head = self.rules[number].least, self.heads[number]
        begin = start if head is None else _longest(head, self._dead[number][2], text, start)
        return len(text[begin:end].decode("utf-8", "replace")) >= least


def _headed(rule: Rule) -> tuple[Nfa, int, dict[int, int]]:
    nfa, start, end = _whole(rule.head, rule.any_case)
    return nfa, start, {end: 1}


def _longest(dfa: Dfa, dead: int | None, text: bytes, start: int) -> int | None:
    state, end = dfa.start, None
    for at in range(start, len(text)):
        state = dfa.step[state + text[at]]
        if state == dead:
            break
        if dfa.marks[state >> 8]:
            end = at + 1
    return end

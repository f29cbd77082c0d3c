"""Levenshtein automata of all words of a lexicon, intersected with the lexicon's trie.

A state is the set of (trie node, edits so far) that the letters read allow; states and their moves are made when first
needed and kept, so a word costs one table step per letter, and most words die within a few."""

from __future__ import annotations


def edits_allowed(term: str) -> int:
    """Misspellings grow with length: none below 4 letters, one below 8, then two."""
    return 0 if len(term) < 4 else 1 if len(term) < 8 else 2


class FuzzyLexicon:
    def __init__(self, terms: list[str], max_states: int = 40_000):
        self.terms, self.max_states = terms, max_states
        self.children: list[dict[str, int]] = [{}]
        self.allowed, self.term = [0], [-1]
        for number, term in enumerate(terms):
            node, most = 0, edits_allowed(term)
            self.allowed[0] = max(self.allowed[0], most)
            for letter in term:
                nxt = self.children[node].get(letter)
                if nxt is None:
                    nxt = self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.allowed.append(0)
                    self.term.append(-1)
                node = nxt
                self.allowed[node] = max(self.allowed[node], most)
            self.term[node] = number
        self._reset()

    def _reset(self) -> None:
        self.moves: list[dict[str, int]] = []
        self.accepts: list[tuple[int, int] | None] = []
        self.sets: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.dead = self._state({})
        self.start = self._state({0: 0})

    def _state(self, at: dict[int, int]) -> int:
        """The state of ``at`` (node -> edits), with the nodes reachable by letters left out of the word."""
        todo = list(at.items())
        while todo:
            node, e = todo.pop()
            if at.get(node) != e:
                continue
            for child in self.children[node].values():
                if e + 1 <= self.allowed[child] and at.get(child, 9) > e + 1:
                    at[child] = e + 1
                    todo.append((child, e + 1))
        key = tuple(sorted(at.items()))
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
            ends = [(e, self.term[n]) for n, e in key if self.term[n] >= 0 and e <= edits_allowed(self.terms[self.term[n]])]
            self.accepts.append(min(ends) if ends else None)
        return number

    def _step(self, state: int, letter: str) -> int:
        at: dict[int, int] = {}
        for node, e in self.sets[state]:
            if e + 1 <= self.allowed[node] and at.get(node, 9) > e + 1:
                at[node] = e + 1
            for c, child in self.children[node].items():
                cost = e + (c != letter)
                if cost <= self.allowed[child] and at.get(child, 9) > cost:
                    at[child] = cost
        number = self._state(at)
        self.moves[state][letter] = number
        return number

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, number of the term) of the nearest term within its edits, the first of equals; None without one."""
        if len(self.sets) > self.max_states:
            self._reset()
        state, moves, dead = self.start, self.moves, self.dead
        for letter in word:
            nxt = moves[state].get(letter)
            state = self._step(state, letter) if nxt is None else nxt
            if state == dead:
                return None
        return self.accepts[state]

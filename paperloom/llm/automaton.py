"""A suffix automaton over several word sequences."""


class SuffixAutomaton:
    """States of all substrings of the added sequences.

    `spread[state]` counts the sequences that hold the state's substrings;
    it is kept for states of at least `least` words, which is all that callers ask for.
    """

    def __init__(self, least):
        self.least = least
        self.step = [{}]
        self.link = [-1]
        self.length = [0]
        self.spread = [0]
        self.last_seen = [-1]
        self.sequences = 0

    def _state(self, step, link, length):
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.spread.append(0)
        self.last_seen.append(-1)
        return len(self.step) - 1

    def _split(self, state, word, target):
        """Where `word` leads from `state`, as a state no longer than one word more."""
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(dict(self.step[target]), self.link[target], self.length[state] + 1)
        self.spread[copy], self.last_seen[copy] = self.spread[target], self.last_seen[target]
        self.link[target] = copy
        while state >= 0 and self.step[state].get(word) == target:
            self.step[state][word] = copy
            state = self.link[state]
        return copy

    def _append(self, last, word):
        known = self.step[last].get(word)
        if known is not None:
            return self._split(last, word, known)
        new = self._state({}, 0, self.length[last] + 1)
        state = last
        while state >= 0 and word not in self.step[state]:
            self.step[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, word, self.step[state][word])
        return new

    def add(self, words):
        state = 0
        for word in words:
            state = self._append(state, word)
        state = 0
        for word in words:  # after all splits, so that every state met is final for now
            state = self.step[state][word]
            up = state
            while self.length[up] >= self.least and self.last_seen[up] != self.sequences:
                self.last_seen[up] = self.sequences
                self.spread[up] += 1
                up = self.link[up]
        self.sequences += 1

    def matching_statistics(self, words, shared_by):
        """At each word, the length of the longest match that ends there and stands in
        at least `shared_by` sequences; 0 where that is under `least`."""
        state, matched, found = 0, 0, []
        for word in words:
            while state and word not in self.step[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.step[state]:
                state, matched = self.step[state][word], matched + 1
            up, size = state, matched
            while size >= self.least and self.spread[up] < shared_by:
                up = self.link[up]
                size = self.length[up]
            found.append(size if size >= self.least else 0)
        return found

"""Search for many phrases at once: a trie with failure and output links reads each character of a text once."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator, Sequence

import numpy as np

from attesta.functions.text import IGNORED_MARKS, WHITE_SPACE

_MARKS = re.compile(IGNORED_MARKS)
_BLANKS = np.array([ord(c) for c in WHITE_SPACE], np.uint32)


class Automaton:
    """States are the beginnings of phrases.  A failure link leads to the longest proper ending of a state that is a state too,
    an output link to the longest one that is a whole phrase."""

    def __init__(self, phrases: Iterable[str]):
        self.phrases = [p for p in phrases if p]
        self.step: list[dict[str, int]] = [{}]
        self.whole = [-1]  # number of the phrase that the state spells
        for number, phrase in enumerate(self.phrases):
            at = 0
            for c in phrase:
                at = self.step[at].setdefault(c, len(self.step))
                if at == len(self.step):
                    self.step.append({})
                    self.whole.append(-1)
            self.whole[at] = number
        self.fail, self.output = [0] * len(self.step), [0] * len(self.step)
        waiting = deque(self.step[0].values())
        while waiting:
            at = waiting.popleft()
            for c, child in self.step[at].items():
                waiting.append(child)
                back = self.fail[at]
                while back and c not in self.step[back]:
                    back = self.fail[back]
                back = self.step[back].get(c, 0)
                self.fail[child] = back
                self.output[child] = back if self.whole[back] >= 0 else self.output[back]
        self.ends = [w >= 0 or o > 0 for w, o in zip(self.whole, self.output)]

    def find(self, text: str) -> Iterator[tuple[int, int]]:
        """(start, number of the phrase) of every occurrence, overlapping ones included, by their ends."""
        step, fail, ends, at = self.step, self.fail, self.ends, 0
        for i, c in enumerate(text):
            after = step[at].get(c)
            while after is None and at:
                at = fail[at]
                after = step[at].get(c)
            at = after or 0
            if ends[at]:
                state = at if self.whole[at] >= 0 else self.output[at]
                while state:
                    number = self.whole[state]
                    yield i + 1 - len(self.phrases[number]), number
                    state = self.output[state]


def apart(found: Iterable[tuple[int, int]], phrases: Sequence[str]) -> Iterator[tuple[int, int]]:
    """Of occurrences of one phrase that overlap the leftmost, as a scan from the left meets them."""
    free: dict[int, int] = {}
    for start, number in found:
        if start >= free.get(number, 0):
            free[number] = start + len(phrases[number])
            yield start, number


def kept(text: str) -> tuple[str, np.ndarray]:
    """The text without ignored marks and white space, and where its characters stand."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    stays = ~np.isin(codes, _BLANKS)
    if "<" in text or "〔" in text:
        for mark in _MARKS.finditer(text):
            stays[mark.start() : mark.end()] = False
    return codes[stays].tobytes().decode("utf-32-le", "surrogatepass"), np.flatnonzero(stays)

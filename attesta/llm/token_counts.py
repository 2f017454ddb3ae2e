"""Greedy word-piece counts by a linear longest-match automaton.

The pieces of a vocabulary form a trie.  A node's failure link leads to the node that remains after the longest pieces at
the front of its string were taken off, and the node knows the number of pieces taken off on the way (their number only,
not the pieces).  A word is then read once, character by character; no character is looked at twice and no piece is
built, so the longest word costs no more per character than the shortest.

Words are maximal runs of letters, digits and underscores, or single other visible characters, of the lower-case text; each
is read behind the vocabulary's word mark.  A character that is no piece counts its UTF-8 bytes, as byte fallback does.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from attesta.llm.common import arrow_schema, batch, own, rows_of

MARK = "▁"  # fixed value: the word mark of the vocabulary
_WORD = re.compile(r"\w+|[^\w\s]")
OUT = "doc_id long, n_words long, n_tokens long"
MEMORY = 500_000  # words whose length a task remembers; then it forgets them all
_LOADED: dict[str, Automaton] = {}


class Automaton:
    """Trie over characters with failure links and counts of popped pieces."""

    def __init__(self, pieces: Iterable[str]):
        pieces = {p for p in pieces if p}
        self.step: list[dict[str, int]] = [{}]
        ends: list[int] = [0]  # tokens that the node's own string counts as, if it is a piece
        for piece in sorted(pieces | {c for p in pieces for c in p}):
            at = 0
            for c in piece:
                at = self.step[at].setdefault(c, len(self.step))
                if at == len(self.step):
                    self.step.append({})
                    ends.append(0)
            ends[at] = 1 if piece in pieces else len(piece.encode("utf-8", "replace"))
        self.fail, self.pops = [0] * len(self.step), [0] * len(self.step)
        level = [(0, c, v) for c, v in self.step[0].items()]
        while level:
            for parent, c, at in level:
                if ends[at]:
                    self.fail[at], self.pops[at] = 0, ends[at]
                    continue
                back, popped = self.fail[parent], self.pops[parent]
                while c not in self.step[back]:  # every character of the alphabet leads on from the root
                    popped += self.pops[back]
                    back = self.fail[back]
                self.fail[at], self.pops[at] = self.step[back][c], popped
            level = [(at, c, v) for _, _, at in level for c, v in self.step[at].items()]

    def count(self, word: str) -> int:
        """Greedy longest-match pieces of a word."""
        step, fail, pops, at, total = self.step, self.fail, self.pops, 0, 0
        for c in word:
            while c not in step[at]:
                if not at:
                    total += len(c.encode("utf-8", "replace"))  # no piece has this character
                    break
                total += pops[at]
                at = fail[at]
            else:
                at = step[at][c]
        while at:
            total += pops[at]
            at = fail[at]
        return total


def automaton(path: str) -> Automaton:
    """From a sentencepiece vocabulary file, once per worker; control and byte pieces are left out."""
    if path not in _LOADED:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i)))
        _LOADED[path] = Automaton(model.id_to_piece(i) for i in plain)
    return _LOADED[path]


def count_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per input row: doc_id, words and greedy word pieces of the whole text.

    A null, empty or blank text counts 0 and 0; a null doc_id is passed through; repeated rows count alike; an empty table
    gives no rows.  Further columns are ignored.  ``vocabulary`` is a path that every executor can open.
    """
    schema = arrow_schema(OUT)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto, known = automaton(vocabulary), {}
        for b in batches:
            out = []
            for key, text in rows_of([b]):
                words = _WORD.findall((text or "").lower())
                if len(known) > MEMORY:
                    known.clear()
                for w in set(words):
                    if w not in known:
                        known[w] = auto.count(MARK + w)
                out.append((key, len(words), sum(map(known.__getitem__, words))))
            if out:
                yield batch(schema, list(zip(*out)))

    return own(docs, doc_id="doc_id", text="text").mapInArrow(run, OUT)

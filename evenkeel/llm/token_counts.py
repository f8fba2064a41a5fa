"""Token counts that follow edits without encoding whole texts again.

A document is a segment tree: its leaves are blocks of pre-tokens, and every
node holds the characters and tokens below it. An edit seeks the block it
touches from the root, splits and encodes from a pre-token boundary a little
before the edit until a boundary behind it falls on an old one, and updates the
sums on the way up.

Splitting can restart at a boundary because the pattern looks ahead only: what a
pre-token is depends on its own characters and at most two behind it (an
apostrophe and two letters; a run of blanks and what follows). So pre-tokens that
end two characters before the edit stand, and once a boundary behind the edit is
an old one, all that follow are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from evenkeel.llm.bpe import Encoder
from evenkeel.llm.texts import Shared, blocks, carrying, checked, map_batches, pick

LEAF, REACH = 64, 2


class TokenTree:
    """The pre-tokens of a text under sums of characters and tokens."""

    def __init__(self, text: str, coder: Encoder):
        self.text, self.coder, self.encoded = text, coder, 0
        self.leaves = self._cut(*self._counted([m.group() for m in coder.pattern.finditer(text)]
                                               if len(text) > 1 << 20 else coder.pattern.findall(text)))
        self._build()

    def _counted(self, pieces: list[str]) -> tuple[list[int], list[int]]:
        self.encoded += len(pieces)
        return list(map(len, pieces)), [len(self.coder[p]) >> 2 for p in pieces]

    @staticmethod
    def _cut(chars: list[int], tokens: list[int]) -> list[tuple[list[int], list[int]]]:
        return [(chars[i: i + LEAF], tokens[i: i + LEAF]) for i in range(0, len(chars), LEAF)] or [([], [])]

    def _build(self) -> None:
        chars, tokens = [sum(c) for c, _ in self.leaves], [sum(t) for _, t in self.leaves]
        self.levels = [(chars, tokens)]
        while len(chars) > 1:
            if len(chars) % 2:
                chars.append(0)
                tokens.append(0)
            chars = [x + y for x, y in zip(chars[::2], chars[1::2])]
            tokens = [x + y for x, y in zip(tokens[::2], tokens[1::2])]
            self.levels.append((chars, tokens))

    def _update(self, first: int, last: int) -> None:
        """The sums of some leaves, and those on the ways up from them."""
        chars, tokens = self.levels[0]
        for i in range(first, last + 1):
            chars[i], tokens[i] = sum(self.leaves[i][0]), sum(self.leaves[i][1])
        for (chars, tokens), (c, t) in zip(self.levels, self.levels[1:]):
            first, last = first // 2, last // 2
            for i in range(first, last + 1):
                c[i], t[i] = chars[2 * i] + chars[2 * i + 1], tokens[2 * i] + tokens[2 * i + 1]

    @property
    def tokens(self) -> int:
        return self.levels[-1][1][0]

    def _seek(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and where the leaf begins."""
        node, start = 0, 0
        if place >= self.levels[-1][0][0]:  # no characters are left
            return 0, 0
        for chars, _ in reversed(self.levels[:-1]):
            node *= 2
            if place - start >= chars[node]:
                start += chars[node]
                node += 1
        return min(node, len(self.leaves) - 1), start

    def edit(self, at: int, remove: int, insert: str) -> None:
        """Replace ``remove`` characters from ``at`` on by ``insert``. Places
        beyond the end are the end."""
        at = min(max(at, 0), len(self.text))
        remove = min(max(remove, 0), len(self.text) - at)
        text = self.text[:at] + insert + self.text[at + remove:]
        shift = len(insert) - remove
        leaf, begin = self._seek(max(at - REACH, 0))
        low, keep = begin, 0
        for size in self.leaves[leaf][0]:
            if low + size + REACH > at:
                break
            low, keep = low + size, keep + 1
        # old boundaries from here on, as far as they are needed
        last, index, old = leaf, keep, low
        pieces, new = [], low
        while new < at + len(insert) or old < at + remove or new - shift != old:
            if new - shift <= old and new < len(text) or old >= len(self.text):
                found = self.coder.pattern.match(text, new)
                pieces.append(found.group())
                new = found.end()
            else:
                while index >= len(self.leaves[last][0]):
                    last, index = last + 1, 0
                old += self.leaves[last][0][index]
                index += 1
        chars, tokens = self._counted(pieces)
        first, end = self.leaves[leaf], self.leaves[last]
        chars, tokens = first[0][:keep] + chars + end[0][index:], first[1][:keep] + tokens + end[1][index:]
        self.text = text
        # a leaf may hold twice as much before it is cut; leaves that are left over stay, empty
        merged = [(chars, tokens)] if len(chars) <= 2 * LEAF else self._cut(chars, tokens)
        room = last - leaf + 1
        self.leaves[leaf: last + 1] = merged + [([], [])] * (room - len(merged))
        if len(merged) > room:
            self._build()
        else:
            self._update(leaf, last)


def edited_counts(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, carry: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """Token counts of ``docs`` (text, edits) before and after their edits.

    ``edits`` is an array of (at, remove, insert): one after another, each on
    the text that the one before left, in characters. Returns the ``carry``
    columns, n_tokens, n_edited (tokens after the edits), n_pretokens (encoded
    to build the tree) and n_encoded (encoded for the edits).

    ``pattern`` must match at every place of a text and look ahead only, by two
    characters at most. Null texts are empty; null or empty edits change nothing, nor
    does a null entry; a null ``insert`` is empty, a null number zero; places
    beyond the end are the end. Every row is on its own, repeated ones too.
    """
    checked(carry, {"n_tokens", "n_edited", "n_pretokens", "n_encoded"})
    docs = pick(docs, *dict.fromkeys([*carry, "text", "edits"]))
    shared = Shared(docs.sparkSession, Encoder(ranks, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch, _, _ in blocks(batches):
            facts = np.zeros((batch.num_rows, 4), np.int64)
            for i, (text, edits) in enumerate(zip(batch.column("text").to_pylist(), batch.column("edits").to_pylist())):
                tree = TokenTree(text or "", shared.value)
                facts[i, 0], facts[i, 2] = tree.tokens, tree.encoded
                for e in edits or ():
                    if e is not None:
                        tree.edit(e["at"] or 0, e["remove"] or 0, e["insert"] or "")
                facts[i, 1], facts[i, 3] = tree.tokens, tree.encoded - facts[i, 2]
            yield {c: batch.column(c) for c in carry} | dict(zip(
                ("n_tokens", "n_edited", "n_pretokens", "n_encoded"), facts.T))

    return map_batches(docs, run, carrying(
        docs, carry, "n_tokens long, n_edited long, n_pretokens long, n_encoded long"))

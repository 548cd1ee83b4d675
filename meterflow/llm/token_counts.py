"""Token counts under a unigram model, by dynamic programming that pre-tokens share along a trie.

A pre-token's segmentation is the one with the largest sum of piece scores (the fewest pieces on a
tie); pieces are byte strings of the vocabulary. The best sum and its number of pieces up to a
byte depend only on the bytes before it, so the distinct pre-tokens of a block are put into a trie
and each trie node is computed once: in sorted order, a pre-token keeps the nodes of the prefix it
shares with the one before it and adds nodes for the rest. A node holds the best (sum, pieces) of
its prefix and the pieces that may still continue. The count at a pre-token's last node is stored,
and a text's tokens are the sum over its pre-tokens.

Piece scores come from the vocabulary file: -log of the rank counted from 1, the usual stand-in
for a log probability where a file holds only an order. Null and empty texts have no tokens;
repeated rows give repeated results. A character that UTF-8 cannot hold is replaced first. Texts are
read whole, however long; an empty table gives no rows; other columns are not read, whatever their
names. What a task remembers is bounded in bytes and dropped at its end.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.text import blocks, buffers

#: Bytes that a task remembers pre-tokens in, about; the memory starts anew when it is full.
REMEMBER = 24 << 20
#: What an entry of the memory takes besides its bytes.
_ENTRY = 150


class UnigramCounter:
    def __init__(self, scores: dict[bytes, float], pattern: str):
        """`scores` must cover every single byte."""
        self.pattern = regex.compile(pattern)
        self.scores = scores
        #: piece trie: node -> {byte: node}; score of the piece that ends at a node, or None
        self.next: list[dict[int, int]] = [{}]
        self.ends: list[float | None] = [None]
        for piece, s in scores.items():
            at = 0
            for b in piece:
                if b not in self.next[at]:
                    self.next[at][b] = len(self.next)
                    self.next.append({})
                    self.ends.append(None)
                at = self.next[at][b]
            self.ends[at] = s
        self.known: dict[str, int] = {}
        self.nodes = self.held = 0

    def forget(self) -> None:
        """Drop what has been remembered."""
        self.known, self.held = {}, 0

    def learn(self, pre_tokens: Iterable[str]) -> None:
        """Store the counts of distinct pre-tokens, each trie node computed once."""
        step, ends = self.next, self.ends
        root = step[0]
        before = b""
        # by depth: (sum, -pieces) of the best segmentation, and pieces under way as (start, piece node)
        best: list[tuple[float, int]] = [(0.0, 0)]
        open_: list[list[tuple[tuple[float, int], int]]] = [[]]
        for raw, p in sorted((p.encode("utf-8", "replace"), p) for p in pre_tokens):
            shared, most = 0, min(len(raw), len(before))
            while shared < most and raw[shared] == before[shared]:
                shared += 1
            del best[shared + 1 :], open_[shared + 1 :]
            for b in raw[shared:]:
                top, going = None, []
                for start, node in chain(open_[-1], ((best[-1], 0),)):
                    node = step[node].get(b) if node else root.get(b)
                    if node is None:
                        continue
                    going.append((start, node))
                    s = ends[node]
                    if s is not None:
                        got = (start[0] + s, start[1] - 1)
                        if top is None or got > top:
                            top = got
                best.append(top)
                open_.append(going)
            self.nodes += len(raw) - shared
            self.known[p] = -best[-1][1]
            before = raw

    def count_block(self, texts: list[str]) -> list[int]:
        split = [self.pattern.findall(t) for t in texts]
        distinct = set(chain.from_iterable(split))
        new = distinct.difference(self.known)
        size = lambda pieces: _ENTRY * len(pieces) + sum(map(len, pieces))
        if self.held + size(new) > REMEMBER:
            self.forget()
            new = distinct
        self.held += size(new)
        self.learn(new)
        get = self.known.__getitem__
        return [sum(map(get, pieces)) for pieces in split]


@lru_cache(maxsize=4)
def counter(path: str, pattern: str) -> UnigramCounter:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(x[0]): int(x[1]) for x in map(bytes.split, lines) if len(x) == 2}
    return UnigramCounter({piece: -math.log(rank + 1) for piece, rank in ranks.items()}, pattern)


def count_tokens(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, n_bytes) of every whole text, one row per row of `docs`."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        model = counter(path, pattern)
        try:
            for batch in batches:
                offs, _ = buffers(batch.column("text"))
                for lo, hi in blocks(offs, 1 << 20):
                    part = batch.slice(lo, hi - lo)
                    n = model.count_block([t or "" for t in part.column("text").to_pylist()])
                    size = pa.array(offs[lo + 1 : hi + 1] - offs[lo:hi])
                    yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(n, pa.int64()), size], ["id", "n_tokens", "n_bytes"])
        finally:
            model.forget()  # the worker goes on to other tasks

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_tokens long, n_bytes long").withColumnRenamed("id", id_col)

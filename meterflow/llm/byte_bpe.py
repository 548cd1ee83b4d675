"""Byte-level BPE encoding and decoding with length-bucketed padded numpy matrices.

A text is split by the vocabulary's pattern into pre-tokens. The distinct pre-tokens of a block
that have not been met before are sorted into buckets by length; each bucket is one padded matrix
of byte ids. In every round each row merges its leftmost pair of minimum rank: ranks come from a
hashed table of pairs, the merged id replaces the pair, and the row is compacted by one place.
Rows without a mergeable pair leave the matrix. Pre-tokens longer than `LONG` bytes, where a
matrix would need as many rounds as bytes, go through a heap that makes the same merges.

Null texts are empty texts and have no ids. Repeated rows give repeated results; other columns of
the table do not matter. A lone invalid character is encoded as UTF-8 replaces it. An empty table
gives no rows. What a task remembers is bounded in bytes and dropped at its end.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.text import blocks, buffers

#: Pre-tokens of more bytes than this are merged with a heap.
LONG = 256
#: Bytes that a task remembers pre-tokens in, about; the memory starts anew when it is full.
REMEMBER = 24 << 20
#: What an entry of the memory takes besides four times its bytes.
_ENTRY = 200
_NONE = np.int32(2**31 - 1)


class PairTable:
    """Open-addressing hash table from a pair of ids to the id (= rank) of their merge."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[(a << 32) | b] = rank
        self._pairs: dict[int, int] = {}
        keys = np.fromiter(pairs.keys(), np.uint64, len(pairs))
        vals = np.fromiter(pairs.values(), np.int32, len(pairs))
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        size = 1 << self.bits
        self.keys = np.full(size, np.uint64(2**64 - 1))
        self.vals = np.full(size, _NONE, np.int32)
        slot, todo = self._slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(todo):
            self.probes += 1
            free = self.keys[slot[todo]] == np.uint64(2**64 - 1)
            want, at = todo[free], slot[todo[free]]
            first = np.unique(at, return_index=True)[1]
            self.keys[at[first]] = keys[want[first]]
            self.vals[at[first]] = vals[want[first]]
            todo = todo[self.keys[slot[todo]] != keys[todo]]
            slot[todo] = (slot[todo] + 1) & (size - 1)

    @property
    def pairs(self) -> dict[int, int]:
        """The same table as a dictionary, made when a long piece first needs it."""
        if not self._pairs:
            used = self.keys != np.uint64(2**64 - 1)
            self._pairs = dict(zip(self.keys[used].tolist(), self.vals[used].tolist()))
        return self._pairs

    def forget(self) -> None:
        self._pairs = {}

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, or the largest int32. A negative id stands for padding."""
        keys = (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)
        slot = self._slot(keys)
        out = np.where(self.keys[slot] == keys, self.vals[slot], _NONE)
        todo = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] != np.uint64(2**64 - 1)))
        for _ in range(self.probes - 1):
            if not len(todo):
                break
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            hit = self.keys[slot[todo]] == keys[todo]
            out[todo[hit]] = self.vals[slot[todo[hit]]]
            todo = todo[~hit & (self.keys[slot[todo]] != np.uint64(2**64 - 1))]
        out[(a < 0) | (b < 0)] = _NONE
        return out


class Codec:
    """Encoder and decoder for one rank file (lines of base64 token and rank) and split pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(x[0]): int(x[1]) for x in map(bytes.split, lines) if len(x) == 2}
        self.pattern = regex.compile(pattern)
        self.table = PairTable(ranks)
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.byte_id = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        #: one number per id, shared by all that is remembered
        self.ids = list(range(len(self.bytes)))
        self.forget()

    def forget(self) -> None:
        """Drop what has been remembered."""
        self.known: dict[str, tuple[int, ...]] = {}
        self.held = 0
        self.table.forget()

    def merge_matrix(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of pieces of similar length, all rows of one padded matrix."""
        out: list[tuple[int, ...]] = [()] * len(pieces)
        same = self.ids
        size = np.array([len(x) for x in pieces])
        width = int(size.max())
        ids = np.full((len(pieces), width), -1, np.int32)
        ids[np.arange(width) < size[:, None]] = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        rows = np.arange(len(pieces))
        ranks = self.table.ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(pieces), width - 1)
        while len(rows):
            if ranks.shape[1] == 0:
                best, least = np.zeros(len(rows), np.int64), np.full(len(rows), _NONE, np.int32)
            else:
                best = ranks.argmin(1)
                least = ranks[np.arange(len(rows)), best]
            done = least == _NONE
            if done.any():
                for r, x in zip(rows[done].tolist(), ids[done].tolist()):
                    out[r] = tuple(same[i] for i in x if i >= 0)
                keep = ~done
                rows, ids, ranks, best, least = rows[keep], ids[keep], ranks[keep], best[keep], least[keep]
                if not len(rows):
                    break
            at = np.arange(len(rows))
            ids[at, best] = least
            stay = np.ones(ids.shape, bool)
            stay[at, best + 1] = False
            ids = ids[stay].reshape(len(rows), -1)
            stay = np.ones(ranks.shape, bool)
            stay[at, best] = False
            ranks = ranks[stay].reshape(len(rows), -1)
            right = np.flatnonzero(best < ranks.shape[1])
            ranks[right, best[right]] = self.table.ranks(ids[right, best[right]], ids[right, best[right] + 1])
            left = np.flatnonzero(best > 0)
            ranks[left, best[left] - 1] = self.table.ranks(ids[left, best[left] - 1], ids[left, best[left]])
        return out

    def merge_heap(self, piece: bytes) -> tuple[int, ...]:
        """The same merges for one long piece, in time n log n."""
        ids = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        n, pairs = len(ids), self.table.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := pairs.get((ids[i] << 32) | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or pairs.get((ids[i] << 32) | ids[j]) != r:
                continue
            ids[i], ids[j] = r, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (x := pairs.get((r << 32) | ids[k])) is not None:
                    heapq.heappush(heap, (x, i))
            if (h := before[i]) >= 0 and (x := pairs.get((ids[h] << 32) | r)) is not None:
                heapq.heappush(heap, (x, h))
        return tuple(i for i in ids if i >= 0)

    def learn(self, pieces: set[str]) -> None:
        """Encode pre-tokens that are not remembered yet."""
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for p in pieces:
            raw = p.encode("utf-8", "replace")
            if len(raw) == 1:
                self.known[p] = (int(self.byte_id[raw[0]]),)
            elif len(raw) > LONG:
                self.known[p] = self.merge_heap(raw)
            else:
                # buckets 2, 3, 4, 6, 8, 12, 16, ...: at most a third of a row is padding
                top = 1 << (len(raw) - 1).bit_length()
                buckets.setdefault(top * 3 // 4 if len(raw) <= top * 3 // 4 else top, []).append((p, raw))
        for width, bucket in buckets.items():
            step = max(1, (1 << 20) // width)
            for i in range(0, len(bucket), step):
                part = bucket[i : i + step]
                self.known.update(zip((p for p, _ in part), self.merge_matrix([raw for _, raw in part])))

    def encode_block(self, texts: list[str]) -> Iterator[list[int]]:
        split = [self.pattern.findall(t) for t in texts]
        new = set().union(*split).difference(self.known)
        size = lambda pieces: _ENTRY * len(pieces) + 4 * sum(map(len, pieces))
        if self.held + size(new) > REMEMBER:
            self.forget()
            new = set().union(*split)
        self.held += size(new)
        self.learn(new)
        get = self.known.__getitem__
        for pieces in split:
            yield list(chain.from_iterable(map(get, pieces)))

    def encode(self, text: str) -> list[int]:
        return next(self.encode_block([text]))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _texts(batches, path: str, pattern: str):
    """(row range of a batch, texts, codec) by blocks of bounded size."""
    coder = codec(path, pattern)
    try:
        for batch in batches:
            offs, _ = buffers(batch.column("text"))
            for lo, hi in blocks(offs, 1 << 20):
                part = batch.slice(lo, hi - lo)
                yield part, [t or "" for t in part.column("text").to_pylist()], coder
    finally:
        coder.forget()  # the worker goes on to other tasks


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids array<int>): the token ids of every text."""
    kind = docs.schema[id_col].dataType

    def run(batches):
        for part, texts, coder in _texts(batches, path, pattern):
            ids = pa.array(list(coder.encode_block(texts)), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column("id"), ids], ["id", "ids"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind.simpleString()}, ids array<int>").withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, path: str, pattern: str, ids_col: str = "ids", out: str = "bytes") -> DataFrame:
    """`tokens` with a binary column `out`: the bytes that the ids stand for (null ids: no bytes)."""

    def run(batches):
        coder = codec(path, pattern)
        for batch in batches:
            got = [coder.decode(x or []) for x in batch.column(ids_col).to_pylist()]
            yield batch.append_column(out, pa.array(got, pa.binary()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema)
    return tokens.mapInArrow(run, f"{fields}, `{out}` binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256) of every whole text.

    Encoding and decoding happen in one pass over the batches, so that the ids of a text, several
    times its size, never leave the task. ids_sha256 is of the decimal ids joined by commas.
    """
    kind = docs.schema[id_col].dataType

    def run(batches):
        for part, texts, coder in _texts(batches, path, pattern):
            n, ids_sha, decoded_sha = [], [], []
            for ids in coder.encode_block(texts):
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(str(ids)[1:-1].replace(" ", "").encode()).hexdigest())
                decoded_sha.append(hashlib.sha256(coder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(decoded_sha)],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(run, f"id {kind.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)

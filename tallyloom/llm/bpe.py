"""Byte-level BPE encoding and decoding with merges done on padded numpy matrices.

Distinct pieces of text are put into matrices of similar length, one piece a row and one byte
a column. In each round every row merges its leftmost pair of minimum rank. The rank of a pair
comes from a hash table over all pairs of the vocabulary. Merged-away columns are skipped by
links and squeezed out when half of a matrix is empty, so a piece of n bytes costs n rounds
over a shrinking row, whatever its length.
"""

from __future__ import annotations

import base64
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import Memory, Shipped, col, slices

NO_RANK = np.int32(2**31 - 1)
# Most pieces whose ids a worker remembers.
REMEMBERED = 500_000
# Bytes of text, or of ids, that are split at a time.
SLICE = 2 << 20
# Cells of one matrix.
CELLS = 1 << 20


class PairTable:
    """Ranks of pairs of ids in an open-addressing hash table of numpy arrays."""

    EMPTY = -1
    MIX = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, pairs: dict[tuple[int, int], int]):
        bits = max(4, (2 * len(pairs)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.full(1 << bits, self.EMPTY, np.int64)
        self.ranks = np.full(1 << bits, NO_RANK, np.int32)
        if not pairs:
            return
        left, right = np.array(list(pairs), np.int64).T
        keys, ranks = left << 32 | right, np.fromiter(pairs.values(), np.int32, len(pairs))
        slot = self._slot(keys)
        while len(keys):  # each round seats one key per free slot; the others move on
            free = self.keys[slot] == self.EMPTY
            self.keys[slot[free]] = keys[free]
            seated = self.keys[slot] == keys
            self.ranks[slot[seated]] = ranks[seated]
            keys, ranks, slot = keys[~seated], ranks[~seated], (slot[~seated] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * self.MIX) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; NO_RANK where it does not merge or a side is -1."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        keys[(left < 0) | (right < 0)] = -2
        out = np.full(keys.shape, NO_RANK, np.int32)
        at, slot = np.flatnonzero(keys != -2), None
        slot = self._slot(keys[at])
        while len(at):
            held = self.keys[slot]
            hit = held == keys[at]
            out[at[hit]] = self.ranks[slot[hit]]
            on = ~hit & (held != self.EMPTY)
            at, slot = at[on], (slot[on] + 1) & self.mask
        return out


class Codec:
    """Encodes and decodes with the ranks of a file of base64 tokens and ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_of[i] = token
        self.byte_ids = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        if (self.byte_ids < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        self.pairs = PairTable({
            (ranks[t[:k]], ranks[t[k:]]): i for t, i in ranks.items()
            for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks})
        self.known = Memory(REMEMBERED)

    def merged(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of every piece, as repeated merging gives them."""
        out: list[np.ndarray] = [None] * len(pieces)
        order = sorted(range(len(pieces)), key=lambda i: len(pieces[i]))
        while order:
            width = max(len(pieces[order[0]]) * 3 // 2, 8)
            rows = [i for i in order[: max(1, CELLS // width)] if len(pieces[i]) <= width]
            order = order[len(rows):]
            for i, ids in zip(rows, self._merge_rows([pieces[i] for i in rows])):
                out[i] = ids
        return out

    def _merge_rows(self, rows: list[bytes]) -> list[np.ndarray]:
        lengths = np.array([len(r) for r in rows])
        width = int(lengths.max())
        # the last column stands for "no neighbour" and never merges
        ids = np.full((len(rows), width + 1), -1, np.int32)
        ids[np.arange(width + 1) < lengths[:, None]] = self.byte_ids[
            np.frombuffer(b"".join(rows), np.uint8)]
        result: list[np.ndarray] = [None] * len(rows)
        place = np.arange(len(rows))
        ranks = np.full(ids.shape, NO_RANK, np.int32)
        ranks[:, :-1] = self.pairs.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(
            len(rows), width)
        while len(place):
            after, before = self._links(ids)
            rounds = 0
            while True:
                best = ranks.argmin(axis=1)
                rank = ranks[np.arange(len(place)), best]
                live = np.flatnonzero(rank != NO_RANK)
                if 2 * len(live) <= len(place) or rounds > ids.shape[1] // 2:
                    break
                rounds += 1
                at, new = best[live], rank[live]
                gone = after[live, at]
                right, left = after[live, gone], before[live, at]
                ids[live, at], ids[live, gone] = new, -1
                after[live, at], before[live, right] = right, at
                ranks[live, gone] = NO_RANK
                ranks[live, at] = self.pairs.rank(new, ids[live, right])
                ranks[live, left] = self.pairs.rank(ids[live, left], new)
            for r in np.flatnonzero(rank == NO_RANK):
                result[place[r]] = ids[r][ids[r] >= 0]
            place, ids, ranks = place[live], ids[live], ranks[live]
            if len(place):  # squeeze out what is gone
                order = np.argsort(ids < 0, axis=1, kind="stable")
                keep = int((ids >= 0).sum(axis=1).max())
                ids = np.take_along_axis(ids, order, 1)[:, : keep + 1]
                ranks = np.take_along_axis(ranks, order, 1)[:, : keep + 1]
                if ids.shape[1] == keep:
                    ids = np.pad(ids, ((0, 0), (0, 1)), constant_values=-1)
                    ranks = np.pad(ranks, ((0, 0), (0, 1)), constant_values=NO_RANK)
        return result

    @staticmethod
    def _links(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        none = ids.shape[1] - 1
        after = np.broadcast_to(np.minimum(np.arange(none + 1) + 1, none), ids.shape).astype(np.int32)
        before = np.broadcast_to(np.arange(none + 1) - 1, ids.shape).astype(np.int32)
        before[:, 0] = none
        return after, before

    def encode(self, documents: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        split = [self.pattern.findall(d) for d in documents]
        new = self.known.missing(set(chain.from_iterable(split)))
        known, open_ = self.known.young, []
        for p in new:
            whole = self.ranks.get(raw := p.encode())
            if whole is None:
                open_.append((p, raw))
            else:
                known[p] = whole.to_bytes(4, "little")
        for (p, _), ids in zip(open_, self.merged([raw for _, raw in open_])):
            known[p] = ids.astype("<u4").tobytes()
        return [b"".join(map(known.__getitem__, pieces)) for pieces in split]

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(t): int(i) for t, i in map(bytes.split, data.splitlines())}


class _Make:
    """Builds a codec in a worker; equal patterns share one."""

    def __init__(self, pattern: str):
        self.pattern = pattern

    def __call__(self, data: bytes) -> Codec:
        return Codec(read_ranks(data), self.pattern)

    def __eq__(self, other):
        return type(other) is _Make and other.pattern == self.pattern

    def __hash__(self):
        return hash(self.pattern)


def encode(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """doc_id, n_tokens and ids (binary: little-endian unsigned 32-bit integers) of each row.

    A null or empty text has no tokens. A piece that is itself a token is that token. Repeated
    rows are encoded one by one; other columns are not looked at. Nothing is shuffled. A worker
    holds one slice of texts and a bounded memory of pieces.
    """
    codec = Shipped(docs.sparkSession, ranks_path, _Make(pattern))

    def run(batches):
        for part in slices(batches, most=SLICE):
            packed = codec.get().encode(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(p) // 4 for p in packed], pa.int64()),
                 pa.array(packed, pa.binary())], names=["doc_id", "n_tokens", "ids"])

    plain = docs.select(col(doc_id).cast("long").alias("doc_id"),
                        F.coalesce(col(text).cast("string"), F.lit("")).alias("text"))
    return plain.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """The rows with the bytes that their packed ids stand for, as ``decoded`` (binary).

    Null ids decode to null. A column already named ``decoded`` is replaced.
    """
    codec = Shipped(encoded.sparkSession, ranks_path, _Make(r"\X"))
    rest = [c for c in encoded.columns if c != "decoded"]
    schema = encoded.select(*map(col, rest)).schema.add("decoded", "binary")

    def run(batches):
        for part in slices(batches, ids, SLICE):
            c = codec.get()
            done = [None if p is None else c.decode(p) for p in part.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(done, pa.binary())], names=[*rest, "decoded"])

    return encoded.select(*map(col, rest)).mapInArrow(run, schema)

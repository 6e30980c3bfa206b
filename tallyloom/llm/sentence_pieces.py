"""SentencePiece BPE encoding and decoding with a prefix table.

Merging is deterministic (best score first, leftmost on a tie), and merges inside a part of a text
go on as if the rest were not there. Hence a row of pieces is the encoding of its text exactly
when each piece encodes to itself and each two neighbours encode to themselves together. So every
prefix has one last piece: the one that ends there, whose predecessor is the last piece of what is
left, and that is compatible with it. An automaton finds the pieces that end at each place, the
table of last pieces is filled from left to right, and the ids are read backwards.

A text is cut first wherever two neighbouring characters stand together in no piece: no merge can
cross there. What lies between recurs (words, mostly), so each distinct part is encoded once.
"""

from __future__ import annotations

import struct

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import Memory, Shipped, col, slices

SPACE = "▁"        # stands for a blank inside pieces
SLICE = 1 << 20         # text bytes worked on together
KNOWN = 200_000         # parts of texts remembered by a worker
TESTED = 400_000        # neighbours whose compatibility a worker remembers
REPLACEMENT = "�"  # decoded from a byte that is not part of a character

# Kinds of pieces and the fields of the model file, fixed values of its format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
PIECES, TRAINER, NORMALIZER = 1, 2, 3
MODEL_TYPE, SPACE_AS_SUFFIX, BPE = 3, 24, 2
CHARSMAP, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES = 2, 3, 4, 5


def _fields(data: bytes) -> dict[int, list]:
    """The fields of one message: numbers, floats and byte strings by field number."""
    out: dict[int, list] = {}
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        elif kind == 2:
            n = varint()
            value, at = data[at:at + n], at + n
        else:
            form, n = ("<f", 4) if kind == 5 else ("<d", 8)
            value, at = struct.unpack(form, data[at:at + n])[0], at + n
        out.setdefault(key >> 3, []).append(value)
    return out


class Codec:
    """A model file's pieces, ready to encode and decode Arrow arrays.

    Supported are BPE models that leave characters as they are, escape blanks, keep repeated ones
    and fall back to bytes, without pieces defined by a user or unused. Others are refused.
    """

    def __init__(self, data: bytes):
        model = _fields(data)
        trainer = _fields(model.get(TRAINER, [b""])[0])
        normal = _fields(model.get(NORMALIZER, [b""])[0])
        entries = [_fields(p) for p in model.get(PIECES, [])]
        kinds = [e.get(3, [NORMAL])[0] for e in entries]
        names = [e[1][0].decode() for e in entries]
        if (trainer.get(MODEL_TYPE) != [BPE] or normal.get(CHARSMAP, [b""])[0]
                or trainer.get(SPACE_AS_SUFFIX, [0])[0]
                or normal.get(REMOVE_SPACES, [1])[0] or not normal.get(ESCAPE_SPACES, [1])[0]
                or {USER, UNUSED} & set(kinds) or kinds.count(BYTE) != 256):
            raise ValueError("not a BPE model without rewriting and with byte fallback")
        self.prefix = bool(normal.get(DUMMY_PREFIX, [1])[0])
        self.kinds = np.array(kinds, np.int8)
        self.ids = {p: i for i, (p, k) in enumerate(zip(names, kinds)) if k == NORMAL}
        self.score = {p: entries[i].get(2, [0.0])[0] for p, i in self.ids.items()}
        self.byte_id = {int(p[1:-1], 16): i for i, (p, k) in enumerate(zip(names, kinds)) if k == BYTE}
        self.begin, self.end = names.index("<s>"), names.index("</s>")
        surfaces = [p.replace(SPACE, " ").encode() if k == NORMAL else b"" if k == CONTROL
                    else bytes([int(p[1:-1], 16)]) if k == BYTE else " ⁇ ".encode()
                    for p, k in zip(names, kinds)]
        self.surfaces = pa.array(surfaces, pa.large_binary())
        self.spaced = np.array([k == NORMAL and p.startswith(SPACE) for p, k in zip(names, kinds)])

        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        self.alone: dict[str, bool] = {}
        self.tested: dict[tuple[str, str], bool] = {}
        self.known = Memory(KNOWN)

        # which characters stand side by side in some piece; class 0 stands in none
        chars = sorted({c for p in self.ids for c in p})
        self.kind_of = np.zeros(0x110000, np.int32)
        self.kind_of[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.together = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        pairs = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        for a, b in pairs:
            self.together[self.kind_of[ord(a)], self.kind_of[ord(b)]] = True

    # -- one part of a text --------------------------------------------------------------------
    def _merges_across(self, text: str, border: int) -> bool:
        """Whether merging the text joins anything across the border, or leaves a side in parts."""
        at = list(range(len(text) + 1))  # where symbols begin, and the end
        score = self.score.get
        while True:
            best, where = None, 0
            for i in range(len(at) - 2):
                s = score(text[at[i]:at[i + 2]])
                if s is not None and (best is None or s > best):
                    best, where = s, i + 1
            if best is None:
                return len(at) != (3 if border else 2)
            if at[where] == border:
                return True
            del at[where]

    def _is_alone(self, piece: str) -> bool:
        known = self.alone.get(piece)
        if known is None:
            known = self.alone[piece] = not self._merges_across(piece, 0)
        return known

    def _fits(self, left: str, right: str) -> bool:
        known = self.tested.get((left, right))
        if known is None:
            if len(self.tested) >= TESTED:
                self.tested.clear()
            known = self.tested[left, right] = not self._merges_across(left + right, len(left))
        return known

    def encode_part(self, part: str) -> list[int]:
        """Ids of a text by the table of last pieces; time goes with its length."""
        last: list[str | None] = [None] * (len(part) + 1)
        for end, piece in self.automaton.iter(part):
            at = end + 1
            if last[at] is None:
                start = at - len(piece)
                if self._is_alone(piece) and (not start or (
                        last[start] is not None and self._fits(last[start], piece))):
                    last[at] = piece
            # a character that is no piece ends no match; it is in no piece either
        ids: list[int] = []
        at = len(part)
        while at:
            piece = last[at]
            if piece is None:
                piece = part[at - 1]
                ids.extend(self.byte_id[b] for b in reversed(piece.encode()))
            else:
                ids.append(self.ids[piece])
            at -= len(piece)
        return ids[::-1]

    # -- batches -------------------------------------------------------------------------------
    def parts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All parts of all texts in a row, and how many of them each text has."""
        mark = SPACE if self.prefix else ""
        escaped = [mark + t.replace(" ", SPACE) if t else "" for t in texts.to_pylist()]
        joined = "".join(escaped)
        raw = joined.encode()
        chars = np.cumsum([len(t) for t in escaped])
        data = np.frombuffer(raw, np.uint8)
        kinds = self.kind_of[np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
        cut = np.ones(len(kinds), bool)
        cut[1:] = ~self.together[kinds[:-1], kinds[1:]]
        starts = np.flatnonzero(data & 0xC0 != 0x80)
        cut[np.concatenate([[0], chars])[:-1][np.diff(chars, prepend=0) > 0]] = True
        ends = np.append(starts, len(data))[chars] if len(chars) else chars
        starts = starts[cut]
        parts = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int64)),
            pa.py_buffer(raw))
        upto = np.searchsorted(starts, ends)
        return parts, np.diff(upto, prepend=0)

    def encode(self, texts: pa.Array) -> pa.Array:
        """Packed ids of each text (little-endian unsigned 32-bit), begin and end included."""
        parts, counts = self.parts(texts)
        coded = parts.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        for p in self.known.missing(distinct):
            self.known.young[p] = np.array(self.encode_part(p), "<u4").tobytes()
        packed = pa.array([self.known.young[p] for p in distinct], pa.large_binary())
        every = packed.take(coded.indices)
        sizes = pc.binary_length(every).to_numpy()
        upto = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
        flat = every.buffers()[2] or pa.py_buffer(b"")
        ids = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(texts), [None, pa.py_buffer(upto.astype(np.int64)), flat])
        begin, end, nothing = (pa.scalar(b, pa.large_binary()) for b in (
            self.begin.to_bytes(4, "little"), self.end.to_bytes(4, "little"), b""))
        return pc.binary_join_element_wise(begin, ids, end, nothing).cast(pa.binary())

    def decode(self, packed: pa.Array) -> pa.Array:
        """The text that each row of packed ids stands for."""
        return pa.array([None if p is None else self._decoded(np.frombuffer(p, "<u4"))
                         for p in packed.to_pylist()], pa.string())

    def _decoded(self, ids: np.ndarray) -> str:
        kinds = self.kinds[ids]
        inside = np.flatnonzero(kinds != CONTROL)
        if not len(inside):
            return ""
        taken = self.surfaces.take(pa.array(ids))
        raw = bytes(taken.buffers()[2])
        skip = int(self.prefix and self.spaced[ids[inside[0]]])
        if inside[-1] - inside[0] + 1 == len(inside):  # else a control id may part two bytes
            try:
                return raw[skip:].decode()
            except UnicodeDecodeError:
                pass
        out, run = [], bytearray()
        for i, kind in zip(ids.tolist(), kinds.tolist()):
            if kind == BYTE:
                run += self.surfaces[i].as_py()
                continue
            out.append(_lenient(run))
            run.clear()
            out.append(self.surfaces[i].as_py().decode())
        out.append(_lenient(run))
        return "".join(out)[skip:]


def _lenient(run: bytearray) -> str:
    """Characters of a run of bytes; a byte that begins none is replaced."""
    out, at = [], 0
    while at < len(run):
        for n in (1, 2, 3, 4):
            try:
                out.append(run[at:at + n].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            n = 1
            out.append(REPLACEMENT)
        at += n
    return "".join(out)


def encode(docs: DataFrame, model_path: str, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """doc_id, n_tokens and ids (binary: little-endian unsigned 32-bit) of each row, with begin
    and end ids.

    A null or empty text has just those two. Repeated rows are encoded one by one; other columns
    are not looked at; a null id stays null; an empty table gives no rows. Nothing is shuffled. A
    worker holds one slice of texts (a longer text is a slice of its own) and bounded memories of
    parts and of tested neighbours.
    """
    codec = Shipped(docs.sparkSession, model_path, Codec)

    def run(batches):
        for part in slices(batches, most=SLICE):
            ids = codec.get().encode(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pc.divide(pc.binary_length(ids).cast(pa.int64()), 4), ids],
                names=["doc_id", "n_tokens", "ids"])

    plain = docs.select(col(doc_id).cast("long").alias("doc_id"),
                        F.coalesce(col(text).cast("string"), F.lit("")).alias("text"))
    return plain.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, model_path: str, ids: str = "ids") -> DataFrame:
    """The rows with the text that their packed ids stand for, as ``decoded``.

    Null ids decode to null, no ids to ''. A byte that is part of no character becomes U+FFFD. A
    column already named ``decoded`` is replaced.
    """
    codec = Shipped(encoded.sparkSession, model_path, Codec)
    rest = [c for c in encoded.columns if c != "decoded"]
    schema = encoded.select(*map(col, rest)).schema.add("decoded", "string")

    def run(batches):
        for part in slices(batches, ids, SLICE):
            yield pa.RecordBatch.from_arrays(
                [*part.columns, codec.get().decode(part.column(ids))], names=[*rest, "decoded"])

    return encoded.select(*map(col, rest)).mapInArrow(run, schema)

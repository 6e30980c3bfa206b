"""Vector bin packing of examples into training sequences.

An example (or a piece of one) asks for tokens, one segment and loss-bearing tokens; a sequence
has a capacity for each. The open sequence takes, among the waiting pieces that fit, the one
whose demands have the largest dot product with what is left of its capacities (both as shares
of the capacity), which is the one that uses the scarce room best. When none fits and room is
left, the best-aligned piece is cut. A sequence that another limit ends early is cut back to a
power of two of tokens, so neither kind has padding; what is cut off waits for the next.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import Memory, Shipped, col, slices, split_words

TOKENS, SEGMENTS = 4096, 512
# Examples that are packed together; a block is a bounded piece of one task's rows.
BLOCK = 1024
# Text bytes of a block that are tokenized at a time.
PIECE_BYTES = 2 << 20
SCHEMA = ("doc_id long, start long, length long, ids binary, loss_tokens long, "
          "doc_tokens long, sequence_id long, offset long")


def pack(lengths: np.ndarray, prompts: np.ndarray, tokens: int = TOKENS,
         segments: int = SEGMENTS, loss: int = TOKENS) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (example, start, length); every token is in exactly one piece.

    ``prompts`` is how many first tokens of an example bear no loss. An example without tokens
    has no piece.
    """
    start = np.zeros(len(lengths), np.int64)
    left = lengths.astype(np.int64).copy()
    loss_before = lambda i, at: np.maximum(at - prompts[i], 0)
    need = loss_before(np.arange(len(lengths)), lengths)
    sequences, waiting = [], int((left > 0).sum())
    whole = np.array([tokens, segments, loss], float)
    while waiting:
        room = whole.copy()
        taken: list[tuple[int, int, int]] = []
        while room[0] > 0 and room[1] > 0 and waiting:
            fits = (left > 0) & (left <= room[0]) & (need <= room[2])
            some = fits.any()
            share = room / whole
            score = np.minimum(left, tokens) / tokens * share[0] + share[1] / segments + (
                np.minimum(need, loss) / loss * share[2])
            i = int(np.where(fits if some else left > 0, score, -1.0).argmax())
            n = int(min(left[i], room[0]))
            if not some:  # cut the piece to what is left of tokens and loss-bearing tokens
                free = max(int(prompts[i]) - int(start[i]), 0)
                n = min(n, free + int(room[2]))
                if n <= 0:
                    break
            bears = int(loss_before(i, start[i] + n) - loss_before(i, start[i]))
            taken.append((i, int(start[i]), n))
            start[i] += n
            left[i] -= n
            need[i] -= bears
            waiting -= left[i] == 0
            room -= (n, 1, bears)
        total = sum(n for _, _, n in taken)
        over = 0 if total == tokens else total - (1 << (total.bit_length() - 1))
        while over:
            i, at, n = taken.pop()
            back = min(n, over)
            over -= back
            waiting += left[i] == 0
            start[i] -= back
            left[i] += back
            need[i] += int(loss_before(i, start[i] + back) - loss_before(i, start[i]))
            if n > back:
                taken.append((i, at, n - back))
        sequences.append(taken)
    return sequences


class WordTokens:
    """Ids of texts by a tokenizer that folds case and never looks beyond white space.

    Each distinct word is tokenized once and remembered, up to a bound. A full stop or comma
    between a word and white space is a word of its own for this tokenizer.
    """

    REMEMBERED = 1_000_000
    FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    STOPS, LETTERS = (np.isin(np.arange(256), list(of)) for of in (
        b".,", b"abcdefghijklmnopqrstuvwxyz0123456789"))

    def __init__(self, data: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(data.decode())
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known = Memory(self.REMEMBERED)

    def _words(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        # a text with "<|" may spell a special token, which is not folded: only cut at white space
        raws = [t.encode() for t in texts]
        plain = np.array([b"<|" not in r for r in raws], bool)

        def stops(data, space, begins):
            mask = np.zeros(len(data), bool)
            stop = self.STOPS[data[1:-1]] & self.LETTERS[data[:-2]] & space[2:]
            stop &= ~begins[1:-2] & ~begins[2:-1]
            if not plain.all():
                stop &= np.repeat(plain, [len(r) for r in raws])[1:-1]
            mask[1:-1] = stop
            return mask

        return split_words([r.translate(self.FOLD) if p else r for r, p in zip(raws, plain)], stops)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[bytes]) -> None:
        plain, other = [], []
        for w in words:
            (plain if w.isalpha() or w.decode().isalpha() else other).append(w)
        for at in range(0, len(plain), 500):  # a word of letters is one unit, ended by an id
            some = plain[at:at + 500]
            ids = np.array(self._ids([b" ".join(some).decode()])[0], "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(some):  # normal form made marks of letters
                other.extend(some)
                continue
            raw, starts = ids.tobytes(), [0, *(4 * ends).tolist()]
            self.known.young.update(
                (w, raw[a:b]) for w, a, b in zip(some, starts, starts[1:]))
        for at in range(0, len(other), 20_000):
            some = other[at:at + 20_000]
            for w, ids in zip(some, self._ids([w.decode() for w in some])):
                self.known.young[w] = np.array(ids, "<u4").tobytes()

    def packed(self, texts: list[str], end: bytes) -> list[bytes]:
        """Little-endian ids of each text, then ``end``."""
        words, counts = self._words(texts)
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self._learn(self.known.missing(distinct))
        known = self.known.young
        every = pa.array([known[w] for w in distinct], pa.large_binary()).take(coded.indices)
        upto = np.concatenate([[0], np.cumsum(pc.binary_length(every).to_numpy())])[np.cumsum(counts)]
        raw = (every.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
        return [raw[a:b] + end for a, b in zip([0, *upto.tolist()], upto.tolist())]


def _packed(tokenizer, block: pa.RecordBatch, end: bytes) -> list[bytes]:
    """``tokenizer.packed`` of the texts of a block, in pieces: memory holds the words of one."""
    return [ids for piece in slices([block], most=PIECE_BYTES)
            for ids in tokenizer.packed(piece.column("text").to_pylist(), end)]


def pack_documents(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id",
                   text: str = "text", prompt_chars: str | None = None, *, end_id: int = 2,
                   tokens: int = TOKENS, segments: int = SEGMENTS,
                   loss: int = TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary, little-endian unsigned 32-bit),
    loss_tokens, doc_tokens, sequence_id, offset.

    A document is the tokenizer's ids without special tokens, then ``end_id``; null is the empty
    text, whose only id is ``end_id``. ``prompt_chars`` names a column with the number of
    leading characters that bear no loss (null: none), as in instruction data. Sequences hold at
    most ``tokens`` tokens, ``segments`` pieces and ``loss`` loss-bearing tokens; they are full
    or have a power of two of tokens. Pieces lie in a sequence without gaps.

    Rows are packed block by block where they are read: nothing is shuffled, and memory holds one
    block. A sequence id is the number of the task and of the sequence in it. A task that runs
    again reads the same rows in the same order and gives the same answer. Repeated rows are
    packed one by one under the same id; an empty table has no pieces.
    """
    words = Shipped(docs.sparkSession, tokenizer_path, WordTokens)
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        tokenizer, sequence = words.get(), TaskContext.get().partitionId() << 40
        for part in slices(batches):
            for at in range(0, part.num_rows, BLOCK):
                block = part.slice(at, BLOCK)
                ids, body = block.column("doc_id").to_pylist(), block.column("text").to_pylist()
                packed = _packed(tokenizer, block, end)
                n = np.array([len(p) // 4 for p in packed], np.int64)
                prompts = np.zeros(len(ids), np.int64)
                for i, chars in enumerate(block.column("prompt").to_pylist()):
                    if chars:  # tokens of the prompt alone; a word across its end bears loss
                        head = body[i][:chars]
                        if chars < len(body[i]) and not body[i][chars].isspace():
                            head = head[:len(head) - len(head.split()[-1])] if (
                                head.split() and not head[-1].isspace()) else head
                        prompts[i] = len(tokenizer.packed([head], b"")[0]) // 4
                rows = []
                for pieces in pack(n, prompts, tokens, segments, loss):
                    offset = 0
                    for i, start, length in pieces:
                        bears = max(start + length - max(int(prompts[i]), start), 0)
                        rows.append((ids[i], start, length,
                                     packed[i][4 * start:4 * (start + length)], bears,
                                     int(n[i]), sequence, offset))
                        offset += length
                    sequence += 1
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.binary() if k == 3 else pa.int64())
                     for k, c in enumerate(columns)],
                    names=[x.split()[0] for x in SCHEMA.split(", ")])

    prompt = F.lit(0) if prompt_chars is None else F.coalesce(col(prompt_chars), F.lit(0))
    plain = docs.select(col(doc_id).cast("long").alias("doc_id"),
                        F.coalesce(col(text).cast("string"), F.lit("")).alias("text"),
                        prompt.cast("long").alias("prompt"))
    return plain.mapInArrow(run, SCHEMA)

"""Fill-in-middle transformation of documents, as a pyarrow.compute pipeline over code points."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import col, slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SLICE = 1 << 20   # text bytes worked on together
BLOCK = 1 << 20   # text bytes cut to code points at a time; a longer text takes several blocks


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64)


def _flat(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins and ends."""
    _, offsets, data = text.buffers()
    width = np.int64 if pa.types.is_large_string(text.type) else np.int32
    at = np.frombuffer(offsets, width)[text.offset:text.offset + len(text) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[at[0]:at[-1]], at - at[0]


def _blocks(raw: np.ndarray, at: np.ndarray) -> Iterator[tuple[pa.ListArray, np.ndarray, np.ndarray]]:
    """List arrays of code points, the row of each list, and the ordinal its first unit has."""
    lo, seen, last = 0, 0, -1
    while lo < len(raw):
        hi = min(lo + BLOCK, len(raw))
        while hi < len(raw) and raw[hi] & 0xC0 == 0x80:
            hi -= 1
        data = raw[lo:hi]
        starts = np.flatnonzero(data & 0xC0 != 0x80)
        units = pa.StringArray.from_buffers(
            len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int32)),
            pa.py_buffer(np.ascontiguousarray(data)))
        first, end = np.searchsorted(at, lo, "right") - 1, np.searchsorted(at, hi, "left")
        rows = np.arange(first, end)
        cuts = np.searchsorted(starts, np.clip(at[first:end + 1] - lo, 0, len(data)))
        before = np.zeros(len(rows), np.int64)
        if first == last:
            before[0] = seen
        last, seen = rows[-1], before[-1] + cuts[-1] - cuts[-2]
        yield pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), units), rows, before
        lo = hi


def _joined(rows: np.ndarray, parts: pa.Array, n_rows: int) -> pa.Array:
    """The parts of each row, in order, as one string; '' for a row without parts."""
    offsets = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n_rows))])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), parts), "")


def pieces(text: pa.Array, first: np.ndarray, second: np.ndarray) -> list[pa.Array]:
    """Prefix, middle and suffix of each text: units before ``first``, before ``second``, the rest."""
    found: list[list] = [[], [], []]
    for lists, rows, before in _blocks(*_flat(text)):
        units = pc.list_flatten(lists)
        parents = pc.list_parent_indices(lists)
        within = parents.to_numpy()
        ordinal = pa.array(np.arange(len(units)) - lists.offsets.to_numpy()[:-1][within]
                           + before[within])
        in_prefix = pc.less(ordinal, pa.array(first[rows]).take(parents))
        in_head = pc.less(ordinal, pa.array(second[rows]).take(parents))
        roles = (in_prefix, pc.and_not(in_head, in_prefix), pc.invert(in_head))
        for mask, out in zip(roles, found):
            out.append((rows, _joined(pc.filter(parents, mask).to_numpy(),
                                      pc.filter(units, mask), len(rows))))
    empty = (np.empty(0, np.int64), pa.array([], pa.string()))
    return [_joined(np.concatenate([r for r, _ in out or [empty]]),
                    pa.concat_arrays([p for _, p in out or [empty]]), len(text)) for out in found]


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 1,
              percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output of each row.

    n counts code points. The first four 8-digit groups of the hex sha256 of ``seed:doc_id`` decide:
    the first two, modulo n + 1, give the places of the cuts; the third leaves a document plain
    unless it is below ``percent`` modulo 100; the fourth below ``spm_percent`` puts the suffix
    first. An empty or null text, and one that contains a marker, stays plain.

    Nothing is shuffled. Repeated rows get the same output. A null id hashes as an empty one. Other
    columns are not looked at, an empty table gives no rows. A worker holds some copies of a slice
    of texts and the code points of one block, however long a text is.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(
        col(doc_id).cast("long").cast("string"), F.lit(""))), 256)
    plain = docs.select(
        col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(col(text).cast("string"), F.lit("")).alias("text"),
        *(F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}")
          for i in range(4)))

    def run(batches):
        for part in slices(batches, most=SLICE):
            texts = part.column("text")
            n = _numbers(pc.utf8_length(texts))
            h1, h2, h3, h4 = (_numbers(part.column(f"h{i}")) for i in range(1, 5))
            cuts = np.sort([h1 % (n + 1), h2 % (n + 1)], axis=0)
            as_is = (n == 0) | (h3 % 100 >= percent)
            for marker in (PREFIX, SUFFIX, MIDDLE):
                as_is |= pc.match_substring(texts, marker).to_numpy(zero_copy_only=False)
            head, middle, tail = pieces(texts, *cuts)
            spm = pa.array(h4 % 100 < spm_percent)
            plain_ = pa.array(as_is)
            output = pc.if_else(plain_, texts, pc.if_else(
                spm, pc.binary_join_element_wise(SUFFIX, tail, PREFIX, head, MIDDLE, middle, ""),
                pc.binary_join_element_wise(PREFIX, head, SUFFIX, tail, MIDDLE, middle, "")))
            form = pc.if_else(plain_, "plain", pc.if_else(spm, "spm", "psm"))
            none = pa.scalar(None, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n), form,
                 pc.if_else(plain_, none, pa.array(cuts[0])),
                 pc.if_else(plain_, none, pa.array(cuts[1] - cuts[0])), output],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return plain.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, "
                                 "middle_chars long, output string")


def _between(text: pa.Array, first: str, second: str) -> list[pa.Array]:
    """What stands after the marker at the start, after the next one, and after MIDDLE."""
    head = pc.utf8_replace_slice(text, 0, len(first), "")
    a, rest = _halves(head, second)
    return [a, *_halves(rest, MIDDLE)]


def _halves(text: pa.Array, marker: str) -> tuple[pa.Array, pa.Array]:
    """Each text before and after the first marker; all of it and '' where there is none."""
    split = pc.split_pattern(text, marker, max_splits=1)
    two = pc.equal(pc.list_value_length(split), 2)
    filled = pc.if_else(two, split, pa.array([["", ""]], split.type)[0])
    return pc.if_else(two, pc.list_element(filled, 0), text), pc.list_element(filled, 1)


def restore(transformed: DataFrame) -> DataFrame:
    """The rows with ``restored``, the text rebuilt from ``output`` and ``form`` alone.

    A null output or form gives null; a column already named ``restored`` is replaced.
    """
    rest = [c for c in transformed.columns if c != "restored"]
    schema = transformed.select(*map(col, rest)).schema.add("restored", "string")

    def run(batches):
        for part in slices(batches, "output", SLICE):
            out, form = part.column("output"), part.column("form")
            head, tail, middle = _between(out, PREFIX, SUFFIX)
            tail2, head2, middle2 = _between(out, SUFFIX, PREFIX)
            text = pc.if_else(
                pc.equal(form, "plain"), out, pc.if_else(
                    pc.equal(form, "psm"), pc.binary_join_element_wise(head, middle, tail, ""),
                    pc.binary_join_element_wise(head2, middle2, tail2, "")))
            yield pa.RecordBatch.from_arrays([*part.columns, text], names=[*rest, "restored"])

    return transformed.select(*map(col, rest)).mapInArrow(run, schema)

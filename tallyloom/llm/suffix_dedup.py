"""Removal of repeated byte strings by longest-previous-factor arrays, spread over the cluster.

A string of LENGTH bytes that occurs twice has the same anchor in both places: the position in it
of the least hash of a SEED-byte string. So positions are dealt by the seed at their anchor. All
starts with one anchor are a stretch of neighbouring starts; the bytes they cover are its span.

First, equal spans of a seed are matched: the later one is a copy in full, without another look at
its bytes. Then, for seeds with several different spans, the spans' bytes are fetched and their
starts are put in suffix order. The longest match of a start with any earlier one is with its
previous or next neighbour in that order that starts earlier in the corpus; a start whose longest
previous factor reaches LENGTH has its bytes removed. The starts of seeds with more than LARGE
spans are dealt by their strings instead, so no task holds such a seed.

A task first merges its own equal spans, so a passage that very many documents share is shuffled
once per task. The answer for it comes back to that task's rows.
"""

from __future__ import annotations

from hashlib import md5

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import SLICE_BYTES, col, slices, stored

LENGTH, SEED = 100, 20
REACH = LENGTH - SEED + 1  # seeds in a string of LENGTH bytes
NO_ID = -2**63
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_BYTE = np.random.default_rng(5).integers(0, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= _M2
    x ^= x >> np.uint64(29)
    return x


def _joined_hash(h: np.ndarray, have: int, want: int) -> np.ndarray:
    """Hashes of ``want`` bytes from those of ``have`` bytes (have <= want <= 2 have)."""
    gap = want - have
    return _mix(h[:len(h) - gap] * _M1 + h[gap:])


def seed_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the SEED bytes, and of the LENGTH bytes, from every position."""
    h, have = _BYTE[data], 1
    for want in (2, 4, 8, 16, SEED):
        h, have = _joined_hash(h, have, want), want
    seed = h
    for want in (40, 80, LENGTH):
        h, have = _joined_hash(h, have, want), want
    return seed, h


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:len(x) - step], x[step:])
        have += step
    return x


def stretches(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of starts that share an anchor: first start, number of starts, offset of the
    anchor from the first start, hash of the seed, hash of the span; for the bytes of one text."""
    if len(data) < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    h, whole = seed_hashes(data)
    least = _window_min(h, REACH)  # one per start
    # positions whose hash is least in some window that holds them
    pad = np.zeros(REACH - 1, np.uint64)
    spots = np.flatnonzero(~_window_min(~np.concatenate([pad, least, pad]), REACH) == h)
    # a start's anchor: the first spot at or after it with the least hash of its window
    at = np.searchsorted(spots, np.arange(len(least)))
    wrong = np.flatnonzero(h[spots[at]] != least)
    while len(wrong):  # the spot before belongs to earlier windows only
        at[wrong] += 1
        wrong = wrong[h[spots[at[wrong]]] != least[wrong]]
    anchor = spots[at]
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    last = np.append(first[1:], len(anchor)) - 1
    # the strings at both ends of a span cover it
    span = _mix(whole[first] * _M1 + whole[last]) ^ (last - first).astype(np.uint64)
    return first, last - first + 1, anchor[first] - first, h[anchor[first]], span


def repeated(strings: np.ndarray) -> np.ndarray:
    """Which of the strings (in order of place) have a longest previous factor of full length.

    In suffix order, the earlier match of a start is its previous or next neighbour with a smaller
    place. It reaches full length only within a run of neighbours whose common prefixes do, so a
    start has one exactly if its place is not the smallest of its run.
    """
    order = np.argsort(strings, kind="stable")
    ordered = strings[order]
    begins = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    least = np.minimum.reduceat(order, begins)
    out = np.empty(len(order), bool)
    out[order] = order > np.repeat(least, np.diff(np.append(begins, len(order))))
    return out


def _first_pass(docs: DataFrame) -> DataFrame:
    """Stretches of every text. Those that repeat an earlier span of the same task come out as
    covered, the others as open, with their seed as key."""
    def run(batches):
        kept = []
        for part in slices(batches):
            for doc, th, text in zip(*(part.column(c).to_pylist() for c in ("doc", "th", "text"))):
                first, count, off, seed, span = stretches(np.frombuffer(text.encode(), np.uint8))
                if len(first):
                    kept.append((seed.view(np.int64),
                                 (span.view(np.int64) & ~0xFFFF) | count << 8 | off,
                                 np.full(len(first), doc), th << 32 | first))
        if not kept:
            return
        seed, span, doc, place = (np.concatenate(c) for c in zip(*kept))
        kept.clear()
        order = np.lexsort((place, doc, span, seed))
        seed, span, doc, place = (c[order] for c in (seed, span, doc, place))
        new = np.concatenate([[True], (seed[1:] != seed[:-1]) | (span[1:] != span[:-1])])
        lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        same = (doc == doc[lead]) & (place == place[lead])
        use = np.flatnonzero(new | ~same)
        for some in np.array_split(use, max(1, len(use) // 50_000)):
            covered = ~new[some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.where(covered, doc[some] * 31 + place[some], seed[some])),
                 pa.array(span[some]), pa.array(doc[some]), pa.array(place[some]),
                 pa.array(covered)], names=["key", "span", "doc", "place", "covered"])

    return docs.mapInArrow(
        run, "key long, span long, doc long, place long, covered boolean")


def _second_pass(spans: DataFrame) -> DataFrame:
    """Merges equal spans of all tasks. Rows come sorted by key, span and place; only one row is
    held at a time. Later copies come out as covered; different spans of one seed as open."""
    names = ["key", "span", "doc", "place"]

    def run(batches):
        last = None  # the first row of the current span
        held = None  # the first span of the current seed, until it is known to be one of several
        for b in batches:
            covered = b.column("covered").to_numpy(zero_copy_only=False)
            cols = [b.column(c).to_numpy() for c in names]
            out = [[c[covered] for c in cols]]
            need = [np.zeros(len(out[0][0]), bool)]
            own = [c[~covered] for c in cols]
            key, span, doc, place = own
            if len(key):
                lead = last or (~key[0], 0, 0, 0)
                new_key = key != np.concatenate([[lead[0]], key[:-1]])
                new = new_key | (span != np.concatenate([[lead[1]], span[:-1]]))
                at = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
                copy = ~new & ((doc != np.where(at >= 0, doc[at], lead[2]))
                               | (place != np.where(at >= 0, place[at], lead[3])))
                firsts = np.flatnonzero(new)
                if len(firsts):
                    if held is not None and not new_key[firsts[0]]:
                        out.append([np.array([v], np.int64) for v in held])
                        need.append(np.ones(1, bool))
                    later = ~new_key[firsts]
                    several = later.copy()
                    several[:-1] |= later[1:]
                    out.append([c[firsts[several]] for c in own])
                    need.append(np.ones(int(several.sum()), bool))
                    last = tuple(int(c[firsts[-1]]) for c in own)
                    held = None if several[-1] else last
                out.append([c[copy] for c in own])
                need.append(np.zeros(int(copy.sum()), bool))
            key, span, doc, place = (np.concatenate(c) for c in zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(doc), pa.array(place >> 32),
                 pa.array((place & 0xFFFFFFFF).astype(np.int32)),
                 pa.array((span & 0xFFFF).astype(np.int16)), pa.array(np.concatenate(need))],
                names=["key", "doc", "th", "start", "shape", "need"])

    return spans.mapInArrow(
        run, "key long, doc long, th long, start int, shape short, need boolean")


def _finished(text: bytes, start: np.ndarray, length: np.ndarray) -> tuple:
    """n_bytes, n_removed, n_spans, kept bytes: the text without the given stretches."""
    edge = np.zeros(len(text) + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + length, -1)
    gone = np.cumsum(edge[:-1]) > 0
    runs = int(gone[:1].sum() + np.count_nonzero(gone[1:] & ~gone[:-1]))
    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
    return len(text), int(gone.sum()), runs, kept


_RESULT = "doc long, n_bytes long, n_removed long, n_spans long, kept binary"


def _packed(docs: DataFrame) -> DataFrame:
    """The texts as compressed bytes, for the way through a shuffle."""
    def run(batches):
        press = zstandard.ZstdCompressor(3)
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), part.column("th"),
                 pa.array([press.compress(t.encode()) for t in part.column("text").to_pylist()],
                          pa.binary())], names=["doc", "th", "text"])

    return docs.mapInArrow(run, "doc long, th long, text binary")


def _settle(docs: DataFrame) -> DataFrame:
    """Finishes the texts without open stretches; passes the others on with what they need."""
    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for part in slices(batches, most=SLICE_BYTES // 4):
            rows = []
            for doc, th, text, info in zip(*(part.column(c).to_pylist()
                                             for c in ("doc", "th", "text", "info"))):
                raw = unpack.decompress(text)
                a = np.frombuffer(b"".join(info or ()), _INFO)
                sure, open_ = a[a["need"] == 0], a[a["need"] == 1]
                if len(open_):
                    rows.append((doc, th, None, None, None, None, raw, sure.tobytes(),
                                 open_.tobytes()))
                else:
                    rows.append((doc, th, *_finished(
                        raw, sure["start"], (sure["shape"] >> 8) + LENGTH - 1), None, None, None))
            types = [pa.int64()] * 5 + [pa.binary()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                names=["doc", "th", "n_bytes", "n_removed", "n_spans", "kept", "raw", "sure",
                       "open"])

    return docs.mapInArrow(run, "doc long, th long, n_bytes long, n_removed long, n_spans long, "
                                "kept binary, raw binary, sure binary, open binary")


# One stretch of a text, as the second pass left it.
_INFO = np.dtype([("start", ">i4"), ("shape", ">i2"), ("key", ">i8"), ("need", ">i1")])


def _open_bytes(settled: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            rows = []
            for doc, th, raw, open_ in zip(*(b.column(c).to_pylist()
                                             for c in ("doc", "th", "raw", "open"))):
                for s in np.frombuffer(open_, _INFO):
                    start, shape = int(s["start"]), int(s["shape"])
                    rows.append((int(s["key"]), doc, th, start, shape,
                                 raw[start:start + (shape >> 8) + LENGTH - 1]))
            if rows:
                types = [pa.int64()] * 3 + [pa.int32(), pa.int16(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                    names=["key", "doc", "th", "start", "shape", "bytes"])

    return settled.mapInArrow(
        run, "key long, doc long, th long, start int, shape short, bytes binary")


# Spans whose starts are sorted together.
TOGETHER = 2_000
# Spans of a seed that one task holds at most, and tasks that the starts of one string are dealt to.
LARGE, SALTS = 4_000, 16


def _factors(spans: list[tuple]) -> list[tuple]:
    """Stretches (doc, th, start, length) whose starts have a longest previous factor of LENGTH.

    ``spans`` are whole groups of one seed each, by place within a group; LARGE spans at most.
    """
    number = np.cumsum([0] + [a[0] != b[0] for a, b in zip(spans, spans[1:])])
    shapes = np.array([s[4] for s in spans])
    counts = shapes >> 8
    data = np.frombuffer(b"".join(s[5] for s in spans), np.uint8)
    begin = np.concatenate([[0], np.cumsum([len(s[5]) for s in spans])[:-1]])
    windows = np.lib.stride_tricks.sliding_window_view(data, LENGTH)
    first = np.concatenate([[0], np.cumsum(counts)])
    span = np.repeat(np.arange(len(spans)), counts)
    strings = np.empty((len(span), LENGTH + 4), np.uint8)
    strings[:, :4] = number[span].astype(">u4").view(np.uint8).reshape(-1, 4)
    strings[:, 4:] = windows[begin[span] + np.arange(len(span)) - first[span]]
    marks = repeated(strings.view(f"S{LENGTH + 4}").ravel())
    edge = np.diff(np.concatenate([[0], marks.astype(np.int8), [0]]))
    inner = first[1:-1]  # a run ends with its span
    both = inner[marks[inner - 1] & marks[inner]]
    lows = np.sort(np.concatenate([np.flatnonzero(edge == 1), both]))
    highs = np.sort(np.concatenate([np.flatnonzero(edge == -1), both]))
    at = np.searchsorted(first, lows, side="right") - 1
    return [(spans[i][1], spans[i][2], spans[i][3] + x, n + LENGTH - 1) for i, x, n in
            zip(at.tolist(), (lows - first[at]).tolist(), (highs - lows).tolist())]


def _third_pass(spans: DataFrame) -> DataFrame:
    def made(spans):
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(list(zip(*_factors(spans))) or [[]] * 4, types)],
            names=["doc", "th", "start", "length"])

    def run(batches):
        ready: list[tuple] = []  # whole groups
        group: list[tuple] = []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if group and row[0] != group[0][0]:
                    if ready and len(ready) + len(group) > TOGETHER:
                        yield made(ready)
                        ready = []
                    ready += group
                    group = []
                if not group or row[1:4] != group[-1][1:4]:
                    group.append(row)
        for spans in ([ready, group] if len(ready) + len(group) > TOGETHER else [ready + group]):
            if spans:
                yield made(spans)

    return spans.mapInArrow(run, "doc long, th long, start int, length int")


def _large_seeds(settled: DataFrame) -> DataFrame:
    """key of the seeds with more than LARGE open spans: few, at most spans / LARGE."""
    def run(batches):
        for b in batches:
            for open_ in b.column("open").to_pylist():
                keys = np.frombuffer(open_, _INFO)["key"].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys)], names=["key"])

    return (settled.select("open").mapInArrow(run, "key long").groupBy("key")
            .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > LARGE).select("key"))


def _starts(spans: DataFrame) -> DataFrame:
    """Every start of the spans: key, digest of its string (a, b), doc, place, salt."""
    def run(batches):
        for b in batches:
            for part in slices(iter([b]), "bytes", SLICE_BYTES // 64):
                rows = []
                for key, doc, th, start, shape, data in zip(*(c.to_pylist()
                                                              for c in part.columns)):
                    for x in range(shape >> 8):
                        d = md5(data[x:x + LENGTH]).digest()
                        rows.append((key, int.from_bytes(d[:8], "big", signed=True),
                                     int.from_bytes(d[8:], "big", signed=True), doc,
                                     th << 32 | start + x))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in list(zip(*rows)) or [[]] * 5],
                    names=["key", "a", "b", "doc", "place"])

    return spans.mapInArrow(run, "key long, a long, b long, doc long, place long").withColumn(
        "salt", F.pmod(F.xxhash64("doc", "place"), F.lit(SALTS)).cast("int"))


def _by_string(spans: DataFrame) -> DataFrame:
    """Like the third pass, but dealt by string: a start goes if its place is not the least of its
    string. Least places are found before the shuffle, so a string of many starts is no large
    group; its starts are dealt to SALTS tasks."""
    starts = _starts(spans)
    place = F.struct("doc", "place")
    least = (starts.groupBy("key", "a", "b").agg(F.min(place).alias("least"),
                                                 F.max(place).alias("most"))
             .filter("least <> most")
             .select("key", "a", "b", "least",
                     F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    return starts.join(least, ["key", "a", "b", "salt"]).filter(place > F.col("least")).select(
        "doc", F.shiftright("place", 32).alias("th"),
        F.col("place").bitwiseAND(0xFFFFFFFF).cast("int").alias("start"),
        F.lit(LENGTH).alias("length")).distinct()


def _close(docs: DataFrame) -> DataFrame:
    def run(batches):
        for part in slices(batches, "raw"):
            rows = []
            for doc, raw, sure, more in zip(*(part.column(c).to_pylist()
                                              for c in ("doc", "raw", "sure", "more"))):
                a = np.frombuffer(sure, _INFO)
                b = np.frombuffer(b"".join(more or ()), [("start", ">i4"), ("length", ">i4")])
                rows.append((doc, *_finished(
                    raw, np.concatenate([a["start"], b["start"]]).astype(np.int64),
                    np.concatenate([(a["shape"] >> 8) + LENGTH - 1, b["length"]]).astype(np.int64))))
            types = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                names=["doc", "n_bytes", "n_removed", "n_spans", "kept"])

    return docs.mapInArrow(run, _RESULT)


def removed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes).

    Every byte covered by a string of LENGTH bytes that also starts earlier (smaller id, or same
    document and earlier start) goes; matches overlap freely, never cross documents and are judged
    on the texts as given. Null is the empty text; texts shorter than LENGTH stay whole. Rows that
    repeat id and text are one document at one place and get the same answer; of different texts
    with one id, or a null id (before all others), the hash of the text decides which is earlier.
    An empty table gives an empty result. Other columns are not looked at.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    body = F.coalesce(col(text).cast("string"), F.lit(""))
    plain = docs.select(F.coalesce(col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc"),
                        F.shiftrightunsigned(F.xxhash64(body), 40).alias("th"), body.alias("text"))
    merged = _second_pass(_first_pass(plain).repartition(parts, "key").sortWithinPartitions(
        "key", "span", "doc", "place"))
    coded = F.concat(*[F.unhex(F.lpad(F.right(F.hex(c), F.lit(w)), w, "0")) for c, w in (
        ("start", 8), ("shape", 4), ("key", 16), (F.col("need").cast("int"), 2))])
    info = merged.groupBy("doc", "th").agg(F.collect_list(coded).alias("info"))
    joined = _packed(plain).join(info, ["doc", "th"], "left").select("doc", "th", "text", "info")
    settled = stored(_settle(joined), "settled")
    open_ = settled.filter(F.col("raw").isNotNull())
    spans = _open_bytes(open_.select("doc", "th", "raw", "open"))
    large = F.broadcast(stored(_large_seeds(open_), "large"))
    more = _third_pass(spans.join(large, "key", "left_anti").repartition(parts, "key")
                       .sortWithinPartitions("key", "doc", "th", "start"))
    more = more.unionByName(_by_string(spans.join(large, "key", "left_semi")))
    pair = F.concat(*[F.unhex(F.lpad(F.right(F.hex(c), F.lit(8)), 8, "0"))
                      for c in ("start", "length")])
    more = more.groupBy("doc", "th").agg(F.collect_list(pair).alias("more"))
    rest = _close(open_.join(more, ["doc", "th"], "left").select("doc", "raw", "sure", "more"))
    names = ["doc", "n_bytes", "n_removed", "n_spans", "kept"]
    result = settled.filter(F.col("raw").isNull()).select(*names).unionByName(rest.select(*names))
    return result.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), *names[1:])
